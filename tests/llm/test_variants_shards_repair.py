import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from anchorline.llm import queries, repair, sharding, variants
from anchorline.llm.common import stored

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    """n: words with their counts."""
    out = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        top = min(near, key=lambda x: (-n[x], x), default=None)
        form = top if top is not None and n[top] >= 5 * n[w] else None
        out[w] = [n[w], len(near), form, n[form] if form else None]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def brute_words(rows, damage, least_n=5):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if damage and h % damage == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 6:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_n}


def variants_of(docs, damage, **options):
    vocabulary = variants.count_words(variants.words_of(docs, damage=damage), least_n=5)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in variants.group_variants(vocabulary, **options).collect()}


def test_variants_on_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for damage in (None, 7):
        assert variants_of(edge_docs, damage, least_frequent=2) == brute_variants(brute_words(rows, damage))
    assert variants_of(no_docs, 199) == {}


@pytest.mark.parametrize("options", [{"least_frequent": 1}, {"least_frequent": 3, "longest": 4}, {"least_frequent": 2, "max_grams": 40}, {"least_frequent": 10**6}])
def test_variants_against_all_pairs(spark, options):
    """Dense words over few letters, with repeated grams, umlauts and ties, under several dictionaries."""
    r = random.Random(3)
    words = {"".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(250)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababab", "abcabcabc", "ab÷abab"}
    n = {w: r.choice([5, 6, 25, 30, 125, 700]) for w in words}
    vocabulary = stored(spark.createDataFrame(list(n.items()), "word string, n long"))
    got = {x.word: (x.n, x.n_near, x.form, x.form_n, x.root) for x in variants.group_variants(vocabulary, **options).collect()}
    assert got == brute_variants(n)


def test_bounds_hold_for_every_edit():
    """No edit of any word affects more of its grams than its bound says."""
    r = random.Random(5)
    words = ["".join(r.choice("ab") for _ in range(r.randint(6, 10))) for _ in range(60)]
    count = Counter(g for w in words for q in range(3, 7) for g in {w[i : i + q] for i in range(len(w) - q + 1)})
    kept = {g: c for g, c in count.items() if len(g) == 3 or (count[g[:-1]] > 12 and r.random() < 0.7)}
    kept = {g: c for g, c in kept.items() if len(g) == 3 or all(g[:i] in kept for i in range(3, len(g)))}
    d = variants.Dictionary.of(kept, 3)
    for w in words:
        grams = d.grams(w)
        changed, inserted = d.bounds(w, grams)
        named = {(p, w[p:e]) for p, e in grams}
        for i in range(len(w) + 1):
            for x in "ab":
                edits = [(w[:i] + x + w[i:], 1, inserted)]
                if i < len(w):
                    edits += [(w[:i] + w[i + 1 :], -1, changed), (w[:i] + x + w[i + 1 :], 0, changed)]
                for other, moved, bound in edits:
                    there = {(p, other[p:e]) for p, e in d.grams(other)}
                    kept_grams = sum((p, g) in there if p + len(g) <= i else (p + moved, g) in there for p, g in named)
                    assert len(named) - kept_grams <= bound, (w, other)


# --- sharding


def brute_difference(sizes, k):
    parts = [sorted([s] + [0] * (k - 1), reverse=True) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1], reverse=True)
        a, b = parts[0], parts[1]
        parts = [sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True), *parts[2:]]
    return parts[0]


def test_differencing():
    r = random.Random(1)
    for k in (2, 3, 16):
        sizes = sorted({r.randint(1, 10**6) for _ in range(50)}, reverse=True)
        to, sums = sharding.difference(sharding._whole(sharding.np.array(sizes), k))
        assert sorted(sums.tolist(), reverse=True) == brute_difference(sizes, k)
        again = Counter()
        for s, t in zip(sizes, to[:, 0].tolist(), strict=True):
            again[t] += s
        assert [again[i] for i in range(k)] == sums.tolist()
    assert sorted(sharding.difference(sharding._whole(sharding.np.array([4, 5, 6, 7, 8]), 2))[1].tolist()) == [14, 16]  # the textbook case


def check_shards(df, shards, **options):
    text = {}
    for r in df.collect():
        text.setdefault((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())), []).append(r.text or "")
    out = sharding.shard_by_bytes(df, shards=shards, **options).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter({k: len(v) for k, v in text.items()})
    of_text, slots, sums = defaultdict(set), defaultdict(list), Counter()
    for r in out:
        of_text[r.size, r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
    assert all(len(v) == 1 for v in of_text.values()) and all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return [sums[i] for i in range(shards)]


def test_shards_on_edges(edge_docs, no_docs):
    check_shards(edge_docs, 4)
    assert sharding.shard_by_bytes(no_docs, shards=4).count() == 0
    assert check_shards(edge_docs.where("doc_id = 26"), 4)[1:].count(0) >= 2  # one group fills one shard


def test_levels_balance_around_a_heavy_group(spark):
    """Copies of one text hold a third of all bytes; the other shards share the rest evenly, through several levels."""
    r = random.Random(7)
    rows = [(i, "x" * r.randint(1, 900) + str(i)) for i in range(6000)]
    rest = sum(len(t) + 1 for _, t in rows)
    copy = "y" * 99
    rows += [(10_000 + i, copy) for i in range(rest // 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for options in ({}, {"block_groups": 50, "fan": 8, "weights": 600}):
        sums = sorted(check_shards(df, 8, **options))
        assert sums[-1] == rest // 200 * 100  # the copies alone
        assert sums[-2] - sums[0] <= 0.003 * sums[0]


def test_shards_without_heavy_groups(spark):
    df = spark.createDataFrame([(i, "z" * (i * 7919 % 1000)) for i in range(8000)], "doc_id long, text string")
    sums = check_shards(df, 16, block_groups=100, fan=4)
    assert max(sums) - min(sums) <= 2000


# --- conversation repair


def brute_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def brute_repair(roles, faults):
    """The cheapest (cost, audit) by trying everything, with inserts of up to two turns anywhere."""
    best = (10**9, "")

    def legal(s):
        return re.fullmatch("(s?(ua)*u?)?", s) is not None

    def go(i, made, cost, audit, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(roles) and re.fullmatch("(s?(ua)+)?", made):
            best = min(best, (cost, audit))
        if inserts < 2:
            for x in "ua":
                if legal(made + x):
                    go(i, made + x, cost + 3, audit + "I", inserts + 1)
        if i < len(roles):
            go(i + 1, made, cost + 4, audit + "D", 0)
            if faults[i] not in ("b", "d"):
                stays = 3 * (faults[i] == "t")
                if roles[i][:1] and legal(made + roles[i][:1]):
                    go(i + 1, made + roles[i][:1], cost + stays, audit + "K", 0)
                for x in "ua":
                    if legal(made + x):
                        go(i + 1, made + x, cost + stays + 3, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def apply(rows, audit):
    out, made, at = [], "", 0
    for edit in audit:
        expected = "a" if made.endswith("u") else "u"
        if edit == "I":
            out.append(f"{repair.ROLES[expected]}:")
            made += expected
            continue
        _, role, text = rows[at]
        at += 1
        if edit == "K":
            out.append(f"{role}:{text}")
            made += role[:1]
        elif edit == "R":
            out.append(f"{repair.ROLES[expected]}:{text}")
            made += expected
    assert at == len(rows) and re.fullmatch("(s?(ua)+)?", made)
    return out


def parse(roles, faults):
    c = repair._Conversation(repair.Parser())
    for i, (role, f) in enumerate(zip(roles, faults, strict=True)):
        c.add(i, role[:1], f)
    return c.result()


def test_parser_against_everything():
    for n in range(4):
        for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=n):
            for faults in itertools.product(("", "b", "t"), repeat=n):
                got = parse(roles, faults)
                assert (got[5], got[6]) == brute_repair(roles, faults), (roles, faults)
    r = random.Random(2)
    for _ in range(150):
        n = r.randint(4, 6)
        roles, faults = [r.choice(("system", "user", "assistant", "tool", "")) for _ in range(n)], [r.choice(("", "", "", "d", "t")) for _ in range(n)]
        got = parse(roles, faults)
        assert (got[5], got[6]) == brute_repair(roles, faults), (roles, faults)


def test_long_conversations_take_few_fronts():
    parser = repair.Parser()
    c = repair._Conversation(parser)
    r = random.Random(9)
    for i in range(30_000):
        c.add(i, r.choice("suat"), r.choice(("", "", "b", "t")))
    assert len(c.result()[6]) >= 30_000 and len(parser.known) < 20_000


def brute_conversations(rows):
    """rows: (conv, turn, role, text, present)."""
    groups = defaultdict(list)
    for conv, turn, role, text, present in rows:
        groups[conv] += [(turn, role or " " if role is None else role, " " if text is None else text)] if present else []
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        faults = brute_faults(own)
        turns = {t for t, _, _ in own if t is not None}
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = brute_repair([role for _, role, _ in own], faults)
        made = "\n".join(apply(own, audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(made.encode()).hexdigest())
    return out


def repaired(rows):
    repairs = stored(repair.find_repairs(rows))
    made = {r.conv_id: r.sha256 for r in repair.digests(repair.repaired_turns(rows, repairs)).collect()}
    return {r.conv_id: (*r[1:], made.get(r.conv_id, hashlib.sha256(b"").hexdigest())) for r in repairs.collect()}


def test_repair_edges(spark):
    rows = [
        (1, 0, "user", "Hi.", True, 1), (1, 1, "assistant", "Yes.", True, 1),
        (2, 5, "assistant", "b.", True, 1), (2, None, "user", "a.", True, 1), (2, None, None, None, True, 1), (2, 9, "user", "a.", True, 1), (2, 9, "user", "a.", True, 1),
        (3, 0, "user", "gone", False, 1), (4, 0, "system", "s only.", True, 1), (4, 1, "system", "s only.", False, 1),
        (None, 1, "user", " \t\n", True, 1), (None, None, "tool", "no end", True, 1), (None, 4, "", "x!  \n", True, 1),
        (5, 1, "user", "word. " * 50_000, True, 1), (5, 2, "user", "word " * 50_000, True, 1), (5, 2, "user", "word " * 50_000, True, 1), (6, 1, "user", "same", True, 1), (7, 1, "user", "same", True, 1),
        (8, None, "user", "q?", True, 1), (8, None, "assistant", "!", None, 1),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, present boolean, audit int")
    assert repaired(df) == brute_conversations([r[:5] for r in rows])
    assert repaired(df.where("false")) == {}


def test_op13_against_brute_force(spark):
    rows = []
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        row = (r.conv_id, r.turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text, fault != 0)
        rows += [row] * (2 if fault == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_structure_repair(spark, DATA).collect()}
    assert got == brute_conversations(rows)


def test_op12_whole_table(spark):
    out = queries.op12_sharding(spark, DATA)
    assert out.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    sums = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert out.count() == docs.count() and len(sums) == 16 and max(sums) - min(sums) < 100
