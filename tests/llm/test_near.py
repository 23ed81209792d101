import random
import re
from collections import Counter

import numpy as np

from anchorline.llm.common import stored
from anchorline.llm.components import components
from anchorline.llm.decontaminate import decontaminate, mark_contamination
from anchorline.llm.neardup import estimate, merge_sketches, near_duplicates, sketches
from anchorline.llm.words import U, mix
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = names.get(find(i), d) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return Counter(out)


def test_mirrored_words_have_their_own_hashes(spark):
    """Thue-Morse words, which agree modulo 2**64 under any odd base, are different words to every operator that hashes them."""
    from anchorline.llm.substrings import remove_repeats
    from anchorline.llm.words import Words

    a = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    assert len(set(Words(data, np.array([0, len(data)]), lower=False).hashes.tolist())) == 2
    docs = spark.createDataFrame([(1, " ".join([a] * 13)), (2, " ".join([b] * 13))], "doc_id long, text string")
    assert [r.kept for r in near_duplicates(docs, k=2).collect()] == [True, True]
    assert [r.n_removed for r in remove_repeats(docs, window=13).collect()] == [0, 0]
    items = spark.createDataFrame([(9, " ".join([b] * 6))], "item_id long, text string")
    assert {r.doc_id: len(r.matches) for r in mark_contamination(docs, items).collect()} == {1: 0, 2: 1}


def test_words_hash_alike_wherever_they_stand():
    """A word's hash depends on its bytes alone, also beyond the bytes whose sums need reducing."""
    from anchorline.llm import words as module

    text = ("zz " * 50 + "word \u00e9\u00e9 " + "x" * 300 + " ") * 40
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, len(data)])
    seen = {}
    for limit in (1 << 24, 1):
        old, module._UNREDUCED = module._UNREDUCED, limit
        w = module.Words(data, at, lower=False)
        module._UNREDUCED = old
        for i, h in enumerate(w.hashes.tolist()):
            assert seen.setdefault(w.text(i), h) == h
    assert len(set(seen.values())) == len(seen) == 4


def test_components_take_few_rounds(spark, monkeypatch):
    """A path with ascending ids takes rounds in the order of its logarithm."""
    from anchorline.llm import components as module

    written = []
    monkeypatch.setattr(module, "stored", lambda df: written.append(1) or stored(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert len({got[i] for i in range(201)}) == 1 and got[500] == got[501] != got[0]
    assert len(written) < 2 * 16


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for k in (2, 5):
        got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(edge_docs, k=k).collect())
        assert got == brute(rows, k)
    assert near_duplicates(no_docs).count() == 0


def test_groups_and_chains(spark):
    """Copies with edits around and under the threshold, and chains of which only neighbours are linked."""
    rng = random.Random(4)
    rows, n = [], 0
    for g in range(6):
        base = sentence(1000 + g, 120).split()
        for c in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 14)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(w)))
            n += 1
    chain = sentence(77, 100).split()
    for _ in range(30):
        rows.append((n, " ".join(chain)))
        n += 1
        chain = chain[4:] + [f"y{rng.randrange(10**6)}" for _ in range(4)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 5):
        got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k=k).collect())
        assert got == brute(rows, k)


def test_sketches():
    """Registers merge to the union's, and the joint likelihood finds the similarity."""
    rng = np.random.default_rng(0)
    for j in (0.3, 0.8, 0.95):
        n = 600
        both = int(2 * n * j / (1 + j))
        pool = mix(rng.integers(0, 2**63, 2 * n - both).astype(U))
        a, b = np.sort(pool[:n]), np.sort(pool[n - both :])
        sa, sb, union = sketches([a, b, np.union1d(a, b)], 256)
        assert merge_sketches(sa, sb) == union
        r = [np.frombuffer(s, ">u2").astype(np.int32)[None, :] for s in (sa, sb)]
        assert abs(estimate(*r, np.array([n]), np.array([n]))[0] - both / (2 * n - both)) < 0.12


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    seen = set()
    for n in near:
        if n not in seen:
            group, todo = set(), [n]
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += near[x]
            seen |= group
            assert len({got[x] for x in group}) == 1
    assert set(got) == set(near)


def letters(text, k=5):
    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_contamination(spark, edge_docs, no_docs):
    rng = random.Random(2)
    items = [(i, sentence(500 + i, rng.choice([3, 6, 9, 14, 30, 60, 130]))) for i in range(40)] + [(98, None), (99, ""), (None, "x")]
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for i, text in items[:40]:
        w = text.split()
        host = sentence(900 + i, rng.choice([5, 300, 4000])).split()
        at = rng.randrange(len(host))
        cut = rng.choice([0, 0, 1, len(w) // 10, len(w) // 4])
        docs.append((1000 + i, " ".join(host[:at] + w[cut:] + host[at:])))
        docs.append((2000 + i, text.upper() + "!"))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, t in docs:
        w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (t or "").translate(LOWER))
        for i, x in items:
            q = letters(x)
            n = len(next(iter(q))) if len(q) == 1 else 5
            # An item shorter than a shingle is found wherever its words stand in a row.
            s = letters(t) if n >= 5 else {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
            if q and len(q & s) >= 0.8 * len(q) and (n < 5 or len(w) >= 5):
                want[d, i, len(q), len(q & s)] += 1
    for block in (1_000_000, 400):
        out = mark_contamination(df, bench, block_shingles=block)
        assert out.columns == ["doc_id", "text", "item_id", "matches"]
        got = Counter((r.doc_id, m.item_id, m.item_shingles, m.shared) for r in out.collect() for m in r.matches)
        assert got == want
    clean = decontaminate(df, bench)
    hit = {d for d, *_ in want}
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - hit
    assert clean.columns == df.columns
    assert decontaminate(no_docs, bench).count() == 0
    assert decontaminate(df, bench.where("false")).count() == df.count()
