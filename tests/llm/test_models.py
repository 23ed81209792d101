import cProfile
import itertools
import math
import pstats
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from anchorline.llm import pitman_yor, toxicity
from anchorline.llm.words import mix, pieces
from tests.llm.conftest import sentence
from tests.llm.test_near import LOWER, WORD


def test_scores_match_counts(spark, edge_docs, no_docs):
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    learnt = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2
    rows = [(r.doc_id, WORD.findall((r.text or "").translate(LOWER)) + [None]) for r in edge_docs.collect()]
    c = Counter(w for d, ws in rows if learnt(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((d, learnt(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for d, ws in rows)
    out = pitman_yor.score(edge_docs, train=train).collect()
    assert Counter((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert pitman_yor.score(no_docs, train=train).count() == 0
    alone = pitman_yor.score(edge_docs, train=F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and abs(r.score) < 1e-9 for r in alone)


def test_score_beats_single_words_and_is_a_distribution(spark):
    """Held-out texts of a language with strong pairs get better scores than from single words."""
    rng = np.random.default_rng(0)
    follow = {i: rng.integers(0, 60, 3) for i in range(60)}

    def text(n):
        w, out = 0, []
        for _ in range(n):
            w = int(follow[w][rng.integers(3)]) if rng.random() < 0.9 else int(rng.integers(60))
            out.append(f"w{w}")
        return " ".join(out)

    df = spark.createDataFrame([(i, text(80)) for i in range(200)], "doc_id long, text string")
    out = pitman_yor.score(df, train=F.col("doc_id") < 150).where("NOT train").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert out[0] > 0.75 * out[1]


def test_rare_contexts_are_seated(spark):
    """A context seen once among many tokens tells the words after it; their order counts, not only their number."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 60))) for i in range(300)]
    rows += [(300, "alpha beta gamma delta"), (301, "alpha beta gamma delta"), (302, "gamma alpha delta beta")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.score for r in pitman_yor.score(df, train=F.col("doc_id") <= 300).where("NOT train").collect()}
    assert out[301] > out[302] + 2


def _log_rising(x, n, d):
    return sum(math.log(x + d * i) for i in range(n))


def _brute_force(tokens, base):
    """Mean predictive probabilities of all (room, before, word) over every seating, weighted exactly."""
    stirling = {d: np.exp(pitman_yor.log_stirling(d, 8)) for d in pitman_yor.DISCOUNT}
    (_, d1, d2), (_, s1, s2) = pitman_yor.DISCOUNT, pitman_yor.STRENGTH
    dishes = sorted(Counter(tokens).items())
    total, weight = Counter(), 0.0
    for t2 in itertools.product(*(range(1, n + 1) for _, n in dishes)):
        c1 = Counter()
        for ((r, _, w), _), t in zip(dishes, t2, strict=True):
            c1[r, w] += t
        up = sorted(c1)
        for t1 in itertools.product(*(range(1, c1[x] + 1) for x in up)):
            all2, cust2, all1, cust1 = Counter(), Counter(), Counter(), Counter()
            log = 0.0
            for ((r, b, _), n), t in zip(dishes, t2, strict=True):
                all2[r, b] += t
                cust2[r, b] += n
                log += math.log(stirling[d2][n, t])
            for (r, w), t in zip(up, t1, strict=True):
                all1[r] += t
                cust1[r] += c1[r, w]
                log += math.log(stirling[d1][c1[r, w], t]) + t * math.log(base[w])
            log += sum(_log_rising(s2, all2[x], d2) - _log_rising(s2, cust2[x], 1) for x in all2)
            log += sum(_log_rising(s1, all1[x], d1) - _log_rising(s1, cust1[x], 1) for x in all1)
            p = math.exp(log)
            weight += p
            tables1 = dict(zip(up, t1, strict=True))
            for ((r, b, w), n), t in zip(dishes, t2, strict=True):
                one = (c1[r, w] - d1 * tables1[r, w] + (s1 + d1 * all1[r]) * base[w]) / (s1 + cust1[r])
                total[r, b, w] += p * (n - d2 * t + (s2 + d2 * all2[r, b]) * one) / (s2 + cust2[r, b])
    return {k: v / weight for k, v in total.items()}


def test_gibbs_against_every_seating():
    """The mean predictive probability over many sweeps is that over all seatings of a small corpus."""
    tokens = [(1, 1, 0)] * 3 + [(1, 1, 1)] + [(1, 2, 0)] * 2 + [(1, 2, 2)] * 2 + [(2, 1, 1)] * 3 + [(2, 1, 0)]
    base = np.array([0.5, 0.2, 0.1])
    want = _brute_force(tokens, base)
    room, before, word = (mix(np.array(x, np.uint64) + np.uint64(9)) for x in zip(*tokens, strict=True))
    names = {int(mix(np.array([i], np.uint64) + np.uint64(9))[0]): i for i in range(3)}
    r = pitman_yor.Restaurants(room, before, word, np.ones(len(tokens), bool))
    by_word = base[[names[int(k)] for k in r.words.keys]]
    rng, total, n = np.random.default_rng(0), 0, 6000
    for i in range(n + 200):
        r.sweep(by_word, rng)
        if i >= 200:
            total = total + r.levels(by_word)[1]
    got = dict(zip(tokens, (total / n)[r.token].tolist(), strict=True))
    assert set(got) == set(want)
    assert all(abs(math.log(got[k] / want[k])) < 0.06 for k in want), (got, want)


def test_root_against_every_seating():
    """The empty context's mean of customers less discounted tables is that over all seatings."""
    c, types = np.array([3, 1, 4]), 5
    d, a = pitman_yor.DISCOUNT[0], pitman_yor.STRENGTH[0]
    stirling = np.exp(pitman_yor.log_stirling(d, 8))
    want, weight = np.zeros(3), 0.0
    for t in itertools.product(*(range(1, n + 1) for n in c)):
        p = math.exp(_log_rising(a, sum(t), d)) * math.prod(stirling[n, x] for n, x in zip(c, t, strict=True)) / (types + 1) ** sum(t)
        want, weight = want + p * (c - d * np.array(t)), weight + p
    got, _ = pitman_yor.seat_root(c, types, 1.0, np.random.default_rng(1), 50, 4000)
    assert np.abs(got - want / weight).max() < 0.06


def test_large_dishes_are_seated_alike():
    """Leaps give the table numbers of seating customer by customer."""
    rng = np.random.default_rng(5)
    fast = pitman_yor.seat(np.full(400, 300), np.full(400, 7.0), 0.8, rng).mean()
    slow = []
    for _ in range(400):
        t = 1
        for i in range(1, 300):
            t += rng.random() < 7.0 / (7.0 + i - 0.8 * t)
        slow.append(t)
    assert abs(fast - np.mean(slow)) < 1.5


def test_predictions_sum_to_one():
    """Over all known types and the unknown one, the probabilities of a context sum to one, as those of a word with several restaurants do."""
    rng = np.random.default_rng(1)
    n, types = 4000, 40
    last, before, word = (mix(rng.integers(0, k, n).astype(np.uint64) + np.uint64(100)) for k in (3, 5, types))
    every = mix(np.arange(types, dtype=np.uint64) + np.uint64(100))
    context = np.full(types, last[0]), np.full(types, before[0])
    setup = pitman_yor.Setup(np.array([1], np.uint64), np.array([last[0]]), np.array([4]), np.array([9]), 1, n, types, 1, 1, 1)
    row = rng.integers(0, 90, n)
    room = setup.rooms(np.append(before, context[1]), np.append(last, context[0]), np.append(row, np.full(types, row[0])))
    assert len(set(room[:n].tolist())) > 3
    r = pitman_yor.Restaurants(room, np.append(before, context[1]), np.append(word, every), np.append(np.ones(n, bool), np.zeros(types, bool)))
    base = np.full(len(r.words), 1 / (types + 1))
    for _ in range(3):
        r.sweep(base, rng)
    p = r.levels(base)[1][r.token[n:]]
    at = r.token[n]
    room1, room2 = r.room1.of[r.up[at]], r.room2.of[at]
    one = (pitman_yor.STRENGTH[1] + pitman_yor.DISCOUNT[1] * r.all_t1[room1]) * base[0] / (pitman_yor.STRENGTH[1] + r.all_c1[room1])
    unknown = (pitman_yor.STRENGTH[2] + pitman_yor.DISCOUNT[2] * r.all_t2[room2]) * one / (pitman_yor.STRENGTH[2] + r.all_c2[room2])
    assert abs(p.sum() + unknown - 1) < 1e-9


def test_groups_agree(spark):
    """Groups and split restaurants change scores little; the number of partitions and the code book change nothing."""
    rows = [(i, sentence(i % 40, 80)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    run = lambda d, **o: {r.doc_id: r for r in pitman_yor.score(d, train=F.col("doc_id") % 7 != 2, **o).collect()}
    whole = run(df)
    assert {k: v.score for k, v in run(df.repartition(3), book=5).items()}.keys() == whole.keys()
    for other in (run(df.coalesce(1), book=3), run(df, group_bytes=5000), run(df, limit=200, group_bytes=9000)):
        assert all(abs(other[k].base_score - whole[k].base_score) < 1e-5 and other[k].n_known == whole[k].n_known and other[k].n_tokens == whole[k].n_tokens for k in whole)
        assert abs(sum(x.score for x in other.values()) / sum(x.score for x in whole.values()) - 1) < 0.1
    same = run(df.coalesce(1), book=3)
    assert all(abs(same[k].score - whole[k].score) < 1e-5 for k in whole)


def test_sizes_of_groups_and_places_change_no_score(spark):
    """The same scores in one group and in many, with words and pairs in one place and dealt over many."""
    rows = [(i, sentence(i % 90, 80) + " of the" * (i % 7)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    run = lambda **o: {r.doc_id: r for r in pitman_yor.score(df, train=F.col("doc_id") % 7 != 2, **o).collect()}
    whole = run()
    for o in ({"group_bytes": 3000}, {"group_bytes": 7000, "limit": 40}, {"limit": 200}, {"group_bytes": 5000, "limit": 100, "chunk_bytes": 2000}):
        other = run(**o)
        assert other.keys() == whole.keys()
        assert max(abs(other[k].score - whole[k].score) for k in whole) < 1e-4, o
        assert all(abs(other[k].base_score - whole[k].base_score) < 1e-4 and other[k].n_known == whole[k].n_known for k in whole), o


def test_places(spark):
    assert pitman_yor.places(np.array([0, 5, 100, 101, 950]), 100).tolist() == [1, 1, 1, 2, 10]
    df = spark.createDataFrame([(i, sentence(i, 50)) for i in range(40)], "doc_id long, text string")
    plans = [pitman_yor.score(df, train=F.lit(True), limit=n)._jdf.queryExecution().analyzed().toString() for n in (1 << 20, 30)]
    assert [p.count("reply(") > 0 for p in plans] == [False, True]


def test_a_desk_seats_what_one_place_would():
    """Dishes put together from reports have the counts and probabilities of the whole restaurant, pairs dealt by row included."""
    rng = np.random.default_rng(2)
    last, before, word = np.full(3000, 7, np.uint64), *(mix(rng.integers(0, k, 3000).astype(np.uint64)) for k in (4, 30))
    setup = pitman_yor.Setup(np.array([1], np.uint64), np.array([7], np.uint64), np.array([3]), np.array([9]), 1, 3000, 30, 1, 1, 2)
    whole = pitman_yor.Dishes(last, before, word, np.ones(3000, bool))
    c1 = np.bincount(whole.up, whole.c2 > 0, len(whole.keys1)).astype(int)
    one = pitman_yor.settle(whole.keys1, c1, whole.room1.of, 1, np.full(len(c1), 1 / 31), setup.draws(1), setup.burn, setup.keep)
    two = pitman_yor.settle(whole.keys2, whole.c2, whole.room2.of, 2, one[whole.up], setup.draws(2), setup.burn, setup.keep)
    parts = [pitman_yor.Dishes(x[0], x[1], x[2], np.ones(1000, bool)) for x in (tuple(a[i::3] for a in (last, before, word)) for i in range(3))]
    bodies = []
    for d in parts:
        w = d.words.keys[d.words.of]
        bodies.append(pitman_yor.squeeze(w, np.zeros(len(w), np.int32), d.before2, w[d.up], d.c2))
    desk = pitman_yor.Desk(np.uint64(7), bodies)
    assert desk.c1.sum() == c1.sum() and desk.c2.sum() == 3000
    for d, (p1, p2) in zip(parts, desk.seated(np.full(len(desk.words), 1 / 31), setup), strict=True):
        assert np.allclose(p1, one[np.searchsorted(whole.keys1, d.keys1)], rtol=1e-12)
        assert np.allclose(p2, two[np.searchsorted(whole.keys2, d.keys2)], rtol=1e-12)


def test_settle_against_every_seating():
    """Mean predictive probabilities under a given parent are those over all seatings, and those of a restaurant sum to one."""
    c, parent = np.array([4, 1, 2, 3, 0]), np.array([0.3, 0.25, 0.2, 0.15, 0.1])
    d, s = pitman_yor.DISCOUNT[2], pitman_yor.STRENGTH[2]
    stirling = np.exp(pitman_yor.log_stirling(d, 8))
    want, weight = np.zeros(5), 0.0
    for t in itertools.product(*(range(1, n + 1) if n else (0,) for n in c)):
        p = math.exp(_log_rising(s, sum(t), d)) * math.prod(stirling[n, x] * q**x for n, x, q in zip(c, t, parent, strict=True))
        want, weight = want + p * (c - d * np.array(t) + (s + d * sum(t)) * parent) / (s + c.sum()), weight + p
    got = pitman_yor.settle(mix(np.arange(5, dtype=np.uint64) + np.uint64(3)), c, np.zeros(5, int), 2, parent, np.random.default_rng(0), 50, 6000)
    assert np.abs(np.log(got / (want / weight))).max() < 0.03
    assert abs(got.sum() - 1) < 1e-9


def test_binomial():
    keys = mix(np.arange(40_000, dtype=np.uint64))
    for n, p in ((1, 0.3), (9, 0.9), (60, 0.5), (500, 0.02), (500, 0.4), (70, 1.0), (3000, 0.97)):
        k = pitman_yor.binomial(np.full(len(keys), n), np.full(len(keys), p), keys, pitman_yor.salts(np.random.default_rng(n), 2))
        sd = math.sqrt(n * p * (1 - p))
        assert k.min() >= 0 and k.max() <= n and abs(k.mean() - n * p) <= sd / 40 and abs(k.std() - sd) <= sd / 40


def _level(n: int, rooms: int):
    """(keys, customers, restaurants, parents' probabilities) of n dishes, most of them small, some of over 256 customers."""
    rng = np.random.default_rng(4)
    c = np.minimum(rng.zipf(1.6, n) - (rng.random(n) < 0.1), 5000)
    return mix(np.arange(n, dtype=np.uint64)), c, rng.integers(0, rooms, n), rng.random(n) ** 4 + 1e-9


def test_settle_draws_as_dish_by_dish_formulas_do():
    """Dishes drawn in lots of like sizes get what ``reseat`` draws for one number of customers at a time."""
    (keys, c, room, parent), level, burn, keep = _level(3000, 40), 2, 2, 3
    d, strength, rng = pitman_yor.DISCOUNT[level], pitman_yor.STRENGTH[level], np.random.default_rng(5)
    t, total = (c > 0).astype(np.int64), np.zeros(len(c))
    totals, customers = (np.bincount(room, x, 40).astype(np.int64) for x in (t, c))
    many = np.flatnonzero(c > 1)
    for i in range(burn + keep):
        for half in (0, 1):
            sel = many[(keys[many] & np.uint64(1)) == half]
            pitman_yor.reseat(sel, c, t, room, totals, d, strength, lambda x, n: np.log(parent[x])[:, None] * np.arange(1, n + 1), lambda x: parent[x], rng, keys)
        if i >= burn:
            total += c - d * t + (strength + d * totals[room]) * parent
    assert (c > pitman_yor.EXACT).any() and (c == 0).any() and len(np.unique(c)) > 50
    got = pitman_yor.settle(keys, c, room, level, parent, np.random.default_rng(5), burn, keep)
    assert np.allclose(got, total / keep / (strength + customers[room]), rtol=1e-11)
    none = np.zeros(0, np.int64)
    assert len(pitman_yor.settle(keys[:0], none, none, level, parent[:0], rng, burn, keep)) == 0


def _calls(run) -> int:
    """Function calls made, a measure of work that no other load on the machine changes."""
    profile = cProfile.Profile()
    profile.runcall(run)
    return pstats.Stats(profile).total_calls


def test_seating_takes_few_calls():
    """Dishes of like sizes and all tries of a step are drawn together: 50,450 calls, where one size and one try at a time took 174,699."""
    keys, c, room, parent = _level(20_000, 300)
    pitman_yor.log_stirling(pitman_yor.DISCOUNT[2])
    assert _calls(lambda: pitman_yor.settle(keys, c, room, 2, parent, np.random.default_rng(1), 2, 2)) < 100_000


def test_dealing_takes_few_calls():
    """Blocks are slices of arrays laid out once: 102 calls for each, where gathering each alone took 143."""
    rng = np.random.default_rng(6)
    text = " ".join(f"w{x}" for x in rng.zipf(1.3, 20_000))
    words = next(pieces(pa.RecordBatch.from_arrays([pa.array([text, None, "a b", "", text])], ["text"]), "text", lower=True))[1]
    book, groups = np.unique(words.hashes)[::2], 200
    setup = pitman_yor.Setup(np.append(book, [pitman_yor.START, pitman_yor.END]), np.array([pitman_yor.START]), np.array([1]), np.array([5]), groups, 40_000, 9, 5, 1, 1)
    learn = np.array([True, False, True, True, False])
    made = list(pitman_yor.Group.blocks(words, 10, learn, setup))
    assert _calls(lambda: list(pitman_yor.Group.blocks(words, 10, learn, setup))) < 120 * len(made)
    # What the blocks hold is every token once, in its text's order, and every text's first token.
    token, one, two, row = pitman_yor.tokens(words)
    assert (setup.codes(token) == [{w: i for i, w in enumerate(setup.book.tolist())}.get(w, 0xFFFF) for w in token.tolist()]).all()
    want = Counter(zip((10 + row).tolist(), learn[row].tolist(), two.tolist(), one.tolist(), token.tolist(), strict=True))
    got, firsts = Counter(), []
    for g, body, first in made:
        group = pitman_yor.Group(pa.table({"base": [10], "body": pa.array([body], pa.binary())}), setup)
        assert (setup.rooms(group.before, group.last, group.row) % np.uint64(groups) == g).all() and (np.diff(group.row) >= 0).all()
        got.update(zip(*(x.tolist() for x in (group.row, group.learn, group.before, group.last, group.word)), strict=True))
        firsts.extend(first.tolist())
    assert got == want and sorted(firsts) == [0, 1, 2, 3, 4]


def test_documents_that_occur_twice_stand_apart(spark):
    rows = [(i, sentence(i, 120)) for i in range(150)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 150, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.perplexity for r in pitman_yor.score(df, train=F.lit(True)).collect()}
    assert max(out[i] for i in range(0, 150, 10)) < min(out[i] for i in range(150) if i % 10)


def test_order_of():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3000):
        for keys in (rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 9, n).astype(np.uint64) << np.uint64(60), rng.integers(0, 1 << 11, n).astype(np.uint64)):
            assert (keys[pitman_yor.order_of(keys)] == np.sort(keys)).all()


def test_toxicity(spark, edge_docs, no_docs):
    rude = ["idiot", "zwerfol", "grumpf"]
    rows = [(i, sentence(i, 50) + (f" {rude[i % 3]}{'' if i % 2 else 'ish'} you" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    model = toxicity.fit(df, labels, learn_from=F.col("doc_id") % 5 != 0)
    out = toxicity.score(df, model).where("doc_id % 5 = 0").collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in out)
    edges = toxicity.score(edge_docs, model)
    assert edges.columns == [*edge_docs.columns, "score"]
    assert all(0 <= r.score <= 1 for r in edges.collect()) and edges.count() == edge_docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.fit(df, labels.where("toxic = 1"), learn_from=F.lit(True)) is None
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}


def _kneser_ney(words, counts):
    """log10 likelihoods of an expression's letters by the class's own counts, those of both classes and letter pairs, in plain dictionaries."""
    node, kinds = {}, {}
    follow = Counter()
    for w, (a, b) in zip(words, counts, strict=True):
        letters = w + b"\0" if len(w) < toxicity.DEPTH else w
        for j in range(len(letters)):
            at = letters[: j + 1]
            if at not in node:
                follow[letters[j - 1] if j else 0, letters[j]] += 1
            n = node.setdefault(at, [0, 0, 0])
            for c, x in enumerate((a, b, a + b)):
                n[c] += x
    d = []
    for c in range(3):
        ones, twos = (sum(n[c] == k for n in node.values()) for k in (1, 2))
        d.append(ones / (ones + 2 * twos) if ones and twos else 0.75)
    total = [sum(n[c] for at, n in node.items() if len(at) == 1) for c in range(3)]
    for at, n in node.items():
        k = kinds.setdefault(at[:-1], [0, 0, 0])
        for c in range(3):
            k[c] += min(n[c], d[c])
    every = sum(follow.values())
    first, distinct, single = Counter(), Counter(), Counter()
    for (p, x), n in follow.items():
        first[p] += n
        distinct[p] += 1
        single[x] += n

    def pair(p, x):
        return (max(follow[p, x] - 0.75, 0) + (0.75 * distinct[p] + 1e-3) * (single[x] + 0.5) / (every + 128)) / (first[p] + 1e-3)

    def share(c, at, x):
        n = node.get(at, total if not at else None)
        lean = toxicity.SHARED if c < 2 else 0
        if n is None or n[c] + lean == 0:
            return 0.0, 1.0
        return max(node.get(at + x, [0, 0, 0])[c] - d[c], 0) / (n[c] + lean), (kinds.get(at, [0, 0, 0])[c] + lean) / (n[c] + lean)

    def ratio(w):
        letters, out = (w + b"\0" if len(w) < toxicity.DEPTH else w[: toxicity.DEPTH]), 0.0
        for j in range(len(letters)):
            at, x = letters[:j], letters[j : j + 1]
            both = share(2, at, x)
            low = both[0] + both[1] * pair(letters[j - 1] if j else 0, letters[j])
            p = [own + left * low for own, left in (share(c, at, x) for c in (0, 1))]
            out += math.log10(p[0] / p[1])
        return out

    return ratio


def test_ratios_are_kneser_ney():
    words = [b"idiot", b"idiotic", b"the", b"then", b"that", b"moron", b"donaudampfschi", "stupidit\u00e9".encode()]
    counts = np.array([[5, 0], [1, 0], [40, 90], [2, 7], [0, 1], [2, 1], [1, 2], [1, 0]])
    brute = _kneser_ney(words, counts)
    model = toxicity.fit_counts(words, counts)
    ask = [*words, b"idiots", b"thus", b"x", b"moronic", b"donaudampfsche", b"stupid"]
    data = np.frombuffer(b"".join(ask), np.uint8)
    end = np.cumsum([len(w) for w in ask])
    got = model.ratios(toxicity._letters(data, end - [len(w) for w in ask], end))
    assert np.abs(got - [brute(w) for w in ask]).max() < 1e-4


def test_held_out_accuracy_on_given_tables(spark):
    """Of the labelled documents that were held out, most toxic ones are found and few clean ones are lost."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxicity.fit(docs, labels, learn_from=learn)
    asked = docs.join(labels.where(~learn & F.col("toxic").isNotNull()), "doc_id").select("doc_id", "toxic", "text")
    out = toxicity.score(asked, model).select("toxic", "score").collect()
    toxic, clean = [r.score >= 0.5 for r in out if r.toxic], [r.score >= 0.5 for r in out if not r.toxic]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) < 0.01, (np.mean(toxic), np.mean(clean), len(toxic), len(clean))


def test_toxicity_reads_runs_to_their_end(spark):
    """What is toxic after a long beginning counts: in a text without ASCII separators, and in words alike at first."""
    rng = np.random.default_rng(2)
    some = lambda n: "".join(chr(0x4E00 + int(x)) for x in rng.integers(0, 400, n))
    for rude, kind in (("\u767d\u75f4\u5783\u573e", "\u4eca\u5929\u5929\u6c14"), ("donaudampfschiffidiot", "donaudampfschifffahrt")):
        text = lambda x: f"{some(60)}\u3002{x}\u3002{some(40)}" if x > "z" else f"{sentence(int(rng.integers(900)), 30)} {x} {sentence(1, 9)}"  # noqa: B023, E731
        rows = [(i, text(kind if i % 4 else rude), int(i % 4 == 0)) for i in range(400)]
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.fit(df, df.select("doc_id", "toxic"), learn_from=F.col("doc_id") % 5 != 0)
        out = toxicity.score(df, model).where("doc_id % 5 = 0").collect()
        assert all((r.score >= 0.5) == bool(r.toxic) for r in out)
