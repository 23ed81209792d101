import numpy as np

from anchorline.operators import evaluate
from anchorline.operators.assign import solve


def brute_pairs(p, g, collar):
    """(i, j, distance) of the largest matching of least total distance."""
    if not p or not g:
        return []
    d = np.abs(np.array(p)[:, None] - np.array(g)[None, :])
    cost = np.where(d <= collar, d, 1e6)
    flip = len(p) > len(g)
    pairs = solve(cost.T if flip else cost)
    out = [(j, i) if flip else (i, j) for i, j in enumerate(pairs.tolist())]
    return [(i, j, d[i, j]) for i, j in out if d[i, j] <= collar]


def test_evaluation_against_whole_matrices(spark):
    rng = np.random.default_rng(4)
    pred, gold, want, errors, tp = [], [], {}, [], 0
    for c in range(4):
        p, g = sorted(rng.uniform(0, 3000, 12).tolist()), sorted(rng.uniform(0, 3000, 0 if c == 2 else 9).tolist())
        pred += [(f"c{c}", 100 * c + i, t, t + 50 if i % 2 else None) for i, t in enumerate(p)]
        gold += [(f"c{c}", 100 * c + i, t, t + 70) for i, t in enumerate(g)]
        wide, narrow = brute_pairs(p, g, 200), brute_pairs(p, g, 50)
        e = [x for _, _, x in wide]
        errors += e
        tp += len(narrow)
        want[f"c{c}"] = (len(p), len(g), len(wide), len(narrow), round(sum(e), 6))
    a = spark.createDataFrame(pred, "clip string, id long, t_ms_f double, t_end_ms_f double")
    b = spark.createDataFrame(gold, "clip string, id long, onset_ms double, offset_ms double")
    out = {r.clip: r for r in evaluate.evaluate(a, b).collect()}
    for c, (n_pred, n_gold, n_wide, n_narrow, total) in want.items():
        r = out[c]
        assert (r.n_pred, r.n_gold, r.n_matched, r.tp, r.fp, r.fn) == (n_pred, n_gold, n_wide, n_narrow, n_pred - n_narrow, n_gold - n_narrow)
        assert round((r.mean_error or 0) * n_wide, 6) == total
    whole = out[None]
    # Matchings of equal total may differ pair by pair: figures are held against the pairs that were chosen.
    assert whole.n_matched == len(errors) and abs(whole.mean_error - np.mean(errors)) < 1e-9
    errors = [r.error for r in evaluate.one_to_one(a, b, 200).collect()]
    assert whole.n_matched == len(errors) and abs(whole.median_error - np.median(errors)) < 1e-9 and abs(whole.p90_error - np.percentile(errors, 90)) < 1e-9
    assert whole.tp == tp and abs(whole.precision - tp / 48) < 1e-9 and abs(whole.pct_within_20 - 100 * np.mean(np.array(errors) <= 20)) < 1e-9
    assert (out["c2"].precision, out["c2"].recall, out["c2"].f1, out["c2"].median_error, out["c2"].pct_within_200) == (0, 0, 0, None, 0)
    assert 0 < whole.n_offsets < whole.n_matched
    assert {r.clip: r.n_pred for r in evaluate.evaluate(a.limit(0), b.limit(0)).collect()} in ({}, {None: 0})


def test_classes_match_their_own(spark):
    p = spark.createDataFrame([("a", 1, 100, "x"), ("a", 2, 120, "y")], "clip string, id long, t_ms long, label string")
    g = spark.createDataFrame([("a", 7, 119.0, "x"), ("a", 8, 101.0, "z")], "clip string, id long, onset_ms double, label string")
    assert {(r.pred, r.gold) for r in evaluate.one_to_one(p, g, 50).collect()} == {(1, 8), (2, 7)}
    assert {(r.pred, r.gold, r.error) for r in evaluate.one_to_one(p, g, 50, by_class=True).collect()} == {(1, 7, 19.0)}
