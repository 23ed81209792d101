import numpy as np
from pyspark.sql import functions as F

from anchorline.operators import fuse


def brute_offset(onsets, motion, hop=10, max_lag=300):
    if len(onsets) < 2 or len(motion) < 3:
        return False, 0.0
    n = int(np.ceil((max(t for t, _ in onsets + motion) + 100) / hop)) + 1
    o, m = np.zeros(n), np.zeros(n)
    for t, s in onsets:
        o[round(t / hop)] = max(o[round(t / hop)], s)
    for t, e in motion:
        m[round(t / hop)] = e
    smooth = lambda x: np.array([sum(x[j] for j in (i - 1, i, i + 1) if 0 <= j < n) / 3 for i in range(n)])
    o, m = smooth(o), smooth(m)
    d = np.array([m[i] - m[max(0, i - 1)] for i in range(n)])
    scores = []
    for lag in range(-max_lag // hop, max_lag // hop + 1):
        pairs = [(o[i], d[i + lag]) for i in range(n) if 0 <= i + lag < n]
        a, b = (np.array(x) for x in zip(*pairs, strict=True))
        a, b = a - a.mean(), b - b.mean()
        scores.append(round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-9)), 9))
    best = scores.index(max(scores))
    return True, float((best - max_lag // hop) * hop)


def test_offsets_and_shifts(spark):
    """A clip whose motion follows by 120 ms, one in time, and clips with too little to tell."""
    rng = np.random.default_rng(1)
    onsets, motion = {}, {}
    for clip, lag in (("late", 120), ("in_time", 0), ("early", -200)):
        at = sorted(rng.choice(400, 12, replace=False) * 10 + 500)
        onsets[clip] = [(float(t), float(s)) for t, s in zip(at, rng.uniform(1, 2, 12), strict=True)]
        motion[clip] = [(float(t + lag), 5.0) for t, _ in onsets[clip]]
    onsets |= {"one": [(5.0, 1.0)], "still": [(5.0, 1.0), (90.0, 1.0)]}
    motion |= {"one": motion["late"], "still": [(5.0, 1.0), (7.0, 1.0)]}
    a = spark.createDataFrame([(c, t, s) for c, rows in onsets.items() for t, s in rows], "clip string, t_ms double, strength double")
    b = spark.createDataFrame([(c, i, t, e) for c, rows in motion.items() for i, (t, e) in enumerate(rows)], "clip string, seq long, t_ms double, energy double")
    estimates = fuse.estimate_offset(a, b)
    got = {r.clip: r for r in estimates.collect()}
    for c in onsets:
        assert (got[c].available, got[c].offset_ms) == brute_offset(onsets[c], motion[c]), c
    assert abs(got["late"].offset_ms - 120) <= 20 and got["late"].confidence > 0.5 and got["one"].confidence == 0
    moved = fuse.shift(a, estimates, ["t_ms"])
    by = {r.clip: r.shifted_ms for r in moved.select("clip", "shifted_ms").distinct().collect()}
    assert by["late"] == got["late"].offset_ms and by["one"] == by["still"] == 0
    assert {r.clip for r in fuse.shift(a, estimates, ["t_ms"], least_confidence=2.0).where("shifted_ms != 0").collect()} == set()
    assert moved.where("clip = 'late'").agg(F.min("t_ms")).first()[0] == onsets["late"][0][0] + by["late"]


def test_fusion_keeps_what_each_stream_knows(spark):
    """An onset stands for an event and keeps its class; speech takes over an onset and its end; lists are kept in order."""
    onsets = spark.createDataFrame([("a", 1, "audio_onset", 1000.0, 0.9, ["hf"], 12.0), ("a", 2, "audio_onset", 1500.0, 0.5, None, None)], "clip string, seq long, kind string, t_ms double, strength_norm double, bands array<string>, snr_db double")
    sed = spark.createDataFrame([("a", 3, "sed_event", 990.0, 0.4, "Glass", "impact"), ("a", 4, "sed_event", 1530.0, 0.7, "Speech", "speech")], "clip string, seq long, kind string, t_ms double, prob double, class string, group string")
    speech = spark.createDataFrame([("a", 5, "speech_start", 1560.0, "hello", 1900)], "clip string, seq long, kind string, t_ms double, transcript string, end_ms long")
    visual = spark.createDataFrame(
        [("a", 1, "cut", 1080.0, None, None), ("a", 2, "cut", 1010.0, None, None), ("a", 3, "flash", 1590.0, None, None), ("a", 4, "motion", 5000.0, None, None), ("a", 5, "intensity_change", 6000.0, 9.0, "up"), ("a", 6, "cut", 7000.0, None, None)],
        "clip string, seq long, kind string, t_ms double, delta double, direction string",
    )
    rows = fuse.fuse([onsets, sed, speech], visual, fuse.Reach()).orderBy("id").collect()
    assert [(r.id, r.kind, r.n_merged) for r in rows] == [("a000", "audio_onset", 2), ("a001", "speech_start", 3), ("a002", "intensity_change", None), ("a003", "cut", None)]
    first, second, change, cut = rows
    assert [(x["class"], x.prob) for x in first.sed] == [("Glass", 0.4)] and first.sources == ["cut", "sed"] and first.visual_support.cut_dt_ms == -10 and first.bands == ["hf"]
    assert abs(first.score - (0.35 * 0.9 + 0.3 * 0.4 + 0.15 * 0.6 + 0.15 + 0.05)) < 1e-9 and first.near_cut_ms == 1010
    assert second.transcript == "hello" and [x["class"] for x in second.sed] == ["Speech"] and second.visual_support is None and second.sources == ["flash", "sed"]
    assert change.low_confidence is None and cut.low_confidence and change.score is None
    assert fuse.fuse([onsets.limit(0)], visual.limit(0), fuse.Reach()).count() == 0
