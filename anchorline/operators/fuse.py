"""One timeline of anchors out of several streams: clustering, visual support, scores, neighbours, ids.

Streams have columns of their own; what one lacks is null in the others. All times are in
the unit of ``t_ms``. A row of an audio stream is (clip, seq, kind, t_ms, ...), ``seq``
giving the order of ties; a visual row is (clip, seq, kind, t_ms, delta, direction).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorline.functions.numeric import clamp, half_even, or_else
from anchorline.operators.folds import fold
from anchorline.operators.joins import Lookup, nearest_lookups

#: Columns of an audio anchor and their types, in order.
AUDIO = {
    "clip": "string", "seq": "bigint", "kind": "string", "stem": "string", "t_ms": "double", "strength": "double", "strength_norm": "double", "prob": "double", "class": "string", "group": "string",
    "bands": "array<string>", "snr_db": "double", "rise_time_ms": "double", "end_ms": "bigint", "t_end_ms": "double", "end_reliable": "boolean", "transcript": "string", "on_music_beat": "boolean",
    "sed": "array<struct<class:string,prob:double,group:string>>", "sources": "array<string>",
}
#: Columns that a cluster's representative takes from its other rows where it has none; the last only when it takes another's place.
FILLED = ("transcript", "end_ms", "on_music_beat", "bands", "sed", "t_end_ms", "end_reliable", "snr_db", "sources")
FILLED_BY_RANK = (*FILLED, "rise_time_ms")
#: Weights of an anchor's score, and the strength and the SNR that count as full.
WEIGHTS = {"onset": 0.35, "sed": 0.30, "snr": 0.15, "visual": 0.15, "beat": 0.05}
FULL_STRENGTH, FULL_SNR = 10.0, 20.0
MOTION = ("motion", "motion_spike", "motion_stop")


def rank_of(kind: Column, prob: Column, strength_norm: Column) -> Column:
    """Which of two close rows stands for both: speech, likely events, onsets, other events, boundaries, cuts, the rest."""
    p = F.coalesce(prob, F.lit(0.0))
    return F.when(kind == "speech_start", 50.0).when((kind == "sed_event") & (p > 0.5), 40 + p).when(kind == "audio_onset", 30 + F.coalesce(strength_norm, F.lit(0.0))).when(kind == "sed_event", 25.0).when(kind == "music_boundary", 20.0).when(kind == "cut", 10.0).otherwise(0.0)


def unite(streams: Sequence[DataFrame]) -> DataFrame:
    """All audio streams with the columns of AUDIO; what a stream lacks is null."""
    own = [s.select(*[(F.col(c) if c in s.columns else F.lit(None)).cast(t).alias(c) for c, t in AUDIO.items()]) for s in streams]
    return reduce(DataFrame.unionByName, own)


def _sorted_sources(*parts: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts])))


def cluster(audio: DataFrame, tol: float) -> DataFrame:
    """One row for each cluster: its representative, filled from the others, with ``n_merged``.

    Rows come by time, then rank. A row within ``tol`` of the representative so far joins its cluster; one of higher
    rank takes its place and its time. What an event says of its class stays, also where an onset stands for it.
    """
    hint = lambda x: F.array(F.struct(x["class"].alias("class"), x["prob"].alias("prob"), x["group"].alias("group")))
    known = lambda x: F.when(F.size(x["sed"]) > 0, x["sed"]).otherwise(hint(x))
    near = lambda s, r: F.abs(r["t_ms"] - s["s_t_ms"]) <= tol
    wins = lambda s, r: r["rank"] > s["s_rank"]
    was = lambda s: {c: s[f"s_{c}"] for c in ("class", "prob", "group", "sed")}

    def filled(c: str) -> Callable[[Column, Column], Column]:
        def following(s: Column, r: Column) -> Column:
            old, new = s[f"s_{c}"], r[c]
            if c not in FILLED_BY_RANK:
                taken, kept = new, old
            else:
                taken, kept = F.coalesce(new, old), F.coalesce(old, new) if c in FILLED else old
            bare = F.size(F.coalesce(r["sed"], s["s_sed"], F.array().cast(AUDIO["sed"]))) == 0
            if c == "sed":
                taken = F.when((s["s_kind"] == "sed_event") & bare, known(was(s))).otherwise(taken)
                kept = F.when(r["kind"] == "sed_event", known(r)).otherwise(kept)
            if c == "sources":
                taken = F.when((s["s_kind"] == "sed_event") & bare, _sorted_sources(taken, F.array(F.lit("sed")))).otherwise(taken)
                kept = F.when(r["kind"] == "sed_event", _sorted_sources(old, F.when(old.isNull(), new), F.array(F.lit("sed")))).otherwise(kept)
            return F.when(~near(s, r), new).when(wins(s, r), taken).otherwise(kept)

        return following

    state = {f"s_{c}": (t, filled(c), lambda r, c=c: r[c]) for c, t in AUDIO.items() if c != "clip"}
    state["s_rank"] = ("double", lambda s, r: F.when(near(s, r) & ~wins(s, r), s["s_rank"]).otherwise(r["rank"]), lambda r: r["rank"])
    state["n_merged"] = ("bigint", lambda s, r: F.when(near(s, r), s["n_merged"] + 1).otherwise(1), lambda r: F.lit(1))
    ranked = audio.withColumn("rank", rank_of(F.col("kind"), F.col("prob"), F.col("strength_norm")))
    out = fold(ranked, ["clip"], [F.col("t_ms"), -F.col("rank"), F.col("seq")], state, gap=("t_ms", "t_ms", tol))
    # The last row of a cluster holds its state: the next row, if any, begins a new one.
    order = Window.partitionBy("clip").orderBy("t_ms", -F.col("rank"), "seq")
    last = F.coalesce(F.lead("n_merged").over(order) == 1, F.lit(True))
    return out.withColumn("__last", last).where("__last").select("clip", *[F.col(f"s_{c}").alias(c) for c in AUDIO if c != "clip"], "n_merged")


def attach_visual(audio: DataFrame, visual: DataFrame, tol: float) -> DataFrame:
    """Audio anchors with what they see, and the visual rows that no audio anchor is near, in one table.

    Each visual row goes to the nearest audio anchor within ``tol``, the earlier of two; of several of a kind the last
    counts. Of rows left alone plain motion goes, and all but changes of intensity are marked as uncertain.
    """
    right = audio.select("clip", F.col("seq").alias("a"), F.col("t_ms").alias("a_t"))
    found = nearest_lookups(visual, right, ["clip"], "a_t", ["a_t", "a"], [Lookup("t_ms", tol, {"a": "a", "a_t": "a_t"})])
    dt = half_even(F.col("a_t") - F.col("t_ms"))
    of = lambda *kinds: F.col("kind").isin(*kinds)
    last = lambda value, *kinds: F.max_by(F.when(of(*kinds), value), F.when(of(*kinds), F.col("seq")))
    seen = found.where("a IS NOT NULL").groupBy(F.col("clip").alias("v_clip"), F.col("a").alias("v_a")).agg(
        last(dt, "motion_stop").alias("motion_stop_dt_ms"), last(dt, "motion_spike", "motion").alias("motion_spike_dt_ms"), last(dt, "cut").alias("cut_dt_ms"),
        last(dt, "intensity_change").alias("intensity_change_dt_ms"), last(F.col("delta"), "intensity_change").alias("intensity_delta"), last(F.col("direction"), "intensity_change").alias("intensity_direction"),
        F.collect_set("kind").alias("v_kinds"),
    )
    support = F.struct("motion_stop_dt_ms", "motion_spike_dt_ms", "cut_dt_ms", "intensity_change_dt_ms", "intensity_delta", "intensity_direction")
    joined = audio.join(seen, (F.col("clip") == F.col("v_clip")) & (F.col("seq") == F.col("v_a")), "left")
    sources = F.when(F.col("v_kinds").isNull(), F.col("sources")).otherwise(_sorted_sources(F.col("sources"), F.col("v_kinds")))
    heard = joined.select(*[sources.alias(c) if c == "sources" else F.col(c) for c in audio.columns], F.when(F.coalesce("motion_stop_dt_ms", "motion_spike_dt_ms", "cut_dt_ms", "intensity_change_dt_ms").isNotNull(), support).alias("visual_support"), F.lit(False).alias("visual_only"), F.lit(None).cast("boolean").alias("low_confidence"))
    alone = found.where("a IS NULL AND kind != 'motion'")
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in heard.schema}
    given = {"clip": F.col("clip"), "seq": F.col("seq"), "kind": F.col("kind"), "t_ms": F.col("t_ms").cast("double"), "visual_only": F.lit(True), "low_confidence": F.when(F.col("kind") != "intensity_change", True)}
    return heard.unionByName(alone.select(*[given[c].alias(c) if c in given else none[c] for c in heard.columns]))


def score_of() -> Column:
    """An audio anchor's score out of its strength, class, SNR, visual support and beat."""
    onset = or_else(F.coalesce("strength_norm", F.lit(0.0)), F.least(F.lit(1.0), F.coalesce("strength", F.lit(0.0)) / FULL_STRENGTH))
    best = F.array_max(F.transform("sed", lambda x: F.coalesce(x["prob"], F.lit(0.0))))
    sed = F.when(F.size("sed") > 0, best).when(F.col("kind") == "sed_event", F.coalesce("prob", F.lit(0.0))).otherwise(0.0)
    snr = clamp(F.coalesce("snr_db", F.lit(0.0)) / FULL_SNR, 0.0, 1.0)
    seen, beat = F.col("visual_support").isNotNull().cast("double"), F.coalesce("on_music_beat", F.lit(False)).cast("double")
    return WEIGHTS["onset"] * onset + WEIGHTS["sed"] * sed + WEIGHTS["snr"] * snr + WEIGHTS["visual"] * seen + WEIGHTS["beat"] * (1 - beat)


def default_sources() -> Column:
    """What an anchor comes from, where its detector did not say."""
    bands = F.when(F.size("bands") > 0, F.transform("bands", lambda b: F.concat(F.lit("superflux_"), b))).otherwise(F.array(F.lit("superflux")))
    one = lambda word, such: F.when(such, F.array(F.lit(word)))
    return _sorted_sources(F.when(F.col("kind") == "audio_onset", bands), one("sed", (F.col("kind") == "sed_event") | (F.size("sed") > 0)), one("asr", F.col("kind") == "speech_start"))


@dataclass(frozen=True)
class Reach:
    """Fixed values, in ms: how near rows of one cluster, visual support, and named cuts and motion are."""

    cluster: float = 40
    visual: float = 100
    near: float = 300


def fuse(audio: Sequence[DataFrame], visual: DataFrame, reach: Reach) -> DataFrame:
    """Numbered anchors (``id`` a000, a001, ... by time) of all audio streams and a visual one."""
    both = attach_visual(cluster(unite(audio), reach.cluster), visual, reach.visual)
    t = half_even(F.col("t_ms"))
    scored = both.withColumns({"t": t, "score": F.when(~F.col("visual_only"), score_of()), "sources": F.when(~F.col("visual_only"), F.coalesce("sources", default_sources()))})
    times = visual.select("clip", F.col("kind").alias("v_kind"), half_even(F.col("t_ms").cast("double")).alias("v_t"), F.col("seq").alias("v_seq"))
    lookups = [Lookup("t", reach.near, {"near_cut_ms": "v_t"}, among=F.col("v_kind") == "cut"), Lookup("t", reach.near, {"near_motion_peak_ms": "v_t"}, among=F.col("v_kind").isin(*MOTION))]
    near = nearest_lookups(scored, times, ["clip"], "v_t", ["v_seq"], lookups)
    n = F.row_number().over(Window.partitionBy("clip").orderBy("t_ms", "visual_only", "seq")) - 1
    return near.withColumn("id", F.format_string("a%03d", n)).drop("t")


ESTIMATE = "clip string, available boolean, offset_ms double, confidence double, max_corr double"


def estimate_offset(onsets: DataFrame, motion: DataFrame, *, hop: float = 10, max_lag: float = 300, tail: float = 100, least: int = 8) -> DataFrame:
    """(clip, available, offset_ms, confidence, max_corr): by how much a clip's motion follows its onsets.

    ``onsets``: (clip, t_ms, strength); ``motion``: (clip, seq, t_ms, energy). Both become curves of one value a hop (the
    strongest onset, the last motion), smoothed over three; motion is differenced; the lag of largest correlation (to nine decimals)
    wins, the first of equal ones. The confidence is how far it stands out of the other lags. A clip with fewer than two
    onsets or three motion rows has no estimate. Only a clip's hops come together, however many rows they sum up.
    """
    bucket = half_even(F.col("t_ms").cast("double") / hop).alias("i")
    o = onsets.groupBy("clip", bucket).agg(F.max("strength").alias("o"), F.lit(None).cast("double").alias("m"), F.count(F.lit(1)).alias("n_o"), F.lit(0).cast("bigint").alias("n_m"), F.max("t_ms").cast("double").alias("last"))
    m = motion.groupBy("clip", bucket).agg(F.lit(None).cast("double").alias("o"), F.max_by("energy", "seq").alias("m"), F.lit(0).cast("bigint").alias("n_o"), F.count(F.lit(1)).alias("n_m"), F.max("t_ms").cast("double").alias("last"))
    lags = round(max_lag / hop)

    def run(t: pa.Table) -> pa.Table:
        none = {"clip": t["clip"][:1], "available": [False], "offset_ms": [0.0], "confidence": [0.0], "max_corr": [None]}
        if sum(t["n_o"].to_pylist()) < 2 or sum(t["n_m"].to_pylist()) < 3:
            return pa.table(none, schema=kind)
        n = int(np.ceil((max(t["last"].to_pylist()) + tail) / hop)) + 1
        curves = {}
        for c in "om":
            curves[c] = np.zeros(n)
            i, v = t["i"].to_numpy(), t[c].to_numpy(zero_copy_only=False)
            there = ~np.isnan(v) & (i >= 0) & (i < n)
            curves[c][i[there]] = np.maximum(v[there], 0) if c == "o" else v[there]
            curves[c] = np.convolve(curves[c], np.ones(3) / 3, "same")
        a, b = curves["o"], np.diff(curves["m"], prepend=curves["m"][0])
        scores = np.zeros(2 * lags + 1)
        fit = np.zeros(2 * lags + 1, bool)
        for k, lag in enumerate(range(-lags, lags + 1)):
            x, y = a[max(0, -lag) : n - max(0, lag)], b[max(0, lag) : n - max(0, -lag)]
            if len(x) >= least:
                x, y = x - x.mean(), y - y.mean()
                scores[k], fit[k] = float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y) + 1e-9)), True
        scores = np.round(scores, 9)  # beyond that lags differ by the order of summing
        best = int(np.where(fit, scores, -np.inf).argmax()) if fit.any() else lags
        rest = float(np.delete(scores, int(scores.argmax())).mean()) if len(scores) > 1 else 0.0
        sure = float(np.clip((scores.max() - rest) / (abs(rest) + 0.05), 0, 1))
        return pa.table({"clip": t["clip"][:1], "available": [True], "offset_ms": [float((best - lags) * hop)], "confidence": [sure], "max_corr": [float(scores[best]) if fit.any() else None]}, schema=kind)

    kind = pa.schema([("clip", pa.string()), ("available", pa.bool_()), ("offset_ms", pa.float64()), ("confidence", pa.float64()), ("max_corr", pa.float64())])
    return o.unionByName(m).groupBy("clip").applyInArrow(run, ESTIMATE)


def shift(rows: DataFrame, estimates: DataFrame, times: Sequence[str], *, least: float = 1, least_confidence: float = 0.0) -> DataFrame:
    """``rows`` whose ``times`` move by their clip's offset, where there is one, larger than ``least`` either way; plus ``shifted_ms``."""
    e = estimates.select(F.col("clip").alias("e_clip"), "available", "offset_ms", "confidence")
    applies = F.coalesce(F.col("available") & (F.abs("offset_ms") > least) & (F.col("confidence") >= least_confidence), F.lit(False))
    by = F.when(applies, F.col("offset_ms")).otherwise(0.0)
    joined = rows.join(e, rows["clip"] == F.col("e_clip"), "left")
    return joined.select(*[(F.col(c) + by).alias(c) if c in times else F.col(c) for c in rows.columns], by.alias("shifted_ms"))
