"""Events of frame series: cuts, motion spikes and stops, flashes; hysteresis of class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from anchorline.functions.numeric import half_even, parabolic_shift
from anchorline.functions.text import threshold_of
from anchorline.operators.segments import hysteresis

#: Deviations above the mean (below it for stops) from which a frame counts.
CUT_DEVIATIONS, MOTION_DEVIATIONS, FLASH_DEVIATIONS = 2.5, 2.0, 3.0
TINY = 1e-9


def first_difference(value: Column, order: WindowSpec) -> Column:
    """A row's change from the row before, 0 in the first."""
    return value - F.coalesce(F.lag(value).over(order), value)


def median_of_three(value: Column, order: WindowSpec) -> Column:
    """A row's median with its two neighbours; the first and last rows stay."""
    a, b = F.coalesce(F.lag(value).over(order), value), F.coalesce(F.lead(value).over(order), value)
    return F.greatest(F.least(a, value), F.least(F.greatest(a, value), b))


def _per_clip(rows: DataFrame, stats: Sequence[Column]) -> DataFrame:
    """``rows`` with figures of their clip: an aggregate joined back, so that no clip is held whole."""
    found = rows.groupBy(F.col("clip").alias("s_clip")).agg(*stats)
    return rows.join(found, F.col("clip") == F.col("s_clip")).drop("s_clip")


def frame_events(frames: DataFrame) -> DataFrame:
    """(clip, f, kind, t_ms, t_ms_f, strength) of frames (clip, f, pts_s, diff, flow, luma); a null flow is the difference.

    Cuts are peaks of the difference; motion energy is the mean of difference and flow, each over its clip's largest;
    spikes (named ``motion`` too) and stops are peaks and valleys of its change, a stop only after high energy; flashes are
    peaks of the change of luminance. Peaks lie between samples where three of them say so. First and last frames have none.
    """
    order = Window.partitionBy("clip").orderBy("f")
    x = frames.select("clip", "f", "pts_s", "diff", F.coalesce("flow", "diff").alias("flow"), "luma")
    x = _per_clip(x, [F.max("diff").alias("top_diff"), F.max("flow").alias("top_flow"), F.avg("diff").alias("m_diff"), F.stddev_pop("diff").alias("s_diff")])
    energy = 0.5 * (F.col("diff") / (F.col("top_diff") + TINY) + F.col("flow") / (F.col("top_flow") + TINY))
    x = x.withColumn("energy", energy).withColumns({"de": first_difference(F.col("energy"), order), "dl": F.abs(first_difference(F.col("luma"), order)), "dl_signed": first_difference(F.col("luma"), order)})
    x = _per_clip(x, [
        F.avg("de").alias("m_de"), F.stddev_pop("de").alias("s_de"), F.percentile("energy", 0.5).alias("med"), F.stddev_pop("energy").alias("s_energy"), F.avg("dl").alias("m_dl"), F.stddev_pop("dl_signed").alias("s_dl"),
    ])
    near = {f"{side}_{c}": f(c).over(order) for c in ("diff", "de", "dl", "energy", "pts_s") for side, f in (("p", F.lag), ("n", F.lead))}
    x = x.withColumns(near).where("p_diff IS NOT NULL AND n_diff IS NOT NULL")
    c = F.col
    peak = lambda v, least: (c(v) >= least) & (c(v) >= c(f"p_{v}")) & (c(v) >= c(f"n_{v}"))
    step = c("n_pts_s") - c("pts_s")
    at = lambda v, sign=1: c("pts_s") + parabolic_shift(sign * c(f"p_{v}"), sign * c(v), sign * c(f"n_{v}")) * step
    cut = peak("diff", c("m_diff") + CUT_DEVIATIONS * (c("s_diff") + TINY))
    spike = peak("de", c("m_de") + MOTION_DEVIATIONS * (c("s_de") + TINY))
    low = (c("de") <= c("m_de") - MOTION_DEVIATIONS * (c("s_de") + TINY)) & (c("de") <= c("p_de")) & (c("de") <= c("n_de"))
    stop = low & (c("p_energy") > c("med") + c("s_energy"))
    flash = peak("dl", c("m_dl") + FLASH_DEVIATIONS * (c("s_dl") + TINY))
    one = lambda such, kind, t, v: F.when(such, F.struct(F.lit(kind).alias("kind"), t.alias("t"), v.alias("strength")))
    found = F.array(one(cut, "cut", at("diff"), c("diff")), one(spike, "motion_spike", at("de"), c("de")), one(spike, "motion", at("de"), c("de")), one(stop, "motion_stop", at("de", -1), -c("de")), one(flash, "flash", c("pts_s"), c("dl")))
    e = x.select("clip", "f", F.explode(F.array_compact(found)).alias("e"))
    return e.select("clip", "f", "e.kind", half_even(c("e.t") * 1000).alias("t_ms"), F.round(c("e.t") * 1000, 1).alias("t_ms_f"), "e.strength")


def class_events(probabilities: DataFrame, *, on: float = 0.5, off: float = 0.3, smooth: bool = True, overrides: dict[str, float] | None = None) -> DataFrame:
    """(clip, class, start, end, peak) of (clip, frame, class, p): each class switched on at its own threshold, off below both
    ``off`` and 0.05 under it; probabilities are medians of three frames first, unless ``smooth`` is false."""
    order = Window.partitionBy("clip", "class").orderBy("frame")
    p = probabilities.select("clip", "class", "frame", (median_of_three(F.col("p"), order) if smooth else F.col("p")).alias("p"))
    level = threshold_of(F.col("class"), overrides, on)
    return hysteresis(p, ["clip", "class"], "frame", "p", level, F.least(F.lit(off), level - 0.05))
