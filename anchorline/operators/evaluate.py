"""Predicted events against gold: one-to-one matches, errors, precision and recall, by clip and pooled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.operators.assign import assign_in_order

#: Columns that hold an event's onset and its end, first that isn't null wins.
ONSETS, OFFSETS = ("onset_ms", "t_ms_f", "t_ms", "start_time_ms"), ("offset_ms", "t_end_ms_f", "end_ms", "end_time_ms")
#: Fixed values, in ms: errors that count as small, the collar of errors, and that of precision and recall.
WITHIN, ERROR_COLLAR, COLLAR = (20, 50, 100, 200), 200, 50


#: Kinds of anchors that are heard.
AUDIO_KINDS = ("audio_onset", "sed_event", "speech_start", "music_boundary")


def predictions(anchors: DataFrame, audio_only: bool = True) -> DataFrame:
    """(clip, id, label, onset_ms, offset_ms, stem, score) of anchors: their exact times where they have them, else the rounded ones."""
    heard = anchors.where(F.col("kind").isin(*AUDIO_KINDS)) if audio_only else anchors
    own = lambda c: F.col(c) if c in anchors.columns else F.lit(None)
    return heard.select("clip", "id", F.col("kind").alias("label"), _first_of(anchors, ("t_ms_f", "t_ms")).alias("onset_ms"), _first_of(anchors, ("t_end_ms_f", "end_ms")).alias("offset_ms"), own("stem").cast("string").alias("stem"), own("score").cast("double").alias("score"))


def event_label(kind: Column, stem: Column, direction: Column, delta: Column, bands: Column) -> Column:
    """What an event is, in one text: its kind, and with bars between, what else is known of it."""
    text = lambda c: F.nullif(c.cast("string"), F.lit(""))
    return F.concat_ws("|", kind, text(stem), text(direction), F.concat(F.lit("d"), delta.cast("string")), text(F.array_join(bands, "+")))


def _first_of(df: DataFrame, names: Sequence[str]) -> Column:
    there = [F.col(c).cast("double") for c in names if c in df.columns]
    return F.coalesce(*there, F.lit(None).cast("double"))


def shaped(events: DataFrame) -> DataFrame:
    """(clip, id, label, onset, offset) of events whatever they call their times; an event without an onset is at 0."""
    label = F.col("label").cast("string") if "label" in events.columns else F.lit(None).cast("string")
    return events.select("clip", "id", label.alias("label"), F.coalesce(_first_of(events, ONSETS), F.lit(0.0)).alias("onset"), _first_of(events, OFFSETS).alias("offset"))


def one_to_one(pred: DataFrame, gold: DataFrame, collar: float, by_class: bool = False) -> DataFrame:
    """(clip, pred, gold, error, offset_error): most pairs within the collar, at least total distance; of one label if ``by_class``."""
    unit = F.concat_ws("\x01", "clip", F.coalesce("label", F.lit(""))) if by_class else F.col("clip").cast("string")
    p = shaped(pred).select("clip", unit.alias("unit"), F.col("id").alias("left"), F.col("onset").alias("p_t"), F.col("offset").alias("p_end"))
    g = shaped(gold).select(unit.alias("unit"), F.col("id").alias("right"), F.col("onset").alias("g_t"), F.col("offset").alias("g_end"))
    chosen = assign_in_order(p.select("unit", "left", F.col("p_t").alias("at")), g.select("unit", "right", F.col("g_t").alias("at"), F.lit(0.0).alias("weight")), "unit", collar)
    found = chosen.join(p.drop("p_t"), ["unit", "left"]).join(g.drop("g_t"), ["unit", "right"])
    return found.select("clip", F.col("left").alias("pred"), F.col("right").alias("gold"), F.col("cost").alias("error"), F.abs(F.col("p_end") - F.col("g_end")).alias("offset_error"))


def evaluate(pred: DataFrame, gold: DataFrame, *, scale: float = 1, by_class: bool = False) -> DataFrame:
    """A row for each clip and, with a null clip, one for all: numbers, error figures, shares, precision, recall and F1.

    Errors are those of pairs within the wide collar, percentiles are exact; offsets are those of pairs that both have one.
    Precision and recall are of pairs matched anew within the narrow collar. ``scale``: units of time in a ms.
    """
    none = F.lit(None).cast("double")
    rows = lambda df, kind, error=none, offset=none: df.select("clip", F.lit(kind).alias("kind"), error.alias("error"), offset.alias("offset_error"))
    wide, narrow = one_to_one(pred, gold, scale * ERROR_COLLAR, by_class), one_to_one(pred, gold, scale * COLLAR, by_class)
    every = rows(pred, "pred").unionByName(rows(gold, "gold")).unionByName(rows(wide, "wide", F.col("error"), F.col("offset_error"))).unionByName(rows(narrow, "narrow"))
    n = lambda kind: F.count_if(F.col("kind") == kind)
    within = [F.coalesce(100.0 * F.try_divide(F.count_if(F.col("error") <= scale * w), F.count("error")), F.lit(0.0)).alias(f"pct_within_{w}") for w in WITHIN]
    # Rows of one clip and of all in one aggregation; a clip whose name is null is no pool.
    made = every.where("clip IS NOT NULL").rollup("clip").agg(
        n("pred").alias("n_pred"), n("gold").alias("n_gold"), n("wide").alias("n_matched"), n("narrow").alias("tp"),
        F.percentile("error", 0.5).alias("median_error"), F.percentile("error", 0.9).alias("p90_error"), F.avg("error").alias("mean_error"), *within,
        F.count("offset_error").alias("n_offsets"), F.percentile("offset_error", 0.5).alias("median_offset_error"), F.percentile("offset_error", 0.9).alias("p90_offset_error"),
    )
    share = lambda of: F.coalesce(F.try_divide(F.col("tp"), F.col(of)), F.lit(0.0))
    scored = made.withColumns({"fp": F.col("n_pred") - F.col("tp"), "fn": F.col("n_gold") - F.col("tp"), "precision": share("n_pred"), "recall": share("n_gold")})
    return scored.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
