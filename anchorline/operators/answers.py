"""Cues out of a model's answers: JSON of several shapes, read as VARIANT values.

An answer is a list of cues, or an object that holds the list as ``cues`` or, where that is
missing or empty, as ``audio_cues``; any other text has no cues. Each element keeps its
place, and what it lacks is filled in; elements that cannot be used are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.functions.numeric import half_even

#: What a cue's type, event and relation may be, and what they are where they are none of these.
AUDIO_TYPES = ("SFX", "AMBIENCE", "MUSIC", "MOVIE_BGM", "NARRATOR", "DIALOGUE")
EVENT_TYPES = ("INSTANT", "EVENT", "CONTINUOUS", "SEGMENT", "GLOBAL")
RELATIONS = ("SYNCHRONOUS", "ANTICIPATORY", "REACTIVE", "CONTEXTUAL", "TRANSITIONAL")
DEFAULT_TYPE, DEFAULT_EVENT, DEFAULT_RELATION = "SFX", "EVENT", "SYNCHRONOUS"
#: The length of a cue without one, and the least, in ms.
DEFAULT_MS, LEAST_MS = 500, 50
#: JSON values that count as missing.
EMPTY = r"^(null|false|\"\"|\[\]|\{\}|-?0+(\.0*)?([eE][-+]?[0-9]+)?)$"
#: Times beyond this are no times.
MOST_MS = 1e15


def is_empty(value: Column) -> Column:
    """Whether a VARIANT is missing, null, false, zero or holds nothing."""
    return value.isNull() | F.coalesce(F.to_json(value).rlike(EMPTY), F.lit(True))


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def text_of(value: Column) -> Column:
    """A VARIANT as text without white space at its ends; empty where it counts as missing."""
    return F.when(is_empty(value), F.lit("")).otherwise(F.regexp_replace(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("")), r"^\s+|\s+$", ""))


def number_of(value: Column) -> Column:
    """A VARIANT that is a number, a boolean or the text of a number; else null."""
    x = F.try_variant_get(value, "$", "double")
    return F.when(F.abs(x) < MOST_MS, x)


def _among(value: Column, known: Sequence[str], default: str) -> Column:
    name = F.upper(text_of(value))
    return F.when(name.isin(*known), name).otherwise(F.lit(default))


def elements(answer: Column) -> Column:
    """The array of VARIANT elements of an answer's text; null where it has none."""
    whole = F.try_parse_json(answer)
    among = lambda name: F.try_variant_get(_field(whole, name), "$", "array<variant>")
    inside = F.when(is_empty(_field(whole, "cues")), among("audio_cues")).otherwise(among("cues"))
    return F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), inside)


def parse_cues(answers: DataFrame, keys: Sequence[str], answer: str) -> DataFrame:
    """One row for each usable cue of each answer, with the answers' ``keys`` and the cue's ``position`` from 1.

    Dropped: elements that aren't objects, without a class (or ``none``), or with a start that isn't a number; a missing
    start is 0. A cue lasts ``LEAST_MS`` at least; an end that isn't after the start gives way to start and length.
    Values that are neither text nor numbers are taken as their JSON text. Broken answers and null ones have no rows.
    """
    e = answers.select(*keys, F.posexplode(elements(F.col(answer))).alias("at", "e"))
    is_object = F.try_variant_get("e", "$", "map<string,variant>").isNotNull()
    f = lambda name: _field(F.col("e"), name)
    kind = text_of(f("audio_class"))
    start = F.when(is_empty(f("start_time_ms")), F.lit(0.0)).otherwise(number_of(f("start_time_ms")))
    length = F.when(is_empty(f("duration_ms")), F.lit(float(DEFAULT_MS))).otherwise(F.coalesce(number_of(f("duration_ms")), F.lit(float(DEFAULT_MS))))
    times = F.transform(F.try_variant_get(f("impact_times_ms"), "$", "array<variant>"), number_of)
    impacts = F.when(F.exists(times, lambda t: t.isNull()), None).otherwise(F.transform(times, half_even))
    named = e.where(is_object).select(
        *keys, (F.col("at") + 1).alias("position"), "e", kind.alias("audio_class"),
        half_even(start).alias("start_time_ms"), F.greatest(F.lit(LEAST_MS).cast("long"), half_even(length)).alias("__length"), half_even(number_of(f("end_time_ms"))).alias("__end"),
        F.coalesce(impacts, F.array().cast("array<bigint>")).alias("impact_times_ms"),
    )
    usable = named.where((F.col("audio_class") != "") & (F.lower("audio_class") != "none") & F.col("start_time_ms").isNotNull())
    end = F.when(F.col("__end") > F.col("start_time_ms"), F.col("__end")).otherwise(F.col("start_time_ms") + F.col("__length"))
    own_id, trigger = text_of(f("cue_id")), text_of(f("cue_trigger"))
    plain = lambda name: F.try_variant_get(f(name), "$", "string")
    return usable.select(
        *keys, "position", F.when(own_id != "", own_id).otherwise(F.format_string("cue_%03d", "position")).alias("cue_id"), plain("anchor_id").alias("anchor_id"),
        _among(f("audio_type"), AUDIO_TYPES, DEFAULT_TYPE).alias("audio_type"), "audio_class", F.col("audio_class").alias("audio_prompt"),
        F.when(trigger != "", trigger).otherwise(F.col("audio_class")).alias("cue_trigger"),
        _among(f("alignment_relation"), RELATIONS, DEFAULT_RELATION).alias("alignment_relation"), _among(f("event_type"), EVENT_TYPES, DEFAULT_EVENT).alias("event_type"),
        "start_time_ms", (end - F.col("start_time_ms")).alias("duration_ms"), end.alias("end_time_ms"),
        text_of(f("visual_evidence")).alias("visual_evidence"), text_of(f("source_audio_context")).alias("source_audio_context"), "impact_times_ms", plain("transcript").alias("transcript"),
    )
