"""Checks of tables as data: a declared set of constraints gives a table of violations.

Constraints of three kinds are put together so that each table is read once: those on a
row alone are one projection; those on a row's children (rows of another table with the
same key) are conditional aggregates, one aggregation for each child table however many
checks look at it; references are the same aggregation of the other table's keys. A
violation is a row (keys, problem); rows that satisfy everything give none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Row:
    """A row is at fault where ``broken`` is true; what can't be told (null) is at fault too."""

    name: str
    broken: Column


@dataclass(frozen=True)
class Children:
    """A row is at fault where ``broken`` is true of a child, or, with ``expected``, where it has another number of children."""

    name: str
    child: str
    broken: Column | None = None
    expected: Column | None = None


@dataclass(frozen=True)
class Exists:
    """A row is at fault without a child for which ``such`` is true."""

    name: str
    child: str
    such: Column


@dataclass(frozen=True)
class Agree:
    """A row is at fault where two child tables hold different rows for it: an order-free digest of the named columns differs."""

    name: str
    child: str
    other: str
    columns: Sequence[str]


Check = Row | Children | Exists | Agree


def _digest(columns: Sequence[str]) -> list[Column]:
    """Sums of two hashes and the number of rows: equal for equal bags of rows."""
    return [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]


def violations(rows: DataFrame, keys: Sequence[str], checks: Sequence[Check], children: dict[str, DataFrame] | None = None) -> DataFrame:
    """(keys, problem) for every check that a row of ``rows`` fails. ``children``: tables with the same keys, by name."""
    base, broken = rows, {}
    for table, child in (children or {}).items():
        aggregates = [F.count(F.lit(1)).alias(f"__{table}_n")]
        for i, c in enumerate(checks):
            if isinstance(c, Children) and c.child == table and c.broken is not None:
                aggregates.append(F.max(F.coalesce(c.broken, F.lit(True))).alias(f"__{i}"))
            elif isinstance(c, Exists) and c.child == table:
                aggregates.append(F.max(F.coalesce(c.such, F.lit(False))).alias(f"__{i}"))
            elif isinstance(c, Agree) and table in (c.child, c.other):
                side = "a" if c.child == table else "b"
                aggregates += [x.alias(f"__{i}_{side}{j}") for j, x in enumerate(_digest(c.columns))]
        if len(aggregates) > 1 or any(isinstance(c, Children) and c.child == table for c in checks):
            found = child.groupBy(*[F.col(k).alias(f"__r_{k}") for k in keys]).agg(*aggregates)
            on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
            base = base.join(found, on, "left").drop(*[f"__r_{k}" for k in keys])
    for i, c in enumerate(checks):
        if isinstance(c, Row):
            broken[c.name] = F.coalesce(c.broken, F.lit(True))
        elif isinstance(c, Children):
            parts = [F.coalesce(F.col(f"__{i}"), F.lit(False))] if c.broken is not None else []
            parts += [~F.coalesce(F.coalesce(F.col(f"__{c.child}_n"), F.lit(0)) == c.expected, F.lit(False))] if c.expected is not None else []
            broken[c.name] = F.greatest(*parts) if len(parts) > 1 else parts[0]
        elif isinstance(c, Exists):
            broken[c.name] = ~F.coalesce(F.col(f"__{i}"), F.lit(False))
        else:
            same = [F.col(f"__{i}_a{j}").eqNullSafe(F.col(f"__{i}_b{j}")) for j in range(2)]
            counts = F.coalesce(F.col(f"__{c.child}_n"), F.lit(0)) == F.coalesce(F.col(f"__{c.other}_n"), F.lit(0))
            broken[c.name] = ~(same[0] & same[1] & counts)
    names = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in broken.items()]))
    return base.select(*keys, F.explode(names).alias("problem"))


#: What the sources of a cue, the annotation and a video's type may be.
SOURCES = ("gemini", "gemini+dsp", "asr", "foley_agent", "audio_only_agent")
ANNOTATION = "pseudo_ground_truth"
VIDEO_TYPES = ("ACTION", "DIALOGUE", "ESTABLISHING", "CHASE", "FIGHT", "REVEAL", "EMOTIONAL", "HORROR_TENSION", "TRAVEL", "OTHER")
#: What a cue must have, what an explanation must say, and by how much a clip may miss its interval, in ms.
CUE_FIELDS = ("cue_id", "audio_type", "audio_class", "audio_prompt", "cue_trigger", "alignment_relation", "event_type", "start_time_ms", "duration_ms", "end_time_ms", "source", "annotation_type")
EXPLANATION_FIELDS = ("video_content", "scene_gravity", "scene_interpretation", "audio_asthetics")
INTERVAL_SLACK_MS = 300


def cue_checks(clip_ms: str = "clip_ms") -> dict[str, Column]:
    """What makes a cue invalid, by name, over its columns and its clip's length."""
    start, length, end = (F.col(c) for c in ("start_time_ms", "duration_ms", "end_time_ms"))
    return {
        "fields": F.greatest(*[F.col(c).isNull() for c in CUE_FIELDS]),
        "start": start < 0,
        "duration": length <= 0,
        "end": end != start + length,
        "beyond_clip": end > F.col(clip_ms),
        "source": ~F.col("source").isin(*SOURCES),
        "annotation": F.col("annotation_type") != ANNOTATION,
        "temporal_annotation": F.col("temporal_annotation_type").isNotNull() & (F.col("temporal_annotation_type") != ANNOTATION),
        "temporal_source": F.col("temporal_source").isNotNull() & ~F.col("temporal_source").isin(*SOURCES),
    }


def record_checks() -> list[Check]:
    """The checks of a dataset record against its cues, artifact cues, token times, files and the index.

    Children, by the record's keys: ``cues`` and ``artifact_cues`` (with the clip's length as ``clip_ms``), ``times``
    (start_ms, end_ms, clip_ms), ``index`` (processing_level, and the record's as ``record_level``).
    """
    wrong = lambda checks: F.greatest(*[F.coalesce(c, F.lit(True)) for c in checks])
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    return [
        Row("source_video", F.col("source_video").isNull()),
        Row("source_interval", F.abs(F.coalesce("source_end_ms", F.lit(-1)) - F.coalesce("source_start_ms", F.lit(-1)) - F.col("clip_ms")) > INTERVAL_SLACK_MS),
        Row("artifact_missing", F.col("least_artifact_bytes") <= 0),
        Row("token_dimension", F.col("token_width") != F.col("hidden_dimension")),
        Row("explanation", F.greatest(*[blank(c) for c in EXPLANATION_FIELDS])),
        Row("video_type", ~F.col("video_type").isin(*VIDEO_TYPES)),
        Row("explanation_audio", ~F.col("explanation_received_audio")),
        Row("artifact_annotation", F.col("artifact_annotation_type") != ANNOTATION),
        Row("artifact_source", ~F.col("artifact_source").isin(*SOURCES)),
        Row("artifact_audio", ~F.col("artifact_received_audio")),
        Row("provenance", ~F.col("provenance_source").isin(*SOURCES) | (F.col("provenance_annotation_type") != ANNOTATION)),
        Row("human_verified", F.col("human_verified")),
        Children("cues", "cues", wrong(cue_checks().values())),
        Children("artifact_cues", "artifact_cues", wrong(cue_checks().values())),
        Agree("cues_disagree", "cues", "artifact_cues", CUE_FIELDS),
        Children("token_times", "times", (F.col("start_ms") < 0) | (F.col("start_ms") >= F.col("end_ms")) | (F.col("end_ms") > F.col("clip_ms"))),
        Children("token_rows", "times", expected=F.col("token_rows")),
        Exists("index", "index", F.coalesce("processing_level", F.lit("low")) == F.coalesce("record_level", F.lit("low"))),
    ]
