"""Timelines over the given tables: one calendar day of ``events`` is a clip.

Times are milliseconds of the day. Purchases are cues, everything else is an anchor.
A reference millisecond of tolerance is one second here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.functions.numeric import half_even
from anchorline.functions.text import STOPWORDS

KINDS = {"click": "audio_onset", "error": "sed_event", "signup": "cut", "view": "motion_spike"}
STEMS = ("effects", "mixture", "dialogue")
#: The audio types of cues.
AUDIO_TYPES = ("SFX", "AMBIENCE", "MUSIC", "MOVIE_BGM", "NARRATOR", "DIALOGUE")

TL = """
base AS (SELECT event_id AS seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS clip, (epoch_us(ts) % 86400000000) / 1000.0::DOUBLE AS t_ms_f,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value AS strength, least(1.0::DOUBLE, value / 500) AS strength_norm, user_id, event_type FROM events),
ev AS (SELECT *, CAST(round_even(t_ms_f, 0) AS BIGINT) AS t_ms, k / 5.0::DOUBLE AS snr_db,
  CASE user_id % 3 WHEN 0 THEN 'effects' WHEN 1 THEN 'mixture' ELSE 'dialogue' END AS stem,
  CASE event_type WHEN 'click' THEN 'audio_onset' WHEN 'error' THEN 'sed_event' WHEN 'signup' THEN 'cut' WHEN 'view' THEN 'motion_spike' END AS kind FROM base),
tl AS (SELECT * FROM ev WHERE kind IS NOT NULL),
cue AS (SELECT seq, clip, t_ms AS start_ms, 1000 * (1 + k) AS duration_ms, k, user_id, strength, 'cue_' || seq AS cue_id,
  ['SFX', 'AMBIENCE', 'MUSIC', 'MOVIE_BGM', 'NARRATOR', 'DIALOGUE'][k % 6 + 1] AS audio_type FROM ev WHERE event_type = 'purchase')
"""


def sql_tokens(text: str, stopwords: Sequence[str] = STOPWORDS) -> str:
    """Stemmed distinct tokens in DuckDB."""
    stop = "(" + ", ".join(f"'{w}'" for w in stopwords) + ")"
    cut = "CASE WHEN length(w) > 4 AND w LIKE '%ing' THEN left(w, length(w) - 3) WHEN length(w) > 4 AND w LIKE '%es' THEN left(w, length(w) - 2) WHEN length(w) > 4 AND w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END"
    return f"list_distinct(list_transform(list_filter(regexp_extract_all(lower({text}), '[a-z0-9]+'), lambda w: w NOT IN {stop}), lambda w: {cut}))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.to_date(ts).cast("string").alias("clip"), (F.unix_micros(ts) % 86400000000 / F.lit(1000.0)).alias("t_ms_f"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("value").alias("strength"), F.least(F.lit(1.0), F.col("value") / 500).alias("strength_norm"), "user_id", "event_type",
    )
    stem = F.when(F.col("user_id") % 3 == 0, STEMS[0]).when(F.col("user_id") % 3 == 1, STEMS[1]).otherwise(STEMS[2])
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return base.withColumns({"t_ms": half_even(F.col("t_ms_f")), "snr_db": F.col("k") / 5.0, "stem": stem, "kind": F.try_element_at(kind, F.col("event_type"))})


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All anchors."""
    return _events(spark, sf_dir).where("event_type != 'purchase'")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cues."""
    types = F.array(*map(F.lit, AUDIO_TYPES))
    return _events(spark, sf_dir).where("event_type = 'purchase'").select(
        "seq", "clip", F.col("t_ms").alias("start_ms"), (1000 * (1 + F.col("k"))).alias("duration_ms"), "k", "user_id", "strength",
        F.concat(F.lit("cue_"), "seq").alias("cue_id"), F.get(types, F.col("k") % 6).alias("audio_type"),
    )
