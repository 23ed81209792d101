"""Queries of identifiers, labels, settings and strict cue checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.functions.numeric import clamp, half_even
from anchorline.functions.text import CLASS_THRESHOLDS, GROUP_BANDS, OTHER_BANDS, bands_of, fill, last_error_line, map_label, modality, threshold_of, video_id
from anchorline.plans.registry import query
from anchorline.plans.views import AUDIO_TYPES, TL, cues, table, timeline
from anchorline.sources.files import clip_aliases, resolve_clips, sanitised

_FORMS = ("https://www.youtube.com/watch?v={}&t=3", "http://youtu.be/{}/", "https://m.youtube.com/shorts/{}", "https://www.youtube-nocookie.com/embed/{}?x=1", "https://example.com/watch?v={}", "https://youtube.com/live", "https://YOUTUBE.com/playlist?list=1&v=", "not a link {}")


@query(f"""
WITH u AS (SELECT event_id, CASE event_id % 8 {" ".join(f"WHEN {i} THEN '{f.partition('{}')[0]}' || CASE WHEN {i} IN (5, 6) THEN '' ELSE key || '{f.partition('{}')[2]}' END" for i, f in enumerate(_FORMS))} END AS url, key FROM (SELECT event_id, left(md5(CAST(event_id AS VARCHAR)), 4 + event_id % 9) AS key FROM events))
SELECT event_id, url, CASE WHEN event_id % 8 < 4 AND length(key) >= 6 THEN key END AS video_id FROM u
""")
def q_video_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of videos from links of several forms; too short ones and links of other hosts have none."""
    key = F.left(F.md5(F.col("event_id").cast("string").cast("binary")), (4 + F.col("event_id") % 9).cast("int"))
    url = F.lit(None).cast("string")
    for i, form in enumerate(_FORMS):
        url = F.when(F.col("event_id") % 8 == i, F.concat(*[F.lit(form.partition("{}")[0]), *([key, F.lit(form.partition("{}")[2])] if "{}" in form else [])])).otherwise(url)
    return table(spark, sf_dir, "events").select("event_id", url.alias("url")).withColumn("video_id", video_id(F.col("url")))


_CLASSES = (*CLASS_THRESHOLDS, "Rain")


@query(f"""
WITH p AS (SELECT p_partkey, [{", ".join(f"'{c}'" for c in _CLASSES)}][p_partkey % {len(_CLASSES)} + 1] AS label FROM part)
SELECT p_partkey, label, CASE label WHEN 'Glass' THEN 0.5::DOUBLE {" ".join(f"WHEN '{c}' THEN {t}::DOUBLE" for c, t in CLASS_THRESHOLDS.items() if c != 'Glass')} ELSE 0.45::DOUBLE END AS threshold FROM p
""")
def q_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold of each class: an override, else the fixed one, else a default."""
    label = F.get(F.array(*map(F.lit, _CLASSES)), F.col("p_partkey") % len(_CLASSES))
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label")).withColumn("threshold", threshold_of(F.col("label"), {"Glass": 0.5}, 0.45))


@query(f"""
WITH {TL} SELECT cue_id, CASE WHEN audio_type IN ('SFX', 'AMBIENCE', 'MUSIC', 'NARRATOR', 'MOVIE_BGM') THEN 'audio' ELSE 'visual' END AS modality,
'{{"cue_id":"' || cue_id || '","audio_type":"' || audio_type || '"}}' AS rejected FROM cue
""")
def q_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a cue is perceived, and its record without the list of actions."""
    record = F.struct("cue_id", "audio_type", F.array("seq").alias("verifier_actions"))
    return cues(spark, sf_dir).select("cue_id", modality(F.col("audio_type")).alias("modality"), F.to_json(record.dropFields("verifier_actions")).alias("rejected"))


@query(f"WITH {TL} SELECT clip, kind, round(avg(CASE WHEN k % 5 <> 0 THEN snr_db END), 6) AS mean_snr, count(*) AS n FROM tl GROUP BY clip, kind")
def q_mean_snr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean signal-to-noise ratio, missing values aside; null where all are missing."""
    x = timeline(spark, sf_dir).withColumn("snr_db", F.when(F.col("k") % 5 != 0, F.col("snr_db")))
    return x.groupBy("clip", "kind").agg(F.round(F.avg("snr_db"), 6).alias("mean_snr"), F.count(F.lit(1)).alias("n"))


_GOLD = "CASE o_orderkey % 4 WHEN 0 THEN 'v' || o_custkey || '/clip_' || o_orderkey WHEN 1 THEN 'v' || o_custkey || '_' || o_orderkey WHEN 2 THEN 'clip_' || o_orderkey ELSE 'v' || o_custkey || '_clip_' || o_orderkey END"


@query(f"""
WITH g AS (SELECT o_orderkey, {_GOLD} AS id FROM orders)
SELECT DISTINCT o_orderkey, unnest([id, string_split(id, '/')[-1], replace(id, '/', '_')]) AS alias FROM g
""")
def q_gold_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name under which a gold document is found."""
    g = table(spark, sf_dir, "orders").select("o_orderkey", _gold_key().alias("id"))
    return g.select("o_orderkey", F.explode(clip_aliases(F.col("id"))).alias("alias"))


def _gold_key():
    v, n = F.concat(F.lit("v"), F.col("o_custkey").cast("string")), F.col("o_orderkey").cast("string")
    forms = (F.concat(v, F.lit("/clip_"), n), F.concat(v, F.lit("_"), n), F.concat(F.lit("clip_"), n), F.concat(v, F.lit("_clip_"), n))
    out = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        out = F.when(F.col("o_orderkey") % 4 == i, form).otherwise(out)
    return out


@query(f"""
WITH g AS (SELECT {_GOLD} AS gold_key, o_orderkey, o_custkey FROM orders)
SELECT gold_key, CASE WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_orderkey % 3 <> 0 THEN 'v' || o_custkey END WHEN o_orderkey % 3 <> 0 THEN 'v' || o_custkey END AS video_id,
CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey AS VARCHAR) ELSE 'clip_' || o_orderkey END AS clip_id FROM g
""")
def q_resolve_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video and clip that each gold key names, among two thirds of all clips."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    name = F.when(F.col("o_orderkey") % 4 == 1, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("clip_"), F.col("o_orderkey").cast("string")))
    clips = o.where("o_orderkey % 3 != 0").select(F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("video_id"), name.alias("clip_id"))
    return resolve_clips(o.select(_gold_key().alias("gold_key")), clips)


_STRICT = f"""{TL}, raw AS (SELECT clip, seq, CASE WHEN k % 13 = 0 THEN 'NOISE' ELSE lower(audio_type) END AS audio_type, CASE WHEN k % 17 = 0 THEN NULL ELSE start_ms - 30000000 END AS start_raw, CASE WHEN k % 7 = 0 THEN 90000000 ELSE duration_ms END AS length_raw,
  CASE WHEN k % 11 = 0 THEN ' ' ELSE 'x' || k END AS audio_class, 'cue_' || (user_id % 100) AS given, row_number() OVER (PARTITION BY clip ORDER BY start_ms, seq) AS i FROM cue)"""


@query(f"""
WITH {_STRICT}, c AS (SELECT *, CASE WHEN upper(audio_type) NOT IN {AUDIO_TYPES} THEN 'audio_type' WHEN start_raw IS NULL THEN 'start_time_ms' WHEN trim(audio_class) = '' THEN 'audio_class' END AS error, least(greatest(0, start_raw), 86400000 - 1) AS s FROM raw),
d AS (SELECT *, least(greatest(1, length_raw), 86400000 - s) AS l FROM c), n AS (SELECT *, row_number() OVER (PARTITION BY clip, given, error IS NULL ORDER BY i) AS nth FROM d)
SELECT clip, seq, CASE WHEN error IS NULL AND nth > 1 THEN given || '_' || lpad(CAST(i AS VARCHAR), CAST(greatest(3, length(CAST(i AS VARCHAR))) AS INTEGER), '0') ELSE given END AS cue_id, error,
CASE WHEN error IS NULL THEN s END AS start_ms, CASE WHEN error IS NULL THEN l END AS duration_ms, CASE WHEN error IS NULL THEN s <> start_raw OR l <> length_raw END AS changed FROM n
""")
def q_strict_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues under strict rules: what is wrong is named, times are moved into the clip, repeated ids get a number."""
    i = F.row_number().over(Window.partitionBy("clip").orderBy("start_ms", "seq"))
    raw = cues(spark, sf_dir).select(
        "clip", "seq", F.when(F.col("k") % 13 == 0, "NOISE").otherwise(F.lower("audio_type")).alias("audio_type"), F.when(F.col("k") % 17 != 0, F.col("start_ms") - 30_000_000).alias("start_raw"),
        F.when(F.col("k") % 7 == 0, 90_000_000).otherwise(F.col("duration_ms")).cast("long").alias("length_raw"), F.when(F.col("k") % 11 == 0, " ").otherwise(F.concat(F.lit("x"), F.col("k").cast("string"))).alias("audio_class"),
        F.concat(F.lit("cue_"), (F.col("user_id") % 100).cast("string")).alias("given"), i.alias("i"),
    )
    error = F.when(~F.upper("audio_type").isin(*AUDIO_TYPES), "audio_type").when(F.col("start_raw").isNull(), "start_time_ms").when(F.trim("audio_class") == "", "audio_class")
    c = raw.withColumns({"error": error, "s": clamp(half_even(F.col("start_raw").cast("double")), 0, 86_400_000 - 1)}).withColumn("l", clamp(F.col("length_raw"), 1, 86_400_000 - F.col("s")))
    nth = F.row_number().over(Window.partitionBy("clip", "given", F.col("error").isNull()).orderBy("i"))
    good = F.col("error").isNull()
    cue_id = F.when(good & (nth > 1), F.format_string("%s_%03d", "given", "i")).otherwise(F.col("given"))
    changed = (F.col("s") != F.col("start_raw")) | (F.col("l") != F.col("length_raw"))
    return c.select("clip", "seq", cue_id.alias("cue_id"), "error", F.when(good, F.col("s")).alias("start_ms"), F.when(good, F.col("l")).alias("duration_ms"), F.when(good, changed).alias("changed"))


@query("""
SELECT event_id, 'video is not downloadable: ' || CASE event_id % 4 WHEN 3 THEN repeat('long ', 60) ELSE 'k=' || json_extract_string(props, '$.k') END AS message FROM events WHERE event_type = 'error'
""")
def q_error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line for each error: the last of its message, without prefixes that repeat, shortened."""
    k = F.concat(F.lit("k="), F.get_json_object("props", "$.k"))
    forms = (F.concat(F.lit("first line\nERROR: ERROR: "), k, F.lit("\n \n")), F.concat(F.lit("a\r\nVideo is NOT downloadable: ERROR:"), k), k, F.concat(F.lit("ERROR: "), F.lit("long " * 70)))
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(F.col("event_id") % 4 == i, form).otherwise(text)
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", last_error_line(text).alias("message"))


@query(f"""
WITH b AS (SELECT doc_id, lower(text) AS t FROM documents) SELECT doc_id, left('Cue of {{' || d.source || '}} in ' || coalesce(d.lang, ''), 40) AS prompt, CASE WHEN length(d.text) > 500 THEN left(d.text, 500) || chr(10) || '… (' || (length(d.text) - 500) || ' more chars)' ELSE d.text END AS logged FROM documents d
""")
def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt of named parts, and texts as a log keeps them."""
    d = table(spark, sf_dir, "documents")
    prompt = fill("Cue of {{{source}}} in {lang}", {"source": F.col("source"), "lang": F.col("lang")})
    return d.select("doc_id", F.left(prompt, F.lit(40)).alias("prompt"), sanitised(F.col("text"), 500).alias("logged"))


def _sql_bands() -> str:
    cases = " ".join(f"WHEN '{g}' THEN '{','.join(b)}'" for g, b in GROUP_BANDS.items())
    return f"CASE acoustic_group {cases} ELSE '{','.join(OTHER_BANDS)}' END"


@query(f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_name LIKE '%a%' THEN 'Glass shatter' WHEN p_name LIKE '%e%' THEN 'Female Speech' WHEN p_name LIKE '%i%' THEN 'singing' WHEN p_name LIKE '%o%' THEN 'Rain on car' ELSE 'hum' END AS label FROM part),
g AS (SELECT *, CASE label WHEN 'Glass shatter' THEN 'impact' WHEN 'Female Speech' THEN 'speech' WHEN 'singing' THEN 'tonal' WHEN 'Rain on car' THEN 'continuous_bed' ELSE 'noise_burst' END AS acoustic_group FROM p)
SELECT p_partkey, label, acoustic_group, {_sql_bands()} AS bands FROM g
""")
def q_label_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The acoustic group of a label and the bands in which its onsets are looked for."""
    name = F.col("p_name")
    label = F.when(name.contains("a"), "Glass shatter").when(name.contains("e"), "Female Speech").when(name.contains("i"), "singing").when(name.contains("o"), "Rain on car").otherwise("hum")
    p = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    return p.withColumn("acoustic_group", map_label(F.col("label"))[1]).select("*", F.array_join(bands_of(F.col("acoustic_group")), ",").alias("bands"))
