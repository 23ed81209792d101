"""Queries of frame series: cuts, spikes, stops and flashes; class events with thresholds of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.functions.text import CLASS_THRESHOLDS
from anchorline.operators import motion
from anchorline.plans.registry import query
from anchorline.plans.views import TL, table, timeline

_NEAR = ", ".join(f"lag({c}) OVER o AS p_{c}, lead({c}) OVER o AS n_{c}" for c in ("diff", "de", "dl", "energy", "pts"))


def _at(v: str, sign: str = "") -> str:
    a, m, b = f"{sign}p_{v}", f"{sign}{v}", f"{sign}n_{v}"
    return f"pts + CASE WHEN abs({a} - 2 * {m} + {b}) < 1e-12 THEN 0 ELSE 0.5 * ({a} - {b}) / ({a} - 2 * {m} + {b}) END * (n_pts - pts)"


def _peak(v: str, least: str) -> str:
    return f"{v} >= {least} AND {v} >= p_{v} AND {v} >= n_{v}"


@query(f"""
WITH {TL}, f AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY t_ms, seq) AS f, t_ms / 1000.0::DOUBLE AS pts, strength AS diff, CASE WHEN k % 4 = 0 THEN strength ELSE k + 1.0::DOUBLE END AS flow, 3.0::DOUBLE * k AS luma FROM tl WHERE kind = 'motion_spike'),
a AS (SELECT clip, max(diff) AS top_diff, max(flow) AS top_flow, avg(diff) AS m_diff, stddev_pop(diff) AS s_diff FROM f GROUP BY clip),
e AS (SELECT f.*, m_diff, s_diff, 0.5 * (diff / (top_diff + 1e-9) + flow / (top_flow + 1e-9)) AS energy FROM f JOIN a USING (clip)),
d AS (SELECT *, energy - lag(energy, 1, energy) OVER o AS de, abs(luma - lag(luma, 1, luma) OVER o) AS dl, luma - lag(luma, 1, luma) OVER o AS dls FROM e WINDOW o AS (PARTITION BY clip ORDER BY f)),
s AS (SELECT clip, avg(de) AS m_de, stddev_pop(de) AS s_de, quantile_cont(energy, 0.5) AS med, stddev_pop(energy) AS s_energy, avg(dl) AS m_dl, stddev_pop(dls) AS s_dl FROM d GROUP BY clip),
x AS (SELECT d.*, s.* EXCLUDE (clip), {_NEAR} FROM d JOIN s USING (clip) WINDOW o AS (PARTITION BY d.clip ORDER BY f)),
v AS (SELECT clip, f, 'cut' AS kind, {_at("diff")} AS t, diff AS strength FROM x WHERE p_diff IS NOT NULL AND n_diff IS NOT NULL AND {_peak("diff", "m_diff + 2.5 * (s_diff + 1e-9)")}
UNION ALL SELECT clip, f, unnest(['motion_spike', 'motion']), {_at("de")}, de FROM x WHERE p_diff IS NOT NULL AND n_diff IS NOT NULL AND {_peak("de", "m_de + 2 * (s_de + 1e-9)")}
UNION ALL SELECT clip, f, 'motion_stop', {_at("de", "-")}, -de FROM x WHERE p_diff IS NOT NULL AND n_diff IS NOT NULL AND de <= m_de - 2 * (s_de + 1e-9) AND de <= p_de AND de <= n_de AND p_energy > med + s_energy
UNION ALL SELECT clip, f, 'flash', pts, dl FROM x WHERE p_diff IS NOT NULL AND n_diff IS NOT NULL AND {_peak("dl", "m_dl + 3 * (s_dl + 1e-9)")})
SELECT clip, CAST(f AS BIGINT) AS f, kind, round(t * 1000, 1) AS t_ms_f, round(strength, 6) AS strength FROM v
""")
def q_frame_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts, motion spikes and stops, and flashes of the motion rows of each day, taken as frames."""
    k = F.col("k")
    n = F.row_number().over(Window.partitionBy("clip").orderBy("t_ms", "seq")).cast("bigint")
    frames = timeline(spark, sf_dir).where("kind = 'motion_spike'").select("clip", n.alias("f"), (F.col("t_ms") / 1000.0).alias("pts_s"), F.col("strength").alias("diff"), F.when(k % 4 != 0, k + 1.0).alias("flow"), (3.0 * k).alias("luma"))
    return motion.frame_events(frames).select("clip", "f", "kind", "t_ms_f", F.round("strength", 6).alias("strength"))


_CLASSES = (*CLASS_THRESHOLDS, "Dog")
_LEVELS = " ".join(f"WHEN '{c}' THEN {t}" for c, t in CLASS_THRESHOLDS.items())
_SQL_CLASSES = "[" + ", ".join(f"'{c}'" for c in _CLASSES) + "]"


@query(f"""
WITH p AS (SELECT vec_id // 100 AS clip, vec_id % 100 AS f, unnest(range(0, len(embedding))) AS c, abs(CAST(unnest(embedding) AS DOUBLE)) * 2 AS v FROM embeddings),
l AS (SELECT clip, f, c, v, {_SQL_CLASSES}[c % {len(_CLASSES)} + 1] AS class FROM p),
m AS (SELECT clip, f, c, class, greatest(least(a, v), least(greatest(a, v), b)) AS v, CASE class {_LEVELS} ELSE 0.5 END::DOUBLE AS lv FROM (SELECT *, lag(v, 1, v) OVER o AS a, lead(v, 1, v) OVER o AS b FROM l WINDOW o AS (PARTITION BY clip, c ORDER BY f))),
s AS (SELECT *, coalesce(last_value(CASE WHEN v >= lv THEN 1 WHEN v <= least(0.3, lv - 0.05) THEN 0 END IGNORE NULLS) OVER (PARTITION BY clip, c ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS st FROM m),
b AS (SELECT *, lag(st, 1, 0) OVER (PARTITION BY clip, c ORDER BY f) AS before FROM s), n AS (SELECT *, sum(CASE WHEN st = 1 AND before = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY clip, c ORDER BY f) AS n FROM b)
SELECT CAST(clip AS BIGINT) AS clip, class || '/' || c AS class, min(f) AS first_frame, max(f) AS last_frame, round(max(v), 6) AS peak FROM n WHERE st = 1 OR before = 1 GROUP BY clip, c, class, n
""")
def q_class_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of classes with thresholds of their own, over medians of three frames; an embedding's numbers are probabilities."""
    names = F.array(*map(F.lit, _CLASSES))
    p = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 100).alias("clip"), (F.col("vec_id") % 100).alias("frame"), F.posexplode("embedding").alias("c", "x"))
    p = p.select(F.concat_ws("/", F.col("clip").cast("string"), F.col("c").cast("string")).alias("clip"), "frame", F.get(names, F.col("c") % len(_CLASSES)).alias("class"), (F.abs(F.col("x").cast("double")) * 2).alias("p"))
    part = lambda i: F.get(F.split("clip", "/"), F.lit(i))
    return motion.class_events(p).select(part(0).cast("bigint").alias("clip"), F.concat_ws("/", "class", part(1)).alias("class"), F.col("start").alias("first_frame"), F.col("end").alias("last_frame"), F.round("peak", 6).alias("peak"))
