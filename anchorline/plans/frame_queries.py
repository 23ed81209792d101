"""Queries of frames, hop windows and token intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.functions.numeric import half_even
from anchorline.operators import frames
from anchorline.plans.registry import query
from anchorline.plans.views import TL, table, timeline


@query(f"""
WITH {TL}, f AS (SELECT clip, kind, CAST(t_ms // 60000 AS BIGINT) AS frame, strength FROM tl), l AS (SELECT clip, kind, max(frame) + 1 AS frames FROM f GROUP BY ALL),
w AS (SELECT clip, kind, unnest(range(0, frames - 15 + 1, 10)) AS start FROM l WHERE frames >= 15)
SELECT w.clip, w.kind, w.start, count(f.strength) AS n, round(coalesce(avg(f.strength), 0), 5) AS mean FROM w LEFT JOIN f ON f.clip = w.clip AND f.kind = w.kind AND f.frame BETWEEN w.start AND w.start + 44 GROUP BY ALL
""")
def q_hop_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean strength of each kind in windows of 45 minutes every ten minutes, while a quarter of an hour is left."""
    f = timeline(spark, sf_dir).select("clip", "kind", F.floor(F.col("t_ms") / 60_000).cast("bigint").alias("frame"), "strength")
    length = f.groupBy("clip", "kind").agg((F.max("frame") + 1).alias("frames"))
    out = frames.sliding_means(f, ["clip", "kind"], "frame", "strength", length, size=45, hop=10, least=15)
    return out.select("clip", "kind", "start", "n", F.round("mean", 5).alias("mean"))


@query(f"""
WITH {TL}, p AS (SELECT clip, kind AS class, t_ms, CAST(t_ms // 14400000 AS BIGINT) * 14400 AS s1, strength_norm AS p FROM tl),
w AS (SELECT clip, class, s1 AS start, CAST(round_even((t_ms / 1000.0::DOUBLE - s1) / 600, 0) AS BIGINT) AS i, p FROM p UNION ALL SELECT clip, class, s1 - 7200, CAST(round_even((t_ms / 1000.0::DOUBLE - s1 + 7200) / 600, 0) AS BIGINT), p / 2 FROM p WHERE s1 >= 7200 AND t_ms / 1000.0::DOUBLE - s1 < 7200),
c AS (SELECT clip, max(t_ms) / 1000.0::DOUBLE AS duration FROM p GROUP BY clip),
u AS (SELECT w.clip, w.class, CAST(round_even(w.start / 600.0::DOUBLE + w.i, 0) AS BIGINT) AS frame, w.p FROM w JOIN c USING (clip) WHERE duration - w.start >= 3600 AND round_even(w.start / 600.0::DOUBLE + w.i, 0) < greatest(1, ceil(duration / 600))),
m AS (SELECT clip, frame, class, avg(p) AS p FROM u GROUP BY ALL),
g AS (SELECT clip, class, unnest(range(0, CAST(greatest(1, ceil(duration / 600)) AS BIGINT))) AS frame FROM (SELECT DISTINCT clip, class FROM w) JOIN c USING (clip))
SELECT clip, frame, class, round(coalesce(p, 0), 9) AS p FROM g LEFT JOIN m USING (clip, frame, class)
""")
def q_overlap_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What windows of four hours that overlap by half say of each kind, as one value for every ten minutes; short tails don't count."""
    seconds = F.col("t_ms") / 1000.0
    p = timeline(spark, sf_dir).select("clip", F.col("kind").alias("class"), seconds.alias("t"), (F.floor(seconds / 14_400) * 14_400).cast("bigint").alias("s"), F.col("strength_norm").alias("p"))
    own = p.select("clip", "class", F.col("s").alias("start"), half_even((F.col("t") - F.col("s")) / 600).alias("i"), "p")
    before = p.where((F.col("s") >= 7200) & (F.col("t") - F.col("s") < 7200)).select("clip", "class", (F.col("s") - 7200).alias("start"), half_even((F.col("t") - F.col("s") + 7200) / 600).alias("i"), (F.col("p") / 2).alias("p"))
    out = frames.overlap_add(own.unionByName(before), "clip", p.groupBy("clip").agg(F.max("t").alias("duration")), hop=600, least_tail=3600)
    return out.select("clip", "frame", "class", F.round("p", 9).alias("p"))


@query("""
WITH o AS (SELECT o_orderkey, CAST(trunc(o_totalprice / 20) AS BIGINT) AS ms, [24.0, 25.0, 29.97, 0.5][o_custkey % 4 + 1]::DOUBLE AS fps FROM orders),
w AS (SELECT *, unnest(range(0, ms, 4000)) AS window_ms FROM o), s AS (SELECT *, window_ms / 1000.0::DOUBLE AS a, least(ms / 1000.0::DOUBLE, window_ms / 1000.0::DOUBLE + 4) AS b FROM w),
t AS (SELECT *, (greatest(a, b - 1.0::DOUBLE / greatest(fps, 1.0)) - a) / 15 AS step, unnest(range(0, 8)) AS i FROM s)
SELECT o_orderkey, window_ms, window_ms // 4000 * 8 + i AS token_index, greatest(0, CAST(round_even(CASE WHEN i = 0 THEN a ELSE ((a + (i * 2 - 1) * step) + (a + i * 2 * step)) / 2 END * 1000, 0) AS BIGINT)) AS start_ms,
least(ms, CAST(round_even(CASE WHEN i = 7 THEN b ELSE ((a + (i * 2 + 1) * step) + (a + (i * 2 + 2) * step)) / 2 END * 1000, 0) AS BIGINT)) AS end_ms FROM t
""")
def q_token_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval that each pooled video token of a clip covers; an order's price is its clip's length."""
    rates = F.array(*[F.lit(x) for x in (24.0, 25.0, 29.97, 0.5)])
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 20).cast("bigint").alias("ms"), F.get(rates, (F.col("o_custkey") % 4).cast("int")).alias("fps"))
    return o.select("o_orderkey", F.inline(frames.token_intervals(F.col("ms"), F.col("fps"))))
