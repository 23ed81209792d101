"""Queries of proposals: near-duplicate folds, merging of two lists, sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.functions.text import PROPOSAL_STOPWORDS, VERIFY_STOPWORDS, overlap, tokens
from anchorline.operators.joins import range_join
from anchorline.operators.scans import first_close
from anchorline.operators.windows import sliding_windows
from anchorline.plans.registry import query
from anchorline.plans.views import TL, cues, sql_tokens, table, timeline

_NAMED = f"""{TL}, np AS (SELECT count(*) AS n FROM part),
named AS (SELECT c.clip, c.seq, c.start_ms AS t, c.audio_type, {{tokens}} AS w FROM cue c, np JOIN part p ON p.p_partkey = c.seq % np.n)"""
_VERIFY, _PROPOSE = (_NAMED.format(tokens=sql_tokens("p.p_name", x)) for x in (VERIFY_STOPWORDS, PROPOSAL_STOPWORDS))
_SIM = "len({0}.w) > 0 AND len(x.w) > 0 AND len(list_intersect(x.w, {0}.w)) / least(len(x.w), len({0}.w))::DOUBLE >= {1} AND x.audio_type = {0}.audio_type AND abs(x.t - {0}.t) <= {2}"
#: Least share of words and reach in ms (a reference millisecond is one second): of near-duplicates, and of proposals.
NEAR_DUPLICATE, PROPOSAL = (0.6, 100_000), (0.5, 400_000)


def _dedup_sql(source: str, near: tuple[float, int]) -> str:
    keep = "list_filter(r.kept, lambda x: " + _SIM.format("s", *near) + ")"
    return f"""s AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY t, seq) AS rn FROM {source}),
r AS (SELECT clip, rn, seq, CAST(NULL AS BIGINT) AS merged_into, [{{'seq': seq, 't': t, 'audio_type': audio_type, 'w': w}}] AS kept FROM s WHERE rn = 1
UNION ALL SELECT s.clip, s.rn, s.seq, {keep}[1].seq, CASE WHEN len({keep}) > 0 THEN r.kept ELSE list_append(r.kept, {{'seq': s.seq, 't': s.t, 'audio_type': s.audio_type, 'w': s.w}}) END FROM r JOIN s ON s.clip = r.clip AND s.rn = r.rn + 1)"""


def _named(spark: SparkSession, sf_dir: str, stopwords: Sequence[str]) -> DataFrame:
    part = table(spark, sf_dir, "part")
    n = part.agg(F.count(F.lit(1)).alias("n"))
    c = cues(spark, sf_dir).withColumn("__one", F.lit(1)).join(F.broadcast(n.withColumn("__one", F.lit(1))), "__one")
    named = c.withColumn("p_partkey", F.col("seq") % F.col("n")).join(part.select("p_partkey", tokens(F.col("p_name"), stopwords).alias("w")), "p_partkey")
    return named.select("clip", "seq", F.col("start_ms").alias("t"), "audio_type", "w")


def _deduped(df: DataFrame, close: tuple[float, int]) -> DataFrame:
    """(clip, seq, merged_into): rows compared with kept rows only, the first fitting one absorbs."""
    return first_close(df, ["clip", "audio_type"], "t", "seq", "w", close[1], close[0]).select("clip", "seq", "merged_into")


@query(f"WITH RECURSIVE {_VERIFY}, {_dedup_sql('named', NEAR_DUPLICATE)} SELECT clip, seq, merged_into FROM r")
def q_near_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(_named(spark, sf_dir, VERIFY_STOPWORDS), NEAR_DUPLICATE)


@query(f"""
WITH RECURSIVE {_PROPOSE}, p AS (SELECT * FROM named WHERE seq % 2 = 0), e AS (SELECT * FROM named WHERE seq % 2 = 1),
m AS (SELECT s.seq, arg_min(x.seq, x.seq) AS into_seq, arg_min(len(list_intersect(x.w, s.w)) / least(len(x.w), len(s.w))::DOUBLE, x.seq) AS sim FROM e s JOIN p x ON x.clip = s.clip AND {_SIM.format('s', *PROPOSAL)} GROUP BY s.seq), o AS (SELECT * FROM e WHERE seq NOT IN (SELECT seq FROM m)), {_dedup_sql('o', PROPOSAL)}
SELECT seq, into_seq AS merged_into, 'primary' AS absorbed_by, CASE WHEN sim < 0.85 THEN 'disagree' ELSE 'adopt' END AS label FROM m
UNION ALL SELECT seq, merged_into, CASE WHEN merged_into IS NULL THEN 'none' ELSE 'extra' END, CASE WHEN merged_into IS NULL THEN 'own' ELSE 'dropped' END FROM r
""")
def q_merge_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra proposals absorbed by the first primary that fits: its label stands if they are close, else both are noted."""
    named = _named(spark, sf_dir, PROPOSAL_STOPWORDS)
    extra = named.where("seq % 2 = 1")
    primary = named.where("seq % 2 = 0").select("clip", F.col("seq").alias("p_seq"), F.col("t").alias("p_t"), F.col("audio_type").alias("p_type"), F.col("w").alias("p_w"))
    sim = overlap(F.col("w"), F.col("p_w"))
    near = range_join(extra, primary, ["clip"], "t", "p_t", PROPOSAL[1]).where((F.col("audio_type") == F.col("p_type")) & (sim >= PROPOSAL[0]))
    absorbed = near.groupBy("seq").agg(F.min(F.struct("p_seq", sim.alias("sim"))).alias("p")).select("seq", F.col("p.p_seq").alias("merged_into"), F.when(F.col("p.sim") < 0.85, "disagree").otherwise("adopt").alias("label"))
    rest = _deduped(extra.join(absorbed.select("seq"), "seq", "left_anti"), PROPOSAL)
    alone = F.col("merged_into").isNull()
    return absorbed.select("seq", "merged_into", F.lit("primary").alias("absorbed_by"), "label").unionByName(rest.select("seq", "merged_into", F.when(alone, "none").otherwise("extra").alias("absorbed_by"), F.when(alone, "own").otherwise("dropped").alias("label")))


_NEAREST = "list_sort(list_transform(list_filter(cuts, lambda c: abs(c - ({0})) <= 1500000 AND c > {1}), lambda c: {{'d': abs(c - ({0})), 'c': c}}))[1].c"
_END = f"coalesce(least({_NEAREST.format('least(start + 6000000, 86400000)', 'start + 3000000')}, 86400000), least(start + 6000000, 86400000))"


@query(f"""
WITH RECURSIVE {TL}, c AS (SELECT clip, list(t_ms ORDER BY t_ms) AS cuts FROM tl WHERE kind = 'cut' GROUP BY clip),
r AS (SELECT clip, cuts, 0 AS i, CAST(0 AS BIGINT) AS start FROM c UNION ALL SELECT clip, cuts, i + 1, coalesce({_NEAREST.format('start + 5000000', 'start')}, start + 5000000) FROM r WHERE {_END} < 86400000)
SELECT clip, CAST(i AS BIGINT) AS i, start AS start_ms, CAST({_END} AS BIGINT) AS end_ms FROM r
""")
def q_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = timeline(spark, sf_dir).where("kind = 'cut'").groupBy("clip").agg(F.array_sort(F.collect_list("t_ms")).alias("cuts"))
    windows = sliding_windows(F.lit(86_400_000), F.col("cuts"), 6_000_000, 1_000_000, 1_500_000, 86_400_000)
    return c.select("clip", F.posexplode(windows).alias("i", "w")).select("clip", F.col("i").cast("bigint").alias("i"), F.col("w.start").alias("start_ms"), F.col("w.end").alias("end_ms"))
