"""Queries of aggregations, sets, scalar functions, projections, top-k and table upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.functions.numeric import clamp, half_even, or_else
from anchorline.functions.text import ONTOLOGY, STOPWORDS, index_suffix, map_label, overlap, rate, stem_name, tokens
from anchorline.operators.joins import nearest_within
from anchorline.plans.registry import query
from anchorline.plans.views import TL, cues, sql_tokens, table, timeline
from anchorline.sources.files import parse_json_objects, repair_json
from anchorline.operators.tables import replace_scope, split_lists, upsert_latest

_STOP = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"

@query(f"""
WITH {TL} SELECT clip, count(*) FILTER (WHERE kind = 'audio_onset') AS audio_onset, count(*) FILTER (WHERE kind = 'sed_event') AS sed_event, count(*) FILTER (WHERE kind = 'cut') AS cut,
count(*) FILTER (WHERE kind = 'motion_spike') AS motion_spike, count(*) FILTER (WHERE kind = 'speech_start') AS speech_start, count(*) AS total FROM tl GROUP BY clip
""")
def q_kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ("audio_onset", "sed_event", "cut", "motion_spike", "speech_start")
    return timeline(spark, sf_dir).groupBy("clip").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds], F.count(F.lit(1)).alias("total"))


@query(f"""
WITH {TL}, m AS (SELECT c.cue_id, c.audio_type, min(abs(a.t_ms - c.start_ms)) AS d FROM cue c LEFT JOIN tl a ON a.clip = c.clip AND a.kind = 'audio_onset' AND abs(a.t_ms - c.start_ms) <= 250000 GROUP BY c.cue_id, c.audio_type)
SELECT audio_type, count(*) AS n, count(d) AS n_delta, round(avg(d), 1) AS mean_delta, CAST(max(d) AS BIGINT) AS max_delta FROM m GROUP BY audio_type
""")
def q_delta_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = timeline(spark, sf_dir).where("kind = 'audio_onset'").select("clip", "t_ms", F.col("seq").alias("a"))
    c = cues(spark, sf_dir).select("clip", "cue_id", "audio_type", "start_ms")
    d = F.abs(F.col("t_ms") - F.col("start_ms"))
    m = nearest_within(c, a, ["clip"], "start_ms", "t_ms", 250_000, ["a"], ["t_ms"]).select("audio_type", d.alias("d"))
    return m.groupBy("audio_type").agg(F.count(F.lit(1)).alias("n"), F.count("d").alias("n_delta"), F.round(F.avg("d"), 1).alias("mean_delta"), F.max("d").alias("max_delta"))


_MATCH = f"""
{TL}, m AS (SELECT p.clip, p.seq, p.t_ms AS pt, g.t_ms AS gt, g.seq AS g, p.k AS pk, g.k AS gk, row_number() OVER (PARTITION BY p.seq ORDER BY abs(g.t_ms - p.t_ms), g.seq) AS rn FROM tl p JOIN tl g
  ON g.clip = p.clip AND g.kind = 'sed_event' AND abs(g.t_ms - p.t_ms) <= 200000 WHERE p.kind = 'audio_onset'),
e AS (SELECT clip, seq, g, abs(gt - pt) / 1000.0::DOUBLE AS err, (gt + 1000 * gk) - (pt + 1000 * pk) AS off FROM m WHERE rn = 1)
"""


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tl = timeline(spark, sf_dir)
    p = tl.where("kind = 'audio_onset'").select("clip", "seq", F.col("t_ms").alias("pt"), F.col("k").alias("pk"))
    g = tl.where("kind = 'sed_event'").select("clip", F.col("seq").alias("g"), F.col("t_ms").alias("gt"), F.col("k").alias("gk"))
    m = nearest_within(p, g, ["clip"], "pt", "gt", 200_000, ["g"], ["g", "gt", "gk"]).where("g IS NOT NULL")
    return m.select("clip", "seq", "g", (F.abs(F.col("gt") - F.col("pt")) / 1000.0).alias("err"), ((F.col("gt") + 1000 * F.col("gk")) - (F.col("pt") + 1000 * F.col("pk"))).alias("off"))


@query(f"""
WITH {_MATCH} SELECT coalesce(clip, 'all') AS clip, count(*) AS n, round(quantile_cont(err, 0.5), 9) AS median, round(quantile_cont(err, 0.9), 9) AS p90, round(avg(err), 9) AS mean,
round(100.0::DOUBLE * count(*) FILTER (WHERE err <= 20) / count(*), 9) AS le20, round(100.0::DOUBLE * count(*) FILTER (WHERE err <= 50) / count(*), 9) AS le50,
round(100.0::DOUBLE * count(*) FILTER (WHERE err <= 100) / count(*), 9) AS le100, round(100.0::DOUBLE * count(*) FILTER (WHERE err <= 200) / count(*), 9) AS le200 FROM e GROUP BY ROLLUP (clip)
""")
def q_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = lambda ms: F.round(100.0 * F.count_if(F.col("err") <= ms) / F.count(F.lit(1)), 9)
    out = _matches(spark, sf_dir).rollup("clip").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.percentile("err", 0.5), 9).alias("median"), F.round(F.percentile("err", 0.9), 9).alias("p90"), F.round(F.avg("err"), 9).alias("mean"), share(20).alias("le20"), share(50).alias("le50"), share(100).alias("le100"), share(200).alias("le200")
    )
    return out.withColumn("clip", F.coalesce("clip", F.lit("all")))


@query(f"""
WITH {_MATCH}, t AS (SELECT clip, count(DISTINCT g) AS tp FROM e GROUP BY clip), n AS (SELECT clip, count(*) FILTER (WHERE kind = 'audio_onset') AS np, count(*) FILTER (WHERE kind = 'sed_event') AS ng FROM tl GROUP BY clip),
s AS (SELECT coalesce(clip, 'all') AS clip, CAST(sum(coalesce(tp, 0)) AS BIGINT) AS tp, CAST(sum(np) AS BIGINT) AS np, CAST(sum(ng) AS BIGINT) AS ng FROM n LEFT JOIN t USING (clip) GROUP BY ROLLUP (clip))
SELECT clip, tp, np - tp AS fp, ng - tp AS fn, round(CASE WHEN np > 0 THEN tp / np::DOUBLE ELSE 0 END, 9) AS precision, round(CASE WHEN ng > 0 THEN tp / ng::DOUBLE ELSE 0 END, 9) AS recall,
round(CASE WHEN np + ng > 0 THEN 2 * tp / (np + ng)::DOUBLE ELSE 0 END, 9) AS f1 FROM s
""")
def q_prf_at_collar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of each clip, and of all from their pooled counts."""
    tp = _matches(spark, sf_dir).groupBy("clip").agg(F.countDistinct("g").alias("tp"))
    n = timeline(spark, sf_dir).groupBy("clip").agg(F.count_if(F.col("kind") == "audio_onset").alias("np"), F.count_if(F.col("kind") == "sed_event").alias("ng"))
    s = n.join(tp, "clip", "left").rollup("clip").agg(F.sum(F.coalesce("tp", F.lit(0))).alias("tp"), F.sum("np").alias("np"), F.sum("ng").alias("ng"))
    ratio = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)), 9)
    return s.select(
        F.coalesce("clip", F.lit("all")).alias("clip"), "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("ng") - F.col("tp")).alias("fn"),
        ratio(F.col("tp"), F.col("np")).alias("precision"), ratio(F.col("tp"), F.col("ng")).alias("recall"), ratio(2 * F.col("tp"), F.col("np") + F.col("ng")).alias("f1"),
    )


@query(f"WITH {_MATCH} SELECT clip, count(*) AS n, round(quantile_cont(abs(off), 0.5), 6) AS median_abs, round(avg(off), 6) AS mean FROM e GROUP BY clip")
def q_offset_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir).groupBy("clip").agg(F.count(F.lit(1)).alias("n"), F.round(F.percentile(F.abs("off"), 0.5), 6).alias("median_abs"), F.round(F.avg("off"), 6).alias("mean"))


@query(f"""
WITH {TL}, g AS (SELECT clip, kind, (t_ms - lag(t_ms) OVER (PARTITION BY clip, kind ORDER BY t_ms, seq)) / 1000.0::DOUBLE AS gap FROM tl),
s AS (SELECT clip, kind, count(*) AS n, count(*) / 864.0::DOUBLE AS per_sec, quantile_cont(gap, 0.5) AS med, quantile_cont(gap, 0.1) AS p10 FROM g GROUP BY clip, kind)
SELECT clip, kind, n, round(per_sec, 6) AS per_sec, round(med, 6) AS median_gap, round(p10, 6) AS p10_gap, round(least(1.0::DOUBLE, greatest(0, least(1.0::DOUBLE, (per_sec - 0.08) / 0.2)) + greatest(0, coalesce(least(1.0::DOUBLE, (800 - med) / 800), 0))), 3) AS noise,
row_number() OVER (PARTITION BY clip ORDER BY n DESC, kind) AS place FROM s
""")
def q_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = (F.col("t_ms") - F.lag("t_ms").over(Window.partitionBy("clip", "kind").orderBy("t_ms", "seq"))) / 1000.0
    s = timeline(spark, sf_dir).select("clip", "kind", gap.alias("gap")).groupBy("clip", "kind").agg(F.count(F.lit(1)).alias("n"), F.percentile("gap", 0.5).alias("med"), F.percentile("gap", 0.1).alias("p10"))
    s = s.withColumn("per_sec", F.col("n") / 864.0)
    part = lambda c: F.greatest(F.lit(0.0), F.coalesce(F.least(F.lit(1.0), c), F.lit(0.0)))
    noise = F.least(F.lit(1.0), part((F.col("per_sec") - 0.08) / 0.2) + part((800 - F.col("med")) / 800))
    return s.select("clip", "kind", "n", F.round("per_sec", 6).alias("per_sec"), F.round("med", 6).alias("median_gap"), F.round("p10", 6).alias("p10_gap"), F.round(noise, 3).alias("noise"), F.row_number().over(Window.partitionBy("clip").orderBy(F.desc("n"), "kind")).cast("bigint").alias("place"))


@query("""
SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders UNION SELECT l_orderkey FROM lineitem)) AS all_ids, (SELECT count(DISTINCT o_custkey) FROM orders) AS distinct_customers,
greatest((SELECT count(DISTINCT o_custkey) FROM orders), (SELECT count(*) FROM customer)) AS most, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS pairs
""")
def q_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    one = orders.agg(F.countDistinct("o_custkey").alias("distinct_customers"))
    ids = orders.select("o_orderkey").union(lines.select("l_orderkey")).distinct().agg(F.count(F.lit(1)).alias("all_ids"))
    customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("c"))
    pairs = lines.agg(F.countDistinct("l_orderkey", "l_linenumber").alias("pairs"))
    # Four one-row aggregates side by side.
    rows = [x.withColumn("__k", F.lit(1)) for x in (one, ids, customers, pairs)]
    joined = rows[0].join(rows[1], "__k").join(rows[2], "__k").join(rows[3], "__k")
    return joined.select("all_ids", "distinct_customers", F.greatest("distinct_customers", "c").alias("most"), "pairs")


@query("""
WITH k AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders), s AS (SELECT id, CAST('0x' || left(sha256(id), 8) AS BIGINT) % 100 AS n FROM k),
l AS (SELECT id, CASE WHEN n < 80 THEN 'train' WHEN n < 90 THEN 'validation' ELSE 'test' END AS split FROM s), c AS (SELECT split, count(*) AS n FROM l GROUP BY split)
SELECT split, id, n FROM l JOIN c USING (split)
""")
def q_split_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of each split, a row each, and how many the split has: no list is gathered."""
    lists = split_lists(table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id")), "id")
    # One row for each of three splits.
    sizes = lists.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return lists.join(F.broadcast(sizes), "split").select("split", "id", "n")


@query("""
SELECT coalesce(CAST(o_custkey AS VARCHAR), 'all') AS video, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, bool_and(o_orderstatus = 'F') AS all_finished
FROM orders GROUP BY ROLLUP (o_custkey)
""")
def q_outcome_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    out = table(spark, sf_dir, "orders").rollup("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(status == "F").alias("finished"), F.count_if(status == "O").alias("open"), F.every(status == "F").alias("all_finished"))
    return out.select(F.coalesce(F.col("o_custkey").cast("string"), F.lit("all")).alias("video"), "n", "finished", "open", "all_finished")


@query(f"""
WITH {TL} SELECT seq, round((strength - avg(strength) OVER w) / (stddev_pop(strength) OVER w + 1e-9), 6) AS z, round(strength / max(strength) OVER (PARTITION BY clip, kind), 6) AS rel FROM tl WINDOW w AS (PARTITION BY clip)
""")
def q_global_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    tl = timeline(spark, sf_dir).select("seq", "clip", "kind", "strength")
    # Sums of clips and kinds are combined before the shuffle and joined back; no clip is gathered.
    clips = tl.groupBy("clip").agg(F.avg("strength").alias("m"), F.stddev_pop("strength").alias("d"))
    kinds = tl.groupBy("clip", "kind").agg(F.max("strength").alias("top"))
    z = (F.col("strength") - F.col("m")) / (F.col("d") + 1e-9)
    return tl.join(clips, "clip").join(kinds, ["clip", "kind"]).select("seq", F.round(z, 6).alias("z"), F.round(F.col("strength") / F.col("top"), 6).alias("rel"))


_PROB = "prob AS (SELECT vec_id, unnest(range(0, len(embedding))) AS c, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"


def _prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("c", "v")).select("vec_id", F.col("c").cast("bigint").alias("c"), F.col("v").cast("double").alias("v"))


@query(f"""
WITH {_PROB}, w AS (SELECT vec_id // 10 * 10 AS win, vec_id, c, v FROM prob UNION ALL SELECT (vec_id - 5) // 10 * 10 + 5, vec_id, c, v FROM prob WHERE vec_id >= 5)
SELECT vec_id AS frame, c, round(avg(v), 5) AS mean_v, count(*) AS n FROM w GROUP BY vec_id, c
""")
def q_overlap_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prob(spark, sf_dir)
    starts = F.filter(F.array(F.floor(F.col("vec_id") / 10) * 10, F.floor((F.col("vec_id") - 5) / 10) * 10 + 5), lambda s: s >= 0)
    return p.select(F.col("vec_id").alias("frame"), "c", "v", F.explode(starts)).groupBy("frame", "c").agg(F.round(F.avg("v"), 5).alias("mean_v"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PROB} SELECT e.label, p.c, round(avg(p.v), 5) AS mean_v FROM prob p JOIN embeddings e USING (vec_id) GROUP BY e.label, p.c")
def q_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("c", "v"))
    return x.groupBy("label", F.col("c").cast("bigint").alias("c")).agg(F.round(F.avg(F.col("v").cast("double")), 5).alias("mean_v"))


@query(f"""
WITH {TL}, b AS (SELECT clip, CAST(round_even(t_ms / 600000.0::DOUBLE, 0) AS BIGINT) AS bucket, max(strength) FILTER (WHERE kind = 'audio_onset') AS onset, arg_max(strength, seq) FILTER (WHERE kind = 'motion_spike') AS motion FROM tl GROUP BY 1, 2)
SELECT clip, bucket, round(coalesce(onset, 0), 6) AS onset, round(coalesce(motion, 0), 6) AS motion, round((lag(coalesce(onset, 0), 1, 0) OVER w + coalesce(onset, 0) + lead(coalesce(onset, 0), 1, 0) OVER w) / 3, 6) AS smooth FROM b WINDOW w AS (PARTITION BY clip ORDER BY bucket)
""")
def q_bucket_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    b = timeline(spark, sf_dir).groupBy("clip", half_even(F.col("t_ms") / 600_000.0).alias("bucket")).agg(F.coalesce(F.max(of("audio_onset", "strength")), F.lit(0.0)).alias("onset"), F.coalesce(F.max_by(of("motion_spike", "strength"), of("motion_spike", "seq")), F.lit(0.0)).alias("motion"))
    w = Window.partitionBy("clip").orderBy("bucket")
    smooth = (F.lag("onset", 1, 0.0).over(w) + F.col("onset") + F.lead("onset", 1, 0.0).over(w)) / 3
    return b.select("clip", "bucket", F.round("onset", 6).alias("onset"), F.round("motion", 6).alias("motion"), F.round(smooth, 6).alias("smooth"))


@query("""
SELECT user_id, left(string_agg(event_id || ': ERROR: k=' || json_extract_string(props, '$.k'), '; ' ORDER BY event_id), 500) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id
""")
def q_error_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.col("event_id").cast("string"), F.lit(": ERROR: k="), F.get_json_object("props", "$.k"))
    # A message has ten characters at least, so the first fifty fill the text: no more are gathered. Those without one don't count.
    has = F.col("x.m").isNotNull()
    x = table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", F.struct("event_id", said.alias("m")).alias("x"))
    nth = F.row_number().over(Window.partitionBy("user_id", has).orderBy("x.event_id"))
    first = x.withColumn("nth", nth).groupBy("user_id").agg(F.sort_array(F.collect_list(F.when(has & (F.col("nth") <= 50), F.col("x")))).alias("x"))
    return first.select("user_id", F.when(F.size("x") > 0, F.left(F.array_join(F.transform("x", lambda e: e["m"]), "; "), F.lit(500))).alias("errors"))


@query("""
SELECT conv_id, count(*) AS n_calls, count(*) FILTER (WHERE role = 'assistant') AS n_answers, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars, min(turn) AS first_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id
""")
def q_call_log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_calls"), F.count_if(F.col("role") == "assistant").alias("n_answers"), F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("chars"), F.min("turn").alias("first_turn"), F.max_by("role", "turn").alias("last_role")
    )


@query("SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) > 1 THEN role || '_' || turn ELSE role END AS cue_id FROM conversations")
def q_unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")) > 1
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(again, F.concat_ws("_", "role", F.col("turn").cast("string"))).otherwise(F.col("role")).alias("cue_id"))


@query(f"""
WITH {TL}, p AS (SELECT *, t_ms // 6000000 AS win, CASE kind WHEN 'sed_event' THEN 1 WHEN 'audio_onset' THEN 2 WHEN 'cut' THEN 5 ELSE 7 END AS pri FROM tl),
r AS (SELECT *, row_number() OVER (PARTITION BY clip, win ORDER BY pri, strength DESC, seq) AS rn FROM p)
SELECT clip, CAST(win AS BIGINT) AS win, count(*) AS n, string_agg(seq || ' ' || kind || ' ' || stem, '; ' ORDER BY t_ms, seq) AS lines FROM r WHERE rn <= 8 GROUP BY clip, win
""")
def q_prompt_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("kind") == "sed_event", 1).when(F.col("kind") == "audio_onset", 2).when(F.col("kind") == "cut", 5).otherwise(7)
    p = timeline(spark, sf_dir).withColumns({"win": F.floor(F.col("t_ms") / 6_000_000), "pri": priority})
    top = p.withColumn("rn", F.row_number().over(Window.partitionBy("clip", "win").orderBy("pri", F.desc("strength"), "seq"))).where("rn <= 8")
    line = F.concat_ws(" ", F.col("seq").cast("string"), "kind", "stem")
    return top.groupBy("clip", "win").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("t_ms", "seq", line.alias("l")))), lambda x: x["l"]), "; ").alias("lines"))


@query(f"""
WITH {_PROB}, r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, c) AS rn FROM prob)
SELECT vec_id, string_agg(CAST(c AS VARCHAR), ',' ORDER BY rn) AS top, round(max(v), 6) AS best FROM r WHERE rn <= 5 GROUP BY vec_id
""")
def q_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.transform("embedding", lambda x, i: F.struct((-x).alias("v"), i.alias("c")))
    top = F.slice(F.sort_array(pairs), 1, 5)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(F.transform(top, lambda x: x["c"].cast("string")), ",").alias("top"), F.round(F.array_max("embedding").cast("double"), 6).alias("best"))


@query(f"""
WITH {TL} SELECT seq, clip, t_ms, kind || '|' || stem AS label, 'pred' AS origin FROM tl WHERE kind IN ('audio_onset', 'sed_event', 'speech_start', 'music_boundary')
UNION ALL SELECT seq, clip, start_ms, audio_type, 'cue' FROM cue
""")
def q_union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = timeline(spark, sf_dir).where(F.col("kind").isin("audio_onset", "sed_event", "speech_start", "music_boundary")).select("seq", "clip", "t_ms", F.concat_ws("|", "kind", "stem").alias("label"), F.lit("pred").alias("origin"))
    return a.unionByName(cues(spark, sf_dir).select("seq", "clip", F.col("start_ms").alias("t_ms"), F.col("audio_type").alias("label"), F.lit("cue").alias("origin")))


@query(f"""
WITH d AS (SELECT doc_id, {sql_tokens("text")} AS w FROM documents), b AS (SELECT item_id, {sql_tokens("text")} AS w FROM benchmark),
s AS (SELECT doc_id, unnest(w) AS t FROM d), u AS (SELECT item_id, unnest(w) AS t FROM b), m AS (SELECT doc_id, item_id, count(*) AS shared FROM s JOIN u USING (t) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, round(shared / least(len(d.w), len(b.w))::DOUBLE, 6) AS sim FROM m JOIN d USING (doc_id) JOIN b USING (item_id) WHERE shared / least(len(d.w), len(b.w))::DOUBLE >= 0.6
""")
def q_token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share 0.6 of the smaller one's tokens.

    Such a pair shares one of the rarest tokens of its smaller side: of n tokens, one of the first n - ceil(0.6 n) + 1.
    Only those meet; common tokens of large texts never do. The sets of the pairs found are then compared whole.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("w")).where(F.size("w") > 0)
    b = table(spark, sf_dir, "benchmark").select("item_id", tokens(F.col("text")).alias("w")).where(F.size("w") > 0)
    s = d.select("doc_id", F.size("w").alias("nd"), F.explode("w").alias("t"))
    u = b.select("item_id", F.size("w").alias("nb"), F.explode("w").alias("t"))
    often = s.groupBy("t").agg(F.count(F.lit(1)).alias("docs"))

    def rarest(x: DataFrame, key: str, n: str) -> DataFrame:
        ranked = x.join(often, "t", "left").groupBy(key, n).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "t"))).alias("r"))
        return ranked.select(key, n, F.explode(F.slice("r", F.lit(1), (F.col(n) - F.ceil(F.col(n) * 0.6 - 1e-9) + 1).cast("int"))).alias("x")).select(key, n, F.col("x.t").alias("t"))

    largest = u.agg(F.max("nb")).first()[0] or 0
    small_items = s.join(rarest(u, "item_id", "nb"), "t").where("nd >= nb").select("doc_id", "item_id")
    small_docs = rarest(s.where(F.col("nd") < largest), "doc_id", "nd").join(u, "t").where("nd < nb").select("doc_id", "item_id")
    met = small_items.unionAll(small_docs).distinct().join(b.withColumnRenamed("w", "v"), "item_id").join(d, "doc_id")
    shared, least = F.size(F.array_intersect("w", "v")).cast("long"), F.least(F.size("w"), F.size("v"))
    sim = shared / least.cast("double")
    return met.where(sim >= 0.6).select("doc_id", "item_id", shared.alias("shared"), F.round(sim, 6).alias("sim"))


@query("""
WITH u AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_replace(url, '[?#].*$', '') AS bare FROM pages), old AS (SELECT DISTINCT bare FROM u WHERE page_id % 2 = 0),
n AS (SELECT bare, min(page_id) AS page_id, min(host) AS host FROM u WHERE page_id % 2 = 1 AND bare NOT IN (SELECT bare FROM old) GROUP BY bare)
SELECT page_id, host, bare AS url, regexp_extract(bare, '([^/]*?)(\\.[^./]*)?$', 1) AS stem FROM n
""")
def q_add_new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_replace("url", r"[?#].*$", "").alias("bare"))
    old = u.where("page_id % 2 = 0").select("bare")
    new = u.where("page_id % 2 = 1").join(old, "bare", "left_anti").groupBy("bare").agg(F.min("page_id").alias("page_id"), F.min("host").alias("host"))
    return new.select("page_id", "host", F.col("bare").alias("url"), stem_name(F.col("bare")).alias("stem"))


@query("""
WITH a AS (SELECT o_custkey AS k, o_orderkey AS v, o_orderstatus AS s, 0 AS batch FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, 1 FROM orders WHERE o_orderkey % 3 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY batch DESC, v DESC) AS rn FROM a) SELECT k AS custkey, v AS orderkey, s AS status FROM r WHERE rn = 1
""")
def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"))
    return upsert_latest(o.where("orderkey % 3 != 0"), o.where("orderkey % 3 = 0"), ["custkey"], "orderkey")


@query("""
WITH q AS (SELECT o_orderkey AS id, o_custkey AS video, o_orderpriority AS label FROM orders), fresh AS (SELECT event_id AS id, user_id AS video, 'pseudo' AS label FROM events WHERE event_type = 'purchase')
SELECT id, video, label FROM q WHERE NOT (label = '5-LOW' AND video IN (SELECT video FROM fresh)) UNION ALL SELECT * FROM fresh
""")
def q_scoped_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("video"), F.col("o_orderpriority").alias("label"))
    fresh = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("id"), F.col("user_id").alias("video"), F.lit("pseudo").alias("label"))
    return replace_scope(old, fresh, ["video"], F.col("label") == "5-LOW")


@query(f"""
WITH p AS (SELECT p_partkey, p_retailprice / 2000 AS prob, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda w: w NOT IN {_STOP})) AS a, list_distinct(list_filter(regexp_extract_all(lower(p_type), '[a-z0-9]+'), lambda w: w NOT IN {_STOP})) AS b FROM part)
SELECT p_partkey, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, prob * greatest(0.15::DOUBLE, CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b))::DOUBLE ELSE 0 END))), 9) AS score FROM p
""")
def q_class_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    sim = overlap(tokens(F.col("p_name"), stem=False), tokens(F.col("p_type"), stem=False))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(clamp(F.col("p_retailprice") / 2000 * F.greatest(F.lit(0.15), sim), 0.0, 1.0), 9).alias("score"))


def _sql_label(c: str, at: int) -> str:
    return "CASE " + " ".join(f"WHEN lower({c}) LIKE '%{r[0]}%' THEN '{r[at]}'" for r in ONTOLOGY) + f" ELSE '{('SFX', 'noise_burst')[at - 1]}' END"


@query(f"SELECT doc_id, {_sql_label('text', 1)} AS audio_type, {_sql_label('text', 2)} AS acoustic_group FROM documents")
def q_ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, group = map_label(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", kind.alias("audio_type"), group.alias("acoustic_group"))


@query("""
SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '#([0-9]+)$', 1) AS INTEGER) AS idx, round(p_size / nullif(p_partkey % 5, 0)::DOUBLE, 6) AS fps FROM part
""")
def q_parse_rate_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    fraction = F.concat_ws("/", F.col("p_size").cast("string"), (F.col("p_partkey") % 5).cast("string"))
    return p.select("p_partkey", index_suffix(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("idx"), F.round(rate(fraction), 6).alias("fps"))


@query("SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, true AS ok FROM events")
def q_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects recovered from properties of which every third lost its end."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")).alias("props"))
    fixed = e.select("event_id", repair_json(F.col("props")).alias("j"))
    return fixed.select("event_id", F.get_json_object("j", "$.k").try_cast("int").alias("k"), F.col("j").isNotNull().alias("ok"))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice) AS total, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, concat_ws('+', CASE WHEN l.n IS NULL THEN 'no_lines' END, CASE WHEN o_totalprice <= 0 THEN 'price' END, CASE WHEN l.first_ship < o_orderdate THEN 'order_after_ship' END) AS problems
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey WHERE l.n IS NULL OR o_totalprice <= 0 OR l.first_ship < o_orderdate
""")
def q_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ship"))
    checks = {"no_lines": F.col("n").isNull(), "price": F.col("o_totalprice") <= 0, "order_after_ship": F.col("first_ship") < F.col("o_orderdate")}
    problems = F.concat_ws("+", *[F.when(c, F.lit(k)) for k, c in checks.items()])
    return table(spark, sf_dir, "orders").join(l, "o_orderkey", "left").select("o_orderkey", problems.alias("problems")).where("problems != ''")


@query("""
WITH h AS (SELECT doc_id, source, sha256(text) AS h FROM documents), c AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h)
SELECT doc_id, h AS clip_sha256, first <> doc_id AS reused FROM h JOIN c USING (h)
""")
def q_cache_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("clip_sha256"))
    first = h.groupBy("clip_sha256").agg(F.min("doc_id").alias("first"))
    return h.join(first, "clip_sha256").select("doc_id", "clip_sha256", (F.col("first") != F.col("doc_id")).alias("reused"))


@query(f"WITH {TL} SELECT cue_id, start_ms BETWEEN 20000000 - 200 AND 40000000 + 200 AS in_window, duration_ms BETWEEN 12000 AND 40000 AS right_length FROM cue WHERE start_ms BETWEEN 19999800 AND 40000200 OR duration_ms BETWEEN 12000 AND 40000")
def q_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    window, length = F.col("start_ms").between(20_000_000 - 200, 40_000_000 + 200), F.col("duration_ms").between(12_000, 40_000)
    return cues(spark, sf_dir).where(window | length).select("cue_id", window.alias("in_window"), length.alias("right_length"))


@query("""SELECT c_custkey, n_name, '{"c_custkey":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' AS preview FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def q_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    preview = F.to_json(F.struct("c_custkey", F.col("c_mktsegment").alias("segment")))
    return table(spark, sf_dir, "customer").join(n, "c_nationkey").select("c_custkey", "n_name", preview.alias("preview"))


@query(f"""
WITH {TL} SELECT seq, round(0.35 * CASE WHEN strength_norm = 0 THEN least(1.0::DOUBLE, strength / 10) ELSE strength_norm END + 0.30 * CASE WHEN kind = 'sed_event' THEN strength_norm ELSE 0 END
+ 0.15 * least(1.0::DOUBLE, greatest(0.0::DOUBLE, snr_db / 20)) + 0.15 * CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + 0.05 * CASE WHEN k % 5 = 0 THEN 0 ELSE 1 END, 6) AS score,
CASE kind WHEN 'sed_event' THEN 'sed+superflux' ELSE 'superflux' END AS sources FROM tl
""")
def q_fusion_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    sed = F.col("kind") == "sed_event"
    onset = or_else(F.col("strength_norm"), F.least(F.lit(1.0), F.col("strength") / 10))
    score = 0.35 * onset + 0.30 * F.when(sed, F.col("strength_norm")).otherwise(0.0) + 0.15 * clamp(F.col("snr_db") / 20, 0.0, 1.0) + 0.15 * (F.col("k") % 2 == 0).cast("int") + 0.05 * (F.col("k") % 5 != 0).cast("int")
    sources = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(F.lit("superflux"), F.when(sed, F.lit("sed")))))), "+")
    return timeline(spark, sf_dir).select("seq", F.round(score, 6).alias("score"), sources.alias("sources"))


@query("""
SELECT vec_id, round(1000 * CAST(embedding[least(greatest(vec_id % 100 - 10, 0), len(embedding) - 1) + 1] AS DOUBLE), 5) AS t_ms FROM embeddings
""")
def q_pts_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = clamp(F.col("vec_id") % 100 - 10, F.lit(0), F.size("embedding") - 1).cast("int")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(1000 * F.get("embedding", at).cast("double"), 5).alias("t_ms"))


@query(f"""
WITH {TL} SELECT seq, last_value(CASE WHEN kind = 'cut' THEN t_ms END IGNORE NULLS) OVER (PARTITION BY clip ORDER BY t_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clock_ms FROM tl
""")
def q_carry_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("clip").orderBy("t_ms", "seq").rowsBetween(Window.unboundedPreceding, 0)
    return timeline(spark, sf_dir).select("seq", F.last(F.when(F.col("kind") == "cut", F.col("t_ms")), ignorenulls=True).over(w).alias("clock_ms"))


@query("""
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS pos, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
""")
def q_jsonl_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects out of text in which they are strung together, every fifth piece being broken."""
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{oops "), "props")).otherwise(F.col("props")).alias("x"), "event_id")
    text = e.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "x"))), lambda r: r["x"]), "\n").alias("text"))
    out = text.select("user_id", F.posexplode(parse_json_objects(F.col("text"))).alias("pos", "object"))
    return out.select("user_id", "pos", F.get_json_object("object", "$.k").cast("int").alias("k"))
