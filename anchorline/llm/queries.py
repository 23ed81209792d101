"""The registered queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm import avi, chat, decontaminate, linededup, neardup, packing, pitman_yor, repair, sharding, substrings, toxicity, urltree, variants
from anchorline.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _remainder(n: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pitman_yor.score(table(spark, sf_dir, "documents"), train=_remainder(7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    formatted = chat.format_turns(chat.canonical_turns(rows.unionByName(more))).select("conv_id", "formatted", "loss_mask")
    back = formatted.select("conv_id", "formatted", chat.parse_turns(F.col("formatted")).alias("turns"), F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss_mask")), "").alias("learnt"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    found = marked.select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", F.col("m.item_id").alias("item_id"), F.col("m.item_shingles").alias("item_shingles"), F.col("m.shared").alias("shared_shingles"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urltree.filter_urls(pages, rules=URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path=_tokenizer_path())



def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, learn_from=_remainder(5) != 0))
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = avi.encode_media(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "media")
    clips = F.transform("clips", lambda c: F.concat_ws(":", c["n_frames"].cast("string")))
    feature = F.concat(F.lit("frames="), F.col("n_frames"), F.lit(";shots="), F.size("clips"), F.lit(";lengths="), F.array_join(clips, ","))
    return avi.read_media(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.group_variants(variants.count_words(variants.words_of(docs, damage=199), least_n=5))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def damaged_turns(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults; dropped rows stay as rows that are not ``present``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(fault == 4, "user").otherwise(space("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("present"), copies).drop("copy")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged_turns(table(spark, sf_dir, "conversations"))
    repairs = stored(repair.find_repairs(rows))
    made = repair.digests(repair.repaired_turns(rows, repairs)).withColumnRenamed("conv_id", "id")
    joined = repairs.join(made, repairs["conv_id"].eqNullSafe(made["id"]), "left")
    return joined.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_scoring, op2_chat_formatting, op3_benchmark_decontamination, op4_minhash_near_dedup, op5_url_filters, op6_packing, op7_toxicity, op8_substring_dedup, op9_line_dedup, op10_media_columns, op11_spelling_variants, op12_sharding, op13_structure_repair)
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def _five_words(source: str) -> str:
    return f"SELECT DISTINCT id, array_to_string(w[j:j+4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS j FROM {source} WHERE len(w) > 0)"


_RULES = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in URL_RULES)
_TREE_LEVELS = "".join(
    f"""n{i} AS MATERIALIZED (SELECT host, gen, raw[{i}] AS segment, sum(pages) AS here FROM l{i - 1} WHERE len(raw) >= {i} GROUP BY ALL),
w{i} AS (SELECT host, gen FROM n{i} GROUP BY host, gen HAVING count(*) >= 16 AND sum(here) < 4 * count(*)),
s{i} AS (SELECT n{i}.host, n{i}.gen, segment FROM n{i} JOIN w{i} ON n{i}.host = w{i}.host AND n{i}.gen = w{i}.gen WHERE here < 16),
l{i} AS MATERIALIZED (SELECT l.host, raw, pages, n, bad, CASE WHEN len(raw) < {i} THEN l.gen ELSE list_append(l.gen, CASE WHEN s.segment IS NULL THEN raw[{i}] ELSE '*' END) END AS gen
FROM l{i - 1} l LEFT JOIN s{i} s ON l.host = s.host AND l.gen = s.gen AND raw[{i}] = s.segment),
"""
    for i in range(1, 13)
)
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' FROM range(2) t(i))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + length('<|turn|><|body|><|end|>')) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id
""",
    "op5_url_filters": f"""
WITH rules(domain, start, rule, verdict) AS (VALUES {_RULES}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS said FROM u JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start) GROUP BY page_id),
x AS (SELECT u.*, f.rule, f.said, string_split(path, '/') AS p FROM u LEFT JOIN f USING (page_id)),
b AS MATERIALIZED (SELECT page_id, host, path, rule, said, list_transform(CASE WHEN len(p) > 12 THEN p[1:11] || [array_to_string(p[12:], '/')] ELSE p END,
lambda s: CASE WHEN regexp_matches(s, '^[0-9a-fA-F-]{{16,}}$') THEN '{{h}}' ELSE regexp_replace(s, '[0-9]+', '{{n}}', 'g') END) AS raw FROM x),
l0 AS MATERIALIZED (SELECT host, raw, count(*) AS pages, count(said) AS n, count(*) FILTER (WHERE said = 'block') AS bad, CAST([] AS VARCHAR[]) AS gen FROM b GROUP BY host, raw),
{_TREE_LEVELS}
tpl AS MATERIALIZED (SELECT host, gen, sum(n) AS n, sum(bad) AS bad FROM l12 GROUP BY host, gen),
pre AS (SELECT *, gen[1:level] AS prefix, gen[1:level - 1] AS parent FROM (SELECT *, unnest(range(1, len(gen) + 1)) AS level FROM tpl)),
node AS MATERIALIZED (SELECT host, level, parent, prefix, sum(n) AS n, sum(bad) AS bad FROM pre GROUP BY ALL),
rate AS (SELECT host, level, parent, sum(bad) / sum(n) AS p, count(*) AS labelled FROM node WHERE n > 0 GROUP BY ALL),
tested AS MATERIALIZED (SELECT node.*, labelled, coalesce(n > 0 AND abs(bad / nullif(n, 0) - p) <= 2.0 * sqrt(p * (1 - p) / nullif(n, 0) + 1e-9), false) AS alike FROM node JOIN rate USING (host, level, parent)),
pool AS (SELECT host, level, parent, sum(n) AS pool_n, sum(bad) AS pool_bad, count(*) AS merged FROM tested WHERE alike GROUP BY ALL),
evidence AS (SELECT host, prefix, n > 0 AS own, CASE WHEN alike OR n = 0 THEN pool_n ELSE n END AS en, CASE WHEN alike OR n = 0 THEN pool_bad ELSE bad END AS eb
FROM tested LEFT JOIN pool USING (host, level, parent) WHERE n > 0 OR (merged >= 2 AND merged = labelled)),
found AS (SELECT host, gen, arg_max(en, level) AS en, arg_max(eb, level) AS eb FROM pre JOIN evidence USING (host, prefix) WHERE NOT own OR level = len(gen) GROUP BY host, gen),
j AS (SELECT host, raw, array_to_string(gen, '/') AS template, (coalesce(eb, 0) + 2.0::DOUBLE) / (coalesce(en, 0) + 4.0::DOUBLE) AS purity FROM l12 LEFT JOIN found USING (host, gen))
SELECT page_id, host, path, rule, template, purity, coalesce(said, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict FROM b JOIN j USING (host, raw)
""",
    "op11_spelling_variants": f"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS step FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE step = 8),
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{6,}}')), {_LOWER}) AS w FROM documents),
seen AS (SELECT doc_id, w, count(*) AS n FROM run GROUP BY doc_id, w),
bytes AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS b FROM seen),
hashed AS (SELECT doc_id, w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, tab[xor(c, x) % 256 + 1])), 4294967295) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS INT)) || substring(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
short AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n FROM short a JOIN short b ON a.i = b.i AND a.s = b.s AND a.word != b.word
UNION SELECT a.word, v.word, v.n FROM short a JOIN v ON a.s = v.word UNION SELECT v.word, a.word, a.n FROM short a JOIN v ON a.s = v.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS other FROM near GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * v.n THEN other END AS form, CASE WHEN top >= 5 * v.n THEN top END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS further FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.further)
SELECT f.*, walk.at AS root FROM f JOIN walk USING (word) WHERE walk.further IS NULL
""",
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_LETTERS}) AS w FROM documents),
i AS (SELECT item_id AS id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_LETTERS}) AS w FROM benchmark),
ds AS ({_five_words("d")}), bs AS ({_five_words("i")}),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, max(n.n) AS item_shingles, count(*) AS shared_shingles
FROM ds JOIN bs USING (s) JOIN n ON n.id = bs.id GROUP BY ds.id, bs.id HAVING count(*) >= 0.8 * max(n.n)
""",
    "op4_minhash_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[j:j+1], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS j FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
twice AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM twice JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
""",
    "op8_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
x AS (SELECT doc_id, j, md5(array_to_string(w[j:j+12], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS j FROM d WHERE len(w) >= 13)),
f AS (SELECT doc_id, j FROM (SELECT doc_id, j, min(doc_id) OVER (PARTITION BY s) AS m FROM x) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, j + k AS p FROM f, range(0, 13) t(k)),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept FROM p ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op9_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS p, unnest(a) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY doc_id
""",
}
