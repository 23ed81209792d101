"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written
as Parquet and read again as the next stage's ``docs``. All stages but the last return
the columns of ``docs``. Rows with null texts, null or repeated ids, and extra columns
pass like any others; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm import decontaminate, linededup, neardup, packing, toxicity
from anchorline.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under one half."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 != 0
    model = toxicity.fit(docs, labels, learn_from=training)
    return toxicity.score(docs, model, score_col="__toxicity").where("__toxicity < 0.5").select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents share; n_chars follows the text."""
    out = linededup.dedup_lines(docs, min_docs=10, min_chars=1)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8): the one of the smallest id."""
    rows, ids = docs.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    key, base = "doc_id", docs
    if rows != ids:  # null or repeated ids: rows get numbers of their own, in a written table so that they stay
        key, base = "__row", stored(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = neardup.near_duplicates(base, id_col=key, k=5, percent=80)
    gone = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")))
    # Ids go by broadcast only where their number is known to be small.
    ids = F.broadcast(gone) if gone.count() <= neardup.BROADCAST_ROWS else gone
    return base.join(ids, base[key].cast("long") == ids["__gone"], "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens in sequences of 2048."""
    import public_tokenizers

    return packing.pack_documents(docs, tokenizer_path=public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the learnt and sketched stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data set folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
