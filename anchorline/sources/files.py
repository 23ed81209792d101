"""Readers and writers of the text formats: link sheets, JSON lines, label files."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the link sheet, in order.
LINK_COLUMNS = ("youtube_url", "video_id", "status", "error", "n_clips", "clips_dir", "processed_at", "extract_status", "extract_error", "processing_level")
#: What counts as fetched, and what as extracted.
FETCHED = ("processed", "done", "complete", "completed")
EXTRACTED = ("extracted", "done", "complete", "completed")


def read_link_sheet(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, null as empty, known columns appended when absent."""
    sheet = spark.read.csv(path, header=True, inferSchema=False)
    named = [c for c in sheet.columns if c and not c.startswith("_c")]
    return sheet.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in named], *[F.lit("").alias(c) for c in LINK_COLUMNS if c not in named])


def create_link_sheet(spark: SparkSession, path: str) -> None:
    """A sheet without rows, only the header, where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        spark.createDataFrame([(",".join(LINK_COLUMNS),)], "value string").coalesce(1).write.text(path)


def pending_links(sheet: DataFrame, force: bool = False) -> DataFrame:
    """Rows that still need work: not both fetched and extracted."""
    among = lambda c, done: F.lower(F.trim(c)).isin(*done)
    todo = sheet.where(F.trim("youtube_url") != "")
    return todo if force else todo.where(~(among("status", FETCHED) & among("extract_status", EXTRACTED)))


def read_json_documents(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One row for each whole-file JSON document, with the file's ``path``."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path).withColumn("path", F.input_file_name())


def read_clip_tables(spark: SparkSession, folder: str, meta_schema: str, status_schema: str) -> DataFrame:
    """(directory, meta, status) of each directory below ``folder``; one that has only one of the two documents is an error."""

    def read(name: str, schema: str) -> DataFrame:
        docs = read_json_documents(spark, f"{folder}/*/{name}.json", schema)
        return docs.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("directory"), F.struct(*[c for c in docs.columns if c != "path"]).alias(name))

    both = read("video_metadata", meta_schema).join(read("processing_status", status_schema), "directory", "full_outer")
    lacks = F.when(F.col("video_metadata").isNull(), "video_metadata.json").when(F.col("processing_status").isNull(), "processing_status.json")
    checked = F.when(lacks.isNotNull(), F.raise_error(F.concat(F.lit("missing "), "directory", F.lit("/"), lacks))).otherwise(F.col("directory"))
    return both.select(checked.alias("directory"), F.col("video_metadata").alias("meta"), F.col("processing_status").alias("status"))


def clip_aliases(clip_id: Column) -> Column:
    """The names under which a clip is found: its id, the last part of it, and the id with underscores for slashes."""
    return F.array_distinct(F.array(clip_id, F.element_at(F.split(clip_id, "/"), -1), F.replace(clip_id, F.lit("/"), F.lit("_"))))


def read_gold(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Gold documents under each alias of their clip; of several documents with one alias the last file counts.

    ``schema`` has clip_id; a document without one is named after its file.
    """
    docs = read_json_documents(spark, path, schema)
    own = F.coalesce(F.nullif("clip_id", F.lit("")), F.regexp_extract("path", r"([^/]+)\.json$", 1))
    rows = docs.withColumn("clip_id", own).withColumn("alias", F.explode(clip_aliases(F.col("clip_id"))))
    rest = [c for c in rows.columns if c not in ("alias", "path")]
    return rows.groupBy("alias").agg(F.max_by(F.struct(*rest), "path").alias("g")).select("alias", *[F.col(f"g.{c}").alias(c) for c in rest])


def resolve_clips(keys: DataFrame, clips: DataFrame) -> DataFrame:
    """(gold_key, video_id, clip_id): the clip that a key names, or nulls.

    In order of preference: ``video/clip``; the parts around the last underscore; ``video_clip`` for any video;
    the clip's own name, the smallest video's.
    """
    named = clips.select("video_id", "clip_id").distinct()
    part = lambda pattern, i: F.regexp_extract("gold_key", pattern, i)
    slash, last = r"^([^/]*)/(.*)$", r"^(.*)_([^_]*)$"
    names = (F.concat(part(slash, 1), F.lit("\x00"), part(slash, 2)), F.concat(part(last, 1), F.lit("\x00"), part(last, 2)), F.concat(F.lit("_"), "gold_key"), F.concat(F.lit("/"), "gold_key"))
    forms = F.explode(F.array(*[F.struct(F.lit(i).alias("way"), name.alias("name")) for i, name in enumerate(names)]))
    asked = keys.select("gold_key").distinct().select("gold_key", forms.alias("f")).select("gold_key", "f.way", "f.name")
    both = F.concat("video_id", F.lit("\x00"), "clip_id")
    known = named.select("video_id", "clip_id", F.explode(F.array(both, F.concat(F.lit("_"), "video_id", F.lit("_"), "clip_id"), F.concat(F.lit("/"), "clip_id"))).alias("name"))
    best = asked.join(known, "name").groupBy("gold_key").agg(F.min(F.struct("way", "video_id", "clip_id")).alias("b"))
    return keys.join(best, "gold_key", "left").select(*keys.columns, F.col("b.video_id").alias("video_id"), F.col("b.clip_id").alias("clip_id"))


def read_event_log(spark: SparkSession, path: str, magic: str, schema: str) -> DataFrame:
    """(path, event) of logs with one JSON object a line; blank lines and comments are left out.

    Each file's first line must be ``magic``; else the read fails.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    # Lines of one block of a file come in order, and the first block has the first line.
    first = lines.where("block = 0").groupBy("path").agg(F.min_by(F.trim("value"), "line").alias("first"))
    bad = first.where(F.col("first") != magic).select("path").head()
    if bad:
        raise ValueError(f"not an event log: {bad[0]}")
    rows = lines.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    return rows.select("path", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("event"))


def sanitised(text: Column, most: int = 120_000) -> Column:
    """A logged text of bounded length, with a note of what was cut."""
    rest = F.char_length(text) - most
    return F.when(rest > 0, F.concat(F.left(text, F.lit(most)), F.lit("\n… ("), rest.cast("string"), F.lit(" more chars)"))).otherwise(text)


def read_audacity(spark: SparkSession, path: str) -> DataFrame:
    """(onset_ms, offset_ms, label) of a label track; comments and machine labels left out."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    p = F.when(F.col("value").contains("\t"), F.split("value", "\t")).otherwise(F.split(F.trim("value"), r"\s+", 3))
    rows = lines.select(p.alias("p")).where(F.size("p") >= 3)
    label = F.trim(F.array_join(F.expr("slice(p, 3, size(p))"), " "))
    ms = lambda i: F.round(F.get("p", F.lit(i)).try_cast("double") * 1000, 1)
    out = rows.select(ms(0).alias("onset_ms"), ms(1).alias("offset_ms"), label.alias("label"))
    return out.where(~(F.col("label").startswith("ANCHOR|") | F.col("label").startswith("CUE|"))).withColumn("label", F.regexp_replace("label", r"^GOLD\|", ""))


def audacity_lines(df: DataFrame, start_ms: str, end_ms: str, label: str, most: int = 80) -> DataFrame:
    """One text column of label-track lines, at least 0.05 s wide."""
    s = F.col(start_ms) / 1000.0
    e = F.greatest(F.col(end_ms) / 1000.0, s + 0.05)
    text = F.left(F.regexp_replace(label, "\t", " "), F.lit(most))
    return df.select(F.format_string("%.6f\t%.6f\t%s", s, e, text).alias("value"))


def _objects(text: str | None) -> list[str]:
    decoder, out, at = json.JSONDecoder(), [], 0
    text = text or ""
    while (at := text.find("{", at)) >= 0:
        try:
            value, at = decoder.raw_decode(text, at)
        except ValueError:
            at += 1
            continue
        if isinstance(value, dict):
            out.append(json.dumps(value, ensure_ascii=False))
    return out


def parse_json_objects(text: Column) -> Column:
    """JSON objects strung together in a text; broken pieces are passed over."""
    run = F.pandas_udf(lambda s: s.map(_objects), T.ArrayType(T.StringType()))
    return run(text)


def _repair(text: str | None) -> str | None:
    if text is None:
        return None
    body = re.sub(r"^\s*```[a-z]*|```\s*$", "", text.strip())
    begins = [i for i in (body.find("{"), body.find("[")) if i >= 0]
    if not begins:
        return None
    body = body[min(begins) :]
    open_, quoted, skip = [], False, False
    for c in body:
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]" and open_:
            open_.pop()
    fixed = body.rstrip() + ('"' if quoted else "")
    fixed = re.sub(r",\s*$", "", fixed)
    fixed += "null" if fixed.endswith(":") else ""
    for candidate in (body, fixed + "".join(reversed(open_))):
        try:
            return json.dumps(json.loads(candidate), ensure_ascii=False)
        except ValueError:
            pass
    pairs = re.findall(r'"(\w+)"\s*:\s*"([^"]*)"?', body)
    return json.dumps(dict(pairs), ensure_ascii=False) if pairs else None


def repair_json(text: Column) -> Column:
    """A model's answer as JSON: fences off, ends closed, else what pairs can be found; null if nothing."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(_repair)

    return F.pandas_udf(run, T.StringType())(text)
