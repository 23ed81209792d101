"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in the class [\x20\x09-\x0D].
SPACES = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data set folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character untouched."""
    return F.translate(c, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the one that the driver and all executors share.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset,
    as in tests on one machine, a temporary folder is set and used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="anchorline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Arrow batches of all operators: the same bounds everywhere, so that a query built later changes nothing for one built before.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded rows and bytes, so that long texts do not fill a Python worker; smaller settings stay."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        have = spark.conf.get(name)
        digits = re.fullmatch(r"(\d+)b?", have.lower())
        if digits is None or not 0 < int(digits[1]) <= most:
            spark.conf.set(name, str(most))


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
