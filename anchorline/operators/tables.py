"""Upkeep of tables without MERGE: upserts, scoped replacement, ledgers and split lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.functions.text import stable_split


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row for each key: the last of ``new`` by ``order``, else the last of ``old``."""
    both = old.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)))
    values = [c for c in old.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("__batch", order)).alias("__v"))
    return last.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def replace_scope(old: DataFrame, fresh: DataFrame, keys: Sequence[str], scope: Column) -> DataFrame:
    """``old`` without rows of the scope whose keys ``fresh`` has, then ``fresh``."""
    named = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.coalesce(scope, F.lit(False))
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return old.join(named, same, "left_anti").unionByName(fresh)


def merge_ledger(old: DataFrame, clips: DataFrame, keys: Sequence[str], interval: Sequence[str]) -> DataFrame:
    """``clips`` with the status of the same clip of the same interval, else pending; absent clips vanish."""
    return clips.join(old.select(*keys, *interval, "status"), [*keys, *interval], "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def split_lists(ids: DataFrame, id_col: str) -> DataFrame:
    """(split, id): the split of each distinct id, one row each."""
    return ids.select(stable_split(F.col(id_col)).alias("split"), F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()


def write_split_lists(lists: DataFrame, path: str) -> None:
    """A folder for each split, its files in the order of ids."""
    lists.repartitionByRange("split", "id").sortWithinPartitions("split", "id").write.partitionBy("split").parquet(path)
