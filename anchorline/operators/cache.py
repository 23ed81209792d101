"""Arrays that are dear to compute, kept in a table by what they were computed from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a kept array is: its shape, and its values in row order.
ARRAY = "shape array<int>, values array<float>"


def _exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def cached_arrays(inputs: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, keys: Sequence[str]) -> DataFrame:
    """(keys, shape, values) of every distinct key of ``inputs``; what the table at ``path`` lacks is computed and added first.

    ``keys`` name the content and the knobs, as the hash of a clip, a model's name and its settings: a change of either
    is another key. A kept array counts only if it has as many values as its shape says. ``compute`` gets the rows of
    ``inputs`` that are missed, one for each key, and gives (keys, shape, values). A null key matches a null key.
    """
    first = [c for c in inputs.columns if c not in keys]
    wanted = inputs.groupBy(*keys).agg(F.any_value(F.struct(*first)).alias("__x")).select(*keys, "__x.*") if first else inputs.select(*keys).distinct()

    def kept() -> DataFrame | None:
        if not _exists(inputs, path):
            return None
        table = inputs.sparkSession.read.schema(", ".join([*[f"{k} {inputs.schema[k].dataType.simpleString()}" for k in keys], ARRAY])).parquet(path)
        size = F.aggregate("shape", F.lit(1), lambda a, n: a * n)
        sound = table.where(F.col("values").isNotNull() & (F.size("values") == size))
        # Two runs at once may both have computed a key: any of its rows will do.
        return sound.groupBy(*keys).agg(F.any_value(F.struct("shape", "values")).alias("__a")).select(*keys, "__a.*")

    def same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        named = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
        return left.join(named, on, how)

    known = kept()
    missed = wanted if known is None else same(wanted, known.select(*keys), "left_anti")
    if not missed.isEmpty():
        compute(missed).select(*keys, "shape", "values").write.mode("append").parquet(path)
        known = kept()
    if known is None:
        return inputs.sparkSession.createDataFrame([], ", ".join([*[f"{k} {inputs.schema[k].dataType.simpleString()}" for k in keys], ARRAY]))
    return same(wanted.select(*keys), known, "inner").select(*keys, "shape", "values")
