"""Segments of sequences: hysteresis, runs, peaks in frames, packing of scenes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorline.operators.folds import fold


def hysteresis(df: DataFrame, keys: Sequence[str], t: str, p: str, on: Column, off: Column) -> DataFrame:
    """(keys, start, end, peak): from the first frame at ``on`` or more to the first at ``off`` or less (or the last frame)."""
    w = Window.partitionBy(*keys).orderBy(t)
    marker = F.when(F.col(p) >= on, 1).when(F.col(p) <= off, 0)
    state = F.coalesce(F.last(marker, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    marked = df.select(*keys, t, p, state.alias("__s"))
    before = F.lag("__s", 1, 0).over(w)
    # A closing frame still belongs to its segment.
    begun = marked.withColumns({"__start": ((F.col("__s") == 1) & (before == 0)).cast("int"), "__in": (F.col("__s") == 1) | (before == 1)})
    numbered = begun.withColumn("__n", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__in")
    return numbered.groupBy(*keys, "__n").agg(F.min(t).alias("start"), F.max(t).alias("end"), F.max(p).alias("peak")).drop("__n")


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], hit: Column) -> DataFrame:
    """Rows of maximal runs of ``hit`` rows, plus the run's number."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = df.withColumn("__hit", F.coalesce(hit, F.lit(False)))
    x = x.withColumn("__new", (F.col("__hit") & ~F.coalesce(F.lag("__hit").over(w), F.lit(False))).cast("int"))
    return x.withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__hit").drop("__hit", "__new")


def split_long(df: DataFrame, start: str, length: str, target: int, most: int) -> DataFrame:
    """Pieces of equal length of rows longer than ``most``; other rows as they are. Adds ``piece``, changes start and length."""
    n = F.when(F.col(length) > most, F.greatest(F.lit(2), F.ceil(F.col(length) / target))).otherwise(F.lit(1)).cast("int")
    x = df.withColumn("__n", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    edge = lambda i: F.col(start) + F.bround(F.col(length) * i / F.col("__n")).cast("long")
    x = x.withColumns({"__a": edge(F.col("piece")), "__b": edge(F.col("piece") + 1)})
    return x.withColumns({start: F.col("__a"), length: F.col("__b") - F.col("__a")}).drop("__a", "__b", "__n")


def pack_scenes(df: DataFrame, keys: Sequence[str], start: str, length: str, target: int, most: int, tail: int) -> DataFrame:
    """``df`` plus ``pack``: a pack is closed when full or when a piece would overfill it; a short last one joins its neighbour."""
    full = lambda s, r: (s["__size"] + r[length] > most) | (s["__size"] >= target)
    packed = fold(
        df, keys, [start],
        {
            "__size": ("bigint", lambda s, r: F.when(full(s, r), r[length]).otherwise(s["__size"] + r[length]), lambda r: r[length]),
            "pack": ("bigint", lambda s, r: F.when(full(s, r), s["pack"] + 1).otherwise(s["pack"]), lambda r: F.lit(1)),
        },
    ).drop("__size")
    w = Window.partitionBy(*keys)
    last = F.max("pack").over(w)
    size = F.sum(length).over(Window.partitionBy(*keys, "pack"))
    return packed.withColumns({"__last": last, "__len": size}).withColumn("pack", F.when((F.col("pack") == F.col("__last")) & (F.col("pack") > 1) & (F.col("__len") < tail), F.col("pack") - 1).otherwise(F.col("pack"))).drop("__last", "__len")
