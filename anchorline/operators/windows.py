"""Window and interval generation as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_cut(cuts: Column, at: Column, tol: int, after: Column) -> Column:
    """The cut nearest to ``at`` within ``tol`` and later than ``after``; the earlier of two."""
    near = F.filter(cuts, lambda c: (F.abs(c - at) <= tol) & (c > after))
    return F.array_min(F.transform(near, lambda c: F.struct(F.abs(c - at).alias("d"), c.alias("c"))))["c"]


def sliding_windows(duration: Column, cuts: Column, size: int, overlap: int, tol: int, longest: int) -> Column:
    """Windows (start, end) over a timeline whose ends and starts snap to cuts; ``longest``: the longest timeline."""
    step, kind = max(1000, size - overlap), "struct<start:bigint,end:bigint>"
    most = longest // max(1, step - tol) + 2

    def one(acc: Column, _: Column) -> Column:
        start = acc["next"]
        plain = F.least(start + size, duration)
        end = F.coalesce(F.least(nearest_cut(cuts, plain, tol, start + size // 2), duration), plain)
        following = F.coalesce(nearest_cut(cuts, start + step, tol, start), start + step)
        new = F.struct(F.when(end >= duration, F.lit(None)).otherwise(following).cast("bigint").alias("next"), F.concat(acc["out"], F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))).alias("out"))
        return F.when(start.isNull(), acc).otherwise(new)

    begin = F.struct(F.lit(0).cast("bigint").alias("next"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), begin, one, lambda acc: acc["out"])
