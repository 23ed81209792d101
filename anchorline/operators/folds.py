"""Order-dependent folds over the rows of one timeline, in the JVM.

A timeline is cut where a gap makes the fold start anew whatever came before; the rows
of a piece are sorted in an array and folded with ``aggregate``; every row comes back
with the state after it. Without such gaps a piece is the whole timeline. A piece of n
rows is folded in blocks of about the root of n, so that its output is copied once for
each block and not once for each row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], state: dict[str, tuple[str, Callable[[Column, Column], Column], Callable[[Column], Column]]], gap: tuple[str, str, float] | None = None, number: str | None = None) -> DataFrame:
    """``df`` plus state columns. state: name -> (type, next(state, row), first(row)).

    ``order`` entries are sorted ascending; give negated columns for descending. ``gap``: (time, end, tolerance), the
    time being first in order; a row more than the tolerance after all ends before it must start a new state as the
    first row does. ``number``: the state that counts from 1 and counts on in such rows.
    """
    rows = [c for c in df.columns if c not in keys]
    keyed = [(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]
    item = F.struct(*keyed, F.struct(*rows).alias("row"))
    parts = [*keys]
    if gap:
        time, end, tol = gap
        w = Window.partitionBy(*keys).orderBy(time)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        new = (F.col(time) - F.max(end).over(before) > tol) & F.first(time).over(before).isNotNull()
        # Rows of equal time stay together.
        df = df.withColumn("__new", F.coalesce(new, F.lit(False)).cast("long")).withColumn("__piece", F.sum("__new").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop("__new")
        parts.append("__piece")
    packed = df.groupBy(*parts).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["row"]).alias("__rows"))
    row_type = df.select(F.struct(*rows).alias("r")).schema["r"].dataType.simpleString()
    kind = "struct<" + ",".join(f"{n}:{t}" for n, (t, _, _) in state.items()) + ">"
    out_type = f"array<struct<row:{row_type},s:{kind}>>"

    def step(acc: Column, row: Column) -> Column:
        old = acc["s"]
        new = F.struct(*[F.when(acc["n"] == 0, first(row)).otherwise(following(old, row)).cast(t).alias(n) for n, (t, following, first) in state.items()])
        return F.struct((acc["n"] + 1).alias("n"), new.alias("s"), F.concat(acc["out"], F.array(F.struct(row.alias("row"), new.alias("s")))).alias("out"))

    def block(acc: Column, rows: Column) -> Column:
        inner = F.aggregate(rows, F.struct(acc["n"].alias("n"), acc["s"].alias("s"), F.array().cast(out_type).alias("out")), step)
        return F.transform(F.array(inner), lambda x: F.struct(x["n"].alias("n"), x["s"].alias("s"), F.concat(acc["out"], x["out"]).alias("out")))[0]

    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast(kind).alias("s"), F.array().cast(out_type).alias("out"))
    size = F.ceil(F.sqrt(F.size("__rows"))).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.size("__rows"), size), lambda i: F.slice("__rows", i, size))
    folded = packed.select(*parts, F.aggregate(blocks, start, block, lambda acc: acc["out"]).alias("__out"))
    earlier = F.lit(0)
    if gap and number:
        earlier = F.coalesce(F.sum(F.element_at("__out", -1)["s"][number]).over(Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    done = folded.withColumn("__earlier", earlier).select(*keys, "__earlier", F.explode("__out").alias("__x"))
    states = [(F.col(f"__x.s.{n}") + F.col("__earlier") if n == number else F.col(f"__x.s.{n}")).alias(n) for n in state]
    return done.select(*keys, *[F.col(f"__x.row.{c}").alias(c) for c in rows], *states)


def keep_first_gap(df: DataFrame, keys: Sequence[str], t: str, seq: str, gap: float) -> DataFrame:
    """Rows at least ``gap`` after the last kept row, first kept first."""
    kept = fold(
        df, keys, [t, seq],
        {
            "__last": ("double", lambda s, r: F.when(r[t] - s["__last"] >= gap, r[t].cast("double")).otherwise(s["__last"]), lambda r: r[t].cast("double")),
            "__kept": ("boolean", lambda s, r: r[t] - s["__last"] >= gap, lambda r: F.lit(True)),
        },
        gap=(t, t, gap),
    )
    return kept.where("__kept").drop("__last", "__kept")


def clusters(df: DataFrame, keys: Sequence[str], t: str, seq: str, rank: str, tol: float) -> DataFrame:
    """``df`` plus ``cluster`` (from 1) and its representative so far (rep_t, rep_rank, rep_seq).

    A row within ``tol`` of the representative joins it; a row of higher rank takes its place.
    """
    near = lambda s, r: F.abs(r[t] - s["rep_t"]) <= tol
    wins = lambda s, r: ~near(s, r) | (r[rank] > s["rep_rank"])
    pick = lambda c, to, kind: (kind, lambda s, r: F.when(wins(s, r), r[c].cast(kind)).otherwise(s[to]), lambda r: r[c].cast(kind))
    return fold(
        df, keys, [F.col(t), -F.col(rank), F.col(seq)],
        {
            "rep_t": pick(t, "rep_t", "double"), "rep_rank": pick(rank, "rep_rank", "double"), "rep_seq": pick(seq, "rep_seq", "bigint"),
            "cluster": ("bigint", lambda s, r: F.when(near(s, r), s["cluster"]).otherwise(s["cluster"] + 1), lambda r: F.lit(1)),
        },
        gap=(t, t, tol), number="cluster",
    )
