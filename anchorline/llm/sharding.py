"""Shards of near equal bytes for groups that can't be divided: Karmarkar-Karp differencing in levels.

All rows of one text are a group and stay together. Differencing repeatedly takes the two
partial partitions with the largest spread and combines them oppositely ordered, the
fullest bin of one with the emptiest of the other, until one partition is left.

At scale this goes in levels. Groups are dealt to blocks of bounded size, and each block
is differenced to one partial partition of ``shards`` bins, whose spread is then tiny.
Blocks' partitions are combined the same way, in fans, level by level, until one task
holds the last ``fan`` of them. Balanced blocks cannot make up for a few heavy groups, so
two kinds of entry reach the last level beside them: heavy groups (a 4,096th of all bytes
or more, so there are at most 4,096), and, as counterweights, as large a share of the
other groups as heavy groups leave unlevelled, dealt to at most ``weights`` lots, which
are differenced as wholes. What each level decides is a table of bins by bins; groups get
their shard by joins along it.

A slot is a row's place in its shard, by the order in which rows were read: counts of each
read partition are summed, no shard is gathered.

Defined cases: a null text counts as empty (size 1, the group of empty texts); equal texts
share a shard whatever their ids; null and repeated ids are rows like any others; an empty
table gives an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorline.llm.common import stored

#: A group with so small a share of all bytes, or of all rows, is placed by itself; there are at most twice as many.
HEAVY = 4096
#: Groups of one block in the mean.
BLOCK_GROUPS = 10_000


def difference(entries: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions, each the sums of k bins, to one.

    Returns (the bin that each entry's each bin falls into, the sums of the bins).
    """
    sums = [np.asarray(e, np.int64) for e in entries]
    n, k = len(sums), len(sums[0])
    # A tree of combinations: node n + i combines two earlier nodes; their bins go to its bins.
    heap = [(int(s.min() - s.max()), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    tree: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    alive: dict[int, np.ndarray] = dict(enumerate(sums))
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        down, up = np.argsort(-alive[a], kind="stable"), np.argsort(alive[b], kind="stable")
        both = alive.pop(a)[down] + alive.pop(b)[up]
        to_a, to_b = np.empty(k, np.int32), np.empty(k, np.int32)
        to_a[down] = to_b[up] = np.arange(k)
        node = n + len(tree)
        tree.append((a, b, to_a, to_b))
        alive[node] = both
        heapq.heappush(heap, (int(both.min() - both.max()), node))
    root = heap[0][1]
    to: dict[int, np.ndarray] = {root: np.arange(k, dtype=np.int32)}
    for i in range(len(tree) - 1, -1, -1):
        a, b, to_a, to_b = tree[i]
        mine = to.pop(n + i)
        to[a], to[b] = mine[to_a], mine[to_b]
    return np.array([to[i] for i in range(n)]), alive[root]


def _whole(sizes: np.ndarray, k: int) -> list[np.ndarray]:
    """Partial partitions that hold one entry each."""
    made = np.zeros((len(sizes), k), np.int64)
    made[:, 0] = sizes
    return list(made)


def _blocks(groups: DataFrame, blocks: int, k: int) -> DataFrame:
    """(block, key, bin, size) of groups (key, size), each block differenced by itself."""

    def run(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["size", "key"], ascending=False, ignore_index=True)
        to, _ = difference(_whole(t["size"].to_numpy(), k))
        return pd.DataFrame({"block": t["block"], "key": t["key"], "bin": to[:, 0], "size": t["size"]})

    dealt = groups.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("long"))
    return dealt.groupBy("block").applyInPandas(run, "block long, key binary, bin int, size long")


def _sums(placed: DataFrame, k: int) -> DataFrame:
    """(block, sums) of placed groups."""
    return placed.groupBy("block").agg(F.array(*[F.sum(F.when(F.col("bin") == i, F.col("size")).otherwise(0)) for i in range(k)]).alias("sums"))


def _combine(level: DataFrame, fans: int, k: int) -> DataFrame:
    """(block, to, above, sums): each block's bins in its fan's bins; the fan's sums stand in one of its rows."""

    def run(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("block", ignore_index=True)
        to, sums = difference([np.asarray(x) for x in t["sums"]])
        return pd.DataFrame({"block": t["block"], "to": list(to), "above": t["above"], "sums": [sums if i == 0 else None for i in range(len(t))]})

    dealt = level.withColumn("above", F.pmod(F.xxhash64("block", F.lit(2)), F.lit(fans)).cast("long"))
    return dealt.groupBy("above").applyInPandas(run, "block long, to array<int>, above long, sums array<bigint>")


def assign_groups(groups: DataFrame, *, shards: int, block_groups: int = BLOCK_GROUPS, fan: int = 2048, weights: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Two tables (key, shard): heavy groups, of bounded number, and all others.

    ``groups``: a written table (key binary, size long, rows long), one row for each group.
    """
    spark, k = groups.sparkSession, shards
    total = groups.agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).first()
    is_heavy = (F.col("size") * HEAVY >= (total["size"] or 0)) | (F.col("rows") * HEAVY >= (total["rows"] or 0))
    heavy = groups.where(is_heavy).select("key", "size").orderBy(F.desc("size"), "key").collect()  # at most 2 * HEAVY
    light = groups.where(~is_heavy)
    n, rest = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    # The bytes that level what heavy groups alone leave uneven, and a share more.
    uneven = 0
    if heavy:
        _, alone = difference(_whole(np.array([r["size"] for r in heavy]), k))
        uneven = int((alone.max() - alone).sum())
    share = min(1.0, 1.25 * uneven / rest + 0.05) if rest else 0.0
    counter = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000)
    lots = stored(light.where(counter).select("key", "size", F.pmod(F.xxhash64("key", F.lit(4)), F.lit(weights)).cast("long").alias("lot")))
    lot_sizes = lots.groupBy("lot").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "lot").collect()  # at most ``weights``

    blocks = max(1, -(-n // block_groups))
    placed = stored(_blocks(light.where(~counter).select("key", "size"), blocks, k))
    level, above = stored(_sums(placed, k)), []
    while level.count() > fan:
        combined = stored(_combine(level, -(-level.count() // fan), k))
        above.append(combined)
        level = combined.where("sums IS NOT NULL").select(F.col("above").alias("block"), "sums")
    last = level.collect()  # at most ``fan``
    last.sort(key=lambda r: r["block"])
    entries = [*_whole(np.array([r["size"] for r in heavy], np.int64), k), *_whole(np.array([r["size"] for r in lot_sizes], np.int64), k), *[np.array(r["sums"]) for r in last]]
    to = difference(entries)[0] if entries else np.zeros((0, k), np.int32)
    n_heavy, n_lots = len(heavy), len(lot_sizes)
    heavy_at = spark.createDataFrame([(bytes(r["key"]), int(t[0])) for r, t in zip(heavy, to, strict=False)], "key binary, shard int")
    lot_at = spark.createDataFrame([(r["lot"], int(t[0])) for r, t in zip(lot_sizes, to[n_heavy:], strict=False)], "lot long, shard int")
    bins = spark.createDataFrame([(r["block"], t.tolist()) for r, t in zip(last, to[n_heavy + n_lots :], strict=True)], "block long, to array<int>")
    for combined in reversed(above):  # bins of a level's blocks, by way of the fans' bins
        over = bins.select(F.col("block").alias("above"), F.col("to").alias("over"))
        bins = stored(combined.select("block", "to", "above").join(over, "above").select("block", F.transform("to", lambda i: F.get("over", i)).alias("to")))
    # With few levels the table of bins is one row for each ten thousand groups; AQE broadcasts it where it is small.
    others = placed.join(bins, "block").select("key", F.get("to", F.col("bin")).alias("shard"))
    return heavy_at, others.unionByName(lots.join(F.broadcast(lot_at), "lot").select("key", "shard"))


def shard_by_bytes(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, block_groups: int = BLOCK_GROUPS, fan: int = 2048, weights: int = 4096) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row; a row's size is its text's UTF-8 bytes plus one."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"), F.monotonically_increasing_id().alias("row")))
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")))
    heavy, others = assign_groups(groups, shards=shards, block_groups=block_groups, fan=fan, weights=weights)
    # Rows of heavy groups find their shard by broadcast of a bounded table, so a text with a third of all rows isn't shuffled by its key.
    first = rows.join(F.broadcast(heavy), "key", "left")
    found = first.where(F.col("shard").isNotNull()).unionByName(first.where(F.col("shard").isNull()).drop("shard").join(others, "key"))
    at = stored(found.select("doc_id", "size", "text_crc32", "shard", "row", F.shiftright("row", 33).alias("read")))
    counts = at.groupBy("shard", "read").count()
    before = counts.select("shard", "read", (F.sum("count").over(Window.partitionBy("shard").orderBy("read")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "read").orderBy("row")) - 1
    slots = at.withColumn("own", own).join(before, ["shard", "read"])
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own")).cast("long").alias("slot"))
