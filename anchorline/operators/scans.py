"""Scans of sorted timelines: a task reads its timelines in order of time, row by row, and keeps only what is still in reach."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def first_close(rows: DataFrame, keys: Sequence[str], t: str, number: str, words: str, reach: int, least: float) -> DataFrame:
    """``rows`` plus merged_into: the ``number`` of the first kept row of equal keys within ``reach`` that shares ``least`` of the words; else null, and the row is kept.

    Rows come in order of (t, number). The share is that of the smaller set; a null key or no words fit nothing.
    """
    at = [rows.columns.index(c) for c in (*keys, t, number, words)]
    schema = StructType([*rows.schema.fields, StructField("merged_into", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        kept: deque = deque()  # (time, place, words) in reach
        lists: dict[str, deque] = {}  # the places of kept rows with a word, in order
        facts: dict[int, tuple] = {}  # place in order -> (number, words it has)
        place = 0
        for batch in batches:
            found = []
            for *key, now, n, w in zip(*[batch.column(i).to_pylist() for i in at], strict=True):
                if (key := tuple(key)) != here:
                    here, kept, lists, facts = key, deque(), {}, {}
                into = None
                if w and now is not None and None not in key:
                    while kept and now - kept[0][0] > reach:
                        _, old, gone = kept.popleft()
                        del facts[old]
                        for x in gone:
                            lists[x].popleft()
                            if not lists[x]:
                                del lists[x]
                    own, shared = set(w), {}
                    for x in own:
                        for m in lists.get(x, ()):
                            shared[m] = shared.get(m, 0) + 1
                    first = min((m for m, c in shared.items() if c / min(facts[m][1], len(w)) >= least), default=None)
                    if first is None:
                        place += 1
                        kept.append((now, place, own))
                        facts[place] = (n, len(w))
                        for x in own:
                            lists.setdefault(x, deque()).append(place)
                    else:
                        into = facts[first][0]
                found.append(into)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "merged_into"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, t, number).mapInArrow(run, schema)


def hits_apart(spans: DataFrame, hits: DataFrame, gap: int) -> DataFrame:
    """(id, times): the times of hits in each span, the first one and then each that is ``gap`` or more after the last one taken.

    ``spans``: (clip, id, lo, hi), ends included; ``hits``: (clip, t). Spans without hits are left out. No pairs of spans and
    hits are made: a span waits for the next hit that it can take.
    """
    kind = spans.schema["id"].dataType.simpleString()
    asked = spans.where("lo <= hi").select("clip", F.col("lo").cast("long").alias("t"), F.col("hi").cast("long").alias("hi"), "id")
    # Of hits at one time only one can be taken.
    given = hits.where("t IS NOT NULL").select("clip", F.col("t").cast("long").alias("t")).distinct()
    both = asked.unionByName(given, allowMissingColumns=True).where("clip IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, count = None, [], 0  # (from when on, order, last time, id, times)
        for batch in batches:
            ids, times = [], []

            def done(x: tuple, ids: list = ids, times: list = times) -> None:
                if x[4]:
                    ids.append(x[3])
                    times.append(x[4])

            for clip, t, hi, i in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if clip != here:
                    for x in waiting:
                        done(x)
                    here, waiting = clip, []
                if hi is not None:
                    heappush(waiting, (t, count, hi, i, []))
                    count += 1
                    continue
                while waiting and waiting[0][0] <= t:
                    _, order, last, of, taken = x = heappop(waiting)
                    if t <= last:
                        taken.append(t)
                        heappush(waiting, (t + gap, order, last, of, taken)) if t + gap <= last else done(x)
                    else:
                        done(x)
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(times, pa.list_(pa.int64()))], names=["id", "times"])
        rest = [x for x in waiting if x[4]]
        yield pa.RecordBatch.from_arrays([pa.array([x[3] for x in rest], id_type), pa.array([x[4] for x in rest], pa.list_(pa.int64()))], names=["id", "times"])

    id_type = {"bigint": pa.int64(), "string": pa.string()}[kind]
    # At one time spans come before hits.
    ordered = both.repartition("clip").sortWithinPartitions("clip", "t", F.col("hi").isNull())
    return ordered.mapInArrow(run, f"id {kind}, times array<bigint>")
