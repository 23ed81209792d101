"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by their number of shingles. For each partition a document is
seen as blocks about as long as the partition's items, so that a short item inside a
long document keeps a large share of the block it lies in. A block's signature is the
minimum of its shingles under each of ``registers`` permutations; signatures of longer
blocks are minima of those of shorter ones. An item and a document that agree in one
register are a candidate, and the candidate's containment is counted on full sets of
shingles. Items of few shingles are looked up by every shingle.

The documents are read once for each block of items and nothing is shuffled; what is
broadcast is one block of items, whose size is bounded by ``block_shingles``.

Words: runs of letters, digits and non-ASCII characters, A-Z lower-cased. Defined
cases: an item with fewer than ``k`` words has its whole sequence as its one shingle and
is found wherever a text holds these words in a row; a document with fewer than ``k``
words holds only such items; one without words has none and never matches; null texts
count as empty; items with null ids are judged like others and reported with a null id;
repeated rows are judged alike; an empty table of items marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline.llm.common import bound_batches
from anchorline.llm.words import U, mix, pieces, run_starts, runs, shingle_sets

MATCHES = "array<struct<item_id:bigint,item_shingles:bigint,shared:bigint>>"
_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("item_shingles", pa.int64()), ("shared", pa.int64())]))
#: Shingles of the shortest block; items of fewer than half as many are looked up directly.
BASE = 16


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U))
    return seeds[:n], seeds[n:] | U(1)


class Items:
    """One bounded block of items: sets, and sorted signature values for each size partition and register."""

    def __init__(self, ids: list[int | None], sets: list[np.ndarray], words: list[int], registers: int, k: int):
        self.ids, self.sets, self.registers = ids, sets, registers
        # Items shorter than a shingle, by their number of words: sorted hashes and their items.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({n for n in words if n < k}):
            mine = np.array([i for i, m in enumerate(words) if m == n])
            v = np.array([sets[i][0] for i in mine])
            self.short[n] = v[o := np.argsort(v, kind="stable")], mine[o]
        x, a = _permutations(registers)
        by_level: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if words[i] < k:
                continue
            by_level.setdefault(-1 if len(s) < BASE // 2 else max(0, (len(s) - 1).bit_length() - (BASE.bit_length() - 1)), []).append(i)
        self.levels: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.seen: dict[int, np.ndarray] = {}
        for level, members in by_level.items():
            if level < 0:
                values = [(np.concatenate([sets[i] for i in members]), np.concatenate([np.full(len(sets[i]), i) for i in members]))]
            else:
                values = [(np.array([((sets[i] ^ x[r]) * a[r]).min() for i in members]), np.array(members)) for r in range(registers)]
            self.levels[level] = [(v[o := np.argsort(v, kind="stable")], m[o]) for v, m in values]
            self.seen[level] = seen = np.zeros(1 << 20, bool)
            for v, _ in values:
                seen[(v >> U(44)).astype(np.int64)] = True

    def _hits(self, level: int, register: int, values: np.ndarray, rows: np.ndarray, found: set[tuple[int, int]]) -> None:
        maybe = np.flatnonzero(self.seen[level][(values >> U(44)).astype(np.int64)])
        if not len(maybe):
            return
        keys, members = self.levels[level][register]
        low, high = np.searchsorted(keys, values[maybe], "left"), np.searchsorted(keys, values[maybe], "right")
        for j in np.flatnonzero(high > low):
            row = int(rows[maybe[j]])
            found.update((row, int(m)) for m in members[low[j] : high[j]])

    def candidates(self, hashes: np.ndarray, rows: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) that agree somewhere. hashes: shingles in text order; rows: their rows, ascending."""
        found: set[tuple[int, int]] = set()
        if not len(hashes) or not self.levels:
            return found
        if -1 in self.levels:
            self._hits(-1, 0, hashes, rows, found)
        top = max(self.levels)
        if top < 0:
            return found
        change = np.flatnonzero(np.diff(rows)) + 1
        begins = np.concatenate(([0], change))
        nth = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
        starts = np.flatnonzero(nth % BASE == 0)
        x, a = _permutations(self.registers)
        for r in range(self.registers):
            least, at, index = np.minimum.reduceat((hashes ^ x[r]) * a[r], starts), rows[starts], nth[starts] // BASE
            for level in range(top + 1):
                if level:  # two neighbouring blocks of one row are one block of the next level
                    first = np.flatnonzero(index % 2 == 0)
                    least, at, index = np.minimum.reduceat(least, first), at[first], index[first] // 2
                if level in self.levels:
                    self._hits(level, r, least, at, found)
        return found


    def short_matches(self, words: Words) -> set[tuple[int, int]]:
        """(row, item) of items shorter than a shingle whose words a row holds in a row."""
        found: set[tuple[int, int]] = set()
        row = words.row_of()
        for n, (keys, members) in self.short.items():
            places = run_starts(words, n)
            hashes = runs(words.hashes, n)[places]
            low, high = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
            for j in np.flatnonzero(high > low):
                found.update((int(row[places[j]]), int(m)) for m in members[low[j] : high[j]])
        return found


def item_sets(items: DataFrame, *, id_col: str, text_col: str, k: int) -> DataFrame:
    """item_id, the sorted distinct shingles and the number of words of each item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=True, letters=True):
                sets = pa.array([s.view(np.int64) for s in shingle_sets(words, k)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), sets, pa.array(words.counts.astype(np.int64))], ["item_id", "shingles", "words"])

    chosen = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "item_id long, shingles array<bigint>, words long").where(F.size("shingles") > 0)


def mark_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 5,
    threshold: float = 0.8,
    registers: int = 32,
    block_shingles: int = 1_000_000,
    matches_col: str = "matches",
) -> DataFrame:
    """``docs`` plus ``matches``: the items of whose shingles the text holds ``threshold`` or more."""
    spark = docs.sparkSession
    bound_batches(spark)
    kept = [c for c in docs.columns if c != matches_col]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(matches_col, T._parse_datatype_string(MATCHES))])
    sets = item_sets(items, id_col=item_id_col, text_col=item_text_col, k=k)
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = -(-total // block_shingles)
    out = docs.select(*kept, F.array().cast(MATCHES).alias(matches_col))
    for n in range(blocks):
        # One bounded block of items: its shingles, as many as block_shingles in the mean.
        own = sets.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n).collect()
        shared = spark.sparkContext.broadcast(Items([r[0] for r in own], [np.array(r[1], np.int64).view(U) for r in own], [r[2] for r in own], registers, k))
        out = out.mapInArrow(_marker(shared, kept, text_col, matches_col, k, threshold), schema)
    return out


def _marker(shared, kept: list[str], text_col: str, matches_col: str, k: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for b in batches:
            for part, words in pieces(b, text_col, lower=True, letters=True):
                places = run_starts(words, k)
                hashes, rows = runs(words.hashes, k)[places], words.row_of()[places]
                matches: list[list[dict]] = part.column(part.schema.get_field_index(matches_col)).to_pylist()
                for row, item in sorted(items.candidates(hashes, rows)):
                    own = hashes[np.searchsorted(rows, row) : np.searchsorted(rows, row, "right")]
                    there = int(np.isin(items.sets[item], own).sum())
                    if there >= threshold * len(items.sets[item]):
                        matches[row] = [*matches[row], {"item_id": items.ids[item], "item_shingles": len(items.sets[item]), "shared": there}]
                for row, item in sorted(items.short_matches(words)):
                    matches[row] = [*matches[row], {"item_id": items.ids[item], "item_shingles": 1, "shared": 1}]
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(matches, _KIND)], [*kept, matches_col])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    marked = mark_contamination(docs, items, matches_col="__matches", **options)
    return marked.where(F.size("__matches") == 0).select(*docs.columns)
