"""Substring dedup: repeated windows of words, in groups by prefixes of variable length.

Every word begins a suffix. Suffixes are split into groups by a prefix of variable
length: one word where that word is rare enough, else two, three and more words, so
that groups fit in a task's memory. Which prefixes are too frequent is learnt from a
sample of documents that grows with the groups; this only balances the groups. In a
group suffixes are sorted by the hash of their first ``window`` words; a run of equal
ones stands for the internal node of that depth in the prefix's suffix tree. The tree
itself is not built: deeper nodes would need the words after the window, a dozen times
the text, in the shuffle. A node's first document keeps its words; every other document
under it repeats them. Prefixes of full depth that are still too frequent need no
sorting: a node's first document is then a plain minimum, aggregated before the shuffle.

A suffix is compared by the 64-bit hash of its first ``window`` words. Nodes send back
(document, node) pairs only, and whole texts move only for documents that lose words.

Defined cases: null and empty texts have no words; texts of fewer than ``window`` words
keep all; rows that share a doc_id are one document, and a repeat inside one document
is kept; rows with a null doc_id neither lose words nor make others lose any; an empty
table gives an empty result; columns n_words and n_removed are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline.llm.common import bound_batches, parts, stored
from anchorline.llm.words import _BASE, U, Words, mix, pieces, run_starts

#: Lengths of prefixes, in words, before the whole window.
PREFIXES = (1, 2, 3, 5, 8)
#: Ids that may be broadcast: at most so many longs.
BROADCAST_ROWS = 1_000_000


def prefix_hashes(words: Words, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, hash of that many words) for every suffix that has a whole window; the window comes last."""
    starts, h = run_starts(words, window), words.hashes
    acc = np.zeros(len(starts), U)
    for n in range(1, window + 1):
        acc = acc * U(_BASE) + h[starts + n - 1]
        if n in PREFIXES or n == window:
            yield n, mix(acc + U(n))


def _in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def grouped(words: Words, window: int, groups: int, frequent: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(group, window hash) of each suffix; group -1: a frequent whole window."""
    group = key = None
    for n, h in prefix_hashes(words, window):
        if group is None:
            group = np.full(len(h), -2, np.int64)
        new = (group == -2) & ~_in(h, frequent.get(n, h[:0]))
        group[new] = (h[new] % U(groups)).astype(np.int64)
        key = h
    group[group == -2] = -1
    return group, key


def frequent_prefixes(docs: DataFrame, window: int, groups: int, sample_docs: int) -> dict[int, np.ndarray]:
    """Prefixes that would fill more than an eighth of a group, by length, sorted; from a bounded sample."""
    sample = docs.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, words in pieces(b, "text", lower=False):
                for n, h in prefix_hashes(words, window):
                    keys, count = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n, np.int32)), pa.array(keys.view(np.int64)), pa.array(count)], ["n", "key", "count"])

    counts = stored(sample.select("text").mapInArrow(run, "n int, key long, count long").groupBy("n", "key").agg(F.sum("count").alias("count")))
    total = counts.where(F.col("n") == window).agg(F.sum("count")).first()[0] or 0
    least = max(8, total / (8 * groups))
    # At most 8 * groups prefixes of each length can be that frequent.
    found = counts.where(F.col("count") > least).select("n", "key").toArrow()
    n, key = found["n"].to_numpy(), found["key"].to_numpy().view(U) if len(found) else np.zeros(0, U)
    return {int(i): np.sort(key[n == i]) for i in set(n.tolist())}


def _firsts(docs: DataFrame, window: int, frequent: np.ndarray) -> dict[int, int]:
    """The smallest document of each frequent window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=False):
                key = [h for _, h in prefix_hashes(words, window)][-1]
                at = np.flatnonzero(_in(key, frequent))
                doc = part.column(0).to_numpy()[words.row_of()[run_starts(words, window)[at]]]
                order = np.lexsort((doc, key[at]))
                k, d = key[at][order], doc[order]
                first = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(k[first].view(np.int64)), pa.array(d[first])], ["key", "doc"])

    got = docs.mapInArrow(run, "key long, doc long").groupBy("key").agg(F.min("doc").alias("doc")).toArrow()
    return dict(zip(got["key"].to_pylist(), got["doc"].to_pylist(), strict=True))


def repeats(docs: DataFrame, window: int, groups: int, frequent: dict[int, np.ndarray]) -> DataFrame:
    """(id, keys): the windows of each document that begin in a document of smaller id too."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=False, size=3 << 20):
                group, key = grouped(words, window, groups, shared.value)
                doc = part.column(0).to_numpy()[words.row_of()[run_starts(words, window)]]
                order = np.argsort(group, kind="stable")
                group, key, doc = group[order], key[order], doc[order]
                names, at = np.unique(group, return_index=True)
                offsets = pa.array(np.append(at, len(group)).astype(np.int32))
                made = [pa.array(names.astype(np.int32)), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (key.view(np.int64), doc))]
                out = pa.RecordBatch.from_arrays(made, ["grp", "keys", "docs"])
                out = out.filter(pa.array(names >= 0))
                for i in range(0, out.num_rows, 16):
                    yield out.slice(i, 16)

    def subtree(t: pa.Table) -> pa.Table:
        key, doc = (t[c].combine_chunks().flatten().to_numpy() for c in ("keys", "docs"))
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        node = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        first = doc[node][np.cumsum(node) - 1]
        again = doc > first
        key, doc = key[again], doc[again]
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])) if len(key) else np.zeros(0, bool)
        key, doc = key[new], doc[new]
        # Back in blocks of documents, so that a group sends one row for each block and not one for each document.
        block = (mix(doc.view(U)) % U(groups)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        names, at = np.unique(block[order], return_index=True)
        offsets = pa.array(np.append(at, len(doc)).astype(np.int32))
        return pa.table({"block": pa.array(names), "ids": pa.ListArray.from_arrays(offsets, pa.array(doc[order])), "keys": pa.ListArray.from_arrays(offsets, pa.array(key[order]))})

    def gather(t: pa.Table) -> pa.Table:
        doc, key = (t[c].combine_chunks().flatten().to_numpy() for c in ("ids", "keys"))
        order = np.argsort(doc, kind="stable")
        names, at = np.unique(doc[order], return_index=True)
        return pa.table({"id": pa.array(names), "keys": pa.ListArray.from_arrays(pa.array(np.append(at, len(doc)).astype(np.int32)), pa.array(key[order]))})

    sent = docs.mapInArrow(suffixes, "grp int, keys array<bigint>, docs array<bigint>")
    answered = sent.groupBy("grp").applyInArrow(subtree, "block int, ids array<bigint>, keys array<bigint>")
    return answered.groupBy("block").applyInArrow(gather, "id long, keys array<bigint>")


def _cut(df: DataFrame, kept: list[str], id_col: str, text_col: str, window: int, firsts: dict[int, int]) -> DataFrame:
    """``df`` (with __keys, perhaps null) with covered words taken out of ``text_col``."""
    schema = T.StructType([df.schema[c] if c != text_col else T.StructField(c, T.StringType()) for c in kept] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    hot = np.array(sorted(firsts), np.int64)
    hot_doc = np.array([firsts[k] for k in hot.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c))  # noqa: E731, B023
            texts, removed, total = [], [], []
            for part, words in pieces(b, text_col, lower=False):
                keys = part.column(part.schema.get_field_index("__keys"))
                ids = part.column(part.schema.get_field_index(id_col)).to_pylist()
                starts = run_starts(words, window)
                key = [h for _, h in prefix_hashes(words, window)][-1].view(np.int64)
                edges = np.searchsorted(starts, words.offsets)
                bounds = np.append(words.offsets, 0)
                for i, doc in enumerate(ids):
                    n, base = int(words.counts[i]), int(bounds[i])
                    own, at = key[edges[i] : edges[i + 1]], starts[edges[i] : edges[i + 1]] - base
                    again = np.isin(own, keys[i].values.to_numpy()) if keys[i].is_valid else np.zeros(len(own), bool)
                    if len(hot) and len(own) and doc is not None:
                        j = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                        again |= (hot[j] == own) & (doc > hot_doc[j])
                    lo, hi = (int(words.start[base]), int(words.end[base + n - 1])) if n else (0, 0)
                    split = words.data[lo:hi].tobytes().split()
                    gone = 0
                    if again.any():
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, at[again], 1)
                        np.add.at(edge, at[again] + window, -1)
                        covered = (np.cumsum(edge[:-1]) > 0).tolist()
                        gone = sum(covered)
                        split = [w for w, c in zip(split, covered, strict=True) if not c]
                    texts.append(b" ".join(split))
                    removed.append(gone)
                    total.append(n)
            made = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text_col else column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*made, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], [*kept, "n_words", "n_removed"])

    return df.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, sample_docs: int = 2000, group_bytes: int = 24 << 20) -> DataFrame:
    """``docs`` without words of repeated windows (kept words joined by one space), plus n_words and n_removed."""
    spark = docs.sparkSession
    bound_batches(spark)
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(parts(spark), -(-size // group_bytes))
    # A prefix that fills an eighth of a group is seen several times in the sample, however many groups there are.
    frequent = frequent_prefixes(named, window, groups, max(sample_docs, groups // 4))
    firsts = _firsts(named, window, frequent[window]) if len(frequent.get(window, ())) else {}
    found = stored(repeats(named, window, groups, frequent))
    keys = found.select(F.col("id").alias("__id"), F.col("keys").alias("__keys"))
    base = docs.select(*kept)
    match = base[id_col].cast("long") == keys["__id"]
    none = F.lit(None).cast("array<bigint>").alias("__keys")
    if found.count() <= BROADCAST_ROWS:
        ids = F.broadcast(keys.select("__id"))
        touched = base.join(ids, base[id_col].cast("long") == ids["__id"], "left_semi").join(keys, match)
        rest = base.join(ids, base[id_col].cast("long") == ids["__id"], "left_anti").select(*kept, none)
        whole = touched.select(*kept, "__keys").unionAll(rest)
    else:
        whole = base.join(keys, match, "left").select(*kept, "__keys")
    return _cut(whole, kept, id_col, text_col, window, firsts)
