"""Packing: sum-of-squares online placement of token runs into sequences of fixed size.

Each task packs the documents it reads, one after another: no shuffle, and memory for
the open sequences only. A document's full windows become sequences at once; its
remainder is placed at the fill level that makes the sum over levels of (number of
open sequences at that level) squared smallest, found in one pass over the level
array. At the end of a task the open sequences are emptied into each other: runs are
cut so that sequences are full, and the last ones have the lengths of powers of two,
which need no padding.

Defined cases: a null or empty text is the end token alone; repeated rows are packed
each for itself; texts of any length are cut into whole windows; an empty table gives
an empty result. Ids come from a vocabulary file whose path is a parameter.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from anchorline.llm.common import bound_batches

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_loaded: dict[str, Callable[[str], list[int]]] = {}


def tokenizer(path: str) -> Callable[[str], list[int]]:
    """text -> ids as the file's tokenizer gives them; its added tokens in a text are those tokens.

    Where the same vocabulary lies beside it as ranks, the rank form does the work (it is
    several times faster and gives the same ids); the file's own tokenizer takes over for
    any text that holds an added token or on which that form gives up.
    """
    if path in _loaded:
        return _loaded[path]
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(path)
    added = [x.content for x in slow.get_added_tokens_decoder().values()]
    encode = exact = lambda text: slow.encode(text, add_special_tokens=False).ids
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if path.endswith(".json") and os.path.exists(ranks_path):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            if any(x in text for x in added):
                return exact(text)
            try:
                return fast.encode_ordinary(text)
            except (Exception, BaseException) as e:  # its pattern engine panics on some extreme texts
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                return exact(text)

    _loaded[path] = encode
    return encode


class Levels:
    """Open sequences by fill level. ``place`` returns the sequence and offset of a run."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, length: int, new: Callable[[], int]) -> tuple[int, int]:
        n, top = self.count, self.size - length
        # Moving one sequence from h to h + length changes the sum of squares by this; full ones do not count.
        change = 2 * (n[length : self.size + 1] - n[: top + 1]) + 2
        change[top] = 1 - 2 * n[top]
        change[0] = 2 * n[length] + 1 if top else 0
        can = n[: top + 1] > 0
        can[0] = True
        change[~can] = np.iinfo(np.int64).max
        h = top - int(np.argmin(change[::-1]))  # of equal changes the fullest
        sequence = self.open[h].pop() if h else new()
        if h:
            n[h] -= 1
        if h < top:
            n[h + length] += 1
            self.open[h + length].append(sequence)
        return sequence, h


def pack(runs: Iterator[tuple[int, np.ndarray]], size: int, first_sequence: int) -> Iterator[tuple]:
    """(document, ids) -> (document, start, length, crc32, document's tokens, sequence, offset), whole windows first."""
    levels, made = Levels(size), [first_sequence]
    waiting: dict[int, list[tuple]] = {}

    def new() -> int:
        made[0] += 1
        return made[0] - 1

    crc = lambda ids: zlib.crc32(ids.tobytes())
    for doc, ids in runs:
        n = len(ids)
        full = n - n % size
        for start in range(0, full, size):
            yield doc, start, size, crc(ids[start : start + size]), n, new(), 0
        if full < n:
            rest = ids[full:]
            sequence, offset = levels.place(len(rest), new)
            waiting.setdefault(sequence, []).append((doc, full, rest, n, offset))
            if offset + len(rest) == size:
                for d, start, part, total, at in waiting.pop(sequence):
                    yield d, start, len(part), crc(part), total, sequence, at
    # Fullest first: each open sequence is filled from the emptiest.
    left = sorted((x for x in waiting.values()), key=lambda x: (-sum(len(p[2]) for p in x), x[0][0] if x[0][0] is not None else -1))
    queue = [(d, start, part, total) for x in left for d, start, part, total, _ in x]
    tokens = sum(len(x[2]) for x in queue)
    targets = [size] * (tokens // size) + [1 << k for k in reversed(range(size.bit_length())) if tokens % size >> k & 1]
    at, sequence = 0, new() if targets else 0
    for d, start, part, total in queue:
        while len(part):
            take = min(len(part), targets[0] - at)
            yield d, start, take, crc(part[:take]), total, sequence, at
            start, part, at = start + take, part[take:], at + take
            if at == targets[0]:
                targets.pop(0)
                at, sequence = 0, new() if targets else 0


def pack_documents(df: DataFrame, *, tokenizer_path: str, end_id: int = 1, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of each document: where its ids lie in which sequence."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)

        def documents() -> Iterator[tuple[int, np.ndarray]]:
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    ids = encode(text) if text else []
                    ids.append(end_id)
                    yield doc, np.array(ids, "<u4")

        rows: list[tuple] = []
        for row in pack(documents(), size, TaskContext.get().partitionId() << 40):
            rows.append(row)
            if len(rows) == 20_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in PIECES.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
