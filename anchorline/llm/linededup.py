"""Line dedup: lines found in many documents go; the other lines are put together again.

Lines are exploded, normalised and hashed; distinct documents are counted for each
hash; lines whose hash reaches the threshold are dropped by position. Only hashes,
document ids and positions are shuffled for the counts.

Defined cases: a null or empty text is one empty line; rows that share a doc_id are
one document (null ids together are one) but each row gives its own result row; a
line whose key is shorter than ``min_chars`` always stays; an empty table gives an
empty result; other columns pass through untouched and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import bound_batches, stored

#: Line hashes that may be broadcast: at most so many rows of 16 bytes.
BROADCAST_ROWS = 1_000_000
_ID, _ROW, _LINES, _DROP = ("__line_doc", "__line_row", "__line_lines", "__line_drop")


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """128 bits of each normalised line: no ASCII white space at its ends, A-Z lower-cased; None if too short."""
    out: list[bytes | None] = []
    for line in text.encode().split(b"\n"):
        key = line.strip(b" \t\n\x0b\x0c\r").lower()
        long = len(key) >= 4 * min_chars or len(key.decode()) >= min_chars
        out.append(hashlib.md5(key, usedforsecurity=False).digest() if long else None)
    return out


def _keyed(base: DataFrame, min_chars: int) -> DataFrame:
    """(document, row, pos, h) for every line that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [line_keys(x or "", min_chars) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.binary()))], [_ID, _ROW, "keys"])

    kind = base.schema[_ID].dataType.simpleString()
    lists = base.mapInArrow(run, f"{_ID} {kind}, {_ROW} binary, keys array<binary>")
    return lists.select(_ID, _ROW, F.posexplode("keys").alias("pos", "h")).where(F.col("h").isNotNull())


def dedup_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``df`` with ``text_col`` cleaned, plus ``n_lines`` (before) and ``n_dropped``.

    Existing columns named n_lines or n_dropped are replaced.
    """
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Rows are matched by a hash of id and text: equal rows have equal answers.
    row = F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text)))
    base = df.select(*kept, row.alias(_ROW), F.split(text, "\n").alias(_LINES))
    bound_batches(df.sparkSession)
    keyed = _keyed(df.select(F.col(id_col).alias(_ID), row.alias(_ROW), F.col(text_col)), min_chars)
    common = stored(keyed.select("h", _ID).distinct().groupBy("h").count().where(F.col("count") >= min_docs).select("h"))
    # Hashes go by broadcast only where their number is known to be small: a very common line then stays where it is read.
    few = F.broadcast(common) if common.count() <= BROADCAST_ROWS else common
    drops = keyed.join(few, "h").groupBy(_ROW).agg(F.collect_set("pos").alias(_DROP))
    joined = base.join(drops, _ROW, "left")
    every = F.sequence(F.lit(0), F.size(_LINES) - 1)
    left = F.when(F.col(_DROP).isNull(), F.col(_LINES)).otherwise(F.transform(F.array_except(every, _DROP), lambda i: F.get(_LINES, i)))
    columns = [F.array_join(left, "\n").alias(c) if c == text_col else F.col(c) for c in kept]
    return joined.select(*columns, F.size(_LINES).cast("long").alias("n_lines"), F.when(F.col(_DROP).isNull(), F.lit(0)).otherwise(F.size(_DROP)).cast("long").alias("n_dropped"))
