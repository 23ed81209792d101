"""Media columns: bytes as AVI motion-JPEG, read back through the RIFF index.

A frame is a grey baseline JPEG of 32 x 32 samples. Its unit of storage is the
quantised coefficient: a block holds 64 payload bytes as 64 coefficients of size
category 8, whose eight amplitude bits are the byte itself. All coefficients use one
one-bit Huffman code and a restart marker follows each block, so nothing is lost and
whole frames are packed and unpacked as bit arrays. Frames are intra frames only;
the decoder also gives 8-bit samples (inverse cosine transform) for histograms.

Shots: the histogram difference of neighbouring frames is compared with the mean plus
``k`` deviations of the clip's own differences (and a floor); the runs between cuts
are timed clips.

Files of other writers are read as well: their index, chunk names and frames; a frame of
another layout is decoded by its own tables (baseline, grey or with chroma, whose luma
is taken) to samples, and such a file has frames and clips but no payload.

Defined cases: a null or empty text is one block of zeros; payloads are padded with
zero bytes to whole blocks; equal texts give equal files; null media gives a row of
nulls; a file that is cut short, has no index or frames that cannot be decoded gives a
row of nulls with the reason in ``error`` (``read_avi`` raises ``ValueError``).
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anchorline.llm.common import bound_batches

SIDE, BLOCK, FPS = 32, 64, 8
PER_FRAME = (SIDE // 8) ** 2
#: Fixed values of the JPEG format: the zigzag order of coefficients in a block.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
_angle = (2 * np.arange(8)[:, None] + 1) * np.arange(8)[None, :] * np.pi / 16
_COSINES = (np.cos(_angle) * np.where(np.arange(8) == 0, np.sqrt(0.125), 0.5)).astype(np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_ONE_CODE = bytes([1] + [0] * 15) + b"\x08"  # one code of one bit, for "no zeros before, size category 8"
_HEAD = (
    b"\xff\xd8"
    + _segment(0xDB, b"\x00" + b"\x01" * 64)
    + _segment(0xC0, struct.pack(">BHHB", 8, SIDE, SIDE, 1) + b"\x01\x11\x00")
    + _segment(0xC4, b"\x00" + _ONE_CODE + b"\x10" + _ONE_CODE)
    + _segment(0xDD, struct.pack(">H", 1))
    + _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
)
_RESTARTS = [bytes([0xFF, 0xD0 + i % 8]) for i in range(PER_FRAME)]
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def encode_frames(payload: bytes) -> list[bytes]:
    """JPEG frames of a payload whose length is a multiple of 64; the last frame is filled with zero blocks."""
    data = np.frombuffer(payload.ljust(-(-len(payload) // (BLOCK * PER_FRAME)) * BLOCK * PER_FRAME, b"\0"), np.uint8)
    bits = np.zeros((len(data), 9), np.uint8)
    bits[:, 1:] = np.unpackbits(data[:, None], axis=1)
    packed = np.packbits(bits.reshape(-1)).tobytes()
    size, frames = BLOCK * 9 // 8, []
    for f in range(0, len(packed), size * PER_FRAME):
        out = [_HEAD]
        for i in range(PER_FRAME):
            out.append(packed[f + i * size : f + (i + 1) * size].replace(b"\xff", b"\xff\x00"))
            out.append(_RESTARTS[i])
        out[-1] = b"\xff\xd9"
        frames.append(b"".join(out))
    return frames


def decode_frame(frame: bytes) -> bytes:
    """The payload bytes of one frame of this module's layout."""
    if not frame.startswith(_HEAD) or not frame.endswith(b"\xff\xd9"):
        raise ValueError("not a frame of this layout")
    scan = _RESTART.sub(b"", frame[len(_HEAD) : -2]).replace(b"\xff\x00", b"\xff")
    bits = np.unpackbits(np.frombuffer(scan, np.uint8)).reshape(-1, 9)
    return np.packbits(bits[:, 1:]).tobytes()


class _Bits:
    """Bits of one restart interval, read from the front."""

    def __init__(self, data: bytes):
        self.value, self.left = int.from_bytes(data.replace(b"\xff\x00", b"\xff")), 8 * len(data.replace(b"\xff\x00", b"\xff"))

    def take(self, n: int) -> int:
        if n > self.left:
            raise ValueError("a frame is cut short")
        self.left -= n
        out = (self.value >> self.left) & ((1 << n) - 1)
        self.value &= (1 << self.left) - 1
        return out

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = (code << 1) | self.take(1)
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("a code that no table has")

    def number(self, size: int) -> int:
        v = self.take(size) if size else 0
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _tables(frame: bytes) -> dict:
    """Quantisers, codes, components, size and restart interval of a baseline frame, and where its scan lies."""
    out: dict = {"quant": {}, "codes": {}, "interval": 0, "at": None}
    at = 2
    if frame[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    while at + 4 <= len(frame) and out["at"] is None:
        marker, size = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body = frame[at + 4 : at + 2 + size]
        if frame[at] != 0xFF or len(body) != size - 2:
            raise ValueError("a frame is cut short")
        if marker == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                out["quant"][body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.float32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                counts, code, i, codes = body[1:17], 0, 17, {}
                for n in range(16):
                    for _ in range(counts[n]):
                        codes[n + 1, code] = body[i]
                        code, i = code + 1, i + 1
                    code <<= 1
                out["codes"][body[0] >> 4, body[0] & 15] = codes
                body = body[i:]
        elif marker == 0xC0:
            bits, out["height"], out["width"], n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("not 8-bit samples")
            out["parts"] = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("not a baseline frame")
        elif marker == 0xDD:
            out["interval"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            out["scan"] = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            out["at"] = at + 2 + size
        at += 2 + size
    if out["at"] is None or "parts" not in out:
        raise ValueError("a frame without a scan")
    return out


def decode_samples(frame: bytes) -> np.ndarray:
    """The luma samples (height x width) of a baseline frame, by the tables it carries."""
    t = _tables(frame)
    luma = next(iter(t["parts"]))
    across, down = (max(x[i] for x in t["parts"].values()) for i in (0, 1))
    h, v, q = t["parts"][luma]
    if len(t["scan"]) == 1:  # one component: blocks in rows, whatever its sampling
        across = down = h = v = 1
    wide, high = -(-t["width"] // (8 * across)), -(-t["height"] // (8 * down))
    # A block takes two bits at least, so a header can't ask for more samples than its data holds.
    if wide * high * (1 if len(t["scan"]) == 1 else sum(x[0] * x[1] for x in t["parts"].values())) > 4 * len(frame):
        raise ValueError("a frame whose size its data can't fill")
    plane = np.zeros((high * v * 8, wide * h * 8), np.float32)
    end = frame.rfind(b"\xff\xd9")
    runs = _RESTART.split(frame[t["at"] : end if end >= 0 else len(frame)])
    each = t["interval"] or wide * high
    for r, data in enumerate(runs):
        bits, before = _Bits(data), dict.fromkeys(t["parts"], 0)
        for unit in range(r * each, min((r + 1) * each, wide * high)):
            for part, dc, ac in t["scan"]:
                ph, pv = (1, 1) if len(t["scan"]) == 1 else t["parts"][part][:2]
                for block in range(ph * pv):
                    c = np.zeros(64, np.float32)
                    before[part] += bits.number(bits.symbol(t["codes"][0, dc]))
                    c[0], k = before[part], 1
                    while k < 64:
                        s = bits.symbol(t["codes"][1, ac])
                        if s == 0:
                            break
                        k += s >> 4
                        if s & 15 and k < 64:
                            c[k] = bits.number(s & 15)
                        k += 1
                    if part == luma:
                        flat = np.zeros(64, np.float32)
                        flat[ZIGZAG] = c * t["quant"][q]
                        y, x = (unit // wide * pv + block // ph) * 8, (unit % wide * ph + block % ph) * 8
                        plane[y : y + 8, x : x + 8] = _COSINES @ flat.reshape(8, 8) @ _COSINES.T
    return np.clip(plane[: t["height"], : t["width"]] + 128, 0, 255).astype(np.uint8)


def samples(payload: bytes) -> np.ndarray:
    """8-bit samples of whole frames: (frames, blocks, 8, 8), at a quarter of full contrast so that few are clipped.

    A byte under 128 is the coefficient byte - 255.
    """
    v = np.frombuffer(payload, np.uint8).astype(np.float32).reshape(-1, BLOCK)
    v = np.where(v < 128, v - 255, v)
    planes = np.empty_like(v)
    planes[:, ZIGZAG] = v
    out = _COSINES @ planes.reshape(-1, 8, 8) @ _COSINES.T
    return np.clip(out / 4 + 128, 0, 255).astype(np.uint8).reshape(-1, PER_FRAME, 8, 8)


#: Holds the payload's length in files written here.
LENGTH_CHUNK = b"aPLN"


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(payload: bytes) -> bytes:
    """An AVI file of motion-JPEG frames with an idx1 index; the payload's length is in a chunk of its own, which other readers skip."""
    frames = encode_frames(payload)
    most = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, len(frames), 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), most, -1, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", SIDE * SIDE, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    info = _chunk(LENGTH_CHUNK, struct.pack("<Q", len(payload)))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + head + info + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def read_avi(data: bytes) -> tuple[list[bytes], int | None, float]:
    """Video frames named by the index, the payload's length (None in other writers' files) and frames a second."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI " or len(data) < 12:
        raise ValueError("not an AVI file")
    movi = index = length = None
    rate = float(FPS)
    at, end = 12, 8 + struct.unpack_from("<I", data, 4)[0]
    while at + 8 <= min(end, len(data)):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        kind = data[at + 8 : at + 12]
        if name == b"LIST" and kind == b"movi":
            movi = at + 8
        elif name == b"LIST" and kind == b"hdrl" and data[at + 12 : at + 16] == b"avih":
            rate = 1e6 / max(1, struct.unpack_from("<I", data, at + 20)[0])
        elif name == LENGTH_CHUNK and size == 8:
            length = struct.unpack_from("<Q", data, at + 8)[0]
        elif name == b"idx1":
            index = data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    if movi is None or index is None or end > len(data):
        raise ValueError("an AVI file without frames or index, or cut short")
    frames = []
    for name, _, offset, size in struct.iter_unpack("<4sIII", index[: len(index) // 16 * 16]):
        if name[2:] not in (b"dc", b"db") or not size:
            continue
        # Offsets count from the list's name, or in some files from the file's start.
        at = next((x for x in (movi + offset, offset) if data[x : x + 4] == name), None)
        if at is None:
            raise ValueError("the index does not fit the frames")
        frames.append(data[at + 8 : at + 8 + size])
    return frames, length, rate


def shots(histograms: np.ndarray, k: float = 2.0, floor: float = 0.1) -> list[tuple[int, int]]:
    """(first, past last) frame of each shot. histograms: frames x bins, each row summing to 1."""
    n = len(histograms)
    d = np.abs(np.diff(histograms, axis=0)).sum(axis=1) / 2
    cuts = np.flatnonzero(d > max(floor, d.mean() + k * d.std())) + 1 if len(d) else []
    edges = [0, *map(int, cuts), n]
    return list(zip(edges[:-1], edges[1:], strict=True))


def frame_histograms(payload: bytes, bins: int = 16) -> np.ndarray:
    s = samples(payload).reshape(-1, SIDE * SIDE) >> 4
    at = s + (np.arange(len(s)) * bins)[:, None]
    return np.bincount(at.reshape(-1), minlength=len(s) * bins).reshape(len(s), bins) / s.shape[1]


def sample_histograms(frames: list[np.ndarray], bins: int = 16) -> np.ndarray:
    """Histograms of decoded frames of any size."""
    return np.array([np.bincount(f.reshape(-1) >> 4, minlength=bins) / max(1, f.size) for f in frames]).reshape(len(frames), bins)


def media_column(text: str | None) -> tuple[bytes, int]:
    """The stored file of a text and the text's length in bytes."""
    raw = (text or "").encode()
    return write_avi(raw.ljust(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK), b"\0")), len(raw)


def encode_media(df: DataFrame, *, text_col: str = "text", out_col: str = "media") -> DataFrame:
    """``df`` with ``text_col`` as AVI bytes in ``out_col`` (and its length in ``n_bytes``)."""
    bound_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in (out_col, "n_bytes")]
    schema = df.select(*kept, F.lit(b"").alias(out_col), F.lit(0).cast("long").alias("n_bytes")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [media_column(x) for x in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in made], pa.binary()), pa.array([x[1] for x in made], pa.int64())], [*kept, out_col, "n_bytes"])

    return df.mapInArrow(run, schema)


CLIPS = "array<struct<start_s:double,end_s:double,n_frames:int>>"


_READ = pa.struct([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("n_frames", pa.int32()), ("clips", pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64()), ("n_frames", pa.int32())]))), ("error", pa.string())])


def media_facts(data: bytes | None, k: float = 2.0, floor: float = 0.1) -> dict:
    """What one stored file holds; nulls and the reason where it can't be read."""
    if data is None:
        return {}
    known = {"media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
    try:
        frames, length, rate = read_avi(data)
        if length is not None:
            whole = b"".join(map(decode_frame, frames))
            payload = whole[:length]
            known |= {"payload_bytes": length, "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-BLOCK:])}
            histograms = frame_histograms(whole)
        else:
            histograms = sample_histograms([decode_samples(f) for f in frames])
    except (ValueError, KeyError, IndexError, struct.error) as e:
        return known | {"error": str(e) or type(e).__name__}
    found = shots(histograms, k, floor) if len(histograms) else []
    return known | {"n_frames": len(frames), "clips": [{"start_s": a / rate, "end_s": b / rate, "n_frames": b - a} for a, b in found]}


def read_media(df: DataFrame, *, media_col: str = "media", k: float = 2.0, floor: float = 0.1) -> DataFrame:
    """The other columns plus what is read back: payload size, hash and tail, the file's size and hash, frames, timed clips and errors."""
    own = [f.name for f in _READ]
    kept = [c for c in df.columns if c != media_col and c not in own]
    read = f"payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames int, clips {CLIPS}, error string"
    schema = StructType([*df.select(*kept).schema.fields, *StructType.fromDDL(read).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([media_facts(x, k, floor) for x in b.column(b.schema.get_field_index(media_col)).to_pylist()], _READ)
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *made.flatten()], [*kept, *own])

    return df.mapInArrow(run, schema)


def clip_rows(df: DataFrame) -> DataFrame:
    """Timed clip rows of what ``read_media`` returned: one row a clip."""
    rest = [c for c in df.columns if c != "clips"]
    return df.select(*rest, F.posexplode("clips").alias("clip", "__c")).select(*rest, "clip", "__c.start_s", "__c.end_s", F.col("__c.n_frames").alias("clip_frames"))
