"""Near-duplicates: SetSketch registers in bands, joint likelihood estimate, exact check on full sets.

A document is its set of ``k``-word shingles; equal sets are one class. A class's
sketch holds ``registers`` truncated, exponentially spaced minima: register i is
``floor(1 - log_b(x))`` clipped to 0..65535, x being the smallest of the set's
exponential hash values of rate ``RATE`` under the i-th permutation. Sketches merge by
register-wise maxima. Classes that agree in all registers of a band meet in a bucket.

Buckets are not expanded into pairs. At first each class is compared with one class of
its buckets; then, in rounds, one class of every component of a bucket with one of the
bucket's largest component. Links found join the components. After the rounds, each class outside its bucket's largest component meets
all classes of other components there: a pair comes out of that join once, and only if
sizes and odd sketches (2,048 parity bits of the sets, from which the number of differing
shingles is known closely) leave the threshold within reach. So every candidate pair is
either inside one component or has been decided. A true link fails the odd sketches with
a probability under 3e-7 (five deviations); ``odd_deviations=None`` does without them.

Pairs are estimated jointly from both sketches by maximum likelihood first; what may
reach the threshold is decided on full sets, which are made again from the texts, move
once, to their pair's second member, and are stored nowhere.

Defined cases: null and empty texts, and texts without words, have an empty set and
are linked with nothing; with fewer than ``k`` words the whole sequence is the one
shingle; a null doc_id is a document that others' components do not take their name
from; repeated rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import bound_batches, discard, stored
from anchorline.llm.components import components
from anchorline.llm.words import U, mix, pieces, shingle_sets

#: Base and rate of the registers, and the largest register value.
LOG_BASE, RATE, TOP = float(np.log(1.001)), 20.0, 65535
#: Ids that may be broadcast: a table of at most so many rows of 24 bytes.
BROADCAST_ROWS = 1_000_000
#: Shingles of first members that go to one group of a second member.
GROUP_SHINGLES = 2_000_000
#: Bits of the odd sketch of a class that shares a bucket.
ODD_BITS = 2048


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U) * U(0xA0761D6478BD642F))
    return seeds[:n], seeds[n:] | U(1)


def fingerprints(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits of each set, None of an empty one."""
    out: list[bytes | None] = []
    for s in sets:
        if len(s):
            m = mix(s + U(0x9E3779B97F4A7C55))
            out.append(np.array([m.sum(dtype=U), np.bitwise_xor.reduce(mix(m))], ">u8").tobytes())
        else:
            out.append(None)
    return out


def sketches(sets: list[np.ndarray], registers: int) -> list[bytes | None]:
    """The registers of each set as 16-bit values in one binary, None of an empty set."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return [None] * len(sets)
    whole = np.concatenate(filled)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in filled])[:-1]))
    x, a = permutations(registers)
    low = np.empty((registers, len(filled)), U)
    for r in range(registers):
        low[r] = np.minimum.reduceat((whole ^ x[r]) * a[r], starts)
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    values = np.clip(np.floor(1 - np.log(least) / LOG_BASE), 0, TOP).astype(">u2").T
    rows = iter([v.tobytes() for v in np.ascontiguousarray(values)])
    return [next(rows) if len(s) else None for s in sets]


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """For each set ODD_BITS bits as 64-bit words: whether an odd number of its shingles falls on a bit."""
    at = np.concatenate([(mix(s ^ U(0xC2B2AE3D27D4EB4F)) & U(ODD_BITS - 1)).astype(np.int64) + i * ODD_BITS for i, s in enumerate(sets)])
    odd = (np.bincount(at, minlength=len(sets) * ODD_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sets), -1)


def odd_limit(total: Column, percent: int, deviations: float = 5) -> Column:
    """The most bits in which two sets of ``total`` shingles together differ if their similarity is ``percent``.

    Such sets differ in ``d`` shingles at most; these fall on ODD_BITS bits, and the number
    of odd ones has this mean and variance. So many deviations and two bits are added.
    """
    n = float(ODD_BITS)
    d = F.floor(total * (100 - percent) / (100 + percent))
    q, r = F.pow(F.lit(1 - 2 / n), d), F.pow(F.lit(1 - 4 / n), d)
    p = (1 - q) / 2
    spread = n * p * (1 - p) + n * (n - 1) * ((1 - 2 * q + r) / 4 - p * p)
    return n * p + deviations * F.sqrt(F.greatest(spread, F.lit(0.0))) + 2


def merge_sketches(a: bytes, b: bytes) -> bytes:
    """The sketch of the union."""
    return np.maximum(np.frombuffer(a, ">u2"), np.frombuffer(b, ">u2")).astype(">u2").tobytes()


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 64) -> np.ndarray:
    """Jaccard similarity of largest joint likelihood. a, b: pairs x registers; na, nb: set sizes."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, grid)[None, :]
    base = float(np.exp(LOG_BASE))
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (base - 1) / base) / LOG_BASE
    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    like = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), like.argmax(axis=1)]


def _sketched(docs: DataFrame, id_col: str, text_col: str, k: int, registers: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=True):
                sets = shingle_sets(words, k)
                made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(fingerprints(sets), pa.binary()), pa.array(sketches(sets, registers), pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["id", "n", "fp", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, fp binary, sketch binary")


def _of_classes(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts of the documents named by ``first``, beside all columns of ``classes``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Ids go by broadcast only where their number is known to be small.
    small = F.broadcast(classes) if classes.count() <= BROADCAST_ROWS else classes
    return texts.join(small, texts["id"].eqNullSafe(small["first"])).drop("id", "first")


def _odd(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(fp, odd): the odd sketches of the given classes (fp, first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=True):
                sets = shingle_sets(words, k)
                mine = [i for i, (x, y) in enumerate(zip(fingerprints(sets), part.column(1).to_pylist(), strict=True)) if x is not None and x == y]
                if mine:
                    yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(mine)), pa.array(list(odd_sketches([sets[i] for i in mine])), pa.list_(pa.int64()))], ["fp", "odd"])

    # Several documents may share the id of a class's first one, or its set: one row of each class stays.
    return _of_classes(docs, classes, id_col, text_col).mapInArrow(run, "fp binary, odd array<bigint>").groupBy("fp").agg(F.first("odd").alias("odd"))


def _probable(pairs: DataFrame, near: DataFrame, percent: int, margin: float) -> DataFrame:
    """Pairs (x, y, first_x, first_y, n_x) whose joint estimate comes within ``margin`` of the threshold."""
    x, y = (near.select(F.col("fp").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"), F.col("first").alias(f"first_{c}")) for c in "xy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            column = lambda c: t.column(t.schema.get_field_index(c))  # noqa: E731, B023
            if t.num_rows:
                registers = [np.frombuffer(b"".join(column(c).to_pylist()), ">u2").astype(np.int32).reshape(t.num_rows, -1) for c in ("s_x", "s_y")]
                keep = estimate(*registers, *(column(c).to_numpy().astype(float) for c in ("n_x", "n_y"))) >= percent / 100 - margin
                yield t.select(["x", "y", "first_x", "first_y", "n_x"]).filter(pa.array(keep))

    return pairs.join(x, "x").join(y, "y").mapInArrow(run, "x binary, y binary, first_x long, first_y long, n_x long")


def _links(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(a, b): pairs whose full sets reach the threshold. Each first member's set goes to its pair's second member.

    A second member with many partners is dealt to several groups, each of ``GROUP_SHINGLES`` shingles.
    """
    hubs = pairs.groupBy("y").agg(F.first("first_y").alias("first"), F.ceil(F.sum("n_x") / GROUP_SHINGLES).cast("int").alias("parts"))
    dealt = pairs.join(hubs.select("y", "parts"), "y").select(F.col("x").alias("fp"), F.col("first_x").alias("first"), F.col("y").alias("hub"), F.pmod(F.xxhash64("x"), "parts").cast("int").alias("part"))
    whole = hubs.select(F.col("y").alias("fp"), "first", F.col("y").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in pieces(b, "text", lower=True):
                sets = shingle_sets(words, k)
                mine = [i for i, (x, y) in enumerate(zip(fingerprints(sets), part.column(1).to_pylist(), strict=True)) if x is not None and x == y]
                names = part.select(["fp", "hub", "part"]).take(pa.array(mine, pa.int64()))
                for i in range(0, len(mine), 256):
                    some = names.slice(i, 256)
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array([sets[j].view(np.int64) for j in mine[i : i + 256]], pa.list_(pa.int64()))], ["fp", "hub", "part", "shingles"])

    def decide(t: pa.Table) -> pa.Table:
        fp, hub, sets = t["fp"].to_pylist(), t["hub"][0].as_py(), t["shingles"].combine_chunks()
        known = sets[fp.index(hub)].values.to_numpy()
        found = set()
        for i, x in enumerate(fp):
            if x != hub and x not in found:
                own = sets[i].values.to_numpy()
                both = len(np.intersect1d(own, known, assume_unique=True))
                if both * 100 >= (len(own) + len(known) - both) * percent:
                    found.add(x)
        return pa.table({"a": pa.array(sorted(found), pa.binary()), "b": pa.array([hub] * len(found), pa.binary())})

    texts = _of_classes(docs, stored(dealt.unionByName(whole)), id_col, text_col)
    return texts.mapInArrow(sets_of, "fp binary, hub binary, part int, shingles array<bigint>").groupBy("hub", "part").applyInArrow(decide, "a binary, b binary")


def _across(open_: DataFrame, members: DataFrame, owner: DataFrame, facts: DataFrame, buckets: Column, percent: int, deviations: float | None) -> DataFrame:
    """Pairs (x, y) of different components in one bucket, each once, whose sizes and odd sketches allow the threshold."""
    words = range(ODD_BITS // 64)
    facts = facts.select("fp", "n", buckets.alias("all"), *[F.get("odd", F.lit(i)).alias(f"p{i}") for i in words])
    most = open_.where("comp = most.comp").select("bucket", F.col("comp").alias("top"))
    # Only buckets that still hold several components are looked at.
    every = members.join(most, "bucket").join(owner, "fp").join(facts, "fp")
    right = every.select("bucket", *[F.col(c).alias(f"r_{c}") for c in every.columns if c not in ("bucket", "top", "band")])
    apart = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"r_p{i}"))) for i in words[1:]), F.bit_count(F.col("p0").bitwiseXOR(F.col("r_p0"))))
    near = F.least("n", "r_n") * 100 >= F.greatest("n", "r_n") * percent
    if deviations is not None:
        near = near & (apart <= odd_limit(F.col("n") + F.col("r_n"), percent, deviations))
    # Two classes outside the largest component meet from either side: one side is enough.
    once = (F.col("r_comp") == F.col("top")) | (F.col("fp") < F.col("r_fp"))
    first = ~F.exists(F.slice(F.arrays_zip(F.col("all").alias("x"), F.col("r_all").alias("y")), F.lit(1), F.col("band")), lambda z: z["x"] == z["y"])
    left = every.where("comp != top").withColumnRenamed("bucket", "l_bucket")
    met = left.join(right, (F.col("l_bucket") == F.col("bucket")) & (F.col("comp") != F.col("r_comp")) & once & near & first)
    return met.select(F.col("fp").alias("x"), F.col("r_fp").alias("y"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    registers: int = 128,
    band: int = 4,
    margin: float = 0.2,
    rounds: int = 2,
    odd_deviations: float | None = 5,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = stored(_sketched(docs, id_col, text_col, k, registers))
    classes = rows.where("n > 0").groupBy("fp").agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("rows"))
    classes = stored(classes)
    # A bucket is a band's number and registers, as one hash: a clash only costs a comparison.
    bands = F.transform(F.sequence(F.lit(0), F.lit(registers // band - 1)), lambda j: F.xxhash64(j, F.substring(F.col("sketch"), j * (2 * band) + 1, F.lit(2 * band))))
    places = classes.select("fp", F.posexplode(bands).alias("band", "bucket"))
    shared = places.groupBy("bucket").count().where("count > 1").select("bucket")
    members = stored(places.join(shared, "bucket").select("bucket", "band", "fp"))
    near = stored(classes.join(members.select("fp").distinct(), "fp").select("fp", "first", "n", "sketch"))
    owner = near.select("fp", F.col("fp").alias("comp"))

    for turn in range(rounds + 1):
        # The first round has one pivot for a group in all its buckets; later ones a fresh one for each bucket.
        order = F.xxhash64("fp") if turn == 0 else F.xxhash64("fp", "bucket", F.lit(turn))
        one = F.struct(order.alias("o"), "fp")
        if turn:
            groups = members.join(owner, "fp").groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"), F.min(one).alias("one"))
        else:
            groups = members.select("bucket", F.col("fp").alias("comp"), F.lit(1).cast("bigint").alias("m"), one.alias("one"))
        largest = F.max(F.struct("m", (-F.col("one.o")).alias("o"), "one", "comp")).alias("most")
        buckets = groups.groupBy("bucket").agg(largest, F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps")
        open_ = groups.join(buckets, "bucket")
        if turn < rounds:
            found = open_.where("comp != most.comp").select(F.col("one.fp").alias("x"), F.col("most.one.fp").alias("y"))
            if turn == 0:  # one partner for each class: of its buckets' pivots the first in order
                pairs = found.groupBy("x").agg(F.min_by("y", F.xxhash64("y")).alias("y"))
            else:
                pairs = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        else:
            still = stored(open_.select("bucket", "comp", "most"))
            met = members.join(still.select("bucket").distinct(), "bucket").select("fp").distinct()
            odd = _odd(docs, stored(near.select("fp", "first").join(met, "fp")), id_col, text_col, k)
            pairs = _across(still, members, owner, near.join(odd, "fp"), bands, percent, odd_deviations)
        probable = stored(_probable(pairs, near, percent, margin))
        links = stored(_links(docs, probable, id_col, text_col, k, percent))
        to_a, to_b = owner.select(F.col("fp").alias("a"), F.col("comp").alias("ca")), owner.select(F.col("fp").alias("b"), F.col("comp").alias("cb"))
        root = components(links.join(to_a, "a").join(to_b, "b"), "ca", "cb")
        before, owner = owner, stored(owner.join(root.withColumnRenamed("node", "comp"), "comp", "left").select("fp", F.coalesce("root", "comp").alias("comp")))
        discard(probable, links, *([before] if turn else []))
    discard(members, near)

    named = classes.select("fp", "first").join(owner, "fp")
    names = named.groupBy("comp").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("size")).where("size > 1")
    joined = named.join(names, "comp").select("fp", "component")
    copies = classes.where("rows > 1").select("fp", "first")
    answer = copies.join(joined, "fp", "full_outer").select("fp", F.coalesce("component", "first").alias("component"))
    own = rows.drop("sketch").join(answer, "fp", "left")
    component = F.coalesce("component", "id")
    return own.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
