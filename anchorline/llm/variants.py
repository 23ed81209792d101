"""Spelling variants: words one edit apart, found by an index of variable-length grams.

The gram dictionary holds grams of ``shortest`` code points and one-letter extensions of
every gram that stands in more than a threshold of words, up to ``longest`` code points;
the threshold is the least for which the dictionary keeps its bound. A word is decomposed
into the longest dictionary grams at its places, without those inside an earlier one.

For a replaced, a deleted and an inserted code point each, a word has a bound on how many
of its grams that edit can affect: grams over the place, grams before it that an extension
over the place could swallow, and grams after it that such an extension could swallow from
the left. A word and its near word share all grams but these, at the same place from the
left or from the right. So of each word only the lists of its rarest grams, one more than
its bound, need be merged; a list is the words of one length with one gram at one place.
Where the bound of both words leaves no gram, they meet in a second index by the shortest
grams alone, where at least one is always left. Merged pairs are verified by their edit
distance. Lists are merged by a join, which AQE splits where a list is long, and no pair
leaves it unverified.

Defined cases: null and empty texts have no words; a null id counts as an empty one where
damage is planted; a run's letters are A-Z, a-z and U+00C0 to U+00FF, and only A-Z are
lower-cased; ties of near words go to the smallest in code-point order; repeated rows
count again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import ascii_lower, bound_batches, discard, parts, stored

#: The most grams of a dictionary, which goes to all tasks.
MAX_GRAMS = 200_000
#: Words that share a gram before it is extended; doubled until the dictionary keeps its bound.
LEAST_FREQUENT = 1024


def words_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, damage: int | None = None) -> DataFrame:
    """(word): every occurrence of a lower-cased run of at least so many letters.

    ``damage``: a run loses one code point where this divides the crc32 of ``id:run``.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"([A-Za-zÀ-ÿ]{{{least_length},}})"), F.lit(1))
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    found = docs.select(key.alias("key"), F.explode(runs).alias("run"))
    # Spark's lower() is exact and fast where all letters are ASCII.
    lowered = found.select("key", F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(ascii_lower(F.col("run"))).alias("word"))
    if damage is None:
        return lowered.select("word")
    h = F.crc32(F.concat("key", "word").cast("binary"))
    at = (h % F.char_length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
    return lowered.select(F.when(h % damage == 0, cut).otherwise(F.col("word")).alias("word")).where(F.char_length("word") >= least_length)


def count_words(words: DataFrame, *, least_n: int = 5) -> DataFrame:
    """(word, n): a written table of the words that occur at least ``least_n`` times."""
    return stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n))


@dataclass
class Dictionary:
    """Grams with the number of words that hold them; ``before`` and ``after``: their proper beginnings and ends."""

    shortest: int
    count: dict[str, int]
    before: frozenset[str]
    after: frozenset[str]

    @cached_property
    def longest(self) -> int:
        """The length of the longest gram."""
        return max(map(len, self.before), default=self.shortest - 1) + 1

    @staticmethod
    def of(count: dict[str, int], shortest: int) -> Dictionary:
        longer = [g for g in count if len(g) > shortest]
        before = frozenset(g[:i] for g in longer for i in range(shortest, len(g)))
        after = frozenset(g[i:] for g in longer for i in range(1, len(g) - shortest + 1))
        return Dictionary(shortest, count, before, after)

    def plain(self) -> Dictionary:
        """The same without grams longer than the shortest."""
        return Dictionary(self.shortest, {g: n for g, n in self.count.items() if len(g) == self.shortest}, frozenset(), frozenset())

    def grams(self, word: str) -> list[tuple[int, int]]:
        """(begin, end) of the word's grams."""
        out, q, covered = [], self.shortest, 0
        for p in range(len(word) - q + 1):
            e = p + q
            while e < len(word) and word[p : e + 1] in self.count:
                e += 1
            if e > covered:
                out.append((p, e))
                covered = e
        return out

    def bounds(self, word: str, grams: list[tuple[int, int]]) -> tuple[int, int]:
        """The most grams that one replaced or deleted code point affects, and one inserted."""
        n, q, most = len(word), self.shortest, self.longest - 1
        if most < q:
            return min(q, len(grams)), min(q - 1, len(grams))
        # From which place on grams that end before i can be swallowed, and up to which end those that begin at i or later can.
        left = [next((p for p in range(max(0, i - most), i - q + 1) if word[p:i] in self.before), i) for i in range(n + 1)]
        right = [next((e for e in range(min(n, i + most), i + q - 1, -1) if word[i:e] in self.after), i) for i in range(n + 1)]

        def affected(lo: int, hi: int) -> int:
            a, b = left[lo], right[hi]
            return sum((p < hi and e > lo) or (e <= lo and p >= a) or (p >= hi and e <= b) for p, e in grams)

        return max(affected(i, i + 1) for i in range(n)), max(affected(i, i) for i in range(n + 1))

    def rarest(self, word: str, grams: list[tuple[int, int]]) -> list[tuple[int, str]]:
        """(begin, gram), those of fewest words first."""
        named = [(self.count.get(word[p:e], 0), word[p:e], p) for p, e in grams]
        return [(p, g) for _, g, p in sorted(named)]


def build_dictionary(vocabulary: DataFrame, *, shortest: int, longest: int, max_grams: int = MAX_GRAMS, least_frequent: int = LEAST_FREQUENT) -> Dictionary:
    """The gram dictionary of a table with the column ``word``."""
    size = F.char_length("word")
    every = F.flatten(F.transform(F.sequence(F.lit(shortest), F.least(F.lit(longest), size)), lambda q: F.transform(F.sequence(F.lit(1), size - q + 1), lambda i: F.substring(F.col("word"), i, q))))
    counts = stored(vocabulary.where(size >= shortest).select(F.explode(F.array_distinct(every)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    long = F.char_length("gram") > shortest
    parents = counts.select(F.col("gram").alias("parent"), F.col("n").alias("in_words")).where(F.col("in_words") > least_frequent)
    extended = counts.where(long).withColumn("parent", F.substring(F.col("gram"), F.lit(1), F.char_length("gram") - 1)).join(parents, "parent").select("gram", "n", "in_words")
    # A gram of the shortest length is listed only if it is frequent: a gram that isn't listed counts as rare.
    listed = stored(extended.unionByName(counts.where(~long & (F.col("n") > least_frequent)).select("gram", "n", F.col("n").alias("in_words"))))
    ladder = [least_frequent << i for i in range(40)]
    held = listed.agg(*[F.count_if(F.col("in_words") > t).alias(str(t)) for t in ladder]).first()
    threshold = next(t for t in ladder if held[str(t)] <= max_grams)
    count = {r["gram"]: r["n"] for r in listed.where(F.col("in_words") > threshold).select("gram", "n").collect()}
    discard(counts, listed)
    return Dictionary.of(count, shortest)


#: Parts in a list: of words of one length; of the longer word; of the shorter one.
SAME, LONGER, SHORTER = 0, 1, 2


def list_places(word: str, variable: Dictionary, plain: Dictionary) -> Iterator[tuple[int, int, int, int, str]]:
    """(index, part, length, place, gram): the lists in which a word is sought or found."""
    n = len(word)
    weak = [True] * 3
    for index, of in ((0, variable), (1, plain)):
        grams = of.grams(word)
        changed, inserted = of.bounds(word, grams)
        ranked = of.rarest(word, grams)
        for part, bound in ((SAME, changed), (LONGER, changed), (SHORTER, inserted)):
            if weak[part]:
                for p, g in ranked[: bound + 1]:
                    yield index, part, n + (part == SHORTER), p, g
                    if part == SHORTER:
                        yield index, part, n + 1, p + 1, g
            weak[part] = weak[part] and len(grams) <= bound


def near_pairs(vocabulary: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(word, n, other, other_n): near words of a table (word, n), each pair both ways, some of them repeated."""
    spark = vocabulary.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast((dictionary, dictionary.plain()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        variable, plain = shared.value
        for b in batches:
            words = b.column(0).to_pylist()
            rows = [(i, *place) for i, w in enumerate(words) for place in list_places(w, variable, plain)]
            if rows:
                at, *places = (pa.array(c) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(2)), *(c.cast(t) for c, t in zip(places, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True))], ["word", "n", "index", "part", "length", "place", "gram"])

    dealt = vocabulary.select("word", "n").repartition(parts(spark), "word")
    listed = dealt.mapInArrow(run, "word string, n long, index int, part int, length int, place int, gram string")
    # A list's name as one hash: a clash only costs a comparison.
    half = F.floor((F.char_length("word") - (F.col("part") == LONGER).cast("int")) / 2).cast("int")
    ends = [F.hash(F.left("word", half)).alias("head"), F.hash(F.right("word", half)).alias("tail")]
    named = stored(listed.select(F.xxhash64("index", F.col("part") == SAME, "length", "place", "gram").alias("list"), "part", "word", "n", *ends))
    right = named.select(F.col("list").alias("to"), F.col("part").alias("as"), F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("head").alias("other_head"), F.col("tail").alias("other_tail"))
    # One edit leaves the first or the last half of the shorter word as it is, which is quickly seen.
    whole = (F.col("head") == F.col("other_head")) | (F.col("tail") == F.col("other_tail"))
    meet = (F.col("list") == F.col("to")) & whole & (F.levenshtein("word", "other", 1) == 1)
    same = named.where(F.col("part") == SAME).join(right.where(F.col("as") == SAME), meet & (F.col("word") < F.col("other")))
    unlike = named.where(F.col("part") == LONGER).join(right.where(F.col("as") == SHORTER), meet)
    once = same.unionByName(unlike).select("word", "n", "other", "other_n")
    return once.unionAll(once.select("other", "other_n", "word", "n"))


def group_variants(vocabulary: DataFrame, *, shortest: int = 3, longest: int = 5, times: int = 5, max_grams: int = MAX_GRAMS, least_frequent: int = LEAST_FREQUENT) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of a written table (word, n).

    Near words differ by one replaced, deleted or inserted code point. A word's form is its
    near word of largest n, if that is ``times`` the word's n or more; its root is where
    forms end. Words have at least ``2 * shortest`` code points each.
    """
    dictionary = build_dictionary(vocabulary, shortest=shortest, longest=longest, max_grams=max_grams, least_frequent=least_frequent)
    pairs = near_pairs(vocabulary, dictionary)
    # A word has no more near words than its length and the alphabet allow, however large the table.
    near = pairs.groupBy("word").agg(F.collect_set(F.struct((-F.col("other_n")).alias("less"), "other")).alias("near"))
    best = near.select("word", F.size("near").cast("long").alias("n_near"), F.array_min("near").alias("best"))
    every = vocabulary.join(best, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    formed = stored(every.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    # Each round doubles the steps taken; n grows by ``times`` with each step, so there are few.
    to = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        over = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(to.join(over, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        to = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return formed.join(to, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
