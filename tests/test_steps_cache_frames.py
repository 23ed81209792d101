import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorline.operators import cache, frames, steps

LOG = "session string, seq long, kind string, step_id string, title string, elapsed_s double"
ROWS = [
    ("a", 1, "session_start", "x", None, None), ("a", 2, "note", "s1", None, None), ("a", 3, "step_begin", "s1", "One", None), ("a", 4, "step_begin", "s2", None, None), ("a", 5, "note", None, None, None),
    ("a", 6, "step_end", "s1", None, 2.5), ("a", 7, "note", "s1", None, None), ("a", 8, "step_begin", "", "none", None), ("a", 9, "step_end", "s1", None, None), ("a", 10, "step_end", "s9", None, 1.0),
    ("b", 1, "step_begin", "s1", "Other", None), ("b", 2, "step_end", "s1", None, None), ("b", 3, "step_begin", "s1", "again", None),
]


def test_steps(spark):
    log = spark.createDataFrame(ROWS, LOG)
    got = [tuple(r) for r in steps.rollup_steps(log).orderBy("session", "step_no").collect()]
    assert got == [("a", 0, "s1", "One", 3, 4, True, 2.5, 1), ("a", 1, "s2", "s2", 4, 1, False, None, 0), ("b", 0, "s1", "Other", 1, 3, True, None, 0)]
    assert sorted(r.seq for r in steps.loose_events(log).collect()) == [2, 5, 8, 10]
    assert steps.rollup_steps(log.limit(0)).count() == 0


def test_streamed_steps_are_those_of_the_batch(spark, tmp_path):
    """Rows in three batches; the last row of each step is what the batch form gives for all rows."""
    pytest.importorskip("google.protobuf")
    log = spark.createDataFrame(ROWS, LOG)
    for i, (lo, hi) in enumerate(((1, 3), (4, 6), (7, 20))):
        log.where(f"seq BETWEEN {lo} AND {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        changes = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
        out = steps.stream_steps(changes).writeStream.foreachBatch(lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(str(tmp_path / f"out/n={n}"))).option("checkpointLocation", str(tmp_path / "cp")).outputMode("update")
        out.trigger(availableNow=True).start().awaitTermination()
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    names = ["session", "step_id", "title", "begin_seq", "n_events", "ended", "elapsed_s", "loose"]
    last = spark.read.parquet(str(tmp_path / "out")).groupBy("session", "step_id").agg(F.max_by(F.struct(*names[2:]), "batch").alias("x")).select("session", "step_id", "x.*")
    assert sorted(map(str, last.select(*names).collect())) == sorted(map(str, steps.rollup_steps(log).select(*names).collect()))


def test_cached_arrays(spark, tmp_path):
    """A second run computes nothing, a changed knob its own rows only; a kept array of a wrong shape is computed again."""
    path, seen = str(tmp_path / "kept"), []

    def compute(rows):
        seen.append(sorted(((r.sha, r.knob) for r in rows.collect()), key=str))
        return rows.select("sha", "knob", F.array(F.lit(2), F.lit(1)).alias("shape"), F.array(F.col("x").cast("float"), F.col("knob").cast("float")).alias("values"))

    rows = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 5.0), ("b", 1, 6.0), (None, 1, 7.0)], "sha string, knob int, x double")
    first = [tuple(r) for r in cache.cached_arrays(rows, compute, path, ["sha", "knob"]).collect()]
    assert sorted((r[0] or "", r[3]) for r in first) == [("", [7.0, 1.0]), ("a", [5.0, 1.0]), ("b", [6.0, 1.0])]
    assert len(seen[0]) == 3
    cache.cached_arrays(rows, compute, path, ["sha", "knob"]).collect()
    assert len(seen) == 1
    changed = rows.withColumn("knob", F.when(F.col("sha") == "b", 2).otherwise(F.col("knob")))
    cache.cached_arrays(changed, compute, path, ["sha", "knob"]).collect()
    assert seen[1:] == [[("b", 2)]]
    spark.createDataFrame([("c", 1, [3, 2], [1.0])], "sha string, knob int, shape array<int>, values array<float>").write.mode("append").parquet(path)
    got = cache.cached_arrays(spark.createDataFrame([("c", 1, 9.0)], "sha string, knob int, x double"), compute, path, ["sha", "knob"]).collect()
    assert [r[3] for r in got] == [[9.0, 1.0]] and seen[2:] == [[("c", 1)]]
    assert cache.cached_arrays(rows.limit(0), compute, str(tmp_path / "none"), ["sha", "knob"]).count() == 0


@pytest.mark.parametrize(("size", "hop", "least"), [(10, 4, 3), (6, 6, 1), (5, 7, 5)])
def test_sliding_means(spark, size, hop, least):
    values = {("a", i): float(i * i % 7) for i in range(31) if i % 5} | {("b", i): 1.0 for i in range(2)} | {("c", 3): 2.0}
    lengths = {"a": 31, "b": 2, "c": 40}
    rows = spark.createDataFrame([(k, i, v) for (k, i), v in values.items()] + [("a", 1, None)], "k string, i long, v double")
    length = spark.createDataFrame(list(lengths.items()), "k string, frames long")
    got = {(r.k, r.start): (r.n, round(r["mean"], 9)) for r in frames.sliding_means(rows, ["k"], "i", "v", length, size, hop, least).collect()}
    want = {}
    for k, n in lengths.items():
        for start in range(0, n, hop):
            if n - start < least:
                break
            inside = [values[k, i] for i in range(start, start + size) if (k, i) in values]
            want[k, start] = (len(inside), round(float(np.mean(inside)), 9) if inside else 0.0)
    assert got == want


def test_token_intervals_and_overlaps(spark):
    df = spark.createDataFrame([(1, 9500, 25.0), (2, 0, 25.0), (3, 700, 0.1)], "i long, ms long, fps double")
    got = {r.i: r.t for r in df.select("i", frames.token_intervals(F.col("ms"), F.col("fps")).alias("t")).collect()}
    assert got[2] == [] and len(got[1]) == 24 and len(got[3]) == 8
    for ms, tokens in ((9500, got[1]), (700, got[3])):
        assert [t.token_index for t in tokens] == list(range(len(tokens))) and tokens[0].start_ms == 0 and tokens[-1].end_ms == ms
        assert all(a.end_ms == b.start_ms for a, b in zip(tokens, tokens[1:], strict=False))
    samples = np.linspace(0, 3.96, 16)
    assert got[1][0].end_ms == round((samples[1] + samples[2]) / 2 * 1000) and got[1][7].start_ms == round((samples[13] + samples[14]) / 2 * 1000)
    p = spark.createDataFrame([("a", 0.0, i, "x", 1.0) for i in range(10)] + [("a", 5.0, i, "x", 3.0) for i in range(10)] + [("a", 9.8, 0, "x", 99.0), ("a", 0.0, 30, "y", 1.0)], "clip string, start double, i long, class string, p double")
    clips = spark.createDataFrame([("a", 10.0), ("b", 3.0)], "clip string, duration double")
    out = {(r["class"], r.frame): r.p for r in frames.overlap_add(p, "clip", clips, hop=1.0, least_tail=0.25).collect()}
    assert [out["x", i] for i in range(10)] == [1.0] * 5 + [2.0] * 5 and all(out["y", i] == 0 for i in range(10)) and len(out) == 20
