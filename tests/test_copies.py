"""Queries over tables that are repeated with other keys, so that many rows stand at one time: the SQL's rows, made without pairs."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorline.operators import assign
from anchorline.operators.joins import Lookup, nearest_lookups
from anchorline.operators.scans import first_close, hits_apart
from anchorline.plans import ORACLE_SQL, QUERIES

DATA, COPIES = "/root/testdata/sf0.001", 5
NEAREST = ("q_audibility", "q_end_choice", "q_audibility_typed", "q_gate_bands", "q_snap_v1", "q_visual_attach", "q_near_cut_time")
SCANS = ("q_near_duplicate", "q_split_cues", "q_split_impacts", "q_merge_near", "q_snap_types", "q_verify_pipeline")


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """The folder with the copies, and a connection to them."""
    folder, con = tmp_path_factory.mktemp("copies"), duckdb.connect()
    for name, key in (("events", "event_id"), ("part", "p_partkey")):
        source = f"'{DATA}/{name}.parquet'"
        con.execute(f"COPY (SELECT t.* REPLACE ({key} + (SELECT count(*) FROM {source}) * i AS {key}) FROM {source} t, range({COPIES}) r(i)) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


def same_rows(df, name, con):
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, df.select(*columns).collect()), key=key) == sorted(want, key=key)


def pairs_by_time(df):
    """Joins of the plan that compare times."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if re.search(r"Join.*abs\(", x)]


@pytest.mark.parametrize("name", NEAREST)
def test_nearest_without_pairs(spark, copies, name):
    folder, con = copies
    df = QUERIES[name](spark, folder)
    assert not pairs_by_time(df)
    same_rows(df, name, con)


def test_nearest_lookups_against_all_pairs(spark):
    """Ties, edges of pieces, null times and keys: the same as the least of all pairs."""
    left = spark.range(600).select("id", F.when(F.col("id") % 50 != 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("k"), F.when(F.col("id") % 41 != 0, F.pmod(F.xxhash64("id"), F.lit(900))).alias("t"), (F.col("id") % 2 == 0).alias("even"))
    right = spark.range(500).select(F.col("id").alias("r"), F.when(F.col("id") % 60 != 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("k"), F.when(F.col("id") % 37 != 0, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(900))).alias("u"), (F.col("id") % 5).alias("kind"))
    got = nearest_lookups(left, right, ["k"], "u", ["r"], [Lookup("t", 9, {"a": "r"}), Lookup("t", 4, {"b": "r"}, among=F.col("kind") == 1, when=F.col("even"))]).collect()
    rows = right.collect()

    def best(x, tol, ok):
        near = [(abs(y.u - x.t), y.r) for y in rows if None not in (x.k, x.t, y.k, y.u) and y.k == x.k and abs(y.u - x.t) <= tol and ok(y)]
        return min(near)[1] if near else None

    assert len(got) == 600
    for x in got:
        assert x.a == best(x, 9, lambda y: True) and x.b == (best(x, 4, lambda y: y.kind == 1) if x.even else None), x


@pytest.mark.parametrize("name", SCANS)
def test_scans_without_arrays(spark, copies, name):
    """A timeline is never one array, and spans and hits make no pairs."""
    folder, con = copies
    df = QUERIES[name](spark, folder)
    assert "collect_list" not in df._jdf.queryExecution().executedPlan().toString() and not pairs_by_time(df)
    same_rows(df, name, con)


def test_hits_apart_and_first_close(spark):
    """One clip of 100,000 rows within one tolerance: every span takes the hits in its reach, every row meets the first kept one."""
    spans = spark.createDataFrame([("a", 1, 5, 100), ("a", 2, 0, 9), ("a", 3, 200, 300), ("b", 4, 0, 50), ("a", 5, 60, 60)], "clip string, id long, lo long, hi long")
    hits = spark.createDataFrame([("a", t) for t in (3, 5, 5, 14, 15, 60, 60, 65, 100)] + [("b", 51), (None, 7)], "clip string, t long")
    got = {r.id: r.times for r in hits_apart(spans, hits, 10).collect()}
    assert got == {1: [5, 15, 60, 100], 2: [3], 5: [60]}
    rows = spark.range(100_000).select(F.lit("a").alias("k"), (F.col("id") % 1000).alias("t"), F.col("id").alias("n"), F.array(F.lit("w"), F.concat(F.lit("x"), (F.col("id") % 1000).cast("string"))).alias("w"))
    out = first_close(rows, ["k"], "t", "n", "w", 10**6, 0.6)
    assert out.where("merged_into IS NULL").count() == 1000 and out.where("merged_into != n % 1000").count() == 0


CROWDED = ("q_action_positions", "q_build_anchors", "q_parse_cues")


@pytest.mark.parametrize("name", CROWDED)
def test_more_than_999_in_a_day_or_hour(spark, tmp_path, name):
    """4,000 events in one day, or as purchases in one hour, so that numbers have four digits."""
    con, step = duckdb.connect(), 1_000_003 if name == "q_parse_cues" else 80_000_003
    con.execute(f"""COPY (SELECT event_id + 1000 * i AS event_id, TIMESTAMP '2024-01-01 01:00:00' + to_microseconds(event_id * {step} + i * {step} // 4) AS ts, user_id,
      CASE WHEN '{name}' = 'q_parse_cues' THEN 'purchase' ELSE event_type END AS event_type, value, props FROM '{DATA}/events.parquet', range(4) r(i)) TO '{tmp_path}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    same_rows(df, name, con)
    numbered = {"q_action_positions": F.max("last_pos"), "q_build_anchors": F.count("id"), "q_parse_cues": F.max("position")}
    assert df.agg(numbered[name]).first()[0] > 1000


def test_matching_in_order_against_whole_matrices(monkeypatch):
    """Number and total cost of the best assignment, also where choices are made again; few rows, ties, weights of both signs."""
    rng = np.random.default_rng(5)
    for k in range(300):
        monkeypatch.setattr(assign, "STEPS", 16_000_000 if k % 2 else 7)
        n, m, reach, share = int(rng.integers(0, 12)), int(rng.integers(0, 12)), int(rng.integers(0, 9)), (1.0, 0.01)[k % 2]
        left, right = np.sort(rng.integers(0, 30, n)).astype(float), np.sort(rng.integers(0, 30, m)).astype(float)
        weight = rng.random(m) - 0.5 if k % 3 else np.zeros(m)
        to = assign.match_in_order(left, right, weight, reach, share)
        apart = np.abs(left[:, None] - right[None, :])
        whole = np.hstack([np.where(apart <= reach, share * apart + weight[None, :], 1e6), np.full((n, n), 1e5)])
        best = [c for c in (whole[i, j] for i, j in enumerate(assign.solve(whole))) if c < 1e4] if n else []
        found = [whole[i, j] for i, j in enumerate(to) if j >= 0]
        assert len(set(to[to >= 0])) == len(found) == len(best) and abs(sum(found) - sum(best)) < 1e-6, (k, n, m)


MATCHED = ("q_match_collar", "q_eval_clips", "q_assign_exclusive", "q_snap_assigned")


@pytest.mark.parametrize("name", MATCHED)
def test_matching_moves_rows_not_pairs(spark, copies, name):
    df = QUERIES[name](spark, copies[0])
    assert not pairs_by_time(df) and df.count() > 0


def test_matching_near_against_whole_matrices():
    """Number and total cost of the best assignment with costs by pair; ties, rows that are left out."""
    rng = np.random.default_rng(6)
    for k in range(300):
        n, m = int(rng.integers(1, 12)), int(rng.integers(1, 9))
        lo = np.sort(rng.integers(0, m + 1, n))
        hi = np.maximum.accumulate(np.minimum(lo + rng.integers(0, 5, n), m))
        cost = rng.integers(0, 4, (n, m)) / 4 if k % 2 else rng.random((n, m))
        to = assign.match_near(lo, hi, lambda i: cost[i, lo[i] : hi[i]], m, 1e4)
        reach = (np.arange(m) >= lo[:, None]) & (np.arange(m) < hi[:, None])
        whole = np.hstack([np.where(reach, cost, 1e6), np.full((n, n), 1e5)])
        best = [c for c in (whole[i, j] for i, j in enumerate(assign.solve(whole))) if c < 1e4]
        found = [whole[i, j] for i, j in enumerate(to) if j >= 0]
        assert len(set(to[to >= 0])) == len(found) == len(best) and abs(sum(found) - sum(best)) < 1e-6, k
