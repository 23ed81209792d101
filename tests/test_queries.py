"""Every query of the catalogue against its SQL on the smallest tables; the others for rows and schema."""

import os

import duckdb
import pytest

from anchorline.plans import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def _rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = _rows(df.select(*columns).collect())
    if name not in ORACLE_SQL:
        assert got
        return
    want = tables.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert got == _rows(want)


def test_no_cross_products(spark):
    """Range joins stay equi-joins on buckets."""
    for name in ("q_audibility", "q_near_cut_time", "q_residual_anti", "q_visual_attach", "q_gate_bands", "q_split_cues"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_verify_pipeline_loses_nothing(spark):
    """Every cue, and every hit split from one, comes out once, kept or in a rejected stream; kept ids are distinct in a clip."""
    out = QUERIES["q_verify_pipeline"](spark, DATA).collect()
    proposed = QUERIES["q_merge_near"](spark, DATA).select("clip", "number", "row").collect()
    purchases = {r.event_id for r in spark.read.parquet(f"{DATA}/events.parquet").where("event_type = 'purchase'").collect()}
    assert sorted((r.clip, r.number) for r in out) == sorted((r.clip, r.number) for r in proposed)
    assert {r.row for r in proposed} == purchases
    assert {r.stream for r in out} <= {"kept", "merged", "not_audible", "judge"}
    kept = [(r.clip, r.cue_id) for r in out if r.stream == "kept"]
    assert len(kept) == len(set(kept))
