import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anchorline.functions.numeric import half_even
from anchorline.functions.text import last_error_line, map_label, overlap, rate, tokens
from anchorline.operators.assign import assign_within, solve
from anchorline.operators.folds import clusters, keep_first_gap
from anchorline.operators.joins import none_within, range_join
from anchorline.operators.tables import merge_ledger, replace_scope, split_lists, upsert_latest, write_split_lists
from anchorline.sources.files import _objects, _repair, audacity_lines, pending_links, read_audacity, read_link_sheet


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(0, 2), st.integers(0, 10_000))
def test_solve_is_optimal(n, more, seed):
    cost = np.random.default_rng(seed).integers(0, 9, (n, n + more)).astype(float)
    best = min(sum(cost[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(n + more), n))
    chosen = solve(cost)
    assert len(set(chosen.tolist())) == n
    assert cost[np.arange(n), chosen].sum() == best


def test_assign_uses_each_once(spark):
    edges = spark.createDataFrame([("c", i, j, float(abs(i - j))) for i in range(5) for j in range(3)], "clip string, left long, right long, cost double")
    rows = assign_within(edges, "clip").collect()
    assert len(rows) == 3 and len({r.left for r in rows}) == 3 == len({r.right for r in rows})
    assert sum(r.cost for r in rows) == 0


def test_assign_of_a_long_timeline(spark):
    """Sparse edges of one timeline, cut where none passes: as many pairs and the same cost as by the whole matrix, of any size of cost."""
    rng = np.random.default_rng(4)
    a, b = (np.sort(rng.integers(0, 6000, 70)) for _ in range(2))
    rows = [("c", i, j, float(abs(x - y)) * 1e5, int(x), int(y)) for i, x in enumerate(a) for j, y in enumerate(b) if abs(x - y) <= 60]
    edges = spark.createDataFrame(rows, "clip string, left long, right long, cost double, x long, y long")
    out = assign_within(edges, "clip", ("x", "y")).collect()
    grid = np.full((70, 70), 1e10)
    for _, i, j, cost, *_ in rows:
        grid[i, j] = cost
    want = grid[np.arange(70), solve(grid)]
    assert len(out) == (want < 1e10).sum() == len({r.left for r in out}) == len({r.right for r in out})
    assert abs(sum(r.cost for r in out) - want[want < 1e10].sum()) < 1
    far = spark.range(30_000).selectExpr("'c' AS clip", "id AS left", "id AS right", "1.0D AS cost", "10 * id AS x", "10 * id + 1 AS y")
    assert assign_within(far, "clip").count() == 30_000


def test_folds_of_a_long_timeline(spark):
    """A timeline is folded in pieces between gaps, with the numbers of the whole."""
    df = spark.range(40_000).selectExpr("'c' AS clip", "id AS seq", "(id DIV 4) * 100 + id % 4 AS t", "id % 3 AS rank")
    out = clusters(df, ["clip"], "t", "seq", "rank", 10)
    assert "__piece" in out._jdf.queryExecution().toString()
    assert out.where("cluster != seq DIV 4 + 1").count() == 0 and out.count() == 40_000
    assert keep_first_gap(df, ["clip"], "t", "seq", 10).selectExpr("count(*)", "sum(seq % 4)").first()[:] == (10_000, 0)


def test_range_join_equals_nested_loop(spark):
    rng = np.random.default_rng(3)
    a = [("x" if i % 2 else "y", i, int(t)) for i, t in enumerate(rng.integers(-500, 500, 60))]
    b = [("x" if i % 2 else "y", i, int(t)) for i, t in enumerate(rng.integers(-500, 500, 60))]
    left, right = spark.createDataFrame(a, "k string, i long, t long"), spark.createDataFrame(b, "k string, j long, u long")
    want = {(i, j) for k, i, t in a for m, j, u in b if k == m and abs(t - u) <= 40}
    assert {(r.i, r.j) for r in range_join(left, right, ["k"], "t", "u", 40).collect()} == want
    assert {r.i for r in none_within(left, right, ["k"], "t", "u", 40).collect()} == {i for _, i, _ in a} - {i for i, _ in want}


def test_expressions(spark):
    row = spark.range(1).select(
        half_even(F.lit(2.5)).alias("even"), rate(F.lit("30000/1001")).alias("r"), rate(F.lit("0/0")).alias("none"), rate(F.lit("N/A")).alias("na"),
        tokens(F.lit("The closing doors, and close knocks on glasses")).alias("t"), overlap(F.array(F.lit("a")), F.array().cast("array<string>")).alias("zero"),
        map_label(F.lit("Male speech, car"))[0].alias("kind"), map_label(F.lit("Nothing known"))[1].alias("group"), last_error_line(F.lit("a\nERROR: ERROR: gone")).alias("e"),
    ).first()
    assert row.even == 2 and abs(row.r - 29.97002997) < 1e-6 and row.none is None and row.na is None
    assert row.t == ["clos", "door", "knock", "glass"]
    assert row.zero == 0 and row.kind == "DIALOGUE" and row.group == "noise_burst" and row.e == "video is not downloadable: gone"


def test_tables(spark):
    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k long, v long, s string")
    new = spark.createDataFrame([(2, 5, "c"), (2, 7, "d"), (3, 1, "e")], "k long, v long, s string")
    assert {tuple(r) for r in upsert_latest(old, new, ["k"], "v").collect()} == {(1, 10, "a"), (2, 7, "d"), (3, 1, "e")}
    assert {tuple(r) for r in replace_scope(old, new.where("k = 2"), ["k"], F.col("s") == "b").collect()} == {(1, 10, "a"), (2, 5, "c"), (2, 7, "d")}
    ledger = spark.createDataFrame([("x", 0, 5, "completed"), ("y", 0, 5, "completed")], "clip string, a long, b long, status string")
    clips = spark.createDataFrame([("x", 0, 5), ("z", 0, 5), ("y", 1, 5)], "clip string, a long, b long")
    assert {tuple(r)[0]: r.status for r in merge_ledger(ledger, clips, ["clip"], ["a", "b"]).collect()} == {"x": "completed", "y": "pending", "z": "pending"}


def test_split_lists_are_rows(spark, tmp_path):
    """No row holds the ids of a whole split; written lists are sorted and complete."""
    ids = spark.range(500).selectExpr("CAST(id % 250 AS STRING) AS id").unionByName(spark.createDataFrame([(None,)], "id string"))
    rows = split_lists(ids, "id")
    assert rows.columns == ["split", "id"] and rows.count() == 250
    write_split_lists(rows, str(tmp_path / "lists"))
    back = spark.read.parquet(str(tmp_path / "lists"))
    assert {(r.split, r.id) for r in back.select("split", F.col("id").cast("string").alias("id")).collect()} == {tuple(r) for r in rows.collect()}


def test_json_texts():
    assert _objects('{"a": 1}{"b": [2]} junk {oops {"c": "}"}') == ['{"a": 1}', '{"b": [2]}', '{"c": "}"}']
    assert _objects(None) == [] and _objects("[1]") == []
    assert _repair('```json\n{"a": 1, "b": [1, 2]}\n```') == '{"a": 1, "b": [1, 2]}'
    assert _repair('{"a": {"b": "cut of') == '{"a": {"b": "cut of"}}'
    assert _repair('{"a": 1,') == '{"a": 1}' and _repair('{"a":') == '{"a": null}' and _repair("none") is None


def test_files(spark, tmp_path):
    sheet = tmp_path / "links.csv"
    sheet.write_text("youtube_url,status,extract_status\nu1,Done,extracted\nu2,,\n,done,\n")
    links = read_link_sheet(spark, str(sheet))
    assert "processing_level" in links.columns and [r.youtube_url for r in pending_links(links).collect()] == ["u2"]
    track = tmp_path / "labels.txt"
    track.write_text("# note\n0.5\t1.25\tGOLD|door slam\n1 2 ANCHOR|x\n\n3.0 4.0 a b\n5\n")
    assert {tuple(r) for r in read_audacity(spark, str(track)).collect()} == {(500.0, 1250.0, "door slam"), (3000.0, 4000.0, "a b")}
    lines = audacity_lines(spark.createDataFrame([(500, 510, "a\tb")], "s long, e long, l string"), "s", "e", "l").collect()
    assert lines[0].value == "0.500000\t0.550000\ta b"


def test_text_functions_follow_their_examples(spark):
    from anchorline.functions.text import PROPOSAL_STOPWORDS, STOPWORDS, VERIFY_STOPWORDS, fill, last_error_line, threshold_of, tokens, video_id

    assert set(VERIFY_STOPWORDS) - set(STOPWORDS) == {"not"} and set(PROPOSAL_STOPWORDS) - set(VERIFY_STOPWORDS) == {"none"}
    said = [("a\nERROR: gone\n", "video is not downloadable: gone"), ("Video is not downloadable: ERROR: x", "video is not downloadable: x"), ("plain", "video is not downloadable: plain"), ("y" * 400, "video is not downloadable: " + "y" * 300)]
    df = spark.createDataFrame(said, "text string, want string")
    assert all(r.got == r.want for r in df.select("want", last_error_line(F.col("text")).alias("got")).collect())
    urls = {"https://www.youtube.com/watch?a=1&v=abc_DEF-123#x": "abc_DEF-123", "https://youtu.be/abcdefghijk?t=1": "abcdefghijk", "https://youtube.com/shorts/abcdefgh": "abcdefgh", "https://youtube.com/watch?v=": None, "https://youtube.com/watch/abcdefgh": None, "https://vimeo.com/abcdefgh": None, "https://youtu.be/abc": None}
    df = spark.createDataFrame(list(urls.items()), "url string, want string")
    assert all(r.got == r.want for r in df.select("want", video_id(F.col("url")).alias("got")).collect())
    row = spark.createDataFrame([("none of the bells", None)], "a string, b string").select(tokens(F.col("a")).alias("x"), tokens(F.col("a"), PROPOSAL_STOPWORDS).alias("y"), fill("{a}: {{{b}}}", {"a": F.col("a"), "b": F.col("b")}).alias("z"), threshold_of(F.lit("Glass"), {"Glass": 0.9}).alias("t"), threshold_of(F.lit("?")).alias("u")).first()
    assert row.x == ["none", "bell"] and row.y == ["bell"] and row.z == "none of the bells: {}" and row.t == 0.9 and row.u is None


def test_json_sources(spark, tmp_path):
    import json

    from anchorline.sources import files

    for v, names in (("a", ("video_metadata", "processing_status")), ("b", ("video_metadata", "processing_status"))):
        (tmp_path / "clips" / v).mkdir(parents=True)
        for n in names:
            (tmp_path / "clips" / v / f"{n}.json").write_text(json.dumps({"n": 1, "state": v}))
    got = files.read_clip_tables(spark, str(tmp_path / "clips"), "n int, state string", "state string").collect()
    assert sorted((r.directory, r.meta.n, r.status.state) for r in got) == [("a", 1, "a"), ("b", 1, "b")]
    (tmp_path / "clips" / "c").mkdir()
    (tmp_path / "clips" / "c" / "video_metadata.json").write_text("{}")
    with pytest.raises(Exception, match="missing c/processing_status.json"):
        files.read_clip_tables(spark, str(tmp_path / "clips"), "n int, state string", "state string").collect()
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "x.json").write_text(json.dumps({"clip_id": "v/clip_1", "n": 1}, indent=1))
    (tmp_path / "gold" / "y.json").write_text(json.dumps({"n": 2}))
    gold = {r.alias: (r.clip_id, r.n) for r in files.read_gold(spark, str(tmp_path / "gold"), "clip_id string, n int").collect()}
    assert gold == {"v/clip_1": ("v/clip_1", 1), "clip_1": ("v/clip_1", 1), "v_clip_1": ("v/clip_1", 1), "y": ("y", 2)}
    log = tmp_path / "run.log"
    log.write_text('#LOG\n\n# note\n{"event": "a", "n": 1}\n  {"event": "b"}\n')
    assert sorted((r.event.event, r.event.n) for r in files.read_event_log(spark, str(log), "#LOG", "event string, n int").collect()) == [("a", 1), ("b", None)]
    with pytest.raises(ValueError, match="not an event log"):
        files.read_event_log(spark, str(log), "#OTHER", "event string")
    sheet = str(tmp_path / "links")
    files.create_link_sheet(spark, sheet)
    files.create_link_sheet(spark, sheet)
    assert tuple(files.read_link_sheet(spark, sheet).columns) == files.LINK_COLUMNS
    rows = spark.createDataFrame([("u1", " Processed", "DONE"), ("u2", "extracted", "done"), ("u3", "done", "processed"), ("", "", "")], "youtube_url string, status string, extract_status string")
    assert {r.youtube_url for r in files.pending_links(rows).collect()} == {"u2", "u3"} and files.pending_links(rows, force=True).count() == 3


def test_dense_timeline_folds(spark):
    """A piece of many rows without gaps, against a loop."""
    n = 20_000
    rows = [(i * 3 + i * 7 % 5, i, float(i * 31 % 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "t long, seq long, rank double").withColumn("clip", F.lit("c"))
    kept, last = 0, None
    for t, _, _ in sorted(rows):
        if last is None or t - last >= 40:
            kept, last = kept + 1, t
    assert keep_first_gap(df, ["clip"], "t", "seq", 40).count() == kept
