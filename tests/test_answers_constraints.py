import json
from collections import defaultdict

from anchorline.operators import answers, constraints


def parsed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, answer string")
    return [r.asDict() for r in answers.parse_cues(df, ["id"], "answer").orderBy("id", "position").collect()]


def test_answers_of_all_shapes(spark):
    cue = {"audio_class": "bang"}
    texts = [
        {"cues": [cue]}, {"cues": [], "audio_cues": [cue, cue]}, [cue], {"cues": "none", "audio_cues": [cue]}, {"cues": None, "audio_cues": [cue]},
        {"cues": 0, "audio_cues": [cue]}, {"results": [cue]}, "text", 7, None, {"cues": {"a": 1}},
    ]
    got = parsed(spark, *map(json.dumps, texts), '{"cues": [', None, "")
    assert [(r["id"], r["cue_id"]) for r in got] == [(0, "cue_001"), (1, "cue_001"), (1, "cue_002"), (2, "cue_001"), (4, "cue_001"), (5, "cue_001")]


def test_elements(spark):
    t = [
        7, None, "x", ["audio_class"], {}, {"audio_class": " None "}, {"audio_class": "a", "start_time_ms": "soon"}, {"audio_class": "a", "start_time_ms": [1]},
        {"audio_class": " b ", "start_time_ms": "1000.5", "duration_ms": "x", "audio_type": "music", "event_type": "boom", "alignment_relation": "reactive"},
        {"audio_class": 5, "start_time_ms": False, "duration_ms": 3, "end_time_ms": [], "cue_trigger": "  "},
        {"cue_id": "own", "audio_class": "c", "start_time_ms": 10, "duration_ms": 700, "end_time_ms": "5", "impact_times_ms": [11.5, "12", True]},
        {"cue_id": 0, "audio_class": "d", "start_time_ms": 10, "end_time_ms": 11.5, "impact_times_ms": [1, None], "audio_type": "noise", "transcript": "so", "anchor_id": 4},
        {"audio_class": "e", "start_time_ms": 2.5, "duration_ms": 0, "end_time_ms": "", "impact_times_ms": "no", "visual_evidence": " v "},
        {"audio_class": "f", "start_time_ms": 1e300},
    ]
    got = {r["position"]: r for r in parsed(spark, json.dumps(t))}
    assert sorted(got) == [9, 10, 11, 12, 13]
    pick = lambda i, *names: tuple(got[i][n] for n in names)
    span = ("cue_id", "start_time_ms", "duration_ms", "end_time_ms")
    assert pick(9, *span, "audio_type", "event_type", "alignment_relation", "audio_class", "cue_trigger") == ("cue_009", 1000, 500, 1500, "MUSIC", "EVENT", "REACTIVE", "b", "b")
    assert pick(10, *span, "audio_class", "audio_type", "cue_trigger") == ("cue_010", 0, 50, 50, "5", "SFX", "5")
    assert pick(11, *span, "impact_times_ms") == ("own", 10, 700, 710, [12, 12, 1])
    assert pick(12, *span, "impact_times_ms", "audio_type", "transcript", "anchor_id") == ("cue_012", 10, 2, 12, [], "SFX", "so", "4")
    assert pick(13, *span, "impact_times_ms", "visual_evidence", "transcript") == ("cue_013", 2, 500, 502, [], "v", None)


GOOD = {
    "clip": "a", "source_video": "v", "source_start_ms": 1000, "source_end_ms": 6100, "clip_ms": 5000, "least_artifact_bytes": 9, "token_width": 768, "hidden_dimension": 768, "token_rows": 2,
    **dict.fromkeys(constraints.EXPLANATION_FIELDS, "said"), "video_type": "CHASE", "explanation_received_audio": True, "artifact_annotation_type": "pseudo_ground_truth", "artifact_source": "gemini",
    "artifact_received_audio": True, "provenance_source": "asr", "provenance_annotation_type": "pseudo_ground_truth", "human_verified": False,
}
CUE = dict.fromkeys(constraints.CUE_FIELDS, "x") | {"clip": "a", "start_time_ms": 10, "duration_ms": 90, "end_time_ms": 100, "source": "gemini", "annotation_type": "pseudo_ground_truth", "temporal_annotation_type": None, "temporal_source": None, "clip_ms": 5000}
TIMES = [{"clip": "a", "start_ms": 0, "end_ms": 4000, "clip_ms": 5000}, {"clip": "a", "start_ms": 4000, "end_ms": 5000, "clip_ms": 5000}]
INDEX = [{"clip": "a", "processing_level": None, "record_level": "low"}]


def failed(spark, record=None, cues=(CUE,), artifact=(CUE,), times=TIMES, index=INDEX):
    return failed_of(spark, [GOOD | (record or {})], cues, artifact, times, index)["a"]


def failed_of(spark, records, cues, artifact, times, index):
    types = {"boolean": ("explanation_received_audio", "artifact_received_audio", "human_verified"), "long": ("source_start_ms", "source_end_ms", "clip_ms", "least_artifact_bytes", "token_width", "hidden_dimension", "token_rows", "start_time_ms", "duration_ms", "end_time_ms", "start_ms", "end_ms")}
    kind = lambda c: next((t for t, names in types.items() if c in names), "string")

    def frame(rows, like):
        return spark.createDataFrame([tuple(r[c] for c in like) for r in rows], ", ".join(f"{c} {kind(c)}" for c in like))

    children = {"cues": frame(cues, CUE), "artifact_cues": frame(artifact, CUE), "times": frame(times, TIMES[0]), "index": frame(index, INDEX[0])}
    found = defaultdict(set)
    for r in constraints.violations(frame(records, GOOD), ["clip"], constraints.record_checks(), children).collect():
        found[r.clip].add(r.problem)
    return found


def test_a_good_record_has_no_violations(spark):
    assert failed(spark) == set()
    assert failed(spark, cues=(CUE, CUE | {"cue_id": "y"}), artifact=(CUE | {"cue_id": "y"}, CUE)) == set()


RECORD_FAULTS = [
    ({"source_video": None}, "source_video"), ({"source_end_ms": 6301}, "source_interval"), ({"source_end_ms": None}, "source_interval"), ({"least_artifact_bytes": 0}, "artifact_missing"), ({"token_width": 512}, "token_dimension"),
    ({"scene_gravity": " "}, "explanation"), ({"video_content": None}, "explanation"), ({"video_type": "OPERA"}, "video_type"), ({"explanation_received_audio": None}, "explanation_audio"),
    ({"artifact_annotation_type": "gold"}, "artifact_annotation"), ({"artifact_source": "x"}, "artifact_source"), ({"artifact_received_audio": False}, "artifact_audio"), ({"provenance_source": "me"}, "provenance"),
    ({"human_verified": True}, "human_verified"), ({"human_verified": None}, "human_verified"), ({"token_rows": 3}, "token_rows"),
]
CUE_FAULTS = [
    {"audio_class": None}, {"start_time_ms": -1, "end_time_ms": 89}, {"duration_ms": 0, "end_time_ms": 10}, {"end_time_ms": 99}, {"duration_ms": 5000, "end_time_ms": 5010},
    {"source": "x"}, {"annotation_type": "gold"}, {"temporal_annotation_type": "gold"}, {"temporal_source": "x"},
]


def test_each_record_and_cue_check(spark):
    """Every fault gives its own violation and no other; all records are checked at once."""
    n = len(RECORD_FAULTS)
    records = [GOOD | change | {"clip": f"r{i}"} for i, (change, _) in enumerate(RECORD_FAULTS)] + [GOOD | {"clip": f"c{i}"} for i in range(len(CUE_FAULTS))]
    both = [CUE | {"clip": r["clip"]} for r in records]
    both += [CUE | change | {"clip": f"c{i}"} for i, change in enumerate(CUE_FAULTS)]
    got = failed_of(spark, records, both, both, [t | {"clip": r["clip"]} for r in records for t in TIMES], [INDEX[0] | {"clip": r["clip"]} for r in records])
    assert [got[f"r{i}"] for i in range(n)] == [{check} for _, check in RECORD_FAULTS]
    assert [got[f"c{i}"] for i in range(len(CUE_FAULTS))] == [{"cues", "artifact_cues"}] * len(CUE_FAULTS)


def test_children_checks(spark):
    assert failed(spark, times=[TIMES[0], TIMES[1] | {"end_ms": 5001}]) == {"token_times"}
    assert failed(spark, times=[TIMES[0], TIMES[1] | {"start_ms": 5000}]) == {"token_times"}
    assert failed(spark, times=TIMES[:1]) == {"token_rows"} and failed(spark, times=[]) == {"token_rows"}
    assert "cues_disagree" in failed(spark, artifact=(CUE, CUE))
    assert failed(spark, index=[]) == {"index"} and failed(spark, index=[INDEX[0] | {"processing_level": "high"}]) == {"index"}
