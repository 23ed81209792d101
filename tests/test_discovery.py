import json

import pytest
from pyspark.errors import PySparkException

from anchorline.sources.discovery import METADATA, STATUS, ClipFolderReader, discover


@pytest.fixture
def folder(tmp_path):
    def add(video, clips, status=True):
        d = tmp_path / video
        d.mkdir()
        (d / METADATA).write_text(clips if isinstance(clips, str) else json.dumps({"clips": clips}))
        if status:
            (d / STATUS).write_text(json.dumps({"of": video}))

    add("v2", [{"clip_id": "a", "start": 1}, {"clip_id": 7}, {}, "odd"])
    add("v1", [{"clip_id": "a"}])
    add("no_status", [{"clip_id": "a"}], status=False)
    add("broken", "{")
    add("empty", [])
    (tmp_path / "file.json").write_text("{}")
    return tmp_path


def ids(df):
    return sorted((r.video_id, r.clip_id or "") for r in df.collect())


def test_directories_and_filters(spark, folder):
    assert ids(discover(spark, str(folder))) == [("v1", "a"), ("v2", ""), ("v2", ""), ("v2", "7"), ("v2", "a")]
    assert ids(discover(spark, f"file://{folder}", clip="a")) == [("v1", "a"), ("v2", "a")]
    assert ids(discover(spark, str(folder), video="v2", clip="7")) == [("v2", "7")]
    assert ids(discover(spark, str(folder), video="gone")) == []
    row = discover(spark, str(folder), video="v2", clip="a").first()
    assert json.loads(row.clip) == {"clip_id": "a", "start": 1} and json.loads(row.status) == {"of": "v2"} and row.directory.endswith("/v2")


def test_other_videos_are_not_read(spark, folder):
    """A video filter prunes partitions: a directory that would fail is not opened."""
    (folder / "v9").mkdir()
    (folder / "v9" / METADATA).write_text('{"clips": {}}')
    (folder / "v9" / STATUS).write_text("{}")
    with pytest.raises(PySparkException, match="clips is no list"):
        discover(spark, str(folder)).collect()
    one = discover(spark, str(folder), video="v1")
    assert ids(one) == [("v1", "a")] and one.rdd.getNumPartitions() == 1
    assert ids(discover(spark, str(folder)).where("video_id IN ('v1', 'v2') AND clip_id = 'a'")) == [("v1", "a"), ("v2", "a")]
    assert discover(spark, str(folder)).where("video_id IN ('v1', 'v2')").rdd.getNumPartitions() == 2


def test_pushed_filters_are_counted(folder):
    from pyspark.sql.datasource import EqualTo, IsNotNull

    reader = ClipFolderReader(str(folder))
    left = list(reader.pushFilters([EqualTo(("video_id",), "v1"), EqualTo(("clip_id",), "a"), IsNotNull(("video_id",))]))
    assert [type(f).__name__ for f in left] == ["EqualTo", "IsNotNull"]
    assert [p.video for p in reader.partitions()] == ["v1"]
    assert len(ClipFolderReader(str(folder)).partitions()) == 5
