"""Discovery of clips in a folder of videos, as a data source that prunes by video.

``spark.read.format("clip_folders").load(folder)`` gives (video_id, directory, clip_id, clip,
status): one row for each clip of each video directory, ``clip`` and ``status`` as JSON text.
A directory is one partition. Filters on ``video_id`` reach the source, so that documents
of other videos are never opened; filters on clips apply to the rows. A directory that
lacks one of its two documents, or holds a broken one, is left out with a warning; one
whose ``clips`` is no list is an error. Paths may name any file system that Arrow knows.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

LOG = logging.getLogger(__name__)
#: The documents of a video's directory.
METADATA, STATUS = "video_metadata.json", "processing_status.json"
SCHEMA = "video_id string, directory string, clip_id string, clip string, status string"
_BATCH = 1000


class _Directory(InputPartition):
    def __init__(self, path: str, video: str):
        super().__init__(path)
        self.path, self.video = path, video


def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    import pyarrow.fs

    if "://" in folder or folder.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


def _document(fs: pa.fs.FileSystem, path: str) -> dict:
    with fs.open_input_stream(path) as f:
        found = json.loads(f.read().decode())
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no object")
    return found


class ClipFolderReader(DataSourceReader):
    """Lists the directories on the driver, reads each in a task of its own."""

    def __init__(self, folder: str):
        self.folder = folder
        self.videos: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("video_id",):
                self._only({f.value})
            elif isinstance(f, In) and f.attribute == ("video_id",):
                self._only(set(f.value))
            else:
                yield f

    def _only(self, videos: set[str]) -> None:
        self.videos = videos if self.videos is None else self.videos & videos

    def partitions(self) -> list[InputPartition]:
        import pyarrow.fs

        fs, base = _file_system(self.folder)
        found = fs.get_file_info(pyarrow.fs.FileSelector(base))
        names = sorted((x.base_name, x.path) for x in found if x.type == pyarrow.fs.FileType.Directory)
        return [_Directory(path, name) for name, path in names if self.videos is None or name in self.videos] or [_Directory("", "")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _file_system(self.folder)
        try:
            metadata, status = (_document(fs, f"{partition.path}/{name}") for name in (METADATA, STATUS))
        except (OSError, ValueError) as e:
            LOG.warning("left out %s: %s", partition.path, e)
            return
        clips = metadata.get("clips")
        if not isinstance(clips, list):
            raise ValueError(f"clips is no list in {partition.path}/{METADATA}")
        said = json.dumps(status)
        for i in range(0, len(clips), _BATCH):
            some = clips[i : i + _BATCH]
            ids = [None if not isinstance(c, dict) or c.get("clip_id") is None else str(c["clip_id"]) for c in some]
            n = len(some)
            yield pa.RecordBatch.from_pydict({"video_id": [partition.video] * n, "directory": [partition.path] * n, "clip_id": ids, "clip": [json.dumps(c) for c in some], "status": [said] * n})


class ClipFolders(DataSource):
    """The ``clip_folders`` format; its one option is the path."""

    @classmethod
    def name(cls) -> str:
        return "clip_folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ClipFolderReader:
        return ClipFolderReader(self.options["path"])


def discover(spark: SparkSession, folder: str, video: str | None = None, clip: str | None = None) -> DataFrame:
    """Clips below ``folder``; ``video`` keeps directories of that name, before anything in them is read, ``clip`` then rows."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ClipFolders)
    found = spark.read.format(ClipFolders.name()).load(folder)
    if video:
        found = found.where(found["video_id"] == video)
    return found.where(found["clip_id"] == clip) if clip else found
