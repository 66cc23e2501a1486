"""An append-only folder of event files as a streaming Data Source.

The folder is the queue: ``append_events`` puts each submission into place as
numbered Parquet files, and ``spark.readStream.format("event_folder")`` reads
them in that order.

* Offset: the name of the last file read.  Names grow, so what lies between
  two offsets never changes, and a micro-batch that is replayed after a crash
  reads the same files.
* Partitions: one for each row group of the files of a micro-batch.
* Admission: ``maxFilesPerTrigger`` files a micro-batch.  Spark asks for the
  end of a micro-batch without saying where it starts, so ``commit`` notes the
  last offset in the file ``progress`` names (one for each query); without it,
  the first micro-batch of a run takes all there is.  With ``availableNow``
  leave the limit unset: that trigger asks for the end once.

Paths may carry any scheme that Arrow's file systems know; without one they are
local.  Executors read with Arrow, row group by row group.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Readers run in Python workers of the driver and the executors: ship this module by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
NAME = "event_folder"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _names(path: str) -> list[str]:
    """Names of the event files, in order."""
    fs, folder = _file_system(path)
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")


class RowGroup(InputPartition):
    def __init__(self, name: str, group: int):
        self.name, self.group = name, group


def _row_groups(path: str, names: list[str]) -> list[RowGroup]:
    fs, folder = _file_system(path)
    out = []
    for name in names:
        with fs.open_input_file(f"{folder}/{name}") as f:
            out += [RowGroup(name, g) for g in range(pq.ParquetFile(f).num_row_groups)]
    return out


def _read(path: str, partition: RowGroup | None) -> Iterator[pa.RecordBatch]:
    if partition is None:  # what Spark asks for where there are no partitions
        return
    fs, folder = _file_system(path)
    with fs.open_input_file(f"{folder}/{partition.name}") as f:
        yield from pq.ParquetFile(f).iter_batches(batch_size=2000, row_groups=[partition.group])


class EventFolderStream(DataSourceStreamReader):
    def __init__(self, path: str, most: int | None = None, progress: str | None = None):
        self.path, self.most, self.progress = path, most, progress
        self.known = self._noted()

    def _noted(self) -> str | None:
        """The last committed offset; "" before the first, None if it isn't noted."""
        if self.progress is None:
            return None
        fs, name = _file_system(self.progress)
        if fs.get_file_info(name).type != pafs.FileType.File:
            return ""
        with fs.open_input_file(name) as f:
            return f.read().decode()

    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        names = _names(self.path)
        if self.known is not None:
            names = [n for n in names if n > self.known][:self.most]
        self.known = names[-1] if names else self.known or ""
        return {"last": self.known}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        if end["last"] < start["last"]:  # a note that is older than the query's own log, under a smaller limit
            self.commit(start)
            raise RuntimeError("the noted progress was behind; it is put right, start the query again")
        self.known = max(self.known or "", end["last"])
        return _row_groups(self.path, [n for n in _names(self.path) if start["last"] < n <= end["last"]])

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        if self.progress is not None:
            fs, name = _file_system(self.progress)
            draft = f"{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as f:
                f.write(end["last"].encode())
            fs.move(draft, name)


class EventFolderBatch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[RowGroup]:
        return _row_groups(self.path, _names(self.path))

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class EventFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return EventFolderBatch(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        most = self.options.get("maxFilesPerTrigger")
        return EventFolderStream(self.options["path"], int(most) if most else None, self.options.get("progress"))


def append_events(spark: SparkSession, path: str, events: DataFrame) -> None:
    """Put ``events`` at the end of the folder, one file a partition, each whole when it appears.

    One writer at a time: numbers go on from the greatest one there.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft = f"{path.rstrip('/')}/.draft-{uuid.uuid4().hex}"
    events.selectExpr("event_id", "ts", "user_id", "event_type", "value", "props").write.parquet(draft)
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    parts = sorted(s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(draft)))
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    number = max((int(n[:20]) for n in names if n[:20].isdigit()), default=0)
    for part in parts:
        if part.endswith(".parquet"):
            number += 1
            fs.rename(jvm.org.apache.hadoop.fs.Path(f"{draft}/{part}"),
                      jvm.org.apache.hadoop.fs.Path(folder, f"{number:020d}.parquet"))
    fs.delete(jvm.org.apache.hadoop.fs.Path(draft), True)


def event_folder_stream(spark: SparkSession, path: str, max_files: int | None = None,
                        progress: str | None = None) -> DataFrame:
    """Raw events of the folder as a stream, ``max_files`` a micro-batch from where ``progress`` says."""
    spark.dataSource.register(EventFolder)
    options = {"maxFilesPerTrigger": max_files, "progress": progress}
    return spark.readStream.format(NAME).options(**{k: v for k, v in options.items() if v}).load(path)


def read_event_folder(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(EventFolder)
    return spark.read.format(NAME).load(path)
