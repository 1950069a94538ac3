"""A replayable line log as a streaming source with partitions and offsets.

The reference reads a topic of a message broker.  This source has the same contract over files,
so that starting, stopping and restarting a job with its offsets can run and be tested without a
broker (Kafka itself is read by :func:`clickflow.sources.readers.kafka_stream`, and not run here).

A log is a folder ``<path>/partition=<p>/segment=<n>/`` of text files.  A segment is published whole,
by a rename, and never changes; per partition its number counts up.  The offset of a partition is the
number of the next segment to read.  Spark stores the offsets in the query's checkpoint, so a
restarted query goes on where the last batch ended, and a batch that failed is read
again between the same offsets.  A new partition starts at its first segment.

Each (partition, segment) range of a batch is read by one task on an executor, as Arrow batches of lines;
the driver lists folder names only.  ``segmentsPerBatch`` bounds what one batch takes of a partition.
Paths are URIs that Arrow's file systems know (local, HDFS, S3) or plain paths.
"""

from __future__ import annotations

import re
import sys
from typing import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Executors need not have this package: what they run of this module travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "partition int, segment bigint, value string"
LINES_PER_BATCH = 10_000
READ_BYTES = 1 << 20


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        if path.startswith("file:"):
            path = "file:///" + path[len("file:") :].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _numbered(system: fs.FileSystem, folder: str, key: str) -> dict[int, str]:
    """The ``key=<number>`` folders of a folder."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    named = ((re.fullmatch(rf"{key}=(\d+)", i.base_name), i.path) for i in found if i.type == fs.FileType.Directory)
    return {int(m[1]): path for m, path in named if m}


def _lines(system: fs.FileSystem, path: str) -> Iterator[str]:
    """The lines of a text file, read in blocks; the last one may lack its line end."""
    with system.open_input_stream(path) as f:
        rest = b""
        while block := f.read(READ_BYTES):
            *whole, rest = (rest + block).split(b"\n")
            for line in whole:
                yield line.decode("utf-8", "replace")
        if rest:
            yield rest.decode("utf-8", "replace")


class LogRange(InputPartition):
    """Segments ``start`` to ``end`` (exclusive) of one partition."""

    def __init__(self, partition: int, start: int, end: int):
        super().__init__((partition, start, end))
        self.partition, self.start, self.end = partition, start, end


class LineLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.most = int(options.get("segmentsPerBatch", 0))
        #: Offsets that Spark has named; unknown after a restart until it plans a batch.
        self.at: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        self.at = {}
        return {}

    def latestOffset(self) -> dict:
        """The end of what is published, at most ``segmentsPerBatch`` beyond the last batch.  The first
        batch after a restart takes all: a bound counted from an unknown offset could fall behind it."""
        system, root = _file_system(self.path)
        latest = dict(self.at or {})
        most = self.most if self.at is not None else 0
        for number, folder in _numbered(system, root, "partition").items():
            key = str(number)
            segments = _numbered(system, folder, "segment")
            start = latest.get(key, min(segments, default=0))
            end = start
            while end in segments and (not most or end < start + most):
                end += 1  # a gap ends the range: what comes after it isn't published yet
            latest[key] = end
        return latest

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        self.at = dict(end)  # also when a restarted query repeats its last batch
        system, root = _file_system(self.path)
        out = []
        for key, stop in end.items():
            begin = start.get(key)
            if begin is None:
                begin = min(_numbered(system, f"{root}/partition={key}", "segment"), default=stop)
            out += [LogRange(int(key), n, n + 1) for n in range(begin, stop)]
        return out

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(self.path)

        def batch(segment: int, lines: list[str]) -> pa.RecordBatch:
            n = len(lines)
            own = pa.array([partition.partition] * n, pa.int32()), pa.array([segment] * n, pa.int64())
            return pa.RecordBatch.from_arrays([*own, pa.array(lines, pa.string())], ["partition", "segment", "value"])

        for segment in range(partition.start, partition.end):
            folder = f"{root}/partition={partition.partition}/segment={segment}"
            names = sorted(i.path for i in system.get_file_info(fs.FileSelector(folder)) if i.base_name[:1] not in "._")
            held: list[str] = []
            for name in names:
                for line in _lines(system, name):
                    held.append(line)
                    if len(held) == LINES_PER_BATCH:
                        yield batch(segment, held)
                        held = []
            if held:
                yield batch(segment, held)


class LineLog(DataSource):
    """``spark.readStream.format("line_log").load(path)`` after ``spark.dataSource.register(LineLog)``."""

    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineLogReader:
        return LineLogReader(self.options)


def line_log_stream(spark, path: str, segments_per_batch: int = 0):
    """The log as a stream of (partition, segment, value)."""
    spark.dataSource.register(LineLog)
    return spark.readStream.format("line_log").option("segmentsPerBatch", str(segments_per_batch)).load(path)
