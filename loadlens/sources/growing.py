"""Lines appended to growing files, as a streaming source with byte offsets.

Spark's own file stream reads a file once, when it appears.  This source follows files that grow: an offset is
the number of bytes read of each file, and always lies behind a line end, so a line that is still being written waits until
it is whole.  Offsets are in the query's checkpoint: after a restart reading goes on behind the last line.  New bytes are
cut into ranges that are read in parallel; a range has the lines that begin in it.

    spark.dataSource.register(GrowingLines)
    spark.readStream.format("growing_lines").load("/shared/feed/*.csv")
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# shipped by value: the workers that run a source see no ``--py-files``
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 << 20  # bytes read by one task
STEP = 1 << 20  # bytes read at a time


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    first: int  # where the batch begins in this file; always behind a line end


def _open(path: str):
    """``(file system, path in it)`` of a path or URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(pattern: str) -> dict[str, int]:
    """Files a path names (a file, a directory's files, or a pattern in the last part) with their sizes."""
    import fnmatch

    from pyarrow import fs

    system, path = _open(pattern)
    folder, _, name = path.rpartition("/")
    if any(c in name for c in "*?["):
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        found = [f for f in found if fnmatch.fnmatch(f.base_name, name)]
    else:
        info = system.get_file_info(path)
        found = system.get_file_info(fs.FileSelector(path)) if info.type == fs.FileType.Directory else [info]
    return {f.path: f.size for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))}


def whole_lines(system, path: str, size: int) -> int:
    """Bytes up to the last line end within the first ``size``."""
    with system.open_input_file(path) as f:
        end = size
        while end > 0:
            begin = max(0, end - STEP)
            f.seek(begin)
            at = f.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


def lines_of_range(system, r: Range) -> Iterator[bytes]:
    """Lines that begin in a range, without their line ends."""
    with system.open_input_file(r.path) as f:
        f.seek(max(r.first, r.begin - 1))
        at, held = max(r.first, r.begin - 1), b""
        skip = r.begin > r.first  # the line that reaches into the range belongs to the range before
        while at - len(held) < r.end:
            data = f.read(STEP)
            if not data:
                break
            at += len(data)
            *lines, held = (held + data).split(b"\n")
            begin = at - len(held) - sum(len(x) + 1 for x in lines)
            for line in lines:
                if skip:
                    skip = False
                elif begin >= r.end:
                    return
                else:
                    yield line[:-1] if line.endswith(b"\r") else line
                begin += len(line) + 1


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        system, _ = _open(self.path)
        return {p: n for p, n in ((p, whole_lines(system, p, size)) for p, size in sorted(_files(self.path).items())) if n}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, stop in sorted(end.items()):
            first = start.get(path, 0)
            if stop < first:
                raise ValueError(f"{path} has become shorter: {stop} bytes after {first}")
            out += [Range(path, at, min(at + self.range_bytes, stop), first) for at in range(first, stop, self.range_bytes)]
        return out

    def read(self, partition: Range):
        import pyarrow as pa

        system, _ = _open(self.path)
        held, size = [], 0
        for line in lines_of_range(system, partition):
            held.append(line.decode("utf-8", "replace"))
            size += len(line)
            if size > STEP:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        pass


class GrowingLines(DataSource):
    """``growing_lines``: one row per whole line (``value``); option ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingLinesReader:  # noqa: N802
        return GrowingLinesReader(self.options["path"], int(self.options.get("rangebytes", self.options.get("rangeBytes", RANGE_BYTES))))


def growing_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A stream of the lines of growing files, one row per line (``value``)."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").option("rangeBytes", str(range_bytes)).load(path)
