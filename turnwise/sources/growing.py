"""A streaming source of lines that are appended to files.

Spark's file source never reads a file twice, so what is appended to a transcript later is lost
there. This source remembers a byte offset per file. Each offset that Spark sees is the number of
an entry in a log below the query's folder; an entry lists the byte ranges that it admits, at most
``maxBytesPerTrigger`` of them, so offsets stay small however many files there are, and what was
admitted survives a restart. Only whole lines are admitted: a line still being written waits for
its end. Ranges are cut into splits, so a large file is read by many tasks, and small ranges are
put together, so many small files are read by few.

Files are listed and read with the file systems of Arrow (local paths, and URIs that it knows).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, line bigint, value string"
ENTRIES_PER_SNAPSHOT = 50
BLOCK_BYTES = 1 << 16
ROWS_AT_ONCE = 2000
# What opening a file is reckoned at when small ranges are put together.
OPEN_BYTES = 1 << 16
# Files whose ends are looked up at once, and those opened at the same time.
FILES_AT_ONCE = 4096
OPEN_FILES = 16


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def last_line_end(file: pa.NativeFile, start: int, stop: int) -> int:
    """The byte after the last newline in [start, stop); ``start`` if there is none."""
    while stop > start:
        begin = max(start, stop - BLOCK_BYTES)
        at = file.read_at(stop - begin, begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        stop = begin
    return start


def next_line_end(file: pa.NativeFile, start: int, stop: int) -> int:
    """The byte after the first newline in [start, stop); ``start`` if there is none."""
    at = start
    while at < stop:
        data = file.read_at(min(BLOCK_BYTES, stop - at), at)
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
    return start


class Range(NamedTuple):
    """Bytes [start, stop) of a file; lines that begin there belong to it, and end by ``limit``."""

    path: str
    start: int
    stop: int
    first: int
    limit: int


class Ranges(InputPartition):
    """What one task reads."""

    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.log = options["path"], options["log"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.most = int(options.get("maxBytesPerTrigger", 1 << 33))
        self.split = int(options.get("splitBytes", 1 << 26))
        self.tasks = int(options.get("minPartitions", 1))
        self._entry: int | None = None
        self._read: dict[str, int] = {}

    # --- the log -------------------------------------------------------------------------

    def _name(self, entry: int) -> str:
        return f"{self.log}/{entry:012d}.json"

    def _load(self, name: str) -> dict:
        store, path = open_path(name)
        with store.open_input_file(path) as file:
            return json.loads(file.read())

    def _store(self, name: str, content: dict) -> None:
        """Written beside its name and then moved there, so it is there whole or not at all."""
        store, path = open_path(name)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        beside = f"{path}.{uuid.uuid4().hex}.part"
        with store.open_output_stream(beside) as out:
            out.write(json.dumps(content).encode())
        store.move(beside, path)

    def _restore(self) -> int:
        """The number of the last entry; offsets per file from the last snapshot and the entries since."""
        if self._entry is not None:
            return self._entry
        store, folder = open_path(self.log)
        store.create_dir(folder, recursive=True)
        names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".json"))
        last = max((int(n[:-5]) for n in names if n[:-5].isdigit()), default=0)
        held = max((int(n[9:-5]) for n in names if n.startswith("snapshot-")), default=0)
        self._read = self._load(f"{self.log}/snapshot-{held:012d}.json") if held else {}
        for entry in range(held + 1, last + 1):
            self._apply(self._load(self._name(entry)))
        self._entry = last
        return last

    def _apply(self, entry: dict) -> None:
        for path, _, stop in entry["ranges"]:
            self._read[path] = stop

    # --- offsets -------------------------------------------------------------------------

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def _files(self) -> list[fs.FileInfo]:
        store, folder = open_path(self.root)
        infos = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        return sorted((f for f in infos if f.type == fs.FileType.File and fnmatch(f.base_name, self.pattern)), key=lambda f: f.path)

    def _end(self, store: fs.FileSystem, info: fs.FileInfo, start: int, left: int) -> int:
        """Where the last whole line ends of at most ``left`` bytes from ``start`` on."""
        with store.open_input_file(info.path) as file:
            stop = last_line_end(file, start, min(info.size, start + left))
            if stop == start and left == self.most and info.size > start + left:
                # A line longer than the whole allowance goes alone.
                stop = next_line_end(file, start + left, info.size)
                stop = start if stop == start + left else stop
        return stop

    def _grown(self) -> list[tuple[fs.FileInfo, int]]:
        """Files with bytes not read yet, and where those begin."""
        out = []
        for info in self._files():
            start = self._read.get(info.path, 0)
            if info.size < start:
                raise ValueError(f"{info.path} has become shorter; files may only grow")
            if info.size > start:
                out.append((info, start))
        return out

    def latestOffset(self) -> dict:
        entry, store, left, ranges = self._restore(), open_path(self.root)[0], self.most, []
        grown = self._grown()
        with ThreadPoolExecutor(OPEN_FILES) as pool:
            for at in range(0, len(grown), FILES_AT_ONCE):
                if left <= 0:
                    break
                some = grown[at:at + FILES_AT_ONCE]
                if sum(info.size - start for info, start in some) <= left:
                    # All of them fit, so none waits for what another takes.
                    stops = list(pool.map(lambda x: self._end(store, x[0], x[1], x[0].size - x[1]), some))
                    ranges += [[info.path, start, stop] for (info, start), stop in zip(some, stops) if stop > start]
                    left -= sum(stop - start for (_, start), stop in zip(some, stops))
                    continue
                for info, start in some:
                    stop = self._end(store, info, start, left) if left > 0 else start
                    if stop > start:
                        ranges.append([info.path, start, stop])
                        left -= stop - start
        if ranges:
            entry += 1
            self._store(self._name(entry), {"ranges": ranges})
            self._apply({"ranges": ranges})
            self._entry = entry
            if entry % ENTRIES_PER_SNAPSHOT == 0:
                self._store(f"{self.log}/snapshot-{entry:012d}.json", self._read)
        return {"entry": entry}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        pieces = [Range(path, a, min(a + self.split, stop), first, stop) for entry in range(start["entry"] + 1, end["entry"] + 1)
                  for path, first, stop in self._load(self._name(entry))["ranges"] for a in range(first, stop, self.split)]
        costs = [r.stop - r.start + OPEN_BYTES for r in pieces]
        most = min(self.split, sum(costs) // self.tasks)
        out: list[Ranges] = []
        held = 0
        for piece, cost in zip(pieces, costs):
            if not out or held + cost > most:
                out.append(Ranges([]))
                held = 0
            out[-1].ranges.append(piece)
            held += cost
        return out

    # --- rows ----------------------------------------------------------------------------

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        lines: list[tuple[str, int, str]] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in lines], pa.string()), pa.array([a for _, a, _ in lines], pa.int64()),
                                               pa.array([v for _, _, v in lines], pa.string())], names=["path", "line", "value"])

        for piece in partition.ranges:
            for begin, value in self._lines(piece):
                lines.append((piece.path, begin, value))
                if len(lines) >= ROWS_AT_ONCE:
                    yield batch()
                    lines = []
        if lines:
            yield batch()

    def _lines(self, piece: Range) -> Iterator[tuple[int, str]]:
        """Lines that begin in the range, each with its first byte's place."""
        with open_path(self.root)[0].open_input_file(piece.path) as file:
            at = piece.start
            if at > piece.first:
                # The line that goes on from the split before is that split's.
                at = at if file.read_at(1, at - 1) == b"\n" else next_line_end(file, at, piece.limit)
                if at == piece.start and file.read_at(1, at - 1) != b"\n":
                    return
            rest = b""
            begin = at
            while begin < piece.stop and at < piece.limit:
                data = file.read_at(min(BLOCK_BYTES, piece.limit - at), at)
                at += len(data)
                rest += data
                *whole, rest = rest.split(b"\n")
                for line in whole:
                    if begin >= piece.stop:
                        break
                    yield begin, line.removesuffix(b"\r").decode("utf-8", "replace")
                    begin += len(line) + 1


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines")``: path, line (its first byte), value.

    Options: ``path`` (a folder), ``log`` (a folder for the admitted ranges, kept with the query's
    checkpoint), ``pattern`` of file names, ``maxBytesPerTrigger``, ``splitBytes``, ``minPartitions``
    (small ranges are put together to splits, but not to fewer than this).
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLinesReader(dict(self.options))


def read_growing_lines(spark: SparkSession, path: str, log: str, **options):
    """A stream of the lines that are in the files now or are appended to them later."""
    spark.dataSource.register(GrowingLines)
    options = {"minPartitions": spark.sparkContext.defaultParallelism, **options}
    return spark.readStream.format("growing_lines").options(path=path, log=log, **options).load()
