"""Following text files while they grow: appended lines are read once, with their line numbers.

Spark's file streams take a file once and whole. Here a step knows, per file, the bytes and lines read so far. It is
planned from the files' lengths, cut into pieces of ``PIECE`` bytes that Spark's tasks read in parallel, and ends at
the last line end of each file; what stands after it waits for the next step. A step takes at most ``max_bytes`` (more
only for a line that is longer). Steps are kept and committed as in :mod:`topicflow.streaming.polls`.

Tasks read byte ranges through Arrow's file systems (local and mounted files, HDFS, S3, GCS, ABFS). A file that is shorter
than what was read of it was replaced, and is read from its beginning again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions.records import strip
from topicflow.streaming.polls import Steps

PIECE = 16 << 20
MAX_BYTES = 4 << 30
_READ = 1 << 20


@dataclass
class Step:
    """``files``: bytes and lines read of each file after this step; ``pieces``: (file, first byte, end, first byte and
    end of the file's part in this step, number of lines before)."""

    number: int
    files: dict[str, tuple[int, int]]
    pieces: list[tuple[str, int, int, int, int, int]]

    def text(self) -> str:
        return json.dumps({"files": self.files, "pieces": self.pieces})

    @classmethod
    def parsed(cls, number: int, text: str) -> Step:
        stored = json.loads(text)
        return cls(number, {k: tuple(v) for k, v in stored["files"].items()}, [tuple(p) for p in stored["pieces"]])


def _opened(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path[len('file:'):]}"
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _cut(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One task for each row."""
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), 20_000)))


def _line_ends(pieces: DataFrame) -> DataFrame:
    """Per piece: how many line ends it has, and where the last one is (null: nowhere)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, last = [], []
            for path, first, end in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "end"))):
                own, at = 0, None
                with _opened(path) as f:
                    for a in range(first, end, _READ):
                        raw = f.read_at(min(_READ, end - a), a)
                        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
                        own += len(ends)
                        at = a + int(ends[-1]) if len(ends) else at
                n.append(own)
                last.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("first"), pa.array(n, pa.int64()), pa.array(last, pa.int64())],
                ["file", "first", "n", "last"])

    return pieces.select("file", "first", "end").mapInArrow(count, "file string, first bigint, n bigint, last bigint")


def _lines(pieces: DataFrame) -> DataFrame:
    """The lines that begin in each piece, whole, with their numbers."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, end, begin, stop, before in zip(*(batch.column(c).to_pylist() for c in (
                    "file", "first", "end", "begin", "stop", "before"))):
                with _opened(path) as f:
                    at, rest, number = first, b"", before
                    if first > begin:  # the line that began before this piece is not its own
                        at = first - 1
                        while b"\n" not in (raw := f.read_at(min(_READ, stop - at), at)):
                            at += len(raw)
                        at += raw.index(b"\n") + 1
                        number += at > first  # its end lies in this piece
                    while at < end or rest:  # at: where the text in hand ends; rest: a line that goes on there
                        raw = rest + f.read_at(min(_READ, stop - at), at)
                        at += len(raw) - len(rest)
                        *own, rest = raw.split(b"\n")
                        if at - len(rest) >= end:  # lines that begin in the next piece
                            begins = at - len(raw) + np.cumsum([0, *(len(x) + 1 for x in own)])[:len(own)]
                            own, rest = own[: int((begins < end).sum())], b""
                            at = max(at, end)
                        if own:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path] * len(own)), pa.array(np.arange(number + 1, number + len(own) + 1)),
                                 pa.array(own, pa.binary())], ["file", "line_no", "value"])
                            number += len(own)

    return pieces.mapInArrow(read, "file string, line_no bigint, value binary")


class Follower(Steps):
    """The place of a reader in the files of a folder (or in one file), kept under ``checkpoint``."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, *, max_bytes: int = MAX_BYTES, piece: int = PIECE):
        super().__init__(spark, checkpoint)
        self.path, self.max_bytes, self.piece = path, max_bytes, piece
        done = self.last_done()
        self.last = Step.parsed(done, self.store.read(f"offsets/{done}")) if done >= 0 else Step(-1, {}, [])

    def next_poll(self) -> Step | None:
        planned = self.store.read(f"offsets/{self.last.number + 1}")
        if planned is not None:
            return Step.parsed(self.last.number + 1, planned)
        found = self.spark.read.format("binaryFile").load(self.path).select("path", "length").collect()  # no contents
        grown = {}
        for r in sorted(found):
            begin, lines = self.last.files.get(r.path, (0, 0))
            if r.length < begin:
                begin, lines = 0, 0
            if r.length > begin:
                grown[r.path] = (begin, lines, r.length)
        room = self.max_bytes
        while grown:  # until some line ends within the room
            step = self._plan(grown, room)
            if step.pieces:
                self.planned(step.number, step.text())
                return step
            if room >= sum(length - begin for begin, _, length in grown.values()):
                return None
            room *= 8
        return None

    def _plan(self, grown: dict[str, tuple[int, int, int]], room: int) -> Step:
        """Ranges of the files, in order of their names, up to ``room`` bytes, each cut at its last line end."""
        cuts = []
        for path, (begin, _, length) in grown.items():
            end = min(length, begin + room)
            room -= end - begin
            cuts += [(path, a, min(a + self.piece, end)) for a in range(begin, end, self.piece)]
        counted = {(r.file, r.first): r for r in _line_ends(_cut(self.spark, cuts, "file string, first bigint, end bigint")).collect()}
        stop, before, pieces, files = {}, {}, [], dict(self.last.files)
        for path, first, _ in cuts:
            last = counted[path, first].last
            stop[path] = stop.get(path, 0) if last is None else last + 1
        for path, first, end in cuts:
            begin, lines, _ = grown[path]
            before.setdefault(path, lines)
            if first < stop[path]:
                pieces.append((path, first, min(end, stop[path]), begin, stop[path], before[path]))
            before[path] += counted[path, first].n
        files |= {path: (stop[path], before[path]) for path in stop if stop[path]}
        return Step(self.last.number + 1, files, pieces)

    def records(self, poll: Step) -> DataFrame:
        """Key (null), value, file and line_no of the step's lines: trimmed, blank ones left out but counted."""
        pieces = _cut(self.spark, poll.pieces,
                      "file string, first bigint, end bigint, begin bigint, stop bigint, before bigint")
        lines = _lines(pieces).withColumn("line", strip(F.col("value").cast("string")))
        return lines.where(F.col("line") != "").select(
            F.lit(None).cast("binary").alias("key"), F.col("line").cast("binary").alias("value"), "file", "line_no")
