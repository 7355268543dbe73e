"""A file topic as a rate-limited stream with record offsets (SRC3).

A Python data source for Structured Streaming.  A topic is a folder of
JSON-lines files that don't change once they are there.  The files are put in
an order when they are found (those found together by name) and keep it; an
offset is a file's place in that order and a byte in it, always at the start
of a record.  So a batch ends exactly ``max_records`` records after the last
one, inside a file if need be, and a restart goes on at the next record.

Spark's own checkpoint holds the offsets of the batches.  What it can't know
is kept in the ``progress`` folder, written before it is used: the order of
the files, and the last offset handed out (on a restart Spark asks for the
newest offset without saying where it stands).

Only the end of the next batch is looked for in the driver, by counting line
ends from the last offset on; the records themselves are read by tasks, in
byte ranges of at most ``SPLIT`` bytes, as Arrow batches that hold the lines.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "fraudflow_topic"
SPLIT = 32 << 20  # bytes of a task's range
_READ = 4 << 20   # bytes read at once
_FIRST = 1 << 16  # bytes read first, as a small batch needs no more
_END = ord("\n")

# Python workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        path = "file://" + path
    elif path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def _hidden(name: str) -> bool:
    return any(part[:1] in "._" for part in name.split("/"))


class TopicLog:
    """The order of a topic's files, kept in a folder of numbered JSON files (one writer)."""

    def __init__(self, topic: str, progress: str) -> None:
        self.system, self.root = _system(topic.removesuffix("*").rstrip("/"))
        self.home, self.folder = _system(progress.rstrip("/"))
        self.home.create_dir(f"{self.folder}/files", recursive=True)
        self.names: list[str] = []
        self.parts = 0
        for info in sorted(self._listed(self.home, f"{self.folder}/files"), key=lambda i: i.path):
            self.names += json.loads(self._text(info.path))
            self.parts += 1
        self.known = set(self.names)
        self.sizes: dict[str, int] = {}

    @staticmethod
    def _listed(system, folder, recursive=False):
        found = system.get_file_info(pafs.FileSelector(folder, recursive=recursive, allow_not_found=True))
        return [i for i in found if i.type == pafs.FileType.File and not _hidden(i.path[len(folder) + 1:])]

    def _text(self, path: str) -> str:
        with self.home.open_input_stream(path) as f:
            return f.read().decode()

    def _put(self, path: str, value) -> None:
        """Write aside, then rename: a reader sees all of it or what was there before."""
        aside = f"{self.folder}/.{path.replace('/', '-')}"
        with self.home.open_output_stream(aside) as f:
            f.write(json.dumps(value).encode())
        self.home.move(aside, f"{self.folder}/{path}")

    def refresh(self) -> None:
        """Take up files that have appeared."""
        found = self._listed(self.system, self.root, recursive=True)
        new = sorted(i.path[len(self.root) + 1:] for i in found if i.path[len(self.root) + 1:] not in self.known)
        self.sizes.update({i.path[len(self.root) + 1:]: i.size for i in found})
        if new:
            part = f"files/{self.parts:09d}.json"
            if self.home.get_file_info(f"{self.folder}/{part}").type != pafs.FileType.NotFound:
                raise RuntimeError(f"{self.folder} is the progress folder of another query as well")
            self._put(part, new)
            self.parts += 1
            self.names += new
            self.known |= set(new)

    def size(self, at: int) -> int:
        name = self.names[at]
        if name not in self.sizes:
            self.sizes[name] = self.system.get_file_info(f"{self.root}/{name}").size
        return self.sizes[name]

    def end(self) -> dict:
        return {"file": len(self.names), "byte": 0}

    def after(self, start: dict, records: int) -> dict:
        """The offset ``records`` records after ``start``, or the topic's end."""
        file, byte = start["file"], start["byte"]
        while file < len(self.names):
            size = self.size(file)
            with self.system.open_input_file(f"{self.root}/{self.names[file]}") as f:
                f.seek(byte)
                most = min(_FIRST, _READ)
                while byte < size and records:
                    data, most = np.frombuffer(f.read(most), np.uint8), min(2 * most, _READ)
                    if not len(data):
                        break
                    ends = np.flatnonzero(data == _END)
                    if len(ends) >= records:
                        byte += int(ends[records - 1]) + 1
                        return {"file": file, "byte": byte} if byte < size else {"file": file + 1, "byte": 0}
                    records -= len(ends)
                    byte += len(data)
                    if byte >= size and data[-1] != _END:
                        records -= 1  # a last record without a line end
            if not records:
                return {"file": file + 1, "byte": 0}
            file, byte = file + 1, 0
        return self.end()

    def state(self) -> dict:
        """initial: where the query began; given: the last offset handed out; planned: the last whose batch Spark has begun."""
        path = f"{self.folder}/state.json"
        return json.loads(self._text(path)) if self.home.get_file_info(path).type == pafs.FileType.File else {}

    def keep(self, state: dict) -> None:
        self._put("state.json", state)


class Range(InputPartition):
    """Records that start in bytes [start, end) of a file."""

    def __init__(self, path: str, file: int, start: int, end: int, whole: bool) -> None:
        self.path, self.file, self.start, self.end, self.whole = path, file, start, end, whole


def ranges(log: TopicLog, start: dict, end: dict) -> list[Range]:
    """Byte ranges between two offsets, cut at SPLIT bytes; only a batch's own start is sure to start a record."""
    out = []
    for file in range(start["file"], min(end["file"] + 1, len(log.names))):
        low = start["byte"] if file == start["file"] else 0
        high = log.size(file) if file < end["file"] else end["byte"]
        for at in range(low, high, SPLIT):
            out.append(Range(f"{log.root}/{log.names[file]}", file, at, min(at + SPLIT, high), at == low))
    return out


def lines(system: pafs.FileSystem, part: Range) -> Iterator[pa.RecordBatch]:
    """Batches (file, byte, line) of the records that start in a range; empty lines are no records."""
    with system.open_input_file(part.path) as f:
        size = f.size()
        # a record that starts before the range belongs to the one before: its line end is looked for from there
        at, rest, skip = part.start - (not part.whole), b"", not part.whole
        f.seek(at)
        # up to the range's end, and then for the rest of a record that starts in it
        while at < size and (data := f.read(min(_READ, max(part.end - at, _FIRST)))):
            buf, base = rest + data, at - len(rest)
            at += len(data)
            a = np.frombuffer(buf, np.uint8)
            ends = np.flatnonzero(a == _END) + 1
            if at >= size and (not len(ends) or ends[-1] < len(a)):
                ends = np.append(ends, len(a))
            if not len(ends):
                rest = buf
                continue
            rest = buf[ends[-1]:]
            starts = np.concatenate([[0], ends[:-1]])
            if skip:
                starts, ends, skip = starts[1:], ends[1:], False
            own = base + starts < part.end
            said = own & (a[starts] != _END)
            column = pa.array([buf[i:j].decode("utf-8", "replace") for i, j in zip(starts[said].tolist(), ends[said].tolist())], pa.string())
            if len(column):
                yield pa.record_batch([pa.array(np.full(len(column), part.file, np.int64)), pa.array(base + starts[said]), column],
                                      ["file", "byte", "line"])
            if not own.all():
                return


class TopicStreamReader(DataSourceStreamReader):
    """``starting`` counts on the first run only; ``max_records`` 0 is no limit."""

    def __init__(self, topic: str, progress: str, starting: str, max_records: int) -> None:
        self.topic, self.progress, self.starting, self.most = topic, progress, starting, max_records
        self.log: TopicLog | None = None

    def _log(self) -> TopicLog:
        if self.log is None:
            self.log = TopicLog(self.topic, self.progress)
            self.at = self.log.state()
            # Spark has taken up what was last handed out unless it was stopped just then
            self.repeat = self.at.get("given") != self.at.get("planned")
            if not self.at:
                self.log.refresh()
                first = {"file": 0, "byte": 0} if self.starting == "earliest" else self.log.end()
                self._keep(initial=first, given=first, planned=first)
        return self.log

    def _keep(self, **new) -> None:
        if {**self.at, **new} != self.at:
            self.at = {**self.at, **new}
            self.log.keep(self.at)

    def initialOffset(self) -> dict:
        self._log()
        return self.at["initial"]

    def latestOffset(self) -> dict:
        log = self._log()
        if not self.repeat:
            log.refresh()
            self._keep(given=log.after(self.at["given"], self.most) if self.most else log.end())
        self.repeat = False
        return self.at["given"]

    def partitions(self, start: dict, end: dict) -> list[Range]:
        log = self._log()
        self._keep(planned=end)
        self.repeat = False
        return ranges(log, start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return lines(_system(self.topic.removesuffix("*").rstrip("/"))[0], partition)


class TopicSource(DataSource):
    """Options: path, progress, starting (latest, earliest), max_records."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file long, byte long, line string"

    def streamReader(self, schema: StructType) -> TopicStreamReader:
        o = self.options
        if o.get("starting", "latest") not in ("latest", "earliest"):
            raise ValueError(f"starting is latest or earliest, not {o['starting']}")
        return TopicStreamReader(o["path"], o["progress"], o.get("starting", "latest"), int(o.get("max_records", 0)))


def read_records(spark: SparkSession, path: str, progress: str, starting: str = "latest",
                 max_records: int | None = None) -> DataFrame:
    """A stream of envelopes (key, value) with the place of each record (file, byte).

    ``progress``: a folder on shared storage for this query alone, kept and
    removed together with its checkpoint.
    """
    # sessions don't share data sources, but their names: each reading has a name of its own
    name = f"{NAME}_{uuid.uuid4().hex[:12]}"
    spark.dataSource.register(type("NamedTopicSource", (TopicSource,), {"name": classmethod(lambda cls: name)}))
    stream = (spark.readStream.format(name).option("path", path).option("progress", progress)
              .option("starting", starting).option("max_records", str(max_records or 0)).load())
    envelope = F.from_json("line", "key string, value string")
    return stream.select(envelope["key"].alias("key"), envelope["value"].alias("value"), "file", "byte")
