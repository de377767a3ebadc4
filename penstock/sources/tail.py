"""Growing log files as a batch or a stream of complete lines: the ``logtail`` data source.

Options: ``path`` (folder, any file system Arrow reads), ``pattern`` (regular
expression the whole file path must match), ``chunkBytes`` (bytes one task
reads); for streams ``maxBytesPerTrigger`` (bytes of a batch, shared fairly by all
files that have new ones) and ``maxBytesPerFile`` (bytes taken from one file per
batch); the rest follows in later batches. For batches, ``lastLines`` gives the last
complete lines of each file only; they are found from the file's end, a block at a time,
so the bytes read don't grow with the file.

A batch's filters on ``file`` are taken over by the source: the files they leave out are
never opened.

A byte range owns the lines whose end mark lies in it. So a position is just a
number of bytes, the driver plans without reading the files, a file of any size
splits into equal tasks, and the unfinished last line waits for its end mark.

A file is known by a digest of its first bytes and of those before the position,
not by its name: a file that was replaced is read from its start, however long
the new one is, and one that was renamed goes on where it was. The driver reads these
few bytes of files with new ones only. Files that are gone leave the position.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringContains,
    StringEndsWith, StringStartsWith)

from penstock.sources import folders

FORMAT = "logtail"
SCHEMA = "value string, file string, position long"
ARROW_SCHEMA = pa.schema([("value", pa.string()), ("file", pa.string()), ("position", pa.int64())])
DEFAULT_PATTERN = r".*/.*\.log"
DEFAULT_CHUNK_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024
#: Bytes of a step back from a file's end.
END_BLOCK_BYTES = 64 * 1024
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Bytes at either end of what was read that tell a file from another; files looked at together.
PRINT_BYTES, PRINTS_AT_ONCE = 256, 16


@dataclass
class FileRange(InputPartition):
    """Bytes ``start`` up to ``end`` of one file, or the ``last`` lines that end there."""

    file: str
    start: int
    end: int
    last: int | None = None


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def list_sizes(path: str, pattern: str) -> dict[str, int]:
    """Size of each matching file below the folder, in path order."""
    system, root = _file_system(path)
    selector = fs.FileSelector(root, recursive=True, allow_not_found=True)
    wanted = re.compile(pattern)
    found = {i.path: i.size for i in system.get_file_info(selector)
             if i.type == fs.FileType.File and wanted.fullmatch(i.path)}
    return dict(sorted(found.items()))


def split_range(file: str, start: int, end: int, chunk: int) -> list[FileRange]:
    """A byte range in pieces of at most ``chunk`` bytes."""
    return [FileRange(file, at, min(at + chunk, end)) for at in range(start, end, chunk)]


def _line_start(handle, at: int) -> int:
    """Where the line holding byte ``at`` begins: just past the previous end mark."""
    while at > 0:
        begin = max(0, at - BLOCK_BYTES)
        handle.seek(begin)
        mark = handle.read(at - begin).rfind(b"\n")
        if mark >= 0:
            return begin + mark + 1
        at = begin
    return 0


def last_start(handle, end: int, count: int) -> int:
    """Where the last ``count`` complete lines of the first ``end`` bytes begin."""
    wanted, at = count + 1, end
    while at > 0:
        begin = max(0, at - END_BLOCK_BYTES)
        handle.seek(begin)
        block = handle.read(at - begin)
        marks = block.count(b"\n")
        if marks >= wanted:
            cut = len(block)
            for _ in range(wanted):
                cut = block.rfind(b"\n", 0, cut)
            return begin + cut + 1
        wanted, at = wanted - marks, begin
    return 0


def _batch(file: str, data: bytes, begin: int) -> pa.RecordBatch:
    """The lines of ``data`` (without its last end mark), the first of which begins at byte ``begin``."""
    lines = pc.split_pattern(pa.array([data], pa.large_binary()), b"\n").values
    # An end mark is one byte, so a line begins where the ones before it, with their marks, end.
    lengths = pc.add(pc.binary_length(lines), 1)
    positions = pc.add(pc.subtract(pc.cumulative_sum(lengths), lengths), begin)
    if b"\r" in data:
        lines = pc.replace_substring_regex(lines, rb"\r\z", b"")
    try:
        texts = lines.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([line.decode("utf-8", "replace") for line in lines.to_pylist()], pa.string())
    files = pa.repeat(pa.scalar(file), len(texts))
    return pa.RecordBatch.from_arrays([texts, files, positions.cast(pa.int64())], schema=ARROW_SCHEMA)


def read_range(path: str, part: FileRange) -> Iterator[pa.RecordBatch]:
    """The lines whose end mark lies in the range, a block at a time."""
    system, _ = _file_system(path)
    with system.open_input_file(part.file) as handle:
        begin, head, at = None, [], part.start
        if part.last is not None:
            begin = at = last_start(handle, part.end, part.last)
        while at < part.end:
            handle.seek(at)
            block = handle.read(min(BLOCK_BYTES, part.end - at))
            if not block:
                raise EOFError(f"{part.file} ends at byte {at}, before byte {part.end} where it was listed to reach")
            last = block.rfind(b"\n")
            if last < 0:
                if begin is not None:
                    head.append(block)
                at += len(block)
                continue
            if begin is None:
                begin = _line_start(handle, at)
                handle.seek(begin)
                head = [handle.read(at - begin)] if begin < at else []
            yield _batch(part.file, b"".join([*head, block[:last]]), begin)
            begin, head = at + last + 1, [block[last + 1:]]
            at += len(block)


def file_prints(path: str, positions: Mapping[str, int]) -> dict[str, str]:
    """For each file a digest of its first bytes and of the last ones before a position; empty if it is shorter."""
    system, _ = _file_system(path)

    def of(item: tuple[str, int]) -> str:
        file, position = item
        try:
            with system.open_input_file(file) as handle:
                head = handle.read(min(PRINT_BYTES, position))
                handle.seek(max(0, position - PRINT_BYTES))
                last = handle.read(min(PRINT_BYTES, position))
        except FileNotFoundError:
            return ""
        if len(last) < min(PRINT_BYTES, position):
            return ""
        return hashlib.sha256(head + last).hexdigest()[:16]

    with ThreadPoolExecutor(PRINTS_AT_ONCE) as pool:
        return dict(zip(positions, pool.map(of, positions.items())))


def fair_shares(pending: Mapping[str, int], budget: int) -> dict[str, int]:
    """Bytes admitted of each file: equal shares, what small files leave over goes to the others, at least one byte."""
    shares, open_ = {}, sorted(pending.items(), key=lambda item: item[1])
    for i, (file, size) in enumerate(open_):
        shares[file] = min(size, max(1, budget // (len(open_) - i)))
        budget = max(0, budget - shares[file])
    return shares


def admits(condition: Filter, file: str) -> bool:
    """Whether a condition of ``TAKEN`` holds for a file's path."""
    match condition:
        case EqualTo(value=value):
            return file == value
        case In(value=values):
            return file in values
        case StringStartsWith(value=value):
            return file.startswith(value)
        case StringEndsWith(value=value):
            return file.endswith(value)
        case StringContains(value=value):
            return value in file
    raise TypeError(f"no condition on a path: {condition}")


TAKEN = (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)


class _TailOptions:
    def __init__(self, options):
        self.path = options["path"]
        self.pattern = options.get("pattern", DEFAULT_PATTERN)
        self.chunk = int(options.get("chunkBytes", DEFAULT_CHUNK_BYTES))
        limit, budget = options.get("maxBytesPerFile"), options.get("maxBytesPerTrigger")
        self.limit = int(limit) if limit else None
        self.budget = int(budget) if budget else None
        self.last = int(options["lastLines"]) if options.get("lastLines") else None


class TailReader(DataSourceReader):
    def __init__(self, options: _TailOptions):
        self.options = options
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if isinstance(condition, TAKEN) and condition.attribute == ("file",):
                self.conditions.append(condition)
            else:
                yield condition

    def partitions(self) -> list[FileRange]:
        o = self.options
        sizes = {file: size for file, size in list_sizes(o.path, o.pattern).items()
                 if all(admits(condition, file) for condition in self.conditions)}
        if o.last is not None:
            return [FileRange(file, 0, size, o.last) for file, size in sizes.items()]
        return [p for file, size in sizes.items() for p in split_range(file, 0, size, o.chunk)]

    def read(self, partition: FileRange | None):
        # no file at all is one task without a range
        return read_range(self.options.path, partition) if partition else iter(())


class TailStreamReader(DataSourceStreamReader):
    """Position = ``{file: {from, to, print, goal}}``: the bytes of the last batch, the digest of what was taken, and
    how far the file reached when the position was last level with all files.

    A position is level when every file's ``to`` is its ``goal``. Until then later batches go on to the same
    goals, so a run that takes what is there ends, although files keep growing.
    """

    def __init__(self, options: _TailOptions):
        if options.last is not None:
            raise ValueError("lastLines is for batches; a stream reads files from their start")
        self.options = options
        self.known: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return {}

    def _recognised(self, sizes: dict[str, int]) -> dict[str, dict]:
        """What is known of each listed file that has new bytes or a new name; a file not known starts at 0."""
        known = self.known
        changed = [f for f, size in sizes.items() if f not in known or size != known[f]["to"]]
        asked = {f: known[f]["to"] for f in changed if f in known and sizes[f] >= known[f]["to"] > 0}
        found = file_prints(self.options.path, asked)
        out = {f: known[f] for f in asked if found[f] == known[f]["print"]}
        # a file without a history may be one that has left its old name, perhaps to another file
        left = {f: e for f, e in known.items() if e["to"] and f not in out and (f not in sizes or f in changed)}
        strange = [f for f in changed if f not in out and sizes[f]]
        for entry in left.values():
            prints = file_prints(self.options.path, {f: entry["to"] for f in strange if sizes[f] >= entry["to"]})
            for file, found_print in prints.items():
                if found_print == entry["print"]:
                    out[file] = entry
                    strange.remove(file)
                    break
        new = {"from": 0, "to": 0, "print": "", "goal": 0}
        return {f: out.get(f, new) if f in changed else known[f] for f in sizes}

    def latestOffset(self) -> dict:
        sizes = list_sizes(self.options.path, self.options.pattern)
        entries = self._recognised(sizes)
        goals = {f: min(sizes[f], e["goal"]) for f, e in entries.items()}
        if all(goals[f] <= e["to"] for f, e in entries.items()):
            goals = sizes
        pending = {f: goals[f] - e["to"] for f, e in entries.items() if goals[f] > e["to"]}
        if not pending:
            return self.known
        if self.options.limit is not None:
            shares = {f: min(size, self.options.limit) for f, size in pending.items()}
        else:
            shares = dict(pending)
        if self.options.budget is not None:
            shares = fair_shares(shares, self.options.budget)
        ends = {f: e["to"] + shares.get(f, 0) for f, e in entries.items()}
        prints = file_prints(self.options.path, {f: ends[f] for f in shares})
        self.known = {f: {"from": e["to"], "to": ends[f], "print": prints.get(f, e["print"]),
                          "goal": max(goals[f], ends[f])} for f, e in entries.items() if ends[f]}
        return self.known

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        # After a restart this call names the checkpointed position before the next end is chosen.
        self.known = dict(end)
        if start == end:
            return []
        return [p for file, e in sorted(end.items())
                for p in split_range(file, e["from"], e["to"], self.options.chunk)]

    def read(self, partition: FileRange):
        return read_range(self.options.path, partition)

    def commit(self, end: dict) -> None:
        pass


def is_level(offset: Mapping[str, Mapping]) -> bool:
    """Whether a position has reached all that the files held when its goals were set."""
    return all(e["to"] >= e["goal"] for e in offset.values())


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TailReader:
        return TailReader(_TailOptions(self.options))

    def streamReader(self, schema) -> TailStreamReader:
        return TailStreamReader(_TailOptions(self.options))


def register(spark: SparkSession) -> None:
    """Make the ``logtail`` format known to a session, filters included; workers need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LogTail)
    spark.conf.set(PUSHDOWN, "true")


def read(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """All complete lines the files hold now, or with ``lastLines`` the last ones of each file."""
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(folders.qualified(spark, path))


def read_stream(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """Lines as the files grow, from their start."""
    register(spark)
    return spark.readStream.format(FORMAT).options(**options).load(folders.qualified(spark, path))
