"""Gzip text files that roll by size, from a stream: the ``rolling`` data sink.

Options: ``path`` (root of the day folders, any file system Arrow writes), ``log``
(a folder of one query's own, as below its checkpoint), ``valueColumn``, ``dayColumn``,
``prefix`` of file names, ``rollBytes`` (text bytes of a file at most; a longer line
is a file of its own) and ``openDays`` (files a task has open at most; one more
closes the one that was written to longest ago).

Tasks write under ``_open``, which readers pass over. The driver's commit notes a
batch's files in the log first and then moves them to their days, so a batch shows
only after all its tasks are through, one cut off between is finished by the note
when the batch comes again, and what the second attempt wrote is dropped. Open files
last no longer than their batch: the trigger is the roll by time.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from penstock.sources import tail

FORMAT = "rolling"
# Name prefix, roll size, the folder name of a null day.
PREFIX = "log_"
ROLL_BYTES = 134217728
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
OPEN_FOLDER = "_open"
OPEN_DAYS = 16
MOVES_AT_ONCE = 16
#: Characters that Spark escapes in the names of partition folders.
ESCAPED = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


@dataclass
class Closed(WriterCommitMessage):
    """The files a task closed: name below ``_open`` and day folder of each."""

    files: list[tuple[str, str]]


class _OpenFile:
    """One file being written, and how many text bytes it holds."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.size = 0
        self._raw = system.open_output_stream(path)
        self._stream = pa.CompressedOutputStream(self._raw, "gzip")

    def write(self, data: pa.Buffer) -> None:
        self._stream.write(data)
        self.size += data.size

    def close(self) -> None:
        self._stream.close()
        self._raw.close()


def marked_lines(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """The values with their end marks as one run of bytes, and where each begins (and the last ends); null is empty."""
    filled = pc.fill_null(values.cast(pa.large_binary()), b"")
    lines = pc.binary_join_element_wise(filled, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    _, offsets, data = lines.buffers()
    return np.frombuffer(offsets, np.int64, len(lines) + 1, lines.offset * 8), data


class _Roller:
    """The open files of one task, by day."""

    def __init__(self, system: fs.FileSystem, root: str, roll_bytes: int, open_days: int) -> None:
        self.system, self.root, self.roll_bytes, self.open_days = system, root, roll_bytes, open_days
        self.open: dict[str, _OpenFile] = {}
        self.files: list[tuple[str, str]] = []

    def write(self, day: str, values: pa.Array) -> None:
        starts, data = marked_lines(values)
        first, last = 0, len(values)
        while first < last:
            file = self._file(day)
            fit = int(np.searchsorted(starts, starts[first] + self.roll_bytes - file.size, side="right")) - 1
            if fit <= first and file.size:
                self._close(day)
                continue
            stop = min(max(fit, first + 1), last)
            file.write(data.slice(starts[first], starts[stop] - starts[first]))
            first = stop

    def _file(self, day: str) -> _OpenFile:
        file = self.open.pop(day, None)
        if file is None:
            if len(self.open) >= self.open_days:
                self._close(next(iter(self.open)))
            name = uuid.uuid4().hex
            file = _OpenFile(self.system, f"{self.root}/{name}")
            self.files.append((name, day))
        self.open[day] = file  # last in order: written to just now
        return file

    def _close(self, day: str) -> None:
        self.open.pop(day).close()

    def close(self) -> None:
        for day in list(self.open):
            self._close(day)


class RollingWriter(DataSourceStreamArrowWriter):
    """See the module."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.log = options["log"].rstrip("/")
        self.value = options.get("valueColumn", "value")
        self.day = options.get("dayColumn", "load_date")
        self.prefix = options.get("prefix", PREFIX)
        self.roll_bytes = int(options.get("rollBytes", ROLL_BYTES))
        self.open_days = int(options.get("openDays", OPEN_DAYS))
        if self.roll_bytes < 1 or self.open_days < 1:
            raise ValueError("rollBytes and openDays must be positive")
        # Queries that share a root don't clear each other's open files.
        self.mine = f"{OPEN_FOLDER}/{hashlib.sha256(self.log.encode()).hexdigest()[:16]}"

    def _root(self) -> tuple[fs.FileSystem, str]:
        return tail._file_system(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Closed:
        system, root = self._root()
        system.create_dir(f"{root}/{self.mine}", recursive=True)
        roller = _Roller(system, f"{root}/{self.mine}", self.roll_bytes, self.open_days)
        for batch in iterator:
            days, values = batch.column(self.day), batch.column(self.value)
            for day in pc.unique(days):
                chosen = pc.equal(days, day) if day.is_valid else pc.is_null(days)
                roller.write(self._folder(day.as_py()), values.filter(chosen))
        roller.close()
        return Closed(roller.files)

    def _folder(self, day: str | None) -> str:
        return f"{self.day}=" + (ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(day)) if day else NO_DAY)

    def _note(self, batch: int) -> tuple[fs.FileSystem, str]:
        system, log = tail._file_system(self.log)
        return system, f"{log}/{batch}.json"

    def _noted(self, batch: int) -> bool:
        system, note = self._note(batch)
        return system.get_file_info(note).type == fs.FileType.File

    def _files(self, messages: list[Closed | None], batch: int) -> list[list[str]]:
        """The batch's files as first noted; notes them if they are not."""
        system, note = self._note(batch)
        if not self._noted(batch):
            files = [f for m in messages if m is not None for f in m.files]
            system.create_dir(note.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(f"{note}.tmp") as out:
                out.write(json.dumps(files).encode())
            system.move(f"{note}.tmp", note)
        with system.open_input_stream(note) as noted:
            return json.loads(noted.read())

    def commit(self, messages: list[Closed | None], batchId: int) -> None:
        system, root = self._root()
        files = self._files(messages, batchId)
        for folder in {folder for _, folder in files}:
            system.create_dir(f"{root}/{folder}", recursive=True)

        def move(file: list[str]) -> None:
            name, folder = file
            # One that is not there was moved by an earlier attempt, and may have expired since.
            if system.get_file_info(f"{root}/{self.mine}/{name}").type == fs.FileType.File:
                system.move(f"{root}/{self.mine}/{name}", f"{root}/{folder}/{self.prefix}{batchId}-{name}.txt.gz")

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(move, files))
        self._clear()
        # Only the batch that was last may come again.
        if batchId and self._noted(batchId - 1):
            log, note = self._note(batchId - 1)
            log.delete_file(note)

    def abort(self, messages: list[Closed | None], batchId: int) -> None:
        # After the note, open files belong to the batch: its next attempt moves them.
        if not self._noted(batchId):
            self._clear()

    def _clear(self) -> None:
        system, root = self._root()
        system.delete_dir_contents(f"{root}/{self.mine}", missing_dir_ok=True)


class Rolling(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> RollingWriter:
        return RollingWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the ``rolling`` format known to a session; workers need no copy of this package."""
    for module in (sys.modules[__name__], tail):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(Rolling)
