"""Files of word tables as a data source, ``gridloom_pages``: in batches or as a stream, a partition for each group of files.

    spark.dataSource.register(PageSource)
    spark.read.format("gridloom_pages").load(root)
    spark.readStream.format("gridloom_pages").option("log", folder).load(root)

Planning reads names and sizes, tasks open the files.  As with Spark's own file sources the names of one load pass the planner;
``files.listed`` has no such limit.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from gridloom.sources.files import ARCHIVE, PORTION, PORTION_ROWS, content, decoded, joined, local, names_in, texts, write_file

SCHEMA = "folder string, name string, path string, value string, error string"
NAME = r"page.*_result\.tsv"
#: Files and bytes of a partition at most, but for a single file.
GROUP_FILES, GROUP_BYTES = 4096, 1 << 26
#: An archive counts as so many times its bytes, as tasks unpack it.
PACKED = 32


@dataclass
class Group(InputPartition):
    paths: list[str]


def walked(root: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of all page files and archives of them below a folder, by name."""
    top = local(root)
    folders = [os.path.abspath(top) if top is not None else root]
    while folders:
        folder = folders.pop()
        for name, inner in sorted(names_in(folder)):
            path = joined(folder, name)
            if inner:
                folders.append(path)
            elif re.fullmatch(NAME, name) or name.endswith(ARCHIVE):
                own = local(path)
                yield path, (os.path.getsize(own) if own is not None and os.path.exists(own) else 0) * (PACKED if name.endswith(ARCHIVE) else 1)


def grouped(files: list[tuple[str, int]], most: int) -> list[Group]:
    """Neighbouring files together, up to so many bytes."""
    out: list[Group] = []
    held = 0
    for path, size in files:
        if not out or held + size > most or len(out[-1].paths) == GROUP_FILES:
            out.append(Group([]))
            held = 0
        out[-1].paths.append(path)
        held += size
    return out


def read_group(group: Group) -> Iterator[pa.RecordBatch]:
    """A row for each page file, those in archives as well; an archive that breaks off ends with an error without a name."""
    names, rows, held = ["folder", "name", "path", "value", "error"], [], 0
    for path in group.paths:
        folder, name = path.rsplit("/", 1)
        for own, found, value, error in texts(path, decoded, True):
            if name.endswith(ARCHIVE):
                if own and not re.fullmatch(NAME, own):
                    continue
                rows.append((folder, own, path, value, error))
            else:
                rows.append((folder, name, path, value, error if found else "the file is gone"))
            held += len(value or "")
            if held > PORTION or len(rows) == PORTION_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names)


class PageSource(DataSource):
    """Options: path; group (bytes of a partition); for streams log (a shared folder that remembers which files each offset has)."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStream(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root, self.most = options["path"], int(options.get("group", GROUP_BYTES))

    def partitions(self) -> list[Group]:
        return grouped(list(walked(self.root)), self.most) or [Group([])]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        yield from read_group(partition)


class PageStream(DataSourceStreamReader):
    """An offset is a number; the log has a file for each with the paths that came with it.  A file is read once, however its time changes."""

    def __init__(self, options) -> None:
        self.root, self.most, self.log = options["path"], int(options.get("group", GROUP_BYTES)), options["log"]
        self.seen: set[str] | None = None
        self.last = 0

    def _entry(self, number: int) -> list[list]:
        data = content(joined(self.log, f"{number:012d}.json"))
        return json.loads(data) if data is not None else []

    def initialOffset(self) -> dict:
        return {"n": 0}

    def latestOffset(self) -> dict:
        if self.seen is None:
            self.seen = set()
            while entry := self._entry(self.last + 1):
                self.last += 1
                self.seen |= {p for p, _ in entry}
        new = [f for f in walked(self.root) if f[0] not in self.seen]
        if new:
            write_file(joined(self.log, f"{self.last + 1:012d}.json"), json.dumps(new).encode())
            self.last += 1
            self.seen |= {p for p, _ in new}
        return {"n": self.last}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        files = [tuple(f) for n in range(start["n"] + 1, end["n"] + 1) for f in self._entry(n)]
        return grouped(files, self.most)

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        yield from read_group(partition)

    def commit(self, end: dict) -> None:
        pass
