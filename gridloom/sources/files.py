"""Files by their paths: folders listed level by level, listed files opened one by one, both inside tasks.

Names that begin with _ or . count like any other, and nothing is opened but what is asked for.  Local paths and file: URIs go through the
operating system, other schemes through Arrow's file systems.  What goes wrong with a file stands in its row.
"""

from __future__ import annotations

import os
import re
import tarfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.sources.store import kept

#: What one task hands on at a time, in bytes and rows.
PORTION, PORTION_ROWS = 1 << 26, 10_000
#: How the name of a file ends that holds files of its folder, one after the other, as a gzipped tar.
ARCHIVE = ".pages.tar.gz"


def local(path: str) -> str | None:
    """The path in the operating system, for paths that have one."""
    if re.match(r"file:/", path):
        return re.sub(r"\Afile:/+", "/", path)
    return None if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path) else path


def joined(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def names_in(folder: str) -> Iterator[tuple[str, bool]]:
    """(name, whether it is a folder) of what lies in a folder; folders that can't be read have nothing, links to folders aren't followed."""
    own = local(folder)
    try:
        if own is not None:
            with os.scandir(own) as found:
                for e in found:
                    if e.is_dir(follow_symlinks=False) or not e.is_dir():
                        yield e.name, e.is_dir()
            return
        system, path = fs.FileSystem.from_uri(folder)
        for info in system.get_file_info(fs.FileSelector(path)):
            yield info.base_name, info.type == fs.FileType.Directory
    except OSError:
        return


def content(path: str) -> bytes | None:
    """The bytes of a file, none where there is no file; other failures are raised."""
    own = local(path)
    if own is not None:
        if not os.path.isfile(own):
            return None
        with open(own, "rb") as f:
            return f.read()
    system, inner = fs.FileSystem.from_uri(path)
    if system.get_file_info(inner).type != fs.FileType.File:
        return None
    with system.open_input_stream(inner) as f:
        return f.read()


def members(path: str) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the files in an archive, read once from its beginning to its end."""
    own = local(path)
    if own is not None:
        stream = open(own, "rb")
    else:
        system, inner = fs.FileSystem.from_uri(path)
        stream = system.open_input_stream(inner, compression=None)
    with stream, tarfile.open(fileobj=stream, mode="r|gz") as archive:
        while (m := archive.next()) is not None:
            if m.isfile():
                yield m.name.rsplit("/", 1)[-1], archive.extractfile(m).read()
            archive.members.clear()


@contextmanager
def whole_file(path: str) -> Iterator:
    """A stream to a file that has its name once it is whole, so a task that runs again replaces it."""
    own = local(path)
    if own is None:
        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        aside = f"{inner}.{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(aside) as f:
            yield f
        system.move(aside, inner)
        return
    os.makedirs(os.path.dirname(own), exist_ok=True)
    aside = f"{own}.{uuid.uuid4().hex}.tmp"
    with open(aside, "wb") as f:
        yield f
    os.replace(aside, own)


def write_file(path: str, data: bytes) -> None:
    with whole_file(path) as f:
        f.write(data)


def listed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """folder and name of all files below a folder whose whole name fits ``pattern``; no file is opened.

    Each level of folders is one job over those found before, so neither the driver nor one task lists the tree.
    """
    top = local(root)
    start = os.path.abspath(top) if top is not None else root

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = re.compile(pattern)
        for batch in parts:
            for folder in batch.column(0).to_pylist():
                rows: list[tuple[str, bool]] = []
                for name, inner in names_in(folder):
                    if inner or fits.fullmatch(name):
                        rows.append((name, inner))
                    if len(rows) == 10_000:
                        yield _names(folder, rows)
                        rows = []
                yield _names(folder, rows)

    out = None
    here = spark.createDataFrame([(start,)], "folder string")
    while True:
        found = kept(here.mapInArrow(look, "folder string, name string, inner boolean"))
        files = found.filter("not inner").select("folder", "name")
        out = files if out is None else out.unionByName(files)
        here = found.filter("inner").select(F.concat(F.rtrim("folder", F.lit("/")), F.lit("/"), "name").alias("folder"))
        if here.isEmpty():
            return out
        here = here.repartition(spark.sparkContext.defaultParallelism * 4)


def _names(folder: str, rows: list[tuple[str, bool]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([folder] * len(rows), pa.string()), pa.array([n for n, _ in rows], pa.string()), pa.array([i for _, i in rows], pa.bool_())], ["folder", "name", "inner"])


def texts(path: str | None, parse: Callable[[bytes], str | None], inside: bool = False) -> Iterator[tuple[str, bool, str | None, str | None]]:
    """(name in its archive, found, text, error) of the file at a path, with ``inside`` of each file in an archive.  An archive that breaks off ends with an error without a name."""

    def one(data: bytes) -> tuple[str | None, str | None]:
        try:
            return parse(data), None
        except Exception as e:
            return None, str(e) or type(e).__name__

    try:
        if inside and path and path.endswith(ARCHIVE):
            for name, data in members(path):
                yield name, True, *one(data)
            return
        data = content(path) if path else None
        yield "", data is not None, *(one(data) if data is not None else (None, None))
    except Exception as e:
        yield "", True, None, str(e) or type(e).__name__


def opened(rows: DataFrame, path: str, parse: Callable[[bytes], str | None], value: str = "value", inside: str | None = None) -> DataFrame:
    """``rows`` with found, ``value`` (what ``parse`` makes of the file at ``path``) and error.

    A file that isn't there isn't found and has neither value nor error; one that can't be read or parsed is found and
    has an error, its kind and its message.  Exactly these files are opened, each where its row is; rows are dealt evenly first.
    With ``inside``, the column of names, an archive gives a row for each file in it, named there.
    """
    schema = StructType([*rows.schema.fields]).add("found", "boolean").add(value, "string").add("error", "string")
    names = [f.name for f in schema.fields]

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out, held = [], 0
            for i, name in enumerate(batch.column(batch.schema.get_field_index(path)).to_pylist()):
                archive = bool(inside and name and name.endswith(ARCHIVE))
                for own, *rest in texts(name, parse, archive):
                    out.append((i, own if archive else None, *rest))
                    held += len(rest[1] or "")
                    if held > PORTION or len(out) == PORTION_ROWS:
                        yield _with(batch, out, names, inside)
                        out, held = [], 0
            yield _with(batch, out, names, inside)

    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(read, schema)


def _with(batch: pa.RecordBatch, out: list[tuple], names: list[str], inside: str | None) -> pa.RecordBatch:
    at, own, found, text, error = list(zip(*out, strict=True)) or [()] * 5
    kept = dict(zip(batch.schema.names, batch.take(pa.array(at, pa.int64())).columns, strict=True))
    if inside:
        kept[inside] = pa.array([old if new is None else new for old, new in zip(kept[inside].to_pylist(), own, strict=True)], pa.string())
    return pa.RecordBatch.from_arrays([*kept.values(), pa.array(found, pa.bool_()), pa.array(text, pa.string()), pa.array(error, pa.string())], names)


def decoded(data: bytes) -> str:
    """UTF-8 with or without a byte order mark; what isn't UTF-8 becomes U+FFFD."""
    return data.decode("utf-8-sig", "replace")
