"""Data sources for Spark's readers and writers: SQLite files, and the stored pages of a portal.

``register(spark)`` makes both known and lets filters reach them::

    spark.read.format("lexmill_sqlite").option("path", p).option("table", "catalog").load().where("anio >= 2000")
    spark.read.format("lexmill_pages").option("path", p).option("row_pattern", "<tr>").load().where("anio = 2024")

A SQLite table is read in ranges of its rowid (or of the integer column ``key``) of ``rows`` rows, a task
each; comparisons with numbers, texts and nulls run inside SQLite, and those on the key also leave out
ranges. Written, each task makes a file of its own in the folder, and the commit names the files that count.

Stored pages lie as ``<path>/<year>/<number>.<extension>``. A task takes one year of the window that the
filters leave, goes through its pages by number, and stops after ``misses`` pages in a row without a
match of ``row_pattern``, as a crawl of that listing would.

Files may be on any store: what is not local is fetched to the task's temporary folder for as long as it
is read.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import sqlite3
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

ROWS = 100_000
COMMITTED = "_committed.json"


def register(spark: SparkSession) -> None:
    """Makes the sources known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    spark.dataSource.register(PagesSource)


def _store(path: str):
    """(file system, path) of a folder or file on any store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


@contextlib.contextmanager
def _local(path: str) -> Iterator[str]:
    """A local copy of a file, or the file itself where it is local."""
    from pyarrow import fs

    store, name = _store(path)
    if isinstance(store, fs.LocalFileSystem):
        yield name
        return
    with tempfile.TemporaryDirectory() as folder:
        there = os.path.join(folder, "copy.sqlite")
        with store.open_input_stream(name) as src, open(there, "wb") as dst:
            while data := src.read(1 << 20):
                dst.write(data)
        yield there


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


#: How SQLite tells a column's affinity from its declared type, in order.
AFFINITY = (("INT", LongType()), ("CHAR", StringType()), ("CLOB", StringType()), ("TEXT", StringType()), ("BLOB", BinaryType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()))
_SQL_TYPE = {LongType(): "INTEGER", IntegerType(): "INTEGER", BooleanType(): "INTEGER", DoubleType(): "REAL", BinaryType(): "BLOB"}
_COMPARED = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}


def _files(path: str) -> list[str]:
    """The SQLite files of a path: itself, or those that a folder's commit names, or all in it."""
    from pyarrow import fs

    store, name = _store(path)
    if store.get_file_info(name).type == fs.FileType.File:
        return [path]
    inside = {os.path.basename(i.path): i for i in store.get_file_info(fs.FileSelector(name))}
    if COMMITTED in inside:
        with store.open_input_stream(f"{name}/{COMMITTED}") as f:
            names = json.loads(f.read())["files"]
    else:
        names = sorted(n for n, i in inside.items() if i.is_file and not n.startswith(("_", ".")))
    return [f"{path.rstrip('/')}/{n}" for n in names]


def _connect(name: str) -> sqlite3.Connection:
    from urllib.parse import quote

    return sqlite3.connect(f"file:{quote(name)}?mode=ro", uri=True)


@dataclass
class FileRange(D.InputPartition):
    """Rows of a file whose key is in a closed range; no range: all rows."""

    path: str
    low: int | None = None
    high: int | None = None


class SqliteSource(D.DataSource):
    """options: path, table, key (integer column to deal rows by; default the rowid), rows (a task)."""

    @classmethod
    def name(cls) -> str:
        return "lexmill_sqlite"

    def schema(self) -> StructType:
        for path in _files(self.options["path"]):
            with _local(path) as name, contextlib.closing(_connect(name)) as db:
                found = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
            if found:
                kind = lambda declared: next((t for part, t in AFFINITY if part in declared.upper()), StringType())
                return StructType([StructField(n, kind(declared or "BLOB"), True) for _, n, declared, *_ in found])
        raise ValueError(f"no table {self.options['table']!r} in {self.options['path']!r}")

    def reader(self, schema: StructType) -> D.DataSourceReader:
        return SqliteReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> D.DataSourceWriter:
        return SqliteWriter(schema, self.options, overwrite)


class SqliteReader(D.DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema, self.path, self.table = schema, options["path"], options["table"]
        self.key, self.rows = options.get("key"), int(options.get("rows", ROWS))
        self.terms: list[tuple[str, list]] = []
        self.low: int | None = None
        self.high: int | None = None

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            term = self._term(f)
            if term is None:
                yield f
            else:
                self.terms.append(term)

    def _term(self, f: D.Filter, narrow: bool = True) -> tuple[str, list] | None:
        """SQL and values of a filter that means the same in SQLite; None: Spark has to apply it."""
        if isinstance(f, D.Not):
            inner = self._term(f.child, False)
            return inner and (f"NOT ({inner[0]})", inner[1])
        if not hasattr(f, "attribute") or len(f.attribute) != 1 or f.attribute[0] not in self.schema.fieldNames():
            return None
        name, kind = f.attribute[0], self.schema[f.attribute[0]].dataType
        plain = lambda v: (isinstance(v, int) and not isinstance(v, bool) and isinstance(kind, LongType)) or (isinstance(v, str) and isinstance(kind, StringType))
        if isinstance(f, (D.IsNull, D.IsNotNull)):
            return f"{_quoted(name)} IS {'NOT ' * isinstance(f, D.IsNotNull)}NULL", []
        if isinstance(f, D.In):
            return (f"{_quoted(name)} IN ({', '.join('?' * len(f.value))})", list(f.value)) if f.value and all(map(plain, f.value)) else None
        if isinstance(f, D.StringStartsWith) and isinstance(kind, StringType):
            return f"substr({_quoted(name)}, 1, ?) = ?", [len(f.value), f.value]
        sign = _COMPARED.get(type(f))
        if sign is None or not plain(f.value):
            return None
        if narrow and name == self.key:  # ranges outside are not even made
            if sign in ("=", ">=", ">"):
                self.low = max(f.value + (sign == ">"), f.value if self.low is None else self.low)
            if sign in ("=", "<=", "<"):
                self.high = min(f.value - (sign == "<"), f.value if self.high is None else self.high)
        return f"{_quoted(name)} {sign} ?", [f.value]

    def _key(self) -> str:
        return _quoted(self.key) if self.key else "rowid"

    def partitions(self) -> list[FileRange]:
        out = []
        for path in _files(self.path):
            with _local(path) as name, contextlib.closing(_connect(name)) as db:
                low, high = db.execute(f"SELECT min({self._key()}), max({self._key()}) FROM {_quoted(self.table)}").fetchone()
                nulls = self.key and db.execute(f"SELECT 1 FROM {_quoted(self.table)} WHERE {self._key()} IS NULL LIMIT 1").fetchone()
            if nulls and self.low is None and self.high is None:
                out.append(FileRange(path))  # rows without a key
            if low is None:
                continue
            low, high = max(low, low if self.low is None else self.low), min(high, high if self.high is None else self.high)
            out += [FileRange(path, a, min(a + self.rows - 1, high)) for a in range(low, high + 1, self.rows)]
        return out or [FileRange("")]

    def read(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        where = [(f"{self._key()} IS NULL", [])] if part.low is None else [(f"{self._key()} BETWEEN ? AND ?", [part.low, part.high])]
        where += self.terms
        columns = ", ".join(_quoted(f.name) for f in self.schema)
        kinds = [{LongType(): pa.int64(), DoubleType(): pa.float64(), BinaryType(): pa.binary()}.get(f.dataType, pa.string()) for f in self.schema]
        with _local(part.path) as name, contextlib.closing(_connect(name)) as db:
            found = db.execute(f"SELECT {columns} FROM {_quoted(self.table)} WHERE {' AND '.join(f'({s})' for s, _ in where)}", [v for _, values in where for v in values])
            while rows := found.fetchmany(4096):
                yield pa.RecordBatch.from_arrays([pa.array([_as(v, k) for v in c], k) for c, k in zip(zip(*rows), kinds)], names=self.schema.fieldNames())


def _as(v, kind: pa.DataType):
    """A value of a column as its type; SQLite lets a column hold others: those that do not fit are null."""
    if v is None:
        return None
    try:
        if kind == pa.int64():
            return int(v)
        if kind == pa.float64():
            return float(v)
        if kind == pa.binary():
            return v if isinstance(v, bytes) else str(v).encode()
        return v.decode(errors="replace") if isinstance(v, bytes) else str(v)
    except (ValueError, OverflowError):
        return None


@dataclass
class Written(D.WriterCommitMessage):
    file: str
    rows: int


class SqliteWriter(D.DataSourceWriter):
    """A file a task; ``append`` keeps the files of the commit before, ``overwrite`` does not name them any more."""

    def __init__(self, schema: StructType, options, overwrite: bool):
        self.schema, self.path, self.table, self.overwrite = schema, options["path"], options["table"], overwrite

    def write(self, rows) -> Written:
        declared = ", ".join(f"{_quoted(f.name)} {_SQL_TYPE.get(f.dataType, 'TEXT')}" for f in self.schema)
        store, folder = _store(self.path)
        file, count = f"{uuid.uuid4().hex}.sqlite", 0
        plain = lambda v: v if v is None or isinstance(v, (int, float, str, bytes)) else bytes(v) if isinstance(v, bytearray) else str(v)
        with tempfile.TemporaryDirectory() as mine:
            with contextlib.closing(sqlite3.connect(f"{mine}/new")) as db:
                db.execute(f"CREATE TABLE {_quoted(self.table)} ({declared})")

                def values():
                    nonlocal count
                    for r in rows:
                        count += 1
                        yield tuple(map(plain, r))

                db.executemany(f"INSERT INTO {_quoted(self.table)} VALUES ({', '.join('?' * len(self.schema))})", values())
                db.commit()
            store.create_dir(folder, recursive=True)
            with open(f"{mine}/new", "rb") as src, store.open_output_stream(f"{folder}/{file}") as dst:
                while data := src.read(1 << 20):
                    dst.write(data)
        return Written(file, count)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, folder = _store(self.path)
        before = [] if self.overwrite or store.get_file_info(f"{folder}/{COMMITTED}").type != fs.FileType.File else [os.path.basename(f) for f in _files(self.path)]
        with store.open_output_stream(f"{folder}/{COMMITTED}.new") as out:
            out.write(json.dumps({"files": before + [m.file for m in messages if m]}).encode())
        store.move(f"{folder}/{COMMITTED}.new", f"{folder}/{COMMITTED}")

    def abort(self, messages) -> None:
        store, folder = _store(self.path)
        for m in messages:
            if m:
                with contextlib.suppress(OSError):
                    store.delete_file(f"{folder}/{m.file}")


@dataclass
class Year(D.InputPartition):
    year: int
    folder: str


class PagesSource(D.DataSource):
    """options: path, row_pattern (what a page with results holds; default any page), misses (default 1)."""

    @classmethod
    def name(cls) -> str:
        return "lexmill_pages"

    def schema(self) -> str:
        return "anio int, pagina int, contenido string"

    def reader(self, schema: StructType) -> D.DataSourceReader:
        return PagesReader(self.options)


class PagesReader(D.DataSourceReader):
    def __init__(self, options):
        self.path, self.pattern, self.misses = options["path"], options.get("row_pattern"), int(options.get("misses", 1))
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            sign = "in" if isinstance(f, D.In) else _COMPARED.get(type(f))
            if sign and f.attribute == ("anio",) and f.value is not None:
                self.tests.append((sign, f.value))
            elif not (isinstance(f, D.IsNotNull) and f.attribute == ("anio",)):
                yield f

    def _wanted(self, year: int) -> bool:
        test = {"=": year.__eq__, ">": year.__gt__, ">=": year.__ge__, "<": year.__lt__, "<=": year.__le__, "in": lambda v: year in v}
        return all(test[sign](value) for sign, value in self.tests)

    def partitions(self) -> list[Year]:
        from pyarrow import fs

        store, folder = _store(self.path)
        years = [int(os.path.basename(i.path)) for i in store.get_file_info(fs.FileSelector(folder)) if not i.is_file and re.fullmatch(r"\d{4}", os.path.basename(i.path))]
        return [Year(y, f"{folder}/{y}") for y in sorted(years) if self._wanted(y)] or [Year(0, "")]

    def read(self, part: Year) -> Iterator[tuple]:
        from pyarrow import fs

        if not part.folder:
            return
        store, _ = _store(self.path)
        pages = sorted((int(m.group(1)), i.path) for i in store.get_file_info(fs.FileSelector(part.folder)) if i.is_file and (m := re.match(r"(\d+)\.", os.path.basename(i.path))))
        missed = 0
        for number, name in pages:
            with store.open_input_stream(name) as f:
                text = f.read().decode("utf-8", errors="replace")
            if self.pattern and not re.search(self.pattern, text):
                missed += 1
                if missed >= self.misses:
                    return
                continue
            missed = 0
            yield part.year, number, text
