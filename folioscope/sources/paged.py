"""Folders of paged files as two data sources, and their pages as a plan over a table of files.

`folioscope_files` lists the files below a root's company folders, whatever their names begin with (Spark's own listing passes
over names that begin with an underscore or a point): a task for each company folder, nothing but names and sizes. Its columns
are company, source_pdf, stem, bytes and modified. Company folders that begin with a point are hidden, and what lies in a folder
of the archive's name is left out; only that is.

`folioscope_pages` reads pages: company, source_pdf, page (from 1), text, error. A task takes small files up to `bytes_a_task`
bytes, or a slice of a large file's pages; slices are shares of the page count, which nobody needs to know before the file is
open. The file is opened where its pages are read, so contents are never rows, and a page's text is only decoded if it is asked
for: give the schema to read fewer columns (`spark.read.schema("source_pdf string, page int")` counts pages without decoding one).
With the option pushdown, conditions on company, source_pdf and page are taken over: other folders aren't listed, other files
aren't opened, other pages aren't decoded. Spark wants spark.sql.python.filterPushdown.enabled for this, and refuses it otherwise.

`pages_of` does the same for files that a plan has chosen (what is still to do), without passing their names through the driver.

A file that can't be opened is one row with page null and an error. Empty folders and empty files' page lists give no rows.
Paths are of a local folder or of a store that Arrow's file systems know. Options: path (the root), pattern (default *.pdf), archive (the folder left out), company (only
companies whose name contains it, whatever its case), opener (module:function, see Opener), bytes_a_task.
"""

from __future__ import annotations

import hashlib
import importlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..config import EngineConfig
from .places import opened, place

#: An open file to its pages' texts: a sequence, of which an item is only asked for when that page is read. With an attribute
#: by_page that is true, an item costs no more than its own page, so a file may be read in slices.
Opener = Callable[[BinaryIO], Sequence[str]]

FILES = "company string, source_pdf string, stem string, bytes bigint, modified timestamp"
PAGES = "company string, source_pdf string, page int, text string, error string"
BYTES_A_TASK = 32 << 20
_ROWS = 256


def stem_of(name: str) -> str:
    """A file's name without what follows its last point."""
    return name.rpartition(".")[0] if "." in name[1:] else name


@dataclass(frozen=True)
class Listed:
    """What is listed of a root."""

    root: str
    pattern: str = "*.pdf"
    archive: str = EngineConfig.archive_dir
    company: str = ""
    #: Names that a pushed-down condition admits; None: all.
    only: frozenset[str] | None = None

    @classmethod
    def of(cls, options: dict[str, str]) -> Listed:
        if not options.get("path"):
            raise ValueError("give the root folder as path")
        root = options["path"].rstrip("/")
        return cls(f"file:{root}" if root.startswith("/") else root, options.get("pattern", cls.pattern), options.get("archive", cls.archive), options.get("company", ""))

    def companies(self) -> list[str]:
        """Names of the root's folders: one listing of one folder."""
        from pyarrow import fs

        system, at = place(self.root)
        found = system.get_file_info(fs.FileSelector(at))
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith("."))
        return [n for n in names if self.company.lower() in n.lower() and (self.only is None or n in self.only)]

    def files(self, company: str) -> Iterator[tuple[str, str, int, object]]:
        """Path, name, size and time of a company's files, by path."""
        from pyarrow import fs

        system, at = place(self.root)
        top = f"{at}/{company}"
        for f in sorted(system.get_file_info(fs.FileSelector(top, recursive=True)), key=lambda f: f.path):
            below = f.path[len(top) + 1 :]
            if f.type == fs.FileType.File and fnmatchcase(f.base_name, self.pattern) and self.archive not in below.split("/")[:-1]:
                yield f"{self.root}/{company}/{below}", f.base_name, f.size, f.mtime


def _batches(rows: Iterable[tuple], names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (of all columns) as batches of the schema's."""
    at, held = [names.index(f.name) for f in schema], []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in zip(at, schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in zip(at, schema, strict=True)], schema=schema)


def _arrow(schema: StructType, known: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    if odd := [f.name for f in schema if f.name not in [c.split()[0] for c in known.split(", ")]]:
        raise ValueError(f"no such columns: {', '.join(odd)}")
    return to_arrow_schema(schema)


@dataclass
class _Company(InputPartition):
    name: str


class FilesReader(DataSourceReader):
    def __init__(self, listed: Listed, schema: StructType):
        self.listed, self.schema = listed, _arrow(schema, FILES)

    def partitions(self) -> Sequence[InputPartition]:
        return [_Company(c) for c in self.listed.companies()]

    def read(self, partition: _Company) -> Iterator[pa.RecordBatch]:
        rows = ((partition.name, path, stem_of(name), size, modified) for path, name, size, modified in self.listed.files(partition.name))
        return _batches(rows, [c.split()[0] for c in FILES.split(", ")], self.schema)


class FilteringFilesReader(FilesReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if (names := _names(f, "company")) is None:
                yield f
            else:
                self.listed = _narrowed(self.listed, names)


class FolderFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folioscope_files"

    def schema(self) -> str:
        return FILES

    def reader(self, schema: StructType) -> FilesReader:
        return (FilteringFilesReader if _pushes(self.options) else FilesReader)(Listed.of(self.options), schema)


def _pushes(options: dict[str, str]) -> bool:
    return options.get("pushdown", "").lower() == "true"


def _names(f: Filter, column: str) -> frozenset | None:
    """The values that a condition admits of a column, if it is one that lists them."""
    if getattr(f, "attribute", None) != (column,):
        return None
    if isinstance(f, EqualTo):
        return frozenset([f.value])
    return frozenset(f.value) if isinstance(f, In) else None


def _narrowed(listed: Listed, names: frozenset[str]) -> Listed:
    return Listed(listed.root, listed.pattern, listed.archive, listed.company, names if listed.only is None else listed.only & names)


@dataclass(frozen=True)
class PageRange:
    """Pages that a condition admits."""

    low: int = 1
    high: int = 2**31 - 1
    only: frozenset[int] | None = None

    def with_(self, f: Filter) -> PageRange | None:
        """Under one more condition, if it is one on the page that can be taken over."""
        if getattr(f, "attribute", None) != ("page",):
            return None
        if (pages := _names(f, "page")) is not None:
            return PageRange(self.low, self.high, pages if self.only is None else self.only & pages)
        for kind, low, high in ((GreaterThan, 1, None), (GreaterThanOrEqual, 0, None), (LessThan, None, -1), (LessThanOrEqual, None, 0)):
            if type(f) is kind:
                return PageRange(self.low if low is None else max(self.low, f.value + low), self.high if high is None else min(self.high, f.value + high), self.only)
        return None

    @property
    def whole(self) -> bool:
        return self == PageRange()

    def of(self, first: int, last: int) -> Iterable[int]:
        """The admitted pages from first to last."""
        span = range(max(first, self.low), min(last, self.high) + 1)
        return span if self.only is None else sorted(p for p in self.only if p in span)


@dataclass(frozen=True)
class Slice:
    """The share `part` of `parts` of a file's pages."""

    company: str
    path: str
    part: int = 0
    parts: int = 1


def read_slice(s: Slice, opener: Opener, pages: PageRange = PageRange(), texts: bool = True) -> Iterator[tuple]:
    """Rows of PAGES. A page that can't be decoded is empty; a file that can't be opened is one row of its first slice."""
    try:
        with opened(s.path) as f:
            found = opener(f)
            n = len(found)
            for p in pages.of(s.part * n // s.parts + 1, (s.part + 1) * n // s.parts):
                yield s.company, s.path, p, (found[p - 1] or "") if texts else None, None
    except Exception as e:  # noqa: BLE001  becomes a row
        if s.part == 0 and pages.whole:
            yield s.company, s.path, None, "", str(e)[: EngineConfig.error_chars]


def packed(files: Iterable[tuple[str, str, int]], bytes_a_task: int, by_page: bool) -> Iterator[list[Slice]]:
    """Slices in lists of about bytes_a_task bytes: large files (company, path, bytes) cut, small ones together."""
    held, room = [], bytes_a_task
    for company, path, size in files:
        parts = max(1, -(-size // bytes_a_task)) if by_page else 1
        if parts > 1 or size >= bytes_a_task:
            yield from ([Slice(company, path, k, parts)] for k in range(parts))
            continue
        if held and size > room:
            yield held
            held, room = [], bytes_a_task
        held.append(Slice(company, path))
        room -= size
    if held:
        yield held


@dataclass
class _Slices(InputPartition):
    slices: list[Slice] = field(default_factory=list)


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.listed, self.schema = Listed.of(options), _arrow(schema, PAGES)
        module, _, name = options.get("opener", f"{__name__}:pypdf_opened").partition(":")
        self.opener: Opener = getattr(importlib.import_module(module), name)
        self.bytes_a_task = int(options.get("bytes_a_task", BYTES_A_TASK))
        self.paths: frozenset[str] | None = None
        self.pages = PageRange()

    def partitions(self) -> Sequence[InputPartition]:
        files = ((c, path, size) for c in self.listed.companies() for path, _, size, _ in self.listed.files(c) if self.paths is None or path in self.paths)
        return [_Slices(s) for s in packed(files, self.bytes_a_task, getattr(self.opener, "by_page", False))]

    def read(self, partition: _Slices) -> Iterator[pa.RecordBatch]:
        texts = "text" in self.schema.names
        rows = (row for s in partition.slices for row in read_slice(s, self.opener, self.pages, texts))
        return _batches(rows, [c.split()[0] for c in PAGES.split(", ")], self.schema)


class FilteringPagesReader(PagesReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if (names := _names(f, "company")) is not None:
                self.listed = _narrowed(self.listed, names)
            elif (paths := _names(f, "source_pdf")) is not None:
                self.paths = paths if self.paths is None else self.paths & paths
            elif (pages := self.pages.with_(f)) is not None:
                self.pages = pages
            else:
                yield f


class PagedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folioscope_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: StructType) -> PagesReader:
        return (FilteringPagesReader if _pushes(self.options) else PagesReader)(self.options, schema)


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session."""
    for source in (FolderFiles, PagedFiles):
        spark.dataSource.register(source)


def hashed(files: DataFrame) -> DataFrame:
    """files with source_hash, the first 16 hex digits of the content's SHA-1 (null: can't be read), read in pieces where the task is."""
    columns = [c for c in files.columns if c != "source_hash"]
    base = files.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = []
            for path in b.column("source_pdf").to_pylist():
                sha = hashlib.sha1(usedforsecurity=False)
                try:
                    with opened(path) as f:
                        while piece := f.read(1 << 20):
                            sha.update(piece)
                    said.append(sha.hexdigest()[:16])
                except Exception:  # noqa: BLE001  whoever reads its pages says why
                    said.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(said, pa.string())], names=[*b.schema.names, "source_hash"])

    return base.mapInArrow(run, StructType(list(base.schema)).add("source_hash", "string"))


def pages_of(files: DataFrame, opener: Opener | None = None, bytes_a_task: int = BYTES_A_TASK) -> DataFrame:
    """PAGES of the files of a table (company, source_pdf, bytes), which should be stored: it is counted first.

    Slices are rows; they are dealt over tasks, several to a task, before any file is opened.
    """
    opener = opener or pypdf_opened
    parts = F.greatest(F.lit(1), F.ceil(F.coalesce("bytes", F.lit(0)) / bytes_a_task)) if getattr(opener, "by_page", False) else F.lit(1)
    slices = files.select("company", "source_pdf", parts.cast("int").alias("parts")).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    n, cores = slices.count(), files.sparkSession.sparkContext.defaultParallelism
    dealt = slices.repartition(max(1, min(n, max(4 * cores, n // 8))), "source_pdf", "part")
    schema = pa.schema([("company", pa.string()), ("source_pdf", pa.string()), ("page", pa.int32()), ("text", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = (row for r in b.to_pylist() for row in read_slice(Slice(r["company"], r["source_pdf"], r["part"], r["parts"]), opener))
            yield from _batches(rows, schema.names, schema)

    return dealt.mapInArrow(run, PAGES)


def whole(decode: Callable[[bytes], list[str]]) -> Opener:
    """An opener of a function that decodes all pages at once; such files aren't cut."""
    return lambda f: decode(f.read())


class _PdfTexts(Sequence):
    def __init__(self, pages):
        self.pages = pages

    def __len__(self) -> int:
        return len(self.pages)

    def __getitem__(self, k):
        try:
            return self.pages[k].extract_text() or ""
        except Exception:  # noqa: BLE001  a page that can't be decoded is empty
            return ""


def pypdf_opened(f: BinaryIO) -> Sequence[str]:
    """Pages by the optional pypdf package, each decoded when it is asked for."""
    from pypdf import PdfReader

    return _PdfTexts(PdfReader(f).pages)


pypdf_opened.by_page = True
