"""Files and their pages. Decoding is a function given by the caller: bytes to page texts."""

from __future__ import annotations

import shutil
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from . import paged
from .places import created, opened, place

Decoder = Callable[[bytes], list[str]]


def qualified(spark: SparkSession, path: str) -> str:
    """path as Spark's readers write it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def company_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of root's folders that aren't hidden. One listing of one folder, which the driver does for every read anyway."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and not f.getPath().getName().startswith("."))


def _listed(spark: SparkSession, root: str, pattern: str, archive: str) -> DataFrame:
    paged.register(spark)
    return spark.read.format("folioscope_files").option("pattern", pattern).option("archive", archive).load(qualified(spark, root))


def list_files(spark: SparkSession, root: str, pattern: str = "*.pdf", config: EngineConfig = EngineConfig()) -> DataFrame:
    """company, source_pdf, stem, bytes of all files below root's company folders, whatever their names; hidden company folders and archives are left out. No file is opened."""
    return _listed(spark, root, pattern, config.archive_dir).select("company", "source_pdf", "stem", "bytes")


def list_outputs(spark: SparkSession, root: str, config: EngineConfig = EngineConfig()) -> DataFrame:
    """company, path, kind, year, short and name of sections and copies below an output folder; none where it isn't there yet."""
    if not exists(spark, root):
        return spark.createDataFrame([], "company string, path string, kind string, year string, short string, name string")
    raw = _listed(spark, root, "*.pdf", "").withColumnRenamed("source_pdf", "path")
    prefix = qualified(spark, root) + "/"
    folder = F.regexp_replace(F.regexp_replace(F.substr("path", F.lit(len(prefix) + 1)), "/[^/]*$", ""), "^[^/]*/", "")
    file = F.element_at(F.split("path", "/"), -1)
    rows = raw.select("company", "path", folder.alias("folder"), presence(file).alias("o"))
    return rows.where(((F.col("folder") == config.sections_dir) & (F.col("o.kind") == "section")) | (F.col("folder") == config.missing_dir)).select("company", "path", F.when(F.col("folder") == config.missing_dir, "copy").otherwise("section").alias("kind"), "o.year", "o.short", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.pdf$", "").alias("name"))


def companies_without_files(spark: SparkSession, root: str, listed: DataFrame, only: str = "") -> DataFrame:
    """company: root's company folders of which listed (company) has no file."""
    names = [(n,) for n in company_folders(spark, root) if only.lower() in n.lower()]
    return spark.createDataFrame(names, "company string").join(listed.select("company").distinct(), "company", "left_anti")


def companies(files: DataFrame, only: str | None = None) -> DataFrame:
    """files of companies whose name contains `only`, whatever its case."""
    return files if not only else files.where(F.contains(F.lower("company"), F.lit(only.lower())))


def read_pages(files: DataFrame, decode: Decoder | None = None) -> DataFrame:
    """company, source_pdf, page, text, error of files (company, source_pdf, bytes), which should be stored. An unreadable file is one row with page null and an error; one bad file fails no job."""
    return paged.pages_of(files, None if decode in (None, pypdf_pages) else decode if getattr(decode, "by_page", False) else paged.whole(decode))


def pypdf_pages(content: bytes) -> list[str]:
    """Page texts by the optional pypdf package; a page that can't be read is empty."""
    import io

    from pypdf import PdfReader

    out = []
    for page in PdfReader(io.BytesIO(content)).pages:
        try:
            out.append(page.extract_text() or "")
        except Exception:  # noqa: BLE001
            out.append("")
    return out


def pypdf_write(source: str, start: int, end: int, target: str) -> None:
    """Writes pages of a file as a file of their own, by the optional pypdf package."""
    from pypdf import PdfReader, PdfWriter

    with opened(source) as f:
        reader, writer = PdfReader(f), PdfWriter()
        for i in range(start - 1, end):
            writer.add_page(reader.pages[i])
        with created(target) as out:
            writer.write(out)


def write_sections(records: DataFrame, write: Callable[[str, int, int, str], None], root: str) -> DataFrame:
    """records with the outcome of write(source, start, end, target) for those of result ok, on the executors; target is below root.

    The end is held between the start and the last page (n_pages). What can't be written becomes result error, with the reason as
    evidence and without path and pages; it fails no other record. Writing again replaces a file, so a task may be run twice.
    """
    columns = records.drop("n_pages").columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b.copy()
            for i in b.index[b["result"] == "ok"]:
                start, n = int(b.at[i, "extract_page"]), int(b.at[i, "n_pages"])
                end = max(start, min(int(b.at[i, "extract_end_page"]), n))
                try:
                    if not 1 <= start <= n:
                        raise ValueError(f"start_out_of_range_(pdf_has_{n})")
                    write(b.at[i, "source_pdf"], start, end, f"{root}/{b.at[i, 'new_path']}")
                    out.at[i, "extract_end_page"] = end
                except Exception as e:  # noqa: BLE001  becomes a row
                    out.loc[i, ["result", "evidence"]] = ["error", f"save_fail:{e}"[: EngineConfig().error_chars]]
                    out.loc[i, ["extract_page", "extract_end_page", "new_path"]] = None
            for c in ("extract_page", "extract_end_page"):
                out[c] = out[c].astype("Int32")
            yield out[columns]

    return records.mapInPandas(run, records.drop("n_pages").schema)


def copy_files(pairs: DataFrame) -> DataFrame:
    """pairs (source, target) with status, copying on the executors what isn't there yet: copied, present or the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for b in batches:
            said = []
            for source, target in zip(b["source"], b["target"], strict=True):
                try:
                    system, at = place(target)
                    if system.get_file_info(at).type != fs.FileType.NotFound:
                        said.append("present")
                        continue
                    with opened(source) as f, created(target) as out:
                        shutil.copyfileobj(f, out, 1 << 20)
                    said.append("copied")
                except Exception as e:  # noqa: BLE001  becomes a row
                    said.append(f"copy_failed:{e}"[: EngineConfig().error_chars])
            yield b.assign(status=said)

    return pairs.select("source", "target").mapInPandas(run, "source string, target string, status string")


def presence(outputs: Column) -> Column:
    """kind, year, short and name of an output's file name."""
    section = F.regexp_extract(outputs, r"^(.*?)__(.*)__cag_p[0-9]+(?:-[0-9]+)?_en\.pdf$", 1)
    return F.when(section != "", F.struct(F.lit("section").alias("kind"), section.alias("year"), F.regexp_extract(outputs, r"^(.*?)__(.*)__cag_p[0-9]+(?:-[0-9]+)?_en\.pdf$", 2).alias("short"), F.lit(None).cast("string").alias("name"))).otherwise(F.struct(F.lit("copy").alias("kind"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("short"), F.regexp_replace(outputs, r"\.pdf$", "").alias("name")))
