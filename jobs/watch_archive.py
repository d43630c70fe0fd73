"""Takes what is new in a growing archive: locates the sections of new files and renews the summaries of their companies.

The documents table is read as a file stream; each run takes the Parquet files that came since the last one, in batches, and
ends. The stream's checkpoint below the output folder is the mark of what has been taken. Of a batch, documents whose path and
content have been taken before are passed over; the others become

- records/company=.../batch=.../: a row for each file, with its decision (first pass), section text and the batch it came in;
- companies/company=.../: a row for each company of the batch, made anew from all its records: files, sections, years with and
  without a section, and where its sections usually begin.

A later content of a path replaces the earlier one in the summaries (its records stay). A batch that is repeated after a failure
replaces its own partitions by the same rows and doesn't look at what its first attempt left. Only companies with new
files are read and written again.
"""

from __future__ import annotations

import logging
import sys
from dataclasses import dataclass
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from folioscope.config import EngineConfig  # noqa: E402
from folioscope.functions import text as T  # noqa: E402
from folioscope.operators import ledger, locate, recover, verdict  # noqa: E402
from folioscope.operators.locate import FILE  # noqa: E402
from folioscope.plans import passes  # noqa: E402
from folioscope.sources import corpus, files as sources  # noqa: E402
from folioscope.sources.tables import discard, spread, stored  # noqa: E402
from jobs.common import main, write_partitions  # noqa: E402

log = logging.getLogger("jobs.watch_archive")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RECORDS = "source_pdf string, stem string, source_hash string, year string, action string, result string, method string, evidence string, extract_page int, extract_end_page int, new_path string, n_section_pages bigint, text string, company string, batch bigint"

COMPANIES = "n_files bigint, n_sections bigint, years_present string, years_missing string, min_page int, max_page int, median_page int, company string"


@dataclass(frozen=True)
class Settings:
    #: Only companies whose name contains this; empty: all. A checkpoint belongs to one value of it.
    company: str = ""
    #: Parquet files of the table in a batch.
    files_a_batch: int = 1000


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the output; empty before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _records(spark: SparkSession, output: str) -> DataFrame:
    return _read(spark, f"{output}/records", RECORDS)


def _latest(records: DataFrame) -> DataFrame:
    """Of each path the record of the last batch, without its text; of several contents of one batch the greatest hash."""
    narrow = records.drop("text")
    return narrow.groupBy("company", "source_pdf").agg(F.max_by(F.struct(*(c for c in narrow.columns if c not in FILE)), F.struct("batch", "source_hash")).alias("r")).select(*FILE, "r.*")


def _summaries(records: DataFrame, config: EngineConfig) -> DataFrame:
    """A row for each company of records."""
    own = _latest(records)
    found = own.where("result = 'ok'")
    years = ledger.coverage(own, found.select("company", "year", F.col("new_path").alias("path")), config)
    listed = lambda status: F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("year")))), ",")
    by_year = years.groupBy("company").agg(listed("present_clean").alias("years_present"), listed("missing_extract").alias("years_missing"))
    usual = recover.consensus(found.select("company", F.col("extract_page").alias("start")), config).drop("pages", "n_years")
    counts = own.groupBy("company").agg(F.count("*").alias("n_files"), F.count_if(F.col("result") == "ok").cast("bigint").alias("n_sections"))
    return counts.join(by_year, "company", "left").join(usual, "company", "left").fillna("", ["years_present", "years_missing"])


def _take(batch: DataFrame, number: int, output: str, settings: Settings, told: dict) -> None:
    spark, config = batch.sparkSession, EngineConfig()
    kept = [c for c in ("doc_id", "text", "source") if c in batch.columns]
    archive = sources.companies(corpus.active(corpus.files_of(batch.select(*kept))), settings.company).where("source_pdf is not null")
    archive = archive.withColumn("source_hash", T.content_hash(F.coalesce("text", F.lit(""))))
    named = stored(archive.select("company", "source_pdf", "source_hash").groupBy(*FILE).agg(F.max("source_hash").alias("source_hash")), "named")
    companies = named.select("company").distinct()
    # partitions of other companies aren't read
    earlier = _records(spark, output).where(F.col("batch") < number).join(F.broadcast(companies) if companies.count() <= 10_000 else companies, "company", "left_semi")
    new = named.join(earlier.select("source_pdf", "source_hash"), ["source_pdf", "source_hash"], "left_anti")
    # by path alone, of which there is one hash and none is greater: texts travel once, for the join and for equal rows
    wanted = new.select(*FILE, F.col("source_hash").alias("_hash"))
    fresh = stored(archive.join(locate.met(wanted), FILE).where("source_hash >= _hash").drop("_hash").dropDuplicates(FILE), "fresh")
    n_new = fresh.count()
    if n_new:
        judged = stored(verdict.judged(corpus.pages(spread(fresh)), config).select(*verdict.LOCATING), "judged")
        files = fresh.select(*FILE, "stem", "source_hash")
        first = stored(passes.pass1(files, judged, config).join(files.select("source_pdf", "stem"), "source_pdf"), "first")
        ranges = first.where("result = 'ok'").select(*FILE, F.col("extract_page").alias("start"), F.col("extract_end_page").alias("end"))
        # files meet their ranges before they are cut, so that no other file's pages are made and no page travels
        sections = corpus.pages(fresh.join(locate.met(ranges), FILE), "start", "end").where("page between start and end")
        texts = locate.joined_texts(sections).withColumnRenamed("n_pages", "n_section_pages")
        rows = first.join(locate.met(texts), FILE, "left").withColumn("batch", F.lit(number).cast("bigint"))
        write_partitions(rows.select(*(f.split()[0] for f in RECORDS.split(", "))), f"{output}/records", "company", "batch")
        touched = stored(fresh.select("company").distinct(), "touched")
        write_partitions(_summaries(_records(spark, output).join(touched, "company", "left_semi"), config), f"{output}/companies", "company")
        told["companies"] += touched.count()
        discard(judged, first, touched)
    told["rows_read"] += batch.count()
    told["files"] += n_new
    told["batches"] += 1
    log.info("batch %s: %s new files", number, n_new)
    discard(named, fresh)


def run(spark: SparkSession, documents: str, output: str, settings: Settings = Settings()) -> dict:
    """Takes all that is new, waits for the end and returns how much that was."""
    told = {"batches": 0, "rows_read": 0, "files": 0, "companies": 0}
    # a file stream takes a folder or a pattern; as a pattern, the path may also be that of one file
    table = documents.rstrip("/")
    stream = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", settings.files_a_batch).parquet(f"{table[:-1]}[{table[-1]}]")
    writer = stream.writeStream.foreachBatch(lambda batch, number: _take(batch, number, output, settings, told))
    query = writer.option("checkpointLocation", f"{output}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("took from %s: %s; records and companies are in %s", documents, told, output)
    return told


def read_back(spark: SparkSession, output: str) -> DataFrame:
    """The output as one table: each file's latest decision and section, beside its company's summary."""
    latest = _latest(_records(spark, output)).select("company", "source_pdf", "source_hash", "year", "action", "result", "method", "extract_page", "extract_end_page", "n_section_pages")
    summary = _read(spark, f"{output}/companies", COMPANIES)
    return latest.join(summary, "company")


if __name__ == "__main__":
    sys.exit(main(__doc__, "watch_archive.json", Settings, run))
