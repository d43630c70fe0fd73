"""The append-only ledger of decisions, resuming from it, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from ..functions.text import fiscal_year, short_name

SCHEMA = (
    "seq bigint, run_id string, ts timestamp, company string, source_pdf string, source_hash string, year string, phase string, action string, result string, evidence string, "
    "pass1_action string, method string, new_path string, extract_page int, extract_end_page int"
)


def parse_lines(lines: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """Records of JSON lines; blank and malformed lines are passed over. Null and missing fields are null."""
    kept = lines.where(F.col(line).isNotNull() & (F.trim(line) != ""))
    bad = F.from_json(line, SCHEMA + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")
    return kept.select(F.col(order).alias("_line"), bad).where("r._bad is null and r is not null").select("_line", "r.*").drop("_bad", "seq").withColumnRenamed("_line", "seq")


def read(spark: SparkSession, path: str) -> DataFrame:
    """A ledger folder; an empty frame where there is none yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(path)


def append(records: DataFrame, path: str, run_id: str) -> None:
    """Adds a run's records as JSON lines of its own folder, which a repeat of the run replaces. One writer at a time.

    seq orders records within and after earlier runs: a run's number, kept in its folder's name, above the record's number.
    """
    spark = records.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = sorted(f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory() and f.getPath().getName().startswith("run=")) if system.exists(folder) else []
    name = next((r for r in runs if r.partition("-")[2] == run_id), None) or f"run={int(runs[-1][4:].partition('-')[0]) + 1 if runs else 1:012d}-{run_id}"
    base = int(name[4:].partition("-")[0]) << 40
    numbered = records.withColumns({"seq": F.monotonically_increasing_id() + F.lit(base), "run_id": F.lit(run_id), "ts": F.current_timestamp()})
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    numbered.select(*(F.col(n) if n in numbered.columns else F.lit(None).alias(n) for n in names)).write.mode("overwrite").json(f"{path}/{name}")


def done_keys(ledger: DataFrame) -> DataFrame:
    return ledger.where("result = 'ok' and source_pdf <> '' and source_hash <> ''").select("source_pdf", "source_hash").distinct()


def latest(ledger: DataFrame) -> DataFrame:
    """The last record of each file."""
    whole = F.max_by(F.struct(*ledger.columns), "seq")
    return ledger.where("source_pdf is not null").groupBy("source_pdf").agg(whole.alias("r")).select("r.*")


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    return files.join(done_keys(ledger), ["source_pdf", "source_hash"], "left_anti")


def not_present(files: DataFrame, outputs: DataFrame) -> DataFrame:
    """files (company, stem) without an output: a section of their year and short name, or a copy under their own name.

    outputs: company, kind (section or copy), year, short, name. A sibling of the same year counts too. A file without year can only have a copy.
    """
    own = files.withColumns({"_year": fiscal_year(F.col("stem")), "_short": short_name(F.col("company"))})
    sections = outputs.where("kind = 'section'").select("company", F.col("year").alias("_year"), F.col("short").alias("_short")).where("_year <> ''").distinct()
    copies = outputs.where("kind = 'copy'").select("company", F.col("name").alias("stem")).distinct()
    return own.join(sections, ["company", "_year", "_short"], "left_anti").join(copies, ["company", "stem"], "left_anti").drop("_year", "_short")


def to_organise(files: DataFrame, ledger: DataFrame, copies: DataFrame) -> DataFrame:
    """files whose latest record says that they truly hold no section, and which haven't been copied (company, stem) yet."""
    gone = latest(ledger).where("action = 'TRULY_MISSING' and result <> 'ok'").select("source_pdf")
    return files.join(gone, "source_pdf", "left_semi").join(copies, ["company", "stem"], "left_anti")


def coverage(files: DataFrame, sections: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """company, year, status, source_filename, extract_path of each company's years; of files of one year the last name counts, of sections the first path."""
    dated = files.withColumn("year", fiscal_year(F.col("stem"))).where(F.col("year") != "").where(~F.array_contains(F.split("source_pdf", "/"), config.archive_dir))
    names = dated.groupBy("company", "year").agg(F.max("stem").alias("source_filename"))
    got = sections.where("year <> ''").groupBy("company", "year").agg(F.min("path").alias("extract_path"))
    return names.join(got, ["company", "year"], "left").select("company", "year", F.when(F.col("extract_path").isNotNull(), "present_clean").otherwise("missing_extract").alias("status"), "source_filename", F.coalesce("extract_path", F.lit("")).alias("extract_path"))


def coverage_totals(report: DataFrame) -> DataFrame:
    n = lambda c: c.cast("bigint")
    return report.agg(n(F.count("*")).alias("n_rows"), n(F.count_if(F.col("status") == "present_clean")).alias("n_present"), n(F.count_if(F.col("status") == "missing_extract")).alias("n_missing"), n(F.countDistinct("company")).alias("n_companies"))


def write_coverage(report: DataFrame, path: str) -> None:
    report.orderBy("company", "year").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def action_histogram(actions: DataFrame) -> DataFrame:
    return actions.groupBy("phase", "action").count().withColumnRenamed("count", "n").orderBy(F.desc("n"), "phase", "action")


def output_path(config: EngineConfig, company: Column, name: Column) -> Column:
    return F.concat_ws("/", company, F.lit(config.sections_dir), name)
