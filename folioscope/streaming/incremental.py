"""New page files into the ledger: a file stream, all that is there at once, each batch once: a repeated batch replaces its records.

A file's pages must arrive in one batch (one Parquet file for each source file, or more in one folder written at once).
The consensus of a company is only known when its batch is complete, so a batch is what a run is in batch mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from ..operators import ledger
from ..plans import passes
from ..sources.tables import stored

PAGES = "company string, source_pdf string, stem string, source_hash string, page int, text string"


def run_available(spark: SparkSession, pages_dir: str, ledger_dir: str, checkpoint: str, replies: DataFrame | None = None, config: EngineConfig = EngineConfig()) -> None:
    """Takes all new files of pages_dir into the ledger and returns; run again, it takes only newer ones."""

    def take(batch: DataFrame, number: int) -> None:
        own, run = batch.sparkSession, f"stream-{number}"
        # what a failed attempt at this batch left doesn't count, and is replaced
        earlier = ledger.read(own, ledger_dir).where(F.col("run_id") != run)
        files = ledger.pending(batch.select("company", "source_pdf", "stem", "source_hash").distinct(), earlier)
        rows = batch.join(files.select("source_pdf"), "source_pdf", "left_semi").select("company", "source_pdf", "page", F.coalesce("text", F.lit("")).alias("text"))
        ledger.append(stored(passes.both(files, rows, replies, config), "records"), ledger_dir, run)

    stream = spark.readStream.schema(PAGES).parquet(pages_dir)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
