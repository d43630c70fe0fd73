"""Where each company's sections usually begin, kept up to date from the ledger as it grows.

The state of a company is a histogram of start pages: pages and how many confirmed sections begin there. New records are added
to it, so nothing earlier is read again, and least, largest and exact median page come from the counts. Its size is the number
of different pages, whatever the number of files; a company with a third of all records costs one task their addition, after
they have been counted by page where they are read.

A section counts when its record is confirmed (first pass, extracted, ok). A file that a later run confirms again, with another
content, counts again, as it does in a plan over the whole ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import EngineConfig
from ..operators import ledger

USUAL = "company string, min_page int, max_page int, median_page int, n_years bigint"


def confirmed(records: DataFrame) -> DataFrame:
    """company and start of sections that the first pass has written."""
    return records.where("phase = 'pass1' and action = 'EXTRACT' and result = 'ok' and extract_page is not null").select("company", F.col("extract_page").alias("start"))


def merged(a: dict[int, int], b: dict[int, int]) -> dict[int, int]:
    """Histograms added."""
    return {k: a.get(k, 0) + b.get(k, 0) for k in a.keys() | b.keys()}


def summary(histogram: dict[int, int]) -> tuple[int, int, int, int]:
    """Least, largest and median page (of an even number, the mean of the middle two, rounded down), and how many sections."""
    pages = sorted(histogram)
    upto = np.cumsum([histogram[p] for p in pages])
    n = int(upto[-1])
    low, high = (pages[int(np.searchsorted(upto, k, "right"))] for k in ((n - 1) // 2, n // 2))
    return pages[0], pages[-1], (low + high) // 2, n


def usual_pages(sections: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """A stream of sections (company, start) to USUAL of each company of a batch that has enough of them."""

    def put(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        for b in batches:
            held = merged(held, {int(k): int(n) for k, n in b["start"].value_counts().items()})
        state.update(([*map(int, held)], [*map(int, held.values())]))
        low, high, median, n = summary(held)
        if n >= config.min_years:
            yield pd.DataFrame({"company": [key[0]], "min_page": [low], "max_page": [high], "median_page": [median], "n_years": [n]}).astype({"min_page": "int32", "max_page": "int32", "median_page": "int32"})

    return sections.where("start is not null").groupBy("company").applyInPandasWithState(put, USUAL, "pages array<int>, counts array<bigint>", "update", GroupStateTimeout.NoTimeout)


def run_available(spark: SparkSession, ledger_dir: str, target: str, checkpoint: str, files_a_batch: int = 1000, config: EngineConfig = EngineConfig()) -> None:
    """Takes what is new in the ledger and replaces the partitions, by company, of the companies it concerns."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("company").parquet(target)

    lines = spark.readStream.schema(ledger.SCHEMA).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_a_batch).json(ledger_dir)
    out = usual_pages(confirmed(lines), config).writeStream.outputMode("update").foreachBatch(write)
    out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("min_page int, max_page int, median_page int, n_years bigint, company string").parquet(target).select(*(c.split()[0] for c in USUAL.split(", ")))
