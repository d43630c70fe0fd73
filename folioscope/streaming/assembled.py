"""Pages that arrive in any order and over any number of batches, put together to files by keyed state.

Pages are judged as they arrive (a projection); only narrow verdict rows are kept, in the stream's state, by file. A file goes on
when all of its n_pages pages have come (without n_pages, with each batch that has pages of it). A page that comes again replaces
itself. A file that went on and comes again, whole, goes on again; who takes files into a ledger passes over those it holds.
Files whose pages don't all come stay in the state, however long; `waiting` names them, by a plan over the pages and the ledger.
There is no timeout: one by event time would drop pages that come late, one by the clock isn't repeatable.

The state is kept by groups of files, as compressed text, so that Spark calls Python once for several files; a group's files that
still wait are written again when one of them gets pages. Files are dealt by their hash, so a company with a third of all is spread.
What is done to a row in Python is to put it in its place; Spark writes and reads its text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import EngineConfig
from ..operators import ledger, verdict
from ..operators.locate import met
from ..plans import passes
from ..sources.tables import discard, stored

PAGES = "company string, source_pdf string, stem string, source_hash string, n_pages int, page int, text string"
_KEY = ["company", "source_pdf", "source_hash"]
_ROW = "stem string, n_pages int, page int, n_chars int, any_evidence boolean, toc_like boolean, toc_numbers array<array<string>>, toc_texts array<array<string>>, ok boolean, kind string, scan_kind string, signals string, cont boolean, stop string, signature boolean"


#: Groups that files are dealt to by their hash. A call of Python for each file takes Spark some milliseconds, so a group has several files.
GROUPS = 1 << 14
#: The rows of a group's files: by file and page, how many pages the file has and the page's row.
Held = dict[tuple, dict[int, tuple[int, str]]]


def _packed(held: Held) -> bytes:
    return zlib.compress(json.dumps([(file, [(p, *v) for p, v in rows.items()]) for file, rows in held.items()]).encode(), 1)


def _unpacked(state: bytes) -> Held:
    return {tuple(file): {p: (n, row) for p, n, row in rows} for file, rows in json.loads(zlib.decompress(state))}


def whole_files(pages: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """A stream of PAGES to a stream of the verdict rows (see verdict.LOCATING) of whole files, with stem, source_hash and n_pages."""

    def put(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else {}
        new = set()
        for b in batches:
            for *file, page, n, row in zip(*(b[c].tolist() for c in (*_KEY, "page", "expected", "row")), strict=True):
                held.setdefault(tuple(file), {})[page] = n, row
                new.add(tuple(file))
        whole = [f for f in held if f in new and len(held[f]) >= max(n for n, _ in held[f].values())]
        out = []
        for file in whole:
            rows = held.pop(file)
            out.append((*file, "[" + ",".join(rows[p][1] for p in sorted(rows)) + "]"))
        if held:
            state.update((_packed(held),))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=[*_KEY, "rows"], dtype=object)

    named = pages.where("source_pdf is not null and page is not null")
    rows = verdict.judged(named, config, keep=("stem", "source_hash", "n_pages"))
    # a row is one text from here on: only its page, and how many the file has, are looked at on the way
    narrow = rows.select(F.pmod(F.xxhash64(*_KEY), F.lit(GROUPS)).alias("_group"), *_KEY, "page", F.coalesce("n_pages", F.lit(-1)).alias("expected"), F.to_json(F.struct(*(c.split()[0] for c in _ROW.split(", ")))).alias("row"))
    schema = "company string, source_pdf string, source_hash string, rows string"
    out = narrow.groupBy("_group").applyInPandasWithState(put, schema, "rows binary", "append", GroupStateTimeout.NoTimeout)
    return out.select(*_KEY, F.inline(F.from_json("rows", f"array<struct<{_ROW.replace(' ', ':').replace(',:', ',')}>>")))


def waiting(pages: DataFrame, records: DataFrame) -> DataFrame:
    """Files of PAGES that the ledger holds nothing of: company, source_pdf, source_hash, n_pages and how many of them have come."""
    seen = pages.where("source_pdf is not null and page is not null").groupBy(*_KEY).agg(F.max("n_pages").alias("n_pages"), F.countDistinct("page").alias("n_come"))
    return seen.join(records.select("source_pdf", "source_hash").distinct(), ["source_pdf", "source_hash"], "left_anti").select(*_KEY, "n_pages", "n_come")


def run_available(spark: SparkSession, pages_dir: str, ledger_dir: str, checkpoint: str, replies: DataFrame | None = None, files_a_batch: int = 1000, config: EngineConfig = EngineConfig()) -> None:
    """Takes all new pages of pages_dir; files that they complete go through both passes into the ledger. Run again, it goes on from its state."""

    def take(batch: DataFrame, number: int) -> None:
        own, run = batch.sparkSession, f"pages-{number}"
        rows = stored(batch, "whole")
        if rows.isEmpty():
            discard(rows)
            return
        earlier = ledger.read(own, ledger_dir).where(F.col("run_id") != run)
        files = ledger.pending(rows.groupBy("company", "source_pdf").agg(F.max("source_hash").alias("source_hash"), F.max("stem").alias("stem")), earlier)
        judged = rows.join(met(files.select("source_pdf", "source_hash")), ["source_pdf", "source_hash"], "left_semi").select(*verdict.LOCATING)
        first = stored(passes.pass1(files, judged, config), "pass1")
        records = stored(first.unionByName(passes.pass2(passes.pass2_plan(first, judged, config), files, replies, config)), "records")
        if records.count():
            ledger.append(records, ledger_dir, run)
        discard(rows, first, records)

    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_a_batch).parquet(pages_dir)
    writer = whole_files(stream, config).writeStream.foreachBatch(take)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
