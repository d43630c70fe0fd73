"""Pages over several batches give what they give at once."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from folioscope.operators import ledger
from folioscope.plans import passes
from folioscope.sources import corpus
from folioscope.streaming import assembled


def add(df, path, order):
    """df as one file of a folder, later than those there."""
    df.coalesce(1).write.mode("append").parquet(path)
    for p in Path(path).glob("part-*.parquet"):
        new = p.with_name(f"pages-{order}.parquet")
        p.rename(new)
        os.utime(new, (1_700_000_000 + order, 1_700_000_000 + order))
    for p in Path(path).glob(".*.crc"):
        p.unlink()


def rows(df):
    names = ["company", "source_pdf", "source_hash", "phase", "pass1_action", "action", "result", "method", "evidence", "extract_page", "extract_end_page", "new_path"]
    return sorted(map(str, (tuple(r[c] for c in names) for r in df.collect())))


def test_pages_over_three_batches(spark, tmp_path):
    # one company a case, so that what files of other batches agree on doesn't differ
    files = corpus.active(corpus.files(spark, "/root/testdata/sf0.001")).where("doc_id % 7 < 3")
    alone = files.withColumn("company", F.concat("company", F.lit(" "), F.col("doc_id").cast("string")))
    pages = corpus.pages(alone).join(alone.select("source_pdf", "stem", "source_hash", F.col("n").alias("n_pages")), "source_pdf").select(*(c.split()[0] for c in assembled.PAGES.split(", ")))
    pages.write.parquet(f"{tmp_path}/all")
    pages = spark.read.parquet(f"{tmp_path}/all")
    docs = str(tmp_path / "pages")
    n_files = pages.select("source_pdf").distinct().count()
    for k in range(3):
        add(pages.where(f"page % 3 = {k}").orderBy(F.rand(k)), docs, k)
    # a page twice, and one of a file that never is whole
    add(pages.where("page = 2").limit(5).unionByName(pages.limit(1).withColumn("source_pdf", F.lit("/corpus/x/part.pdf")).withColumn("n_pages", F.lit(9))), docs, 3)
    book = str(tmp_path / "ledger")
    for _ in range(2):
        assembled.run_available(spark, docs, book, str(tmp_path / "check"), files_a_batch=1)
    got = ledger.read(spark, book)
    want = passes.both(alone.select("company", "source_pdf", "source_hash", "stem"), pages.select("company", "source_pdf", "page", "text"), None)
    assert rows(got) == rows(want)
    assert got.select("source_pdf").distinct().count() == n_files
    assert {r.run_id for r in got.select("run_id").distinct().collect()} == {"pages-2"}


def test_files_without_all_pages_wait(spark, tmp_path):
    made = [("c", f"f{i}", "R_2001", f"h{i}", 4, p, f"{corpus.HEADING}\n{corpus.BODY}\n{corpus.SIGNED}" + "x" * 200 if p == 2 else "y" * 90) for i in range(2) for p in (1, 2, 3)]
    made += [("c", "unknown", "R_2001", "u", None, 1, None), ("c", None, "x", "x", 1, 1, "x"), ("c", "x", "x", "x", 1, None, "x")]
    docs, book = str(tmp_path / "pages"), str(tmp_path / "ledger")
    waiting = lambda: sorted(map(tuple, assembled.waiting(spark.read.schema(assembled.PAGES).parquet(docs), ledger.read(spark, book)).collect()))
    add(spark.createDataFrame(made, assembled.PAGES), docs, 0)
    assembled.run_available(spark, docs, book, str(tmp_path / "check"))
    assert {r.source_pdf for r in ledger.read(spark, book).collect()} == {"unknown"}
    assert waiting() == [("c", "f0", "h0", 4, 3), ("c", "f1", "h1", 4, 3)]
    add(spark.createDataFrame([("c", "f1", "R_2001", "h1", 4, 4, "z" * 90)], assembled.PAGES), docs, 1)
    assembled.run_available(spark, docs, book, str(tmp_path / "check"))
    got = {(r.source_pdf, r.phase): r for r in ledger.read(spark, book).collect()}
    assert (got["f1", "pass1"].extract_page, got["f1", "pass1"].action) == (2, "EXTRACT")
    assert waiting() == [("c", "f0", "h0", 4, 3)]
