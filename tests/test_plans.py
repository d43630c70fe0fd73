"""What the plans don't do: rows of pages and files aren't sent to every executor, however small the packed tables look."""

import re

import duckdb
from pyspark.sql import functions as F

from folioscope.operators import ledger, locate, recover, verdict
from folioscope.plans import passes, queries, sql
from folioscope.sources import corpus
from folioscope.streaming import assembled

SF = "/root/testdata/sf0.001"


def sent(df):
    """Joins by file whose other side is broadcast."""
    return re.findall(r"Broadcast\w+Join \[company#\d+L?, source_pdf#\d+.*", df._jdf.queryExecution().executedPlan().toString())


def packed(spark, tmp_path):
    """Files, and their pages' verdicts as they are stored: far smaller than their rows."""
    files = corpus.active(corpus.files(spark, SF)).where("doc_id < 40")
    verdict.judged(corpus.pages(files)).select(*verdict.LOCATING).write.parquet(f"{tmp_path}/judged")
    return files, spark.read.parquet(f"{tmp_path}/judged")


def test_first_yes_sends_no_pages(spark, tmp_path):
    files, judged = packed(spark, tmp_path)
    records = files.select(*locate.FILE, "source_hash", "stem")
    first = passes.pass1(records, judged)
    assert sent(first) == []
    first.write.parquet(f"{tmp_path}/first")
    first = spark.read.parquet(f"{tmp_path}/first")
    plan = passes.pass2_plan(first, judged)
    samples = plan.select(*locate.FILE, recover.sample_pages(plan.ws, plan.we, plan.centre).alias("pages"))
    assert sent(recover.first_yes(samples, corpus.replies(files.drop("text")))) == []


def test_yes_range_sends_no_replies(spark, tmp_path):
    files, _ = packed(spark, tmp_path)
    corpus.replies(files).write.parquet(f"{tmp_path}/replies")
    replies = spark.read.parquet(f"{tmp_path}/replies")
    starts = replies.where("verdict").groupBy(*locate.FILE).agg({"page": "min"}).toDF(*locate.FILE, "start")
    got = recover.yes_range(starts, replies)
    assert sent(got) == []
    assert got.count() == starts.count() > 0


def test_paged_stream_calls_python_for_groups(spark, tmp_path, monkeypatch):
    """Files of one group: a call for all, each goes on when it is whole, the others keep their rows."""
    monkeypatch.setattr(assembled, "GROUPS", 1)
    rows = lambda pages: spark.createDataFrame([("c", f, "R_2001", "h", n, p, "y" * 90) for f, n, p in pages], assembled.PAGES).coalesce(1)
    docs, book = str(tmp_path / "pages"), str(tmp_path / "ledger")
    seen = []
    for pages in ([("a", 2, 1), ("b", 1, 1), ("d", 3, 3)], [("a", 2, 2), ("d", 3, 1)], [("d", 3, 2), ("d", 3, 2)]):
        rows(pages).write.mode("append").parquet(docs)
        assembled.run_available(spark, docs, book, str(tmp_path / "check"))
        seen.append({r.source_pdf for r in ledger.read(spark, book).collect()})
    assert seen == [{"b"}, {"a", "b"}, {"a", "b", "d"}]


def test_paged_stream_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = queries.queries()["stream_paged_files"](spark, SF)
    want = con.execute(sql.SQL["stream_paged_files"]).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_pages_are_cut_in_one_pass(spark):
    """A page costs its own length: the whole text isn't carried to, and searched for, each page."""
    text = "\U0001f600\r\n" * 300 + "é" * 7
    docs = spark.createDataFrame([(1, "src", text), (2, "src", ""), (3, "src", None), (4, "src", "x" * 400), (5, "src", "y" * 401)], "doc_id long, source string, text string")
    pages = corpus.pages(corpus.files_of(docs).withColumn("k", F.lit(9)))
    got = {(r.doc_id, r.page): r.text for r in pages.collect()}
    note = lambda p: f"This page was left for notes of readers of the report, number {p}."
    want = {}
    for i, t in ((1, text), (2, ""), (4, "x" * 400), (5, "y" * 401)):
        cut = [t[k : k + 400] for k in range(0, len(t), 400)]
        want |= {(i, p + 1): cut[p] if p < len(cut) else note(p + 1) for p in range(len(cut) + 4)}
    assert got == want
    optimized = pages._jdf.queryExecution().optimizedPlan().toString()
    assert "substr(text" not in optimized and "substring(text" not in optimized
