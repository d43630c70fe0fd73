"""The runnable jobs: whole output against SQL, reruns, growing input, settings."""

import json
import os
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import common, extract_sections, queries, watch_archive

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def rows(df, *without):
    names = sorted(c for c in df.columns if c not in without)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=lambda r: [(x is None, str(x)) for x in r])


def by_sql(name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = con.execute(queries.SQL[name])
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in got.fetchall()), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    names, want = by_sql(name)
    assert sorted(got.columns) == names
    assert rows(got) == want
    assert want


def files_below(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in Path(path).rglob("*.parquet")}


def test_extract_one_company_replaces_only_its_partitions(spark, tmp_path):
    docs, out = str(tmp_path / "documents.parquet"), str(tmp_path / "out")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    given.write.parquet(docs)
    catalog = {t.name for t in spark.catalog.listTables()}
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    first = extract_sections.run(spark, docs, out)
    before, held = rows(extract_sections.read_back(spark, out)), files_below(f"{out}/sections")
    assert first["files"] == spark.read.parquet(f"{out}/sections").count()
    assert len({p.split("/")[0] for p in held}) == 20
    extract_sections.run(spark, docs, out, extract_sections.Settings(company="SRC1 "))
    after = files_below(f"{out}/sections")
    assert rows(extract_sections.read_back(spark, out)) == before
    changed = {p.split("/")[0] for p in held.keys() ^ after.keys()}
    assert len(changed) == 1 and changed.pop().startswith("company=src1 ")
    # nothing of the session is left changed
    assert {t.name for t in spark.catalog.listTables()} == catalog
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    # what isn't there any more goes with a run over all
    spark.createDataFrame(given.where("source = 'src2'").collect(), given.schema).write.mode("overwrite").parquet(docs)
    extract_sections.run(spark, docs, out)
    assert [r.company for r in spark.read.parquet(f"{out}/sections").select("company").distinct().collect()] == ["src2 Steel & Power Corporation of India Ltd."]


def test_passes_read_the_bucketed_pages_without_a_shuffle(spark, tmp_path):
    """Each pass's aggregate by file over the pages' verdicts has no exchange below it."""
    from folioscope.operators import locate, verdict
    from folioscope.sources import corpus

    pages = corpus.pages(corpus.active(corpus.files(spark, SF)))
    table, name = extract_sections._bucketed(verdict.judged(pages).select(*verdict.LOCATING), str(tmp_path / "pages"), extract_sections.Settings(buckets=3))
    plan = locate.text_layer(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    spark.sql(f"drop table {name}")


def test_extract_odd_rows_and_empty_table(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(None, "x", "en", "src1", 1), (1, None, "en", "src1", 0), (2, "", "en", "src1", 0), (3, "y" * 900, "en", None, 900)], schema).write.parquet(f"{tmp_path}/a")
    extract_sections.run(spark, f"{tmp_path}/a", f"{tmp_path}/o")
    got = {r.source_pdf.split("/")[3]: r for r in extract_sections.read_back(spark, f"{tmp_path}/o").collect()}
    assert {k: (r.action, r.result) for k, r in got.items()} == {"d1": ("ERROR", "error"), "d2": ("EXTRACT", "ok")}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e")
    assert extract_sections.run(spark, f"{tmp_path}/e", f"{tmp_path}/none")["files"] == 0
    assert extract_sections.read_back(spark, f"{tmp_path}/none").count() == 0
    assert watch_archive.run(spark, f"{tmp_path}/e", f"{tmp_path}/never")["files"] == 0
    assert watch_archive.read_back(spark, f"{tmp_path}/never").count() == 0
    told = watch_archive.run(spark, f"file:{tmp_path}/a", f"file:{tmp_path}/w")
    assert told["files"] == 2 and {(r.action, r.n_files) for r in watch_archive.read_back(spark, f"{tmp_path}/w").collect()} == {("ERROR", 2), ("EXTRACT", 2)}


def add(spark, df, path, order):
    """df as one more file of a folder, later than those there."""
    df.coalesce(1).write.mode("append").parquet(path)
    for p in Path(path).glob("*.parquet"):
        if not p.name.startswith("given"):
            new = p.with_name(f"given-{order}.parquet")
            p.rename(new)
            os.utime(new, (1_700_000_000 + order, 1_700_000_000 + order))
    for p in Path(path).glob(".*.crc"):
        p.unlink()


def test_watch_takes_only_what_is_new(spark, tmp_path):
    docs, out = str(tmp_path / "documents"), str(tmp_path / "out")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    add(spark, given.where("doc_id % 3 = 0"), docs, 1)
    first = watch_archive.run(spark, docs, out)
    assert first["batches"] == 1 and first["rows_read"] == given.where("doc_id % 3 = 0").count()
    held = files_below(f"{out}/records")
    # more documents of three companies only, with some that were there already
    more = given.where("doc_id % 3 = 1 and source in ('src1', 'src4', 'src7')")
    add(spark, more.unionByName(given.where("doc_id % 3 = 0 and source = 'src9'")), docs, 2)
    summaries = files_below(f"{out}/companies")
    second = watch_archive.run(spark, docs, out)
    active = more.where("doc_id % 97 <> 0").count()
    assert (second["batches"], second["files"], second["companies"]) == (1, active, 3)
    assert second["rows_read"] == more.count() + given.where("doc_id % 3 = 0 and source = 'src9'").count()
    after = files_below(f"{out}/records")
    assert all(after[p] == b for p, b in held.items())
    changed = {p.split(" ")[0] for p in summaries.keys() ^ files_below(f"{out}/companies").keys()}
    assert changed == {"company=src1", "company=src4", "company=src7"}
    # a run without news changes nothing
    assert watch_archive.run(spark, docs, out) == {"batches": 0, "files": 0, "companies": 0, "rows_read": 0}
    assert files_below(f"{out}/records") == after
    # the same as all at once
    watch_archive.run(spark, docs, f"{tmp_path}/at_once")
    assert rows(watch_archive.read_back(spark, out)) == rows(watch_archive.read_back(spark, f"{tmp_path}/at_once"))


def test_watch_summaries_over_five_runs_equal_one(spark, tmp_path):
    docs, out = str(tmp_path / "documents"), str(tmp_path / "out")
    given = spark.read.parquet(f"{SF}/documents.parquet").where("source in ('src1', 'src2', 'src5', 'src8')")
    for k in range(5):
        add(spark, given.where(f"(doc_id div 20) % 5 = {k}"), docs, k)
        watch_archive.run(spark, docs, out)
    spark.read.parquet(docs).write.parquet(f"{tmp_path}/all")
    watch_archive.run(spark, f"{tmp_path}/all", f"{tmp_path}/once")
    assert rows(watch_archive.read_back(spark, out)) == rows(watch_archive.read_back(spark, f"{tmp_path}/once"))
    assert spark.read.parquet(f"{out}/companies").where("median_page is not null").count() > 0


def test_watch_repeats_a_batch_and_replaces_contents(spark, tmp_path):
    out, told = str(tmp_path / "out"), {"batches": 0, "rows_read": 0, "files": 0, "companies": 0}
    given = spark.read.parquet(f"{SF}/documents.parquet").where("source = 'src1'")
    watch_archive._take(given, 0, out, watch_archive.Settings(), told)
    once = rows(watch_archive.read_back(spark, out))
    watch_archive._take(given, 0, out, watch_archive.Settings(), told)  # as after a failure between writing and the checkpoint
    assert rows(watch_archive.read_back(spark, out)) == once
    assert spark.read.parquet(f"{out}/records").count() == len(once)
    # a later content of a path counts, the earlier record stays
    one = given.where("doc_id % 97 <> 0").orderBy("doc_id").limit(1).withColumn("text", F.lit("other words " * 50))
    watch_archive._take(one, 1, out, watch_archive.Settings(), told)
    assert spark.read.parquet(f"{out}/records").count() == len(once) + 1
    assert len(rows(watch_archive.read_back(spark, out))) == len(once)
    watch_archive._take(given.limit(0), 2, out, watch_archive.Settings(), told)
    assert len(rows(watch_archive.read_back(spark, out))) == len(once)


def test_watch_moves_each_text_once_before_judging_and_once_for_sections(spark, tmp_path, monkeypatch):
    """As at size, where nothing is small enough to be broadcast: exchanges that carry a text (or a first one of equal rows), in the plans of new files and of records; pages never travel."""
    from folioscope.operators import locate

    carried = {}
    note = lambda name, df: carried.setdefault(name, [c for c in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")) if re.search(r"\b(text|first)#", c)])
    keep, write = watch_archive.stored, watch_archive.write_partitions
    monkeypatch.setattr(watch_archive, "stored", lambda df, name: (note(name, df), keep(df, name))[1])
    monkeypatch.setattr(watch_archive, "write_partitions", lambda df, path, *a, **b: (note(path.rpartition("/")[2], df), write(df, path, *a, **b))[1])
    monkeypatch.setattr(locate, "SENT", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        watch_archive._take(spark.read.parquet(f"{SF}/documents.parquet"), 0, f"{tmp_path}/out", watch_archive.Settings(), dict.fromkeys(("batches", "rows_read", "files", "companies"), 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(carried["fresh"]) == len(carried["records"]) == 1
    assert not re.search(r"\bpage#", carried["records"][0])


def test_settings(tmp_path):
    for job, name in ((extract_sections, "extract_sections.json"), (watch_archive, "watch_archive.json")):
        assert common.settings(job.Settings, str(ROOT / "jobs" / name)) == job.Settings()
    (tmp_path / "c.json").write_text(json.dumps({"company": "a", "buckets": 3}))
    assert common.settings(extract_sections.Settings, str(tmp_path / "c.json"), company="b") == extract_sections.Settings(company="b", buckets=3)
    (tmp_path / "c.json").write_text(json.dumps({"bukets": 3}))
    with pytest.raises(ValueError, match="bukets"):
        common.settings(extract_sections.Settings, str(tmp_path / "c.json"))


@pytest.mark.parametrize("name", ["extract_sections", "watch_archive"])
def test_command_line(name, tmp_path):
    said = subprocess.run([sys.executable, str(ROOT / "jobs" / f"{name}.py"), f"{SF}/documents.parquet", str(tmp_path / "out"), "--company", "src3 ", "--master", "local[2]"], capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-2000:]
    assert json.loads(said.stdout.strip().splitlines()[-1])["files"] > 0
    assert f"jobs.{name}" in said.stderr


def test_jobs_import_nothing_of_the_training_data_package():
    for p in [*(ROOT / "jobs").glob("*.py"), Path(__file__)]:
        lines = [x for x in p.read_text().splitlines() if x.lstrip().startswith(("import ", "from "))]
        assert not [x for x in lines if "llm" in x or "corpus_pipeline" in x]
