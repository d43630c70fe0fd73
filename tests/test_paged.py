"""Listing and paged reading: complete listings, slices, pruning, errors."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioscope.sources import files, paged

NAMES = ("Acme/a.pdf", "Acme/_b.pdf", "Acme/_old/c.pdf", "_Co/d.pdf", "Acme/.e.pdf", "Acme/.dot/f.pdf", "Acme/deep/er/g h.pdf")
OUT = ("Acme/archives/x.pdf", "Acme/deep/archives/y.pdf", ".hidden/z.pdf", "Acme/note.txt", "top.pdf", "Acme/UPPER.PDF")


class _Counted(list):
    """Pages that leave a mark of each one decoded, beside the file they are of."""

    def __init__(self, pages, marks):
        super().__init__(pages)
        self.marks = marks

    def __getitem__(self, k):
        with open(f"{self.marks}/{os.getpid()}", "a") as f:
            f.write(f"{k + 1}\n")
        return super().__getitem__(k)


def fake_opened(f):
    """Content: a folder for marks, then pages, separated by form feeds."""
    marks, *pages = f.read().decode().split("\f")
    return _Counted(pages, marks)


fake_opened.by_page = True


def put(root, name, content=b"x"):
    p = Path(root) / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(content)


def decoded(marks):
    """Pages decoded, in order, and how many processes decoded any."""
    own = [[int(x) for x in p.read_text().split()] for p in Path(marks).iterdir()]
    return sorted(x for o in own for x in o), len(own)


@pytest.fixture
def root(tmp_path):
    for name in (*NAMES, *OUT):
        put(tmp_path / "in", name)
    (tmp_path / "in" / "Empty").mkdir()
    return str(tmp_path / "in")


def test_listing_is_complete(spark, root):
    got = files.list_files(spark, root).collect()
    assert sorted(r.source_pdf.split("/in/")[1] for r in got) == sorted(NAMES)
    assert {r.company for r in got} == {"Acme", "_Co"} and {r.bytes for r in got} == {1}
    assert {r.source_pdf.split("/in/")[1]: r.stem for r in got}["Acme/.e.pdf"] == ".e"
    assert files.company_folders(spark, root) == ["Acme", "Empty", "_Co"]
    # as outputs, too
    for name in ("_Co/no_comments_content/_d.pdf", "Acme/comments_mentioned/cag_pages/_2001__Acme__cag_p2_en.pdf", "Acme/other/e.pdf"):
        put(f"{root}/out", name)
    assert sorted((r.company, r.kind, r.name) for r in files.list_outputs(spark, f"{root}/out").collect()) == [("Acme", "section", "_2001__Acme__cag_p2_en"), ("_Co", "copy", "_d")]
    assert files.list_outputs(spark, f"{root}/nowhere").count() == 0


def test_listing_format(spark, root):
    paged.register(spark)
    load = lambda **o: spark.read.format("folioscope_files").options(**o).load(root)
    assert load().rdd.getNumPartitions() == 3  # a task for each company folder
    assert load(company="CO").count() == 1 and load(pattern="*.txt").count() == 1 and load(archive="deep").count() == 7
    got = spark.read.format("folioscope_files").schema("stem string, modified timestamp").load(root)
    assert got.columns == ["stem", "modified"] and got.where("modified is null").count() == 0
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("folioscope_files").schema("colour string").load(root).collect()


def test_resume_sees_underscored_files(spark, root):
    from folioscope.operators import ledger

    listed = files.list_files(spark, root)
    put(f"{root}-out", "_Co/no_comments_content/d.pdf")
    left = ledger.not_present(listed, files.list_outputs(spark, f"{root}-out"))
    assert sorted(r.source_pdf.split("/in/")[1] for r in left.collect()) == sorted(set(NAMES) - {"_Co/d.pdf"})


def test_hashes_are_of_contents(spark, root):
    put(root, "Acme/empty.pdf", b"")
    listed = files.list_files(spark, root)
    listed = listed.unionByName(listed.limit(1).withColumn("source_pdf", F.lit(f"{root}/Acme/gone.pdf")))
    got = {r.source_pdf.split("/in/")[1]: r.source_hash for r in paged.hashed(listed.withColumn("source_hash", F.lit("old"))).collect()}
    assert got["Acme/a.pdf"] == "11f6ad8ec52a2984" and got["Acme/empty.pdf"] == "da39a3ee5e6b4b0d" and got["Acme/gone.pdf"] is None


def test_a_long_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "marks").mkdir()
    text = "\f".join([str(tmp_path / "marks"), *(f"page {k}" for k in range(1, 10_001))])
    put(tmp_path / "in", "_Co/_long.pdf", text.encode())
    for k in range(9):
        put(tmp_path / "in", f"Acme/{k}.pdf", f"{tmp_path / 'marks'}\fone\ftwo".encode())
    paged.register(spark)
    df = spark.read.format("folioscope_pages").option("opener", "test_paged:fake_opened").option("bytes_a_task", 20_000).load(str(tmp_path / "in"))
    parts = df.rdd.getNumPartitions()
    assert parts == -(-len(text) // 20_000) + 1  # slices of the long file, and the small files together
    got = df.where("text like 'page %'").groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n"), F.min("page").alias("a"), F.max("page").alias("b")).collect()
    assert len(got) == parts - 1 and sum(r.n for r in got) == 10_000 and max(r.n for r in got) < 3000
    assert df.count() == 10_018 and df.where("text <> concat('page ', page) and company = '_Co'").count() == 0
    # the same by a plan over a table of files
    listed = files.list_files(spark, str(tmp_path / "in"))
    plan = paged.pages_of(listed, fake_opened, 20_000)
    assert sorted(map(tuple, plan.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert plan.where("company = '_Co'").select(F.spark_partition_id()).distinct().count() > 2
    # contents are in no plan
    assert "content" not in plan._jdf.queryExecution().executedPlan().toString()


def test_columns_and_pages_are_pruned(spark, tmp_path):
    marks = tmp_path / "marks"
    marks.mkdir()
    for company in ("Acme", "_Co"):
        put(tmp_path / "in", f"{company}/x.pdf", "\f".join([str(marks), *(f"p{k}" for k in range(1, 101))]).encode())
    paged.register(spark)
    read = spark.read.format("folioscope_pages").option("opener", "test_paged:fake_opened")
    counts = read.schema("company string, page int").load(str(tmp_path / "in"))
    assert sorted(map(tuple, counts.groupBy("company").agg(F.max("page").alias("n")).collect())) == [("Acme", 100), ("_Co", 100)]
    assert "text" not in counts._jdf.queryExecution().executedPlan().toString()
    assert decoded(marks) == ([], 0)
    kept = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        read = spark.read.format("folioscope_pages").option("opener", "test_paged:fake_opened").option("pushdown", True)
        some = read.load(str(tmp_path / "in")).where("company = '_Co' and page > 3 and page <= 7 and page in (1, 5, 6, 90)")
        assert sorted((r.company, r.page, r.text) for r in some.collect()) == [("_Co", 5, "p5"), ("_Co", 6, "p6")]
        assert decoded(marks)[0] == [5, 6]
        listed = spark.read.format("folioscope_files").option("pushdown", True).load(str(tmp_path / "in")).where("company = '_Co'")
        assert listed.count() == 1 and listed.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", kept)
    # without it, Spark filters
    some = spark.read.format("folioscope_pages").option("opener", "test_paged:fake_opened").load(str(tmp_path / "in")).where("company = '_Co' and page in (5, 6)")
    assert sorted((r.company, r.page) for r in some.collect()) == [("_Co", 5), ("_Co", 6)]


def test_unreadable_files_and_pages(spark, tmp_path):
    put(tmp_path / "in", "Acme/good.pdf", b"one\ftwo")
    put(tmp_path / "in", "Acme/_bad.pdf", b"\xff")
    put(tmp_path / "in", "_Co/none.pdf", b"")
    listed = files.list_files(spark, str(tmp_path / "in"))
    got = files.read_pages(listed, lambda b: b.decode().split("\f") if b else []).collect()
    assert sorted((r.source_pdf.rsplit("/", 1)[1], r.page, bool(r.error)) for r in got) == [("_bad.pdf", None, True), ("good.pdf", 1, False), ("good.pdf", 2, False)]
    assert files.read_pages(listed.limit(0), lambda b: [""]).count() == 0

    class Pages:
        def extract_text(self):
            raise ValueError

    assert paged._PdfTexts([Pages()])[0] == ""


def test_page_ranges():
    every = paged.PageRange()
    assert list(every.of(3, 5)) == [3, 4, 5] and every.whole
    f = paged.In(("page",), (9, 4, 1))
    assert list(every.with_(f).with_(paged.GreaterThanOrEqual(("page",), 2)).of(1, 8)) == [4]
    assert every.with_(paged.EqualTo(("text",), "x")) is None and list(every.with_(paged.LessThan(("page",), 3)).of(1, 9)) == [1, 2]


def test_packing_keeps_every_page_once():
    sizes = [("c", f"f{k}", s) for k, s in enumerate([0, 5, 100, 9, 3, 250, 99, 100, 1, 1])]
    got = [s for task in paged.packed(sizes, 100, True) for s in task]
    assert {(s.path, s.part, s.parts) for s in got} == {(f"f{k}", p, n) for k, (_, _, size) in enumerate(sizes) for n in [max(1, -(-size // 100))] for p in range(n)} and len(got) == 12
    assert all(len(task) == 1 or sum(dict((p, s) for _, p, s in sizes)[x.path] for x in task) <= 100 for task in paged.packed(sizes, 100, True))
    assert max(s.parts for task in paged.packed(sizes, 100, False) for s in task) == 1
