"""Each pipeline stage on the smallest tables, held against its operator's brute-force meaning."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from folioscope.llm import bpe, jaccard, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in P.STAGES:
        before, docs = docs, P.stored(stage(spark, docs, SF), name)
        sizes.append(docs.count())
        if name == "near_copies":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            groups = jaccard.cluster(before).collect()
            assert kept == {r.component for r in groups}
        if name == "benchmark":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(i in r.text for r in docs.collect() for i in items)
        if name != P.STAGES[-1][0]:
            assert docs.columns == before.columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    codec = bpe.Codec(queries.ranks(), P.public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(codec.decode(r.ids).decode() == texts[r.doc_id] for r in docs.collect())
    assert docs.where(F.col("n_tokens") != F.size("ids")).count() == 0


def test_long_list_of_copies_is_not_broadcast(spark, monkeypatch):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words that differ from these"), (None, "a b c d e f"), (4, None), (3, "other words that differ from these")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [sorted(map(tuple, P.drop_near_copies(spark, docs, "").collect()), key=str) for _ in range(2) if not _ or monkeypatch.setattr(P, "LISTED", 0) is None]
    assert got[0] == got[1] == sorted([(1, "a b c d e f"), (3, "other words that differ from these"), (4, None)], key=str)


def test_repeated_and_null_ids_are_decided_by_row(spark):
    a, b, c = ("one two three four five six seven", "red green blue white black grey pink", "north south east west up down left")
    near = [" ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(1, 60))]
    rows = [(1, a), (2, b), (2, a), (3, b), (4, c), (4, c), (5, near[0]), (5, near[1]), (None, a), (None, a), (None, None), (None, None), (6, None), (6, None), (6, "")]
    want = [(1, a), (2, b), (4, c), (None, None), (None, None), (6, None), (6, "")]
    got = list(map(tuple, P.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()))
    five = [r for r in got if r[0] == 5]
    assert len(five) == 1 and five[0][1] in near
    assert sorted((r for r in got if r[0] != 5), key=str) == sorted(want, key=str)
    alone = [(None, a), (None, a), (1, a), (2, b)]
    assert sorted(map(tuple, P.drop_near_copies(spark, spark.createDataFrame(alone, "doc_id bigint, text string"), "").collect()), key=str) == sorted([(1, a), (2, b)], key=str)
    nameless = [(None, a), (None, a), (None, b), (None, "")]
    assert sorted(map(tuple, P.drop_near_copies(spark, spark.createDataFrame(nameless, "doc_id bigint, text string"), "").collect()), key=str) == sorted([(None, a), (None, b), (None, "")], key=str)


def test_both_ways_of_near_copies_agree(spark):
    """Rows of unique ids, and the same with a row without id, which takes the other way, keep the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = P.drop_near_copies(spark, docs, SF)
    two = P.drop_near_copies(spark, docs.union(spark.createDataFrame([(None, "these words are in no other text at all")], docs.schema)), SF)
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in two.collect() if r.doc_id is not None)
    assert two.where("doc_id is null").count() == 1 and one.count() < docs.count()


def test_empty_tables(spark, tmp_path):
    """The whole pipeline over a table without rows, and without labels or items."""
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids"]
