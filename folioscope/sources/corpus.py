"""A paged corpus made of `documents`, for tests and registered queries: no table here holds what the rules look for.

A document is a file of one of twenty companies; its text is cut into pages of 400 characters, and a scenario puts headings,
bodies, signatures and contents lists on some of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

HEADING = "Comments of the Comptroller and Auditor General of India"
SHORT = "Comments of the C&AG"
BODY = "I, on behalf of the Comptroller and Auditor General of India, have conducted a supplementary audit under section 143(6)(a) of the Act."
SIGNED = "For and on behalf of the Comptroller and Auditor General of India"
HINDI = "भारत के नियंत्रक एवं महालेखापरीक्षक की टिप्पणियां " * 3


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def files_of(documents: DataFrame) -> DataFrame:
    """A file for each document (doc_id, source, text), with what its pages will show."""
    d = documents.select("doc_id", "source", "text")
    n = (F.ceil(F.length("text") / F.lit(400.0)) + 4).cast("int")
    i, k = F.expr("doc_id div 20"), F.expr("doc_id div 20") % 10
    y = 1975 + i % 45
    d = d.withColumns({"n": n, "odd": (F.floor(i / 10) % 2).cast("int"), "company": F.concat("source", F.lit(" Steel & Power Corporation of India Ltd.")), "y": y, "s": (i % 8).cast("int")})
    bare = k.isin(0, 3, 4, 5, 8) & ((F.col("doc_id") % 20 == 3) | ((F.col("doc_id") % 20 == 7) & (i > 0)))
    stem = F.expr("""case s when 0 then concat('R_', y, '-03-31') when 1 then concat('R_', y, '_03_31') when 2 then concat('R_AR_', y - 1, '-', y) when 3 then concat('R_', y - 1, '_', y)
        when 4 then concat('R_', y - 1, '_', lpad(y % 100, 2, '0')) when 5 then concat('R_AR_', y) when 6 then concat('Report ', y) else 'Report' end""")
    d = d.withColumns({"k": F.when(bare, 9).otherwise(k).cast("int"), "stem": stem, "p": (1 + F.col("doc_id") % (F.col("n") - 2)).cast("int"), "t": (2 + F.try_mod("doc_id", F.col("n") - 4)).cast("int")})
    path = F.concat(F.lit("/corpus/"), "company", F.lit("/d"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 97 == 0, "/archives/").otherwise("/"), "stem", F.lit(".pdf"))
    return d.select("doc_id", "company", path.alias("source_pdf"), "stem", F.substring(F.sha1(F.concat_ws("|", "stem", F.col("doc_id").cast("string"))), 1, 16).alias("source_hash"), "n", "k", "odd", "p", "t", "text")


def active(corpus: DataFrame) -> DataFrame:
    return corpus.where("not contains(source_pdf, '/archives/')")


def pages(corpus: DataFrame, *keep: str) -> DataFrame:
    """The pages of files, with columns of the files to keep."""
    # cut in one pass, so that a page costs its own length and not its file's; four pages follow that hold notes
    cut = F.concat(F.regexp_extract_all("text", F.lit("(?s).{1,400}"), F.lit(0)), F.array_repeat(F.lit(None).cast("string"), 4))
    raw = F.when(F.col("page") <= F.col("n") - 4, F.col("_cut")).otherwise(F.concat(F.lit("This page was left for notes of readers of the report, number "), F.col("page").cast("string"), F.lit(".")))
    at, odd = F.col("page") == F.col("p"), F.col("odd") == 1
    lines = lambda *x: F.concat_ws("\n", *(F.col(v) if isinstance(v, str) and v == "raw" else F.lit(v) if isinstance(v, str) else v for v in x))
    k = lambda n: F.col("k") == n
    contents = lines("Contents", "Notice of the meeting ........ 2", "Report of the board ........ 3", F.concat(F.lit(HEADING + " ........ "), F.col("t").cast("string")), "Accounts of the year ........ 9", "raw")
    text = (
        F.when(k(7), "")
        .when(k(0) & at, lines(HEADING, "raw", BODY, SIGNED)).when(k(0) & odd & (F.col("page") == F.col("p") + 1), F.lit(HINDI))
        .when(k(1) & at, F.when(odd, lines(SHORT, "raw")).otherwise(lines(HEADING + " thereon", "raw")))
        .when(k(2) & at, F.when(odd, lines(HEADING, "45", "raw", BODY)).otherwise(lines(HEADING + " are placed next to the report", "raw")))
        .when(k(3) & at, F.when(odd, lines(SHORT, "raw", SIGNED)).otherwise(lines("Nil Comments", "raw"))).when(k(3) & odd & (F.col("page") == F.col("p") + 1), lines("Notice of Annual General Meeting", "raw"))
        .when(k(4) & (F.col("page") == 1), contents).when(k(4) & (F.col("page") == F.col("t") + 2), lines(HEADING, "raw", BODY, SIGNED))
        .when(k(5) & at, lines("Independent Auditor's Report", HEADING, "raw", BODY, SIGNED)).when(k(6) & at, lines("Independent Auditor's Report", HEADING, BODY, "raw", "raw", "Deloitte Haskins & Sells"))
        .when(k(8) & at, F.when(odd, lines(SHORT + " ........ 12", "raw", BODY)).otherwise(lines(SHORT + " ........ 12", "raw", BODY, SIGNED)))
        .otherwise(F.col("raw"))
    )
    rows = corpus.select("*", F.posexplode(cut).alias("_at", "_cut")).drop("text").withColumn("page", F.col("_at") + 1)
    return rows.withColumn("raw", raw).select("company", "source_pdf", "doc_id", *keep, "page", text.alias("text"))


def replies(corpus: DataFrame) -> DataFrame:
    """A stand-in classifier: by (doc_id * 31 + page) mod 13, 0 is yes, 1 no reply, else no."""
    rows = corpus.select("company", "source_pdf", "doc_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("page"))
    h = (F.col("doc_id") * 31 + F.col("page")) % 13
    return rows.select("company", "source_pdf", "page", F.when(h == 0, True).when(h != 1, False).alias("verdict"))


def ledger_lines(corpus: DataFrame) -> DataFrame:
    """Lines of an earlier ledger, with blank, malformed and incomplete ones, and two for every fifth file."""
    d = corpus.select("doc_id", "company", "source_pdf", "source_hash", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn")).where("turn = 0 or doc_id % 5 = 0")
    result = F.element_at(F.array(*map(F.lit, ("ok", "error", "deferred"))), ((F.col("doc_id") + F.col("turn")) % 3 + 1).cast("int"))
    record = F.to_json(F.struct("company", "source_pdf", F.when(F.col("doc_id") % 13 != 0, F.col("source_hash")).alias("source_hash"), F.lit("pass1").alias("phase"), F.when(F.col("doc_id") % 4 == 0, "TRULY_MISSING").otherwise("EXTRACT").alias("action"), result.alias("result")))
    line = F.when(F.col("doc_id") % 11 == 0, "  ").when(F.col("doc_id") % 7 == 0, '{"source_pdf": "x", ').otherwise(record)
    return d.select((F.col("doc_id") * 2 + F.col("turn")).alias("seq"), line.alias("line"))
