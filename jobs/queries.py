"""The jobs as registered queries, over whole tables, and their output in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.plans import sql
from folioscope.sources.tables import shared_root

from . import extract_sections, watch_archive


def _twice(job, spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """What stands in a new folder after the job ran there twice."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    output = f"{shared_root(documents)}/{name}-{uuid.uuid4().hex}"
    for _ in range(2):
        job.run(spark, f"{sf_dir}/documents.parquet", output)
    return job.read_back(spark, output)


def job1_extract_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(extract_sections, spark, sf_dir, "job1")


def job2_watch_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(watch_archive, spark, sf_dir, "job2")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_extract_sections, job2_watch_archive)}

_HASHED = "(select source_pdf, substr(sha1(coalesce(text, '')), 1, 16) as source_hash from files)"

SQL = {
    "job1_extract_sections": sql.BASE + f""",
decided as materialized (select company, source_pdf, year, phase, action, result, method, evidence, extract_page, extract_end_page, new_path from pass1 where result <> 'deferred'
  union all select company, source_pdf, year, phase, action, result, method, evidence, extract_page, extract_end_page, new_path from pass2 where mode = 'on'),
texts as (select p.source_pdf, count(*) as n_section_pages, sha256(string_agg(text, chr(10) order by page)) as text_sha256 from pages p join decided d on p.source_pdf = d.source_pdf and d.result = 'ok' and page between extract_page and extract_end_page group by all)
select company, source_pdf, h.source_hash, year, phase, action, result, method, evidence, extract_page, extract_end_page, new_path, n_section_pages, text_sha256, status
from decided join {_HASHED} h using (source_pdf) left join texts using (source_pdf) left join report using (company, year)""",
    "job2_watch_archive": sql.BASE + f""",
years as (select a.company, a.year, bool_or(coalesce(p.result = 'ok', false)) as there from files a join pass1 p using (source_pdf) where a.year <> '' group by all),
texts as (select p.source_pdf, count(*) as n_section_pages from pages p join pass1 d on p.source_pdf = d.source_pdf and d.result = 'ok' and page between extract_page and extract_end_page group by all),
summary as (select company, count(*) as n_files, count(*) filter (where result = 'ok') as n_sections from pass1 group by company),
lists as (select company, coalesce(string_agg(year, ',' order by year) filter (where there), '') as years_present, coalesce(string_agg(year, ',' order by year) filter (where not there), '') as years_missing from years group by company)
select p.company, source_pdf, h.source_hash, p.year, action, result, method, extract_page, extract_end_page, n_section_pages, n_files, n_sections, coalesce(years_present, '') as years_present, coalesce(years_missing, '') as years_missing, min_page, max_page, median_page
from pass1 p join {_HASHED} h using (source_pdf) left join texts using (source_pdf) join summary s on s.company = p.company left join lists l on l.company = p.company left join agreed g on g.company = p.company""",
}
