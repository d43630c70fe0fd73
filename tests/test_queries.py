"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from folioscope.plans import queries, sql

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", ["actions_all", "coverage_report", "ledger_latest", "pass2_actions", "section_text", "toc_entries", "vision_sample"])
def test_equal(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(sql.SQL[name])
    names = [d[0] for d in want.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert cols == sorted(names)
    key = lambda r: [(x is None, str(x)) for x in r]
    assert sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=key) == sorted(([plain(r[i]) for i in order] for r in want.fetchall()), key=key)


def test_all_have_sql():
    assert queries.queries().keys() == sql.SQL.keys()
