"""Histograms kept in a stream's state give what the whole ledger gives."""

import random
import statistics

from hypothesis import given, strategies as st

from folioscope.operators import ledger, recover
from folioscope.streaming import usual_pages


@given(st.lists(st.integers(1, 40), min_size=1, max_size=30), st.lists(st.integers(1, 40), max_size=30))
def test_summaries_of_merged_histograms(a, b):
    count = lambda xs: {x: xs.count(x) for x in set(xs)}
    assert usual_pages.summary(usual_pages.merged(count(a), count(b))) == (min(a + b), max(a + b), int(statistics.median(a + b) // 1), len(a + b))


def test_five_runs_equal_the_whole_ledger(spark, tmp_path):
    random.seed(3)
    book, target, check = (str(tmp_path / n) for n in ("ledger", "usual", "check"))
    schema = "company string, source_pdf string, phase string, action string, result string, extract_page int"
    for run in range(5):
        rows = [(f"Co & {random.randint(0, 5)}" if run else "Co & 1", f"f{run}-{k}", random.choice(["pass1", "pass1", "pass2"]), "EXTRACT", random.choice(["ok", "ok", "error"]), random.choice([None, *range(1, 60)])) for k in range(40)]
        rows += [("alone", f"g{run}", "pass1", "EXTRACT", "ok", 7)] * (run < 2)
        ledger.append(spark.createDataFrame(rows, schema), book, f"run{run}")
        usual_pages.run_available(spark, book, target, check)
        whole = recover.consensus(usual_pages.confirmed(ledger.read(spark, book))).drop("pages")
        assert sorted(map(tuple, usual_pages.read(spark, target).collect())) == sorted((r.company, r.min_page, r.max_page, r.median_page, r.n_years) for r in whole.collect())
    assert usual_pages.read(spark, target).where("company = 'alone'").count() == 0
    before = sorted(p.name for p in (tmp_path / "usual").rglob("*.parquet"))
    usual_pages.run_available(spark, book, target, check)
    assert sorted(p.name for p in (tmp_path / "usual").rglob("*.parquet")) == before
