"""Section location: rules, verdicts, finders, ledger and adapters on small tables."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from folioscope.config import EngineConfig
from folioscope.functions import text as T
from folioscope.operators import ledger, locate, recover, verdict
from folioscope.sources import classifier, corpus, files

H, B, S = corpus.HEADING, corpus.BODY, corpus.SIGNED


def judge(spark, texts):
    rows = [("c", "f", i + 1, t) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "company string, source_pdf string, page int, text string")
    return pages, verdict.judged(pages)


def test_verdicts(spark):
    cases = [
        ("", ""), (None, ""), ("nothing here", "no_canonical_heading"), (f"{H} are placed next to the report", "rejected_redirect"), ("Nil Comments", "nil_comments"),
        (f"{H} thereon", "canonical_without_body_or_sig"), ("Comments of the C&AG", "short_header_without_body_or_sig"), (f"{H}\n{B}", "canonical"), (f"{H} ...... 3\n{B}", "canonical_rejected_as_toc"),
        (f"{H} ...... 3\n{B}\n{S}", "canonical"), (f"C & AG Comments\n{S}", "short_header"), (f"CAG Comments\n45\n{S}", "short_header_rejected_as_toc"), (f"{H}\nNothing has come to our notice", "canonical"),
    ]
    _, got = judge(spark, [t for t, _ in cases])
    assert [r.kind for r in got.orderBy("page").collect()] == [k for _, k in cases]


def test_quirks(spark):
    _, got = judge(spark, [f"Comments of the Comptroller & Auditor General\n{B}", "éCAG Comments", f"Independent Auditor’s Report\n{H}\n{B}", f"Independent Auditor's Report\n{H}\n{B}\n{S}"])
    r = got.orderBy("page").collect()
    assert r[0].canonical and not r[1].short_header and not r[2].dq_head and r[3].dq_head and r[3].scan_kind == "strong_cag_overrides_dq"


def test_walk_stops_after_signature(spark):
    filler = "x" * 60
    pages, got = judge(spark, [f"{H}\n{B}\n{S}", filler, filler + S, filler, filler])
    starts = spark.createDataFrame([("c", "f", 1)], "company string, source_pdf string, start int")
    assert locate.section_ends(starts, got).first().end == 3


def test_walk_stops_at_cap_and_short_page(spark):
    filler = "x" * 60
    starts = spark.createDataFrame([("c", "f", 1)], "company string, source_pdf string, start int")
    assert locate.section_ends(starts, judge(spark, [filler] * 9)[1]).first().end == 6
    assert locate.section_ends(starts, judge(spark, [filler, filler, "   " * 30, filler])[1]).first().end == 2
    assert locate.section_ends(starts, judge(spark, [filler])[1]).first().end == 1


def test_names(spark):
    stems = {"R_2010-03-31": "2009-2010", "R_2010_03_31": "2009-2010", "R_2001-2002": "2001-2002", "a_2001_2002": "2001-2002", "R_1999_00": "1999-1900", "R_AR_1988": "1988", "Report 2011": "2011", "x_2011x": "", "Report": ""}
    got = spark.createDataFrame([(k,) for k in stems], "s string").select("s", T.fiscal_year(F.col("s")).alias("y")).collect()
    assert {r.s: r.y for r in got} == stems
    names = {"Andrew Yule & Company Ltd.": "Andrew_Yule", "The Co": "The_Co", "": "Unknown", "A B": "A_B", "Bharat Heavy Electricals Ltd": "Bharat_Heavy_Electricals"}
    got = spark.createDataFrame([(k,) for k in names], "s string").select("s", T.short_name(F.col("s")).alias("y")).collect()
    assert {r.s: r.y for r in got} == names


def loop_sample(ws, we, c):
    near = [p for p in range(ws, we + 1) if abs(p - c) <= 10]
    rest = [p for p in range(ws, we + 1) if abs(p - c) > 10]
    room = 30 - len(near)
    return sorted(near + (rest if len(rest) <= room else [rest[int(i * (len(rest) / room))] for i in range(room)]))


def test_samples_equal_a_loop(spark):
    import random

    random.seed(3)
    rows = [(a := random.randint(1, 90), a + random.randint(0, 150), random.randint(1, 200)) for _ in range(300)]
    got = spark.createDataFrame(rows, "ws int, we int, c int").select("ws", "we", "c", recover.sample_pages(F.col("ws"), F.col("we"), F.col("c")).alias("p")).collect()
    assert all(r.p == loop_sample(r.ws, r.we, r.c) for r in got)


def test_ledger(spark, tmp_path):
    lines = ["", "{bad", '{"source_pdf": "a", "source_hash": "1", "result": "error"}', '{"source_pdf": "a", "source_hash": "1", "result": "ok"}', '{"source_pdf": "b", "result": "ok"}']
    got = ledger.parse_lines(spark.createDataFrame(list(enumerate(lines)), "seq bigint, line string"))
    assert [tuple(r) for r in ledger.done_keys(got).collect()] == [("a", "1")]
    assert {r.source_pdf: r.result for r in ledger.latest(got).collect()} == {"a": "ok", "b": "ok"}
    path = str(tmp_path / "ledger")
    assert ledger.read(spark, path).count() == 0
    row = spark.createDataFrame([("c", "a", "1", "ok")], "company string, source_pdf string, source_hash string, result string")
    ledger.append(row, path, "one")
    ledger.append(row, path, "two")
    assert [r.run_id for r in ledger.read(spark, path).orderBy("seq").collect()] == ["one", "two"]
    assert ledger.pending(row, ledger.read(spark, path)).count() == 0


def test_stream_is_idempotent(spark, tmp_path):
    from folioscope.streaming import incremental

    pages = [("c", f"f{i}", f"R_AR_20{i:02}", f"h{i}", p, f"{H}\n{B}\n{S}" + "x" * 200 if p == 2 else "y" * 90) for i in range(4) for p in (1, 2, 3)]
    spark.createDataFrame(pages, incremental.PAGES).coalesce(1).write.parquet(str(tmp_path / "pages"))
    for _ in range(2):
        incremental.run_available(spark, str(tmp_path / "pages"), str(tmp_path / "ledger"), str(tmp_path / "check"))
    rows = ledger.read(spark, str(tmp_path / "ledger")).collect()
    assert len(rows) == 4 and all(r.action == "EXTRACT" and r.extract_page == 2 for r in rows)


def test_files_and_bad_pages(spark, tmp_path):
    for name in ("Acme/a.pdf", "Acme/archives/b.pdf", ".hidden/c.pdf", "Other/d/e.pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"one\ftwo" if name != "Other/d/e.pdf" else b"\xff")
    listed = files.list_files(spark, str(tmp_path))
    assert sorted(r.stem for r in listed.collect()) == ["a", "e"]
    for name in ("reports/Acme/old_reports/x.pdf", "reports/Acme/reports/y.pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"one")
    assert sorted((r.company, r.stem) for r in files.list_files(spark, f"{tmp_path}/reports/").select("company", "stem").collect()) == [("Acme", "x"), ("Acme", "y")]
    got = files.read_pages(listed, lambda b: b.decode().split("\f")).collect()
    assert sorted((r.page or 0, bool(r.error)) for r in got) == [(0, True), (1, False), (2, False)]


def test_pace():
    clock = [0.0]
    pace = classifier.Pace(["a" * 9, "b" * 9], 0.3, 65.0, lambda: clock[0], lambda s: clock.__setitem__(0, clock[0] + s))
    replies = iter(["YES", RuntimeError("429 slow"), RuntimeError("401"), "no, YES", RuntimeError("broken"), "NO"])

    def send(key):
        if isinstance(x := next(replies), Exception):
            raise x
        return x

    assert pace.call(send, 3) == "YES" and clock[0] == 0.0
    # b is throttled; a waits for its gap, is refused and leaves; b comes back after its cooldown
    assert pace.call(send, 3) == "no, YES" and clock[0] == 65.0
    assert pace.call(send, 1) is None
    assert pace.call(send, 1) == "NO" and round(clock[0], 6) == 65.6
    assert {k[1]: n for k, n in pace.used.items()} == {"answered": 1, "throttled": 1, "refused": 1, "failed": 1} or sum(pace.used.values()) == 6
    with pytest.raises(ValueError):
        classifier.Pace([], 0.3, 65.0)
    assert classifier.Pace(["a"], 0, 0).call(lambda k: (_ for _ in ()).throw(RuntimeError("403")), 3) is None


def test_usable_keys(monkeypatch):
    assert classifier.usable_keys(["", "sk-REPLACE_ME", "xxxx", " good "]) == ["good"]
    monkeypatch.setenv("OPENAI_API_KEY", "one,two")
    assert classifier.usable_keys() == ["one", "two"]
    monkeypatch.delenv("OPENAI_API_KEY")
    assert classifier.usable_keys() == []


def test_image_oracle():
    sent = []
    oracle = classifier.ImageOracle(["k" * 9], render=lambda s, p, d: b"jpeg" if p != 2 else None, send=lambda url, key, body: sent.append(body) or "yes")
    assert oracle("f", 1, "find") is True and oracle("f", 2, "find") is None
    assert sent[0]["messages"][0]["content"][1]["image_url"]["url"] == "data:image/jpeg;base64,anBlZw==" and sent[0]["max_tokens"] == 50
    assert classifier.request_arguments("o3-mini")["reasoning_effort"] == "low"


def test_page_images_read_and_convert_once(tmp_path):
    for name in ("a.pdf", "_b.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    made = []

    def convert(content, first, last, dpi):
        made.append((content, first, last))
        return [f"{content.decode()}:{p}@{dpi}" for p in range(first, min(last, 9) + 1)]

    render = classifier.PageImages(convert=convert)
    a, b = f"file:{tmp_path}/a.pdf", str(tmp_path / "_b.pdf")
    assert [render(a, p, 50) for p in (1, 2, 3, 4, 7, 8, 9, 10)] == [*(f"a.pdf:{p}@50" for p in (1, 2, 3, 4, 7, 8, 9)), None]
    assert render(b, 2, 50) == "_b.pdf:2@50" and render(a, 2, 50) == "a.pdf:2@50"
    assert made == [(b"a.pdf", 1, 4), (b"a.pdf", 7, 10), (b"_b.pdf", 2, 5), (b"a.pdf", 2, 5)]
    with pytest.raises(FileNotFoundError):
        render(str(tmp_path / "gone.pdf"), 1, 50)


def _page_judge(source, page, prompt):
    if page == 1:
        raise RuntimeError("no image")
    return page in (2, 3)


def test_a_bad_page_is_one_null_verdict(spark):
    rows = spark.createDataFrame([("c", "f", 9, [1, 2, 5]), ("c", "g", 1, [1])], "company string, source_pdf string, n_pages int, pages array<int>")
    got = classifier.ask_files(rows, _page_judge)
    assert sorted((r.source_pdf, r.page, r.verdict) for r in got.collect()) == [("f", 1, None), ("f", 2, True), ("f", 3, True), ("f", 4, False), ("g", 1, None)]
    assert recover.yes_range(recover.first_yes(rows, got), got).select("start", "end").collect() == [(2, 3)]


def _flaky_send(url, key, body):
    """Fails once for each key in a process, then answers."""
    seen = _flaky_send.__dict__
    seen[key] = seen.get(key, 0) + 1
    if seen[key] == 1:
        raise RuntimeError("broken")
    return "no"


def test_usage_counts_stored_replies_once(spark, tmp_path):
    """Calls come with the pages they were made for: a plan that is run again isn't counted again, once its replies are stored."""
    rows = spark.createDataFrame([("c", f"f{i}", 9, [1, 2, 3]) for i in range(4)], "company string, source_pdf string, n_pages int, pages array<int>")
    oracle = classifier.ImageOracle(["a" * 9], EngineConfig(requests_a_minute=10**9), render=lambda s, p, d: b"jpeg", send=_flaky_send)
    got = classifier.ask_files(rows.coalesce(1), oracle, tasks=1)
    got.write.parquet(str(tmp_path / "replies"))
    got.count()  # run once more
    stored = spark.read.parquet(str(tmp_path / "replies"))
    used = {(r.key, r.outcome): r.n for r in classifier.usage(stored).collect()}
    assert used == {("a" * 8, "answered"): 12, ("a" * 8, "failed"): 1} and stored.count() == 12
    assert sum(sum(r.calls.values()) for r in stored.collect()) == 13
    assert classifier.usage(classifier.ask_files(rows, _page_judge)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="YESNOT ", max_size=12))
def test_replies(reply):
    assert classifier.verdict_of(reply) == ("YES" in reply and "NO" not in reply) and classifier.verdict_of(None) is None


def test_window(spark):
    rows = [(a, b, n) for a in (1, 20, 300) for b in (a, a + 50) for n in (5, 60, 400)]
    ws, we = recover.search_window(F.col("a"), F.col("b"), F.col("n"), EngineConfig())
    for r in spark.createDataFrame(rows, "a int, b int, n int").select("a", "b", "n", ws.alias("ws"), we.alias("we")).collect():
        buffer = max(int(max(30, r.b - r.a + 1) * 0.3), 5)
        want = (max(1, r.a - buffer), min(r.n, r.b + buffer))
        assert (r.ws, r.we) == (want if want[0] <= want[1] else (1, r.n))


def _decode(content):
    if content == b"broken":
        raise ValueError("not a document")
    return content.decode().split("\f")


def _copy_pages(source, start, end, target):
    if "unwritable" in target:
        raise OSError("full")
    with files.opened(source) as f, files.created(target) as out:
        out.write("\f".join(_decode(f.read())[start - 1 : end]).encode())


def _second_page(source, page, prompt):
    return page == 2


def test_command_twice_over_folders(spark, tmp_path):
    """Folders of fake files through the command: sections and copies are written, a second run has nothing to do."""
    from folioscope.__main__ import main

    filler = "y" * 250
    section = "\f".join([filler, f"{H}\n{B}\n{S}" + "x" * 200, "short"])
    made = {"Acme Steel Ltd/R_AR_2001.pdf": section, "Acme Steel Ltd/deep/R_AR_2002.pdf": section, "Acme Steel Ltd/R_AR_2003.pdf": section, "Acme Steel Ltd/R_AR_2004.pdf": "one\ftwo\fthree", "Acme Steel Ltd/R_AR_2005.pdf": filler, "Acme Steel Ltd/archives/R_AR_1990.pdf": section, "Other/R_AR_2001.pdf": "broken"}
    for name, text in made.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    (tmp_path / "in" / "Empty").mkdir()
    given = [str(tmp_path / "in"), str(tmp_path / "out"), "--decode", f"{__name__}:_decode", "--write", f"{__name__}:_copy_pages"]
    out = tmp_path / "out"
    assert main([*given, "--skip-vision", "--dry-run"], spark) == 0
    assert not list(out.rglob("*.pdf"))
    assert main([*given, "--oracle", f"{__name__}:_second_page"], spark) == 0
    wrote = sorted(p.relative_to(out).as_posix() for p in out.rglob("*.pdf"))
    names = [f"Acme Steel Ltd/comments_mentioned/cag_pages/{y}__Acme_Steel__cag_p2_en.pdf" for y in (2001, 2002, 2003, 2004)]
    assert wrote == sorted([*names, "Acme Steel Ltd/no_comments_content/R_AR_2005.pdf"])
    assert (out / names[0]).read_text().startswith(H)
    rows = {(r.source_pdf.rsplit("/", 1)[-1], r.company, r.phase): r for r in ledger.read(spark, str(out / "_ledger")).where("result <> 'dry_run'").orderBy("seq").collect()}
    assert rows["R_AR_2001.pdf", "Other", "pass1"].action == "ERROR" and "not a document" in rows["R_AR_2001.pdf", "Other", "pass1"].evidence
    assert rows["R_AR_2004.pdf", "Acme Steel Ltd", "pass2"].action == "VISION" and rows["R_AR_2005.pdf", "Acme Steel Ltd", "pass2"].action == "TRULY_MISSING"
    report = spark.read.option("header", True).csv(str(out / "missing_years_report"))
    assert {(r.company, r.year, r.status, r.source_filename) for r in report.collect()} == {("Acme Steel Ltd", str(y), "present_clean", f"R_AR_{y}") for y in range(2001, 2005)} | {("Acme Steel Ltd", "2005", "missing_extract", "R_AR_2005"), ("Other", "2001", "missing_extract", "R_AR_2001")}
    assert [r.company for r in spark.read.option("header", True).csv(str(out / "companies_without_files")).collect()] == ["Empty"]
    before = ledger.read(spark, str(out / "_ledger")).count()
    assert main([*given, "--skip-vision", "--company", "acme"], spark) == 0
    assert ledger.read(spark, str(out / "_ledger")).count() == before
    assert len(list(out.glob("run_log_*.txt"))) >= 1


def test_command_exit_codes(spark, tmp_path, monkeypatch):
    from folioscope.__main__ import main

    monkeypatch.delenv("OPENAI_API_KEY", raising=False)
    assert main([str(tmp_path / "none"), str(tmp_path / "out")], spark) == 1
    assert main([str(tmp_path), str(tmp_path / "out")], spark) == 4


def test_unwritable_section_is_an_error_record(spark, tmp_path):
    rows = spark.createDataFrame([("s", "ok", "k", 1, 2, "c/unwritable.pdf", 5), ("s", "ok", "k", 9, 9, "c/x.pdf", 5), ("s", "deferred", "k", None, None, None, 5)], "source_pdf string, result string, evidence string, extract_page int, extract_end_page int, new_path string, n_pages int")
    got = files.write_sections(rows, _copy_pages, str(tmp_path)).collect()
    assert sorted((r.result, r.extract_page) for r in got) == [("deferred", None), ("error", None), ("error", None)]
    assert any("out_of_range" in r.evidence for r in got) and any("full" in r.evidence for r in got)


RULE_CASES = {
    "canonical": (["Comments of the Comptroller and Auditor General", "COMMENTS  of the comptroller & auditor general"], ["Comments of Comptroller and Auditor General"]),
    "short_header": (["Comments of C&AG", "comments of the CAG", "C & AG Comments", "Comments of C and AG"], ["xCAG Comments", "CAG Commentsx"]),
    "nil_comments": (["No Comments by the C & AG", "nil comments", "have decided not to conduct the supplementary audit"], ["No Comments by anyone"]),
    "body_behalf": (["I on behalf of the Comptroller and Auditor General"], ["on behalf of the Comptroller and Auditor General"]),
    "body_section": (["have conducted a supplementary audit under S. 619 (4)", "have conducted a supplementary audit under Section 143(6)"], ["have conducted a supplementary audit under Section 143(5)"]),
    "body_decl": (["Comptroller and Auditor General of India (CAG) has conducted a supplementary audit"], ["Comptroller and Auditor General has conducted a supplementary audit"]),
    "nil_body": (["nothing significant has come to knowledge", "no comment upon or supplement to", "nothing has come to my notice"], ["nothing came to my notice"]),
    "signature": (["Director General of Audit", "For on behalf of the Comptroller & Auditor General", "Pr Director of Audit", "Principal D\u0130rector of Commercial Audit"], ["Director of Audit"]),
    "redirect": (["annexed hereto", "forms part of this report", "appended to this report", "is enclosed herewith", "attached herewith", "placed after", "placed immediately after the Audit"], ["nothing of the kind"]),
    "any_evidence": (["Section 619 (2", "C & AG", "the CAG", "supplementary audit"], ["CAGE", "section 143 (5"]),
    "disqualifier": (["  Secretarial Auditors Report", "Cost Audit Report", "Form MGT-9", "x\nInternal Auditor's Report", "Directors Report to the Members"], ["a Form MGT-9"]),
    "firm": (["S.R.B.C & Co", "E.Y", "pwc", "BSR & Co", "(Firm Registration No", "Chartered Accountants\nFirm Registration"], ["they", "Sharp & Co"]),
}


def test_rules_by_literal_texts(spark):
    """Each alternative with both signs; the words by which texts are passed over change nothing."""
    from folioscope.functions.rules import PRESET, folded

    for name, (yes, no) in RULE_CASES.items():
        rule = getattr(PRESET, name)
        t = spark.createDataFrame([(x, True) for x in yes] + [(x, False) for x in no], "t string, want boolean")
        got = t.select("t", "want", rule.found(F.col("t"), folded(F.col("t"))).alias("gated"), rule.found(F.col("t")).alias("bare")).collect()
        assert [(r.t, r.gated, r.bare) for r in got if not r.gated == r.bare == r.want] == [], name


def test_contents_evidence_by_literal_texts(spark):
    """What the contents gave, the entry, and each page tried up to the accepted one."""
    filler = "y" * 120
    good = f"{H}\n{B}\n{S}" + "x" * 60
    contents = lambda n: "\n".join(["Contents", "Notice of the meeting ........ 2", "Report of the board ........ 3", f"{H}   of  India ........ {n}", "Accounts of the year ........ 9", filler])
    cases = {
        "none": [filler, good],
        "no_entry": [contents(2).replace(H, "Nothing"), filler, good],
        "hit": [contents(2), filler, "", good, filler],
        "exact": [filler, contents(4), filler, good],
        "failed": [contents(2), filler, ""],
        "beyond": [contents(99), filler, good],
    }
    rows = [("c", name, i + 1, t) for name, texts in cases.items() for i, t in enumerate(texts)]
    judged = verdict.judged(spark.createDataFrame(rows, "company string, source_pdf string, page int, text string"))
    jump = locate.toc_jump(locate.toc_entries(judged), judged)
    got = {r.source_pdf: r.toc for r in locate.toc_outcome(locate.text_layer(judged), jump).collect()}
    entry = f"{H} o"  # 60 characters of the entry, spaces as one
    assert got["none"] == "no_toc_pages" and got["no_entry"] == got["beyond"] == "no_entries_in_toc(toc_pages=1)"
    assert got["hit"] == f"toc_validated|toc_p1|matched:{entry}|target_p2|hit_p4|validation:p2=no,p3=no_text,p4=OK|canonical"
    assert got["exact"] == f"toc_validated|toc_p2|matched:{entry}|target_p4|hit_p4|validation:p4=OK|canonical"
    assert got["failed"] == "toc_validation_failed|toc_p1|target_p2|tried:p2=no,p3=no_text,p4=out_of_range,p5=out_of_range,p6=out_of_range,p7=out_of_range"


def test_signals_name_what_was_overridden(spark):
    texts = [f"{H} ...... 3\n{B}\n{S}", f"{H} ...... 3\n{B}", f"{H}\n{B}", "Nil Comments", f"CAG Comments\n45\n{B}\n{S}"]
    got = [r.signals for r in judge(spark, texts)[1].orderBy("page").collect()]
    assert got == ["canonical(canonical+body+sig)|overrides_toc(toc_tail)", "canonical_rejected_as_toc(canonical+body)|toc_tail", "canonical(canonical+body)", "nil_comments()", "short_header(short+body+sig)|overrides_toc(toc_tail)"]


def test_section_texts_by_either_way(spark):
    """Ranges sent to the pages, or met in a shuffle, give the same; sent ones leave no exchange of texts."""
    pages = spark.createDataFrame([("c", f"f{i}", p, f"{i}-{p}" if p != 3 else None) for i in range(3) for p in range(1, 6)], "company string, source_pdf string, page int, text string")
    ranges = spark.createDataFrame([("c", "f0", 2, 4), ("c", "f2", 5, 5), ("c", "gone", 1, 2)], 'company string, source_pdf string, start int, end int')
    ways = [locate.section_texts(ranges, pages, n) for n in (None, 3, locate.SENT + 1)]
    want = [("c", "f0", "0-2\n\n0-4", 3), ("c", "f2", "2-5", 1)]
    assert all(sorted(map(tuple, w.collect())) == want for w in ways)
    assert "BroadcastHashJoin" in ways[1]._jdf.queryExecution().executedPlan().toString()
