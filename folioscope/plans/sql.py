"""The registered queries in DuckDB SQL, written from their definitions. Patterns come from the catalogue; RE2 needs no lookaround for them."""

from __future__ import annotations

from ..functions import rules as R
from ..sources import corpus as C


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _has(rule: R.Rule, of: str) -> str:
    flags = rule.flags
    return f"regexp_matches({of}, {_q((f'(?{flags})' if flags else '') + rule.pattern)})"


def _count(rule: R.Rule, of: str) -> str:
    return f"cast(len(regexp_extract_all({of}, {_q(f'(?{rule.flags})' + rule.pattern)})) as int)"


def _tail(rule: R.Rule) -> str:
    return f"regexp_extract(text, {_q('(?i)' + rule.pattern + '([\\s\\S]{0,80})')}, 1)"


def _join(*lines: str) -> str:
    return " || chr(10) || ".join(lines)


_P = R.PRESET
_H, _S, _B, _G = _q(C.HEADING), _q(C.SHORT), _q(C.BODY), _q(C.SIGNED)
_YEAR = """case when regexp_matches(stem, '\\d{4}-03-31') then cast(cast(regexp_extract(stem, '(\\d{4})-03-31', 1) as int) - 1 as varchar) || '-' || regexp_extract(stem, '(\\d{4})-03-31', 1)
 when regexp_matches(stem, '\\d{4}_03_31') then cast(cast(regexp_extract(stem, '(\\d{4})_03_31', 1) as int) - 1 as varchar) || '-' || regexp_extract(stem, '(\\d{4})_03_31', 1)
 when regexp_matches(stem, '\\d{4}-\\d{4}') then regexp_extract(stem, '\\d{4}-\\d{4}')
 when regexp_matches(stem, '\\d{4}_\\d{4}') then replace(regexp_extract(stem, '\\d{4}_\\d{4}'), '_', '-')
 when regexp_matches(stem, '\\d{4}_\\d{2}(_|$|\\.)') then regexp_extract(stem, '(\\d{4})_\\d{2}(_|$|\\.)', 1) || '-' || substr(regexp_extract(stem, '(\\d{4})_\\d{2}(_|$|\\.)', 1), 1, 2) || regexp_extract(stem, '\\d{4}_(\\d{2})(_|$|\\.)', 1)
 when regexp_matches(stem, '_AR_\\d{4}\\b') then regexp_extract(stem, '_AR_(\\d{4})\\b', 1)
 when regexp_matches(stem, '\\b20\\d{2}\\b') then regexp_extract(stem, '\\b(20\\d{2})\\b', 1) else '' end"""
_DROPPED = ", ".join(map(_q, R.DROPPED_WORDS))
_WORDS = "list_filter(string_split_regex(regexp_replace(company, '[^\\w\\s&]', '', 'g'), '\\s+'), lambda w: w <> '')"
_SAID = f"list_filter({_WORDS}, lambda w: lower(w) not in ({_DROPPED}) and length(w) > 1)"
_SHORT = f"coalesce(nullif(trim(regexp_replace(array_to_string(case when len({_SAID}) > 0 then {_SAID}[1:3] else {_WORDS}[1:2] end, '_'), '_{{2,}}', '_', 'g'), '_'), ''), 'Unknown')"
_NAME = f"""case when year <> '' then year || '__' || short || '__' else stem || '__' end || 'cag_p' || "start" || case when "end" > "start" then '-' || "end" else '' end || '_en.pdf'"""

BASE = f"""
with all_files as (select doc_id, company, '/corpus/' || company || '/d' || doc_id || case when doc_id % 97 = 0 then '/archives/' else '/' end || stem || '.pdf' as source_pdf, stem,
  substr(sha1(stem || '|' || doc_id), 1, 16) as source_hash, n, k, odd, cast(1 + doc_id % (n - 2) as int) as p, cast(2 + doc_id % (n - 4) as int) as t, text, {_YEAR} as year, {_SHORT} as short
 from (select *, case i % 8 when 0 then 'R_' || y || '-03-31' when 1 then 'R_' || y || '_03_31' when 2 then 'R_AR_' || (y - 1) || '-' || y when 3 then 'R_' || (y - 1) || '_' || y
   when 4 then 'R_' || (y - 1) || '_' || lpad(cast(y % 100 as varchar), 2, '0') when 5 then 'R_AR_' || y when 6 then 'Report ' || y else 'Report' end as stem
  from (select doc_id, text, doc_id // 20 as i, 1975 + doc_id // 20 % 45 as y, source || ' Steel & Power Corporation of India Ltd.' as company, cast(ceil(length(text) / 400.0::double) + 4 as int) as n,
    (doc_id // 20 // 10) % 2 as odd, case when doc_id // 20 % 10 in (0, 3, 4, 5, 8) and (doc_id % 20 = 3 or doc_id % 20 = 7 and doc_id // 20 > 0) then 9 else doc_id // 20 % 10 end as k from documents))),
files as materialized (select * from all_files where not contains(source_pdf, '/archives/')),
pages as materialized (select company, source_pdf, page, case
   when k = 7 then '' when k = 0 and page = p then {_join(_H, 'raw', _B, _G)} when k = 0 and odd = 1 and page = p + 1 then {_q(C.HINDI)}
   when k = 1 and page = p then case when odd = 1 then {_join(_S, 'raw')} else {_join(_q(C.HEADING + ' thereon'), 'raw')} end
   when k = 2 and page = p then case when odd = 1 then {_join(_H, "'45'", 'raw', _B)} else {_join(_q(C.HEADING + ' are placed next to the report'), 'raw')} end
   when k = 3 and page = p then case when odd = 1 then {_join(_S, 'raw', _G)} else {_join("'Nil Comments'", 'raw')} end when k = 3 and odd = 1 and page = p + 1 then {_join("'Notice of Annual General Meeting'", 'raw')}
   when k = 4 and page = 1 then {_join("'Contents'", "'Notice of the meeting ........ 2'", "'Report of the board ........ 3'", _q(C.HEADING + ' ........ ') + ' || t', "'Accounts of the year ........ 9'", 'raw')}
   when k = 4 and page = t + 2 then {_join(_H, 'raw', _B, _G)}
   when k = 5 and page = p then {_join(_q("Independent Auditor's Report"), _H, 'raw', _B, _G)} when k = 6 and page = p then {_join(_q("Independent Auditor's Report"), _H, _B, 'raw', 'raw', "'Deloitte Haskins & Sells'")}
   when k = 8 and page = p then case when odd = 1 then {_join(_q(C.SHORT + ' ........ 12'), 'raw', _B)} else {_join(_q(C.SHORT + ' ........ 12'), 'raw', _B, _G)} end
   else raw end as text
  from (select *, case when page <= n - 4 then substr(text, (page - 1) * 400 + 1, 400) else 'This page was left for notes of readers of the report, number ' || page || '.' end as raw
   from (select *, cast(unnest(range(1, n + 1)) as int) as page from files))),
f0 as (select company, source_pdf, page, text, cast(length(text) as int) as n_chars, {_has(_P.canonical, 'text')} as canonical, {_has(_P.short_header, 'text')} as short_header, {_has(_P.nil_comments, 'text')} as nil_comments,
  {_has(_P.body_behalf, 'text')} or {_has(_P.body_section, 'text')} or {_has(_P.body_decl, 'text')} as body, {_has(_P.nil_body, 'text')} as nil_body, {_has(_P.signature, 'text')} as signature, {_has(_P.redirect, 'text')} as redirect,
  {_has(_P.any_evidence, 'text')} as any_evidence, {_count(_P.toc_dotted_line, 'text')} as toc_dotted_n, {_count(_P.toc_dotless_line, 'text')} as toc_dotless_n,
  case when {_has(_P.canonical, 'text')} then {_has(_P.toc_tail, _tail(_P.canonical))} when {_has(_P.short_header, 'text')} then {_has(_P.toc_tail, _tail(_P.short_header))} else false end as tail_hit,
  substr(text, cast(floor(length(text) * 0.4::double) as int) + 1) as low, {_has(_P.disqualifier, 'substr(text, 1, 300)')} as dq_head, {_has(_P.disqualifier, 'substr(text, 1, 600)')} as dq_walk,
  cast(length(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) as int) as n_stripped,
  coalesce(len(regexp_extract_all(text, '[\\x{{0900}}-\\x{{097F}}]'))::double / nullif(len(regexp_extract_all(text, '\\p{{L}}')), 0), 0.0::double) as script_ratio from pages),
f1 as (select *, canonical or short_header as head, nil_comments or nil_body as nil, {_has(_P.firm, 'low')} and not {_has(_P.signature, 'low')} as ca_firm, {_has(_P.signature, 'low')} as signature_bottom,
  (canonical or short_header) and redirect and not body and not signature as is_redirect, n_stripped >= 50 and script_ratio <= 0.3::double and not dq_walk as cont, n_chars >= 100 and (toc_dotted_n >= 3 or toc_dotless_n >= 5) as toc_like,
  (canonical or short_header)::int + body::int + signature::int as score, case when not (canonical or short_header) then '' when tail_hit then 'toc_tail' when toc_dotted_n >= 3 then 'toc_dotted' when toc_dotless_n >= 3 then 'toc_dotless' else '' end as toc_reason from f0),
f2 as (select *, not ca_firm and score >= 2 as strong, case when n_chars = 0 then '' when is_redirect then 'rejected_redirect' when not head and nil_comments then 'nil_comments' when not head then 'no_canonical_heading'
   when not body and not signature and not nil then case when canonical then 'canonical_without_body_or_sig' else 'short_header_without_body_or_sig' end
   when toc_reason <> '' and not (body and signature) then case when canonical then 'canonical_rejected_as_toc' else 'short_header_rejected_as_toc' end
   when canonical then 'canonical' else 'short_header' end as kind from f1),
f3 as (select *, kind in ('canonical', 'short_header', 'nil_comments') as ok, case when n_chars = 0 then null when dq_head then case when strong then 'strong_cag_overrides_dq' end when kind in ('canonical', 'short_header', 'nil_comments') then kind end as scan_kind,
  concat_ws('+', case when canonical then 'canonical' end, case when short_header then 'short' end, case when body then 'body' end, case when signature then 'sig' end, case when nil_body then 'nil_body' end) as parts,
  case when n_stripped < 50 then 'short' when script_ratio > 0.3::double then 'script' when dq_walk then 'disqualifier' else '' end as stop from f2),
judged as materialized (select *, coalesce(scan_kind, kind) || '(' || parts || ')' || case when toc_reason = '' then '' when ok then '|overrides_toc(' || toc_reason || ')' when ends_with(kind, '_as_toc') then '|' || toc_reason else '' end as signals from f3),
layer as (select company, source_pdf, cast(sum(n_chars) as bigint) as n_chars, sum(n_chars) >= 200 as has_text, max(page) as n_pages, bool_or(any_evidence) as evidence, count(*) filter (where n_chars > 0) as n_written, coalesce(string_agg(cast(page as varchar), ',' order by page) filter (where toc_like and page <= 10), '') as toc_pages from judged group by all),
e0 as ({' union all '.join(f"select company, source_pdf, page as toc_page, {i} as pattern, regexp_extract_all(text, {_q('(?im)' + r.pattern)}, 1) as found, regexp_extract_all(text, {_q('(?im)' + r.pattern)}, 0) as texts from judged where toc_like and page <= 10" for i, r in enumerate(_P.toc_entries))}),
e1 as (select company, source_pdf, toc_page, pattern, unnest(range(0, len(found))) as position, unnest(found) as number, unnest(texts) as entry from e0),
entries as (select e1.company, e1.source_pdf, toc_page, pattern, cast(position as int) as position, cast(number as int) as target, trim(regexp_replace(substr(entry, 1, 60), '[ \\t\\n\\r\\f]+', ' ', 'g')) as matched from e1 join layer using (company, source_pdf) where cast(number as int) between 1 and n_pages),
chosen as (select company, source_pdf, arg_min(target, (toc_page, pattern, position)) as target, arg_min(matched, (toc_page, pattern, position)) as matched, min(toc_page) as toc_page from entries group by all),
looked as (select c.company, c.source_pdf, c.page, case when c.page > n_pages then 'out_of_range' when coalesce(j.n_chars, 0) = 0 then 'no_text' when j.ok then 'OK' else 'no' end as said, j.kind, j.signals
  from (select *, cast(unnest(range(target, target + 6)) as int) as page from chosen) c join layer l using (company, source_pdf) left join judged j on j.source_pdf = c.source_pdf and j.page = c.page),
accepted as (select source_pdf, min(page) as "start", arg_min(kind, page) as kind, arg_min(signals, page) as signals from looked where said = 'OK' group by all),
jump as (select c.company, c.source_pdf, c.toc_page, c.matched, c.target, a."start", a.kind, a.signals, (select string_agg('p' || page || '=' || said, ',' order by page) from looked k where k.source_pdf = c.source_pdf and page <= coalesce(a."start", 1000000)) as tried from chosen c left join accepted a using (source_pdf)),
scan as (select company, source_pdf, min(page) as "start", arg_min(scan_kind, page) as kind, arg_min(signals, page) as signals from judged where scan_kind is not null group by all),
starts as (select company, source_pdf, coalesce(j."start", s."start") as "start", case when j."start" is not null then 'toc' else 'strict_rule' end as method, case when j."start" is not null then 'toc_jump' else s.kind end as kind, coalesce(j.signals, s.signals) as signals
  from (select * from jump where "start" is not null) j full join scan s using (company, source_pdf)),
walk as (select s.source_pdf, j.page, min(j.page) filter (where not j.cont) over (partition by s.source_pdf) as bad, min(j.page) filter (where j.signature) over (partition by s.source_pdf) as sig from starts s join judged j on s.source_pdf = j.source_pdf and j.page between s."start" + 1 and s."start" + 5),
ranges as materialized (select s.*, coalesce(w.e, s."start") as "end",
  coalesce(case when r.sig < coalesce(r.bad, 1000000) then 'signature' else (select j.stop from judged j where j.source_pdf = s.source_pdf and j.page = r.bad) end, case when n_pages >= s."start" + 5 then 'cap' else 'eof' end) as stop
  from starts s join layer using (company, source_pdf) left join (select source_pdf, min(bad) as bad, min(sig) as sig from walk group by all) r using (source_pdf)
  left join (select source_pdf, max(page) as e from walk where page < coalesce(bad, 1000000) and page <= coalesce(sig, 1000000) group by all) w using (source_pdf)),
toc as (select company, source_pdf, case when toc_pages = '' then 'no_toc_pages' when target is null then 'no_entries_in_toc(toc_pages=' || toc_pages || ')' when "start" is null then 'toc_validation_failed|toc_p' || toc_page || '|target_p' || target || '|tried:' || tried
  else 'toc_validated|toc_p' || toc_page || '|matched:' || matched || '|target_p' || target || '|hit_p' || "start" || '|validation:' || tried || '|' || kind end as toc from layer left join jump using (company, source_pdf)),
pass1 as materialized (select company, source_pdf, source_hash, year, 'pass1' as phase, cast(null as varchar) as pass1_action, action, case action when 'EXTRACT' then 'ok' when 'ERROR' then 'error' else 'deferred' end as result,
  case when hit then method end as method, case action when 'ERROR' then 'could_not_open_source' when 'DEFER_VISION' then 'no_text_layer|n_pages=' || n_pages when 'DEFER_XY' then 'toc:' || toc || '|scanned=' || n_written else kind || '|' || signals || '|toc:' || toc || '|walk:' || stop end as evidence, case when hit then "start" end as extract_page, case when hit then "end" end as extract_end_page,
  case when hit then company || '/comments_mentioned/cag_pages/' || {_NAME} end as new_path
 from (select f.*, r."start", r."end", r.method, r.kind, r.signals, r.stop, t.toc, n_pages, n_written, has_text and r."start" is not null as hit, case when n_pages is null then 'ERROR' when not has_text then 'DEFER_VISION' when r."start" is null then 'DEFER_XY' else 'EXTRACT' end as action
  from files f left join layer l using (company, source_pdf) left join toc t using (company, source_pdf) left join ranges r using (company, source_pdf))),
agreed as (select company, min(extract_page) as min_page, max(extract_page) as max_page, cast(floor(median(extract_page)) as int) as median_page, count(*) as n_years, list_sort(list(extract_page)) as pages from pass1 where result = 'ok' group by company having count(*) >= 3),
plan as materialized (select company, source_pdf, source_hash, year, action as pass1_action, l.n_pages, l.evidence, n_years is not null as eligible,
  case when n_years is null then 1 when b.lo > b.hi then 1 else b.lo end as ws, case when n_years is null then n_pages when b.lo > b.hi then n_pages else b.hi end as we, coalesce(median_page, n_pages // 2) as centre
 from pass1 join layer l using (company, source_pdf) left join agreed using (company),
 lateral (select greatest(1, min_page - greatest(5, cast(floor(greatest(30, max_page - min_page + 1) * 0.3::double) as int))) as lo, least(n_pages, max_page + greatest(5, cast(floor(greatest(30, max_page - min_page + 1) * 0.3::double) as int))) as hi) b
 where result = 'deferred'),
replies as (select company, source_pdf, page, case (doc_id * 31 + page) % 13 when 0 then true when 1 then null else false end as verdict from (select *, cast(unnest(range(1, n + 1)) as int) as page from files)),
w0 as (select source_pdf, cast(unnest(range(ws, we + 1)) as int) as page, centre from plan),
w1 as (select *, abs(page - centre) <= 10 as near from w0),
w2 as (select *, 30 - count(*) filter (where near) over (partition by source_pdf) as room, count(*) filter (where not near) over (partition by source_pdf) as m, row_number() over (partition by source_pdf, near order by page) - 1 as r from w1),
sampled as materialized (select source_pdf, page from w2 where near or m <= room or exists (select 1 from range(0, 30) g(i) where i < room and floor(i * (m::double / room)) = r)),
yes as (select company, source_pdf, min(page) as "start" from sampled join replies using (source_pdf, page) where verdict group by all),
yesno as (select y.source_pdf, r.page, min(r.page) filter (where r.verdict is not true) over (partition by y.source_pdf) as bad from yes y join replies r on y.source_pdf = r.source_pdf and r.page between y."start" + 1 and y."start" + 5),
yesrange as (select y.*, coalesce(e, y."start") as "end" from yes y left join (select source_pdf, max(page) as e from yesno where page < coalesce(bad, 1000000) group by all) using (source_pdf)),
modes as (select p.*, f.stem, f.short, y."start" as s0, y."end" as e0, mode, p.pass1_action = 'DEFER_VISION' or p.evidence as looks from plan p join files f using (company, source_pdf) cross join (values ('on'), ('off'), ('dry')) v(mode) left join yesrange y on y.source_pdf = p.source_pdf),
asked as (select *, (select count(*) from sampled x where x.source_pdf = modes.source_pdf) as n_sampled, case when mode = 'on' and looks then s0 end as "start", case when mode = 'on' and looks then e0 end as "end" from modes),
pass2 as materialized (select mode, company, source_pdf, source_hash, year, 'pass2' as phase, pass1_action, case when not looks or mode = 'off' or mode = 'on' and "start" is null then 'TRULY_MISSING' when pass1_action = 'DEFER_VISION' then 'VISION' else 'VISION_AGG' end as action,
  case when not looks or mode = 'off' or mode = 'on' and "start" is null then 'no_match' when mode = 'dry' then 'dry_run' else 'ok' end as result, cast(null as varchar) as method,
  case when not looks then case when eligible then 'no_keywords_anywhere|skipped_vision' else 'no_keywords_anywhere|not_eligible_xy' end when mode = 'off' then case when pass1_action = 'DEFER_VISION' then 'scanned_pdf|vision_disabled' else 'deterministic_failed|vision_disabled' end
   when mode = 'dry' then 'would_look|p' || ws || '-p' || we when "start" is not null then 'vision_hit|sampled=' || n_sampled else 'vision_no_match|window=p' || ws || '-p' || we || '|sampled=' || n_sampled end as evidence, "start" as extract_page, "end" as extract_end_page,
  case when "start" is not null then company || '/comments_mentioned/cag_pages/' || {_NAME} end as new_path from asked),
l0 as (select doc_id, company, source_pdf, source_hash, unnest([0, 1]) as turn from files),
l1 as (select doc_id * 2 + turn as seq, case when doc_id % 11 = 0 then '  ' when doc_id % 7 = 0 then '{{"source_pdf": "x", ' else to_json(struct_pack(company := company, source_pdf := source_pdf, source_hash := case when doc_id % 13 <> 0 then source_hash end, phase := 'pass1',
  action := case when doc_id % 4 = 0 then 'TRULY_MISSING' else 'EXTRACT' end, result := ['ok', 'error', 'deferred'][(doc_id + turn) % 3 + 1]))::varchar end as line from l0 where turn = 0 or doc_id % 5 = 0),
ledger as materialized (select seq, line->>'$.source_pdf' as source_pdf, line->>'$.source_hash' as source_hash, line->>'$.phase' as phase, line->>'$.action' as action, line->>'$.result' as result from l1 where trim(line) <> '' and json_valid(line)),
lastrow as (select source_pdf, max(seq) as seq, arg_max(action, seq) as action, arg_max(result, seq) as result from ledger group by source_pdf),
report as (select company, a.year, case when p.path is not null then 'present_clean' else 'missing_extract' end as status, max(stem) as source_filename, coalesce(p.path, '') as extract_path
  from files a left join (select company, year, min(new_path) as path from (select company, year, new_path, result from pass1 union all select company, year, new_path, result from pass2 where mode = 'on') where result = 'ok' and year <> '' group by all) p using (company, year) where a.year <> '' group by company, a.year, p.path)
"""

_KEY = "company, source_pdf, page"

_FINAL = {
    "company_filter": "select company, source_pdf from files where contains(lower(company), 'src1')",
    "company_nonempty": "select company, count(*) as n_files, count(*) filter (where stem = 'Report') as n_undated from all_files group by company",
    "page_count": "select company, source_pdf, max(page) as n_pages from pages group by all",
    "ledger_done_keys": "select distinct source_pdf, source_hash from ledger where result = 'ok' and source_pdf <> '' and source_hash <> ''",
    "resume_presence": """select source_pdf from files f where not exists (select 1 from pass1 p join files g using (source_pdf) where p.result = 'ok' and p.extract_page % 2 = 0 and g.year <> '' and g.company = f.company and g.year = f.year and g.short = f.short)
      and not exists (select 1 from files g where g.doc_id % 6 = 0 and g.company = f.company and g.stem = f.stem)
      and not exists (select 1 from pass1 p join files g using (source_pdf) where p.result = 'ok' and p.extract_page % 2 = 0 and g.year = '' and g.company = f.company and f.year = g.stem and f.year <> '')""",
    "section_text": """select p.company, p.source_pdf, string_agg(text, chr(10) order by page) as text, count(*) as n_pages from pages p join ranges r on p.source_pdf = r.source_pdf and page between "start" and "end" group by all""",
    "ledger_append": "select seq, source_pdf, phase, action, result from ledger union all select 10000000, source_pdf, phase, action, result from pass1",
    "organize_no_section": "select company, source_pdf from files f join lastrow l using (source_pdf) where action = 'TRULY_MISSING' and result <> 'ok' and not exists (select 1 from files g where g.doc_id % 8 = 0 and g.company = f.company and g.stem = f.stem)",
    "coverage_report": "select * from report",
    "output_name": f"select source_pdf, {_NAME} as name, company || '/comments_mentioned/cag_pages/' || {_NAME} as path from ranges join files using (company, source_pdf)",
    "fiscal_year": "select source_pdf, year from all_files",
    "short_name": "select distinct company, short from all_files",
    "content_hash": "select doc_id, substr(sha1(text), 1, 16) as hash from documents",
    "text_slices": f"select {_KEY}, substr(text, 1, 300) as head, substr(text, 1, 600) as walk_head, low as bottom from f0",
    "continuation_flags": f"select {_KEY}, n_stripped, dq_walk, cont from judged",
    "script_ratio": f"select {_KEY}, round(script_ratio, 9) as script_ratio, script_ratio > 0.3::double as hindi from judged",
    "toc_line_counts": f"select {_KEY}, toc_dotted_n, toc_dotless_n from judged",
    "evidence_render": f"select {_KEY}, concat_ws('+', case when canonical then 'canonical' end, case when short_header then 'short' end, case when body then 'body' end, case when signature then 'sig' end, case when nil_body then 'nil_body' end) as evidence from judged",
    "search_window": "select source_pdf, eligible, ws, we, centre from plan",
    "reply_parse": f"select {_KEY}, reply, contains(upper(reply), 'YES') and not contains(upper(reply), 'NO') as verdict from (select *, ['YES', 'yes.', 'No', 'YES and NO', 'NOT SURE', 'UNKNOWN', ''][page % 7 + 1] as reply from pages)",
    "rule_flags": f"select {_KEY}, canonical, short_header, nil_comments, body, nil_body, signature, redirect, any_evidence, dq_head from judged",
    "toc_match": f"select {_KEY}, toc_reason from judged",
    "signature_bottom": f"select {_KEY}, signature_bottom from judged",
    "ca_firm_signature": f"select {_KEY}, ca_firm from judged",
    "strong_signature": f"select {_KEY}, score, strong from judged",
    "redirect_page": f"select {_KEY}, is_redirect from judged",
    "page_verdict": f"select {_KEY}, ok, kind, scan_kind from judged",
    "any_evidence": "select company, source_pdf, evidence from layer",
    "toc_like": f"select {_KEY}, toc_like from judged",
    "toc_entries": "select * from entries",
    "toc_jump": "select * from jump",
    "toc_evidence": "select * from toc",
    "page_signals": f"select {_KEY}, signals from judged",
    "first_section_page": """select company, source_pdf, "start", kind from scan""",
    "scan_position": """select j.company, j.source_pdf, count(*) filter (where page <= coalesce(s."start", 1000000)) as scanned from judged j left join scan s using (source_pdf) where n_chars > 0 group by all""",
    "priority_scan": """select company, source_pdf, arg_min(page, (far, page)) as "start", arg_min(scan_kind, (far, page)) as kind from (select j.*, abs(page - 6) > 2 and n_pages - 1 > 9 as far from judged j join layer l using (source_pdf)) where scan_kind is not null group by all""",
    "section_start": "select * from starts",
    "section_range": "select * from ranges",
    "vision_sample": "select source_pdf, count(*) as n_sampled, string_agg(cast(page as varchar), ',' order by page) as sampled from sampled group by all",
    "vision_first_yes": "select * from yes",
    "vision_range": "select * from yesrange",
    "resume_done_anti": "select source_pdf from files f where not exists (select 1 from ledger l where l.result = 'ok' and l.source_pdf = f.source_pdf and l.source_hash = f.source_hash)",
    "ledger_latest": "select * from lastrow",
    "text_layer": "select company, source_pdf, n_chars, has_text from layer",
    "company_consensus": "select * replace (array_to_string(pages, ',') as pages) from agreed",
    "action_histogram": "select phase, action, count(*) as n from (select phase, action from pass1 union all select phase, action from pass2 where mode = 'on') group by all",
    "coverage_totals": "select count(*) as n_rows, count(*) filter (where status = 'present_clean') as n_present, count(*) filter (where status = 'missing_extract') as n_missing, count(distinct company) as n_companies from report",
    "stream_usual_pages": "select company, min_page, max_page, median_page, n_years from agreed",
    "stream_paged_files": "select source_pdf, phase, action, result, extract_page from pass1 union all select source_pdf, phase, action, result, extract_page from pass2 where mode = 'on'",
    "pass1_actions": "select * from pass1",
    "pass2_plan": "select * from plan",
    "pass2_actions": "select * from pass2",
    "actions_all": "select source_pdf, phase, action, result, extract_page from pass1 union all select source_pdf, phase, action, result, extract_page from pass2 where mode = 'on'",
}

SQL = {name: BASE + final for name, final in _FINAL.items()}
