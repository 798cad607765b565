"""The same rules as SQL text for DuckDB, to check the queries against another engine."""

from __future__ import annotations

import re

from ..functions import lexicon as L
from ..functions.text import DASHES, key_of

LEX = L.LATIN


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(s: str) -> str:
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def clean(s: str) -> str:
    return strip(rf"regexp_replace(regexp_replace(translate({s}, chr(160) || chr(12288), '  '), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


def key(s: str) -> str:
    return rf"regexp_replace(lower({s}), '[\s\-{DASHES}_/\\.]+', '', 'g')"


def any_term(k: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({k}, {q(key_of(t))})" for t in terms) + ")" if terms else "false"


def listed(tests: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {t} THEN {q(v)} END" for t, v in tests) + "], lambda v: v IS NOT NULL)"


def matched(k: str, terms: list[str]) -> str:
    return listed([(f"contains({k}, {q(key_of(t))})", t) for t in terms])


def categories(k: str, table: dict[str, list[str]]) -> str:
    return listed([(any_term(k, ts), c) for c, ts in table.items()])


#: Guarded obligations without look-arounds, which RE2 lacks.
GUARDED = {"need": r"(regexp_matches({s}, 'need($|[^l]|l$|l[^e])'))", "is": r"(regexp_matches({s}, '\bis\b'))"}


def obligations(s: str, k: str, lex: L.Lexicon = LEX) -> list[tuple[str, str]]:
    return [(GUARDED[t].format(s=s) if t in lex.guarded else f"contains({k}, {q(key_of(t))})", t) for t in lex.obligations]


def has_obligation(s: str, k: str) -> str:
    return "(" + " OR ".join(t for t, _ in obligations(s, k)) + ")"


def is_heading(s: str) -> str:
    k = key(s)
    no = rf"(regexp_matches({s}, '^[\d\s./\-–—()（）%]+$') OR {has_obligation(s, k)} OR regexp_matches({s}, '[。！？；;]$') OR len(regexp_extract_all({s}, '[，,：:]')) >= 3)"
    yes = rf"(regexp_matches({s}, '^第.{{1,12}}[章節篇]') OR regexp_matches({s}, '^\d+([.\-]\d+){{1,5}}\s*[\x{{3400}}-\x{{9fff}}A-Za-z]') OR regexp_matches({s}, '^\d+[、.]\s*[\x{{3400}}-\x{{9fff}}A-Za-z]{{2,}}') OR {any_term(k, LEX.headings + LEX.plain_headings)})"
    return f"(length({s}) BETWEEN 2 AND 90 AND NOT {no} AND {yes})"


def joined(xs: str) -> str:
    return f"array_to_string({xs}, '|')"


def firsts(xs: str) -> str:
    """Each value once, where it first stands."""
    return f"list_filter({xs}, lambda v, i: list_position({xs}, v) = i)"


def html(s: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = f"replace({s}, {q(a)}, {q(b)})"
    return s


def slug(s: str) -> str:
    return f"('sys-' || lpad((list_sum(list_transform(string_split({s}, ''), lambda c, i: i * unicode(c))) % 1000003)::BIGINT::VARCHAR, 6, '0'))"


def present(t: str, s: str, k: str) -> str:
    """A short Latin term as a word, any other in the key."""
    word = rf" AND regexp_matches(lower({s}), {q('(^|[^a-z0-9])' + re.escape(t.lower()) + '($|[^a-z0-9])')})" if re.fullmatch(r"[a-z0-9+./_-]{2,15}", t.lower()) else ""
    return f"(contains({k}, {q(key_of(t))}){word})"


def codes(s: str) -> str:
    """Codes without look-behinds: each run of letters and digits gets two marks before it, of which a match begins with
    the second, and may end with the first where a word follows a sign."""
    marked = rf"regexp_replace(regexp_replace({s}, '[\x{{C0}}-\x{{24F}}]', 'a', 'g'), '([A-Za-z0-9]+)', chr(2) || chr(1) || '\1', 'g')"
    inner = r"(?:(?:\x02\x01)?["
    found = rf"\x01(?:[A-Za-z]+[-/]\x02\x01)?[A-Za-z]*[0-9]+{inner}A-Za-z0-9+./-])*|\x01[A-Z]{inner}A-Z0-9+./-]){{1,14}}(?:\b|\x02)"
    return f"list_transform(regexp_extract_all({marked}, '{found}'), lambda x: replace(replace(x, chr(1), ''), chr(2), ''))"


_SYSTEMS = [t for ts in LEX.systems.values() for t in ts]
_NOISE = f"(length(line_key) BETWEEN 2 AND 45 AND NOT {has_obligation('block', 'line_key')} AND NOT {any_term('line_key', LEX.semantic + _SYSTEMS)})"

PAGES = "pages AS (SELECT source || '-' || (doc_id // 1000) AS source_id, doc_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY source, doc_id // 1000 ORDER BY doc_id) AS pdf_page FROM documents)"
RAW = f"""{PAGES},
raw_lists AS (SELECT source_id, pdf_page, list_filter(list_transform(string_split(text, chr(10)), lambda x: {clean('x')}), lambda x: x <> '') AS ls FROM pages),
raw_blocks AS (SELECT source_id, pdf_page, unnest(ls) AS block, generate_subscripts(ls, 1) AS block_index FROM raw_lists)"""
REPEATED = f"""{RAW},
edge AS (SELECT source_id, pdf_page, block, {key('block')} AS line_key FROM raw_blocks JOIN (SELECT source_id, pdf_page, len(ls) AS n FROM raw_lists) USING (source_id, pdf_page) WHERE block_index <= 3 OR block_index > n - 3),
repeated AS (SELECT source_id, line_key, count(DISTINCT pdf_page) AS n_pages FROM edge JOIN (SELECT source_id, count(*) AS n_all FROM pages GROUP BY 1) USING (source_id) WHERE {_NOISE} GROUP BY source_id, line_key, n_all HAVING count(DISTINCT pdf_page) >= greatest(3, floor(n_all * 0.15)))"""
BLOCKS = f"""{REPEATED},
blocks AS (SELECT source_id, pdf_page, row_number() OVER (PARTITION BY source_id, pdf_page ORDER BY block_index) AS block_index, block FROM raw_blocks b WHERE NOT EXISTS (SELECT 1 FROM repeated r WHERE r.source_id = b.source_id AND r.line_key = {key('b.block')}))"""
#: A block is one line, so its parts are its sentences; where there are several, the fold is checked elsewhere.
CHUNKS = f"""{BLOCKS},
sliced AS (SELECT source_id, pdf_page, block_index, block, unnest(generate_series(0, greatest(0, CAST(ceil((length(block) - 760) / 680.0) AS BIGINT)))) AS i FROM blocks),
chunks AS (SELECT source_id, pdf_page, block_index, i + 1 AS chunk_index, substring(block, i * 680 + 1, 760) AS chunk FROM sliced)"""
NAV = r"(regexp_matches(chunk, '^[\d\s\-–—_/]+$'))"
HEADINGS = f"""{CHUNKS},
heads AS (SELECT source_id, pdf_page, block_index, CASE WHEN {is_heading('block')} THEN block END AS h FROM blocks),
headings AS (SELECT source_id, pdf_page, block_index, last_value(h IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(h IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS on_page FROM heads WINDOW w AS (PARTITION BY source_id, pdf_page ORDER BY block_index)),
named AS (SELECT source_id, pdf_page, block_index, coalesce(before, on_page, 'PDF page ' || pdf_page) AS heading, CASE WHEN before IS NOT NULL THEN 'preceding_heading' WHEN on_page IS NOT NULL THEN 'page_heading' ELSE 'page_fallback' END AS heading_basis FROM headings)"""
TERMS = f"""{HEADINGS},
codes AS (SELECT source_id, pdf_page, block_index, chunk_index, regexp_extract_all(regexp_replace(upper(replace(chunk, 'ß', 'ss')), '[\\x{{C0}}-\\x{{24F}}]', 'a', 'g'), '\\b[A-Z][A-Z0-9+./_-]{{1,14}}\\b') AS ts FROM chunks WHERE {any_term(key('chunk'), LEX.semantic + _SYSTEMS)}),
code_rows AS (SELECT source_id, pdf_page, block_index, chunk_index, unnest(ts) AS term, generate_subscripts(ts, 1) AS pos FROM codes),
counted AS (SELECT source_id, term, count(*) AS n, min((pdf_page, block_index, chunk_index, pos)) AS seen FROM code_rows WHERE term NOT IN ('PDF', 'PAGE', 'THE', 'AND', 'FOR') GROUP BY 1, 2),
terms AS (SELECT source_id, term, n FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n DESC, seen) AS rank FROM counted) WHERE rank <= 80 AND n >= 2)"""
_UNIT = r"regexp_matches(lower(chunk), '(\d+(\.\d+)?\s*(mhz|ghz|mbps|gbps|mm|cm|m|v|a|w)\b|iso\s*\d+|ieee\s*[\d.]+)')"
_OPEN = r"(length(chunk) < 120 AND NOT regexp_matches(chunk, '[.?!。！？；;:]」?）?\s*$'))"
ENRICHED = f"""{TERMS},
keyed AS (SELECT c.*, n.heading, n.heading_basis, {key('chunk')} AS k, {key('heading')} AS hk FROM chunks c JOIN named n USING (source_id, pdf_page, block_index) WHERE NOT {NAV}),
own AS (SELECT source_id, list(term) AS ts FROM terms GROUP BY 1),
hinted AS (SELECT keyed.*, {categories('k', LEX.systems)} AS system_hints, {matched('k', _SYSTEMS)} AS system_terms, {matched('k', LEX.semantic)} AS semantic, {categories('k', LEX.capabilities)} AS business_axes,
  {listed(obligations('chunk', 'k'))} AS obligation_terms, {matched('k', LEX.interfaces)} AS interfaces, list_filter(coalesce(ts, []), lambda t: contains(k, {key('t')})) AS dynamic, {categories('k', LEX.spaces)} AS direct, {categories('hk', LEX.spaces)} AS inherited
  FROM keyed LEFT JOIN own USING (source_id)),
enriched AS (SELECT *, least(6, 2 * len(system_terms)) + (len(semantic) > 0)::INT + (len(business_axes) > 0)::INT + (len(business_axes) >= 2)::INT + (len(obligation_terms) > 0)::INT + 2 * {any_term('hk', LEX.headings)}::INT
  + (len(interfaces) > 0 AND len(semantic) > 0)::INT + (len(dynamic) > 0 AND (len(semantic) > 0 OR len(obligation_terms) > 0))::INT AS score,
  list_sort(list_distinct(list_concat(list_concat(list_concat(list_concat(system_terms, semantic), business_axes), interfaces), dynamic))) AS matched_terms,
  {listed([(any_term('k', LEX.negations), 'negation_or_exclusion'), (any_term('k', LEX.conditions), 'condition_or_exception'), ('len(system_hints) >= 2', 'cross_system'), (_UNIT, 'specification_signal'), (_OPEN, 'possible_fragment')])} AS signal_flags,
  list_concat(direct, list_filter(inherited, lambda x: NOT list_contains(direct, x))) AS space_hints FROM hinted),
cands AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY pdf_page, block_index, chunk_index) AS serial, row_number() OVER (PARTITION BY source_id, pdf_page ORDER BY block_index, chunk_index) AS sequence_on_page FROM enriched),
candidates AS (SELECT *, 'CAND-' || lpad(serial::VARCHAR, 5, '0') AS candidate_id FROM cands)"""
RECORDS = f"""{ENRICHED},
near AS (SELECT *, lag(candidate_id) OVER w AS p, lead(candidate_id) OVER w AS x FROM candidates WINDOW w AS (PARTITION BY source_id, pdf_page ORDER BY serial)),
keyed_quotes AS (SELECT *, lower(regexp_replace(chunk, '\\s+', '', 'g')) AS qk FROM near),
merged AS (SELECT source_id, qk, min(serial) AS ord, arg_min(chunk, serial) AS quote, list(candidate_id ORDER BY serial) AS candidate_ids, list(pdf_page ORDER BY serial) AS all_pages FROM keyed_quotes GROUP BY 1, 2),
records AS (SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY ord) AS record_no, ord, quote, candidate_ids, list_filter(all_pages, lambda v, i: list_position(all_pages, v) = i) AS pdf_pages, all_pages[1] AS page FROM merged)"""
GROUPS = f"""{RECORDS},
runs AS (SELECT *, row_number() OVER (PARTITION BY source_id, page ORDER BY record_no) AS i, length(quote) AS chars, len(candidate_ids) AS cands FROM records),
walk AS (SELECT source_id, page, i, 1 AS bin, chars AS c, cands AS n FROM runs WHERE i = 1
  UNION ALL SELECT r.source_id, r.page, r.i, CASE WHEN w.c + r.chars > 4800 OR w.n + r.cands > 12 THEN w.bin + 1 ELSE w.bin END, CASE WHEN w.c + r.chars > 4800 OR w.n + r.cands > 12 THEN r.chars ELSE w.c + r.chars END, CASE WHEN w.c + r.chars > 4800 OR w.n + r.cands > 12 THEN r.cands ELSE w.n + r.cands END
  FROM walk w JOIN runs r ON r.source_id = w.source_id AND r.page = w.page AND r.i = w.i + 1),
grouped AS (SELECT source_id, page, bin, min(record_no) AS first, max(record_no) AS last, sum(r.chars) AS chars, string_agg(array_to_string(r.candidate_ids, '|'), '|' ORDER BY record_no) AS ids FROM walk w JOIN runs r USING (source_id, page, i) GROUP BY 1, 2, 3),
groups AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY first) AS group_no FROM grouped)"""
_NAMED = [t for table in (LEX.systems, LEX.capabilities) for ts in table.values() for t in ts]
PRESERVED = f"""{ENRICHED},
spoken AS (SELECT source_id, candidate_id, list_filter(list_concat({listed([(present(t, 'chunk', 'k'), t) for t in _NAMED])}, {codes('chunk')}), lambda t: length(t) >= 2 AND NOT list_contains([{', '.join(q(g) for g in LEX.generic)}], lower(t))) AS ts FROM candidates)"""
_NL = "chr(10)"
_QUOTED = f"array_to_string(list_transform(string_split(quote, {_NL}), lambda x: CASE WHEN x = '' THEN '>' ELSE '> ' || x END), {_NL})"


def _context(label: str, record: str) -> str:
    return f"CASE WHEN {record}.record_no IS NULL THEN '' ELSE '**{label} | ' || array_to_string({record}.candidate_ids, ',') || '**' || {_NL} || '> 內容已完整收錄於其他來源片段，依候選 ID 交叉核對。' || {_NL} || {_NL} END"


RENDERED = rf"""{GROUPS},
extra AS (SELECT source_id, min(serial) AS ord, list(trim(regexp_replace(heading, '\s+', ' ', 'g')) ORDER BY serial) AS hs, flatten(list(space_hints ORDER BY serial)) AS sh, bool_or(len(system_hints) >= 3) AS mixed FROM keyed_quotes GROUP BY source_id, qk),
segs AS (SELECT source_id, page, bin, record_no, candidate_ids, pdf_pages, quote, {firsts('hs')} AS hs, {firsts('sh')} AS sh, mixed FROM walk JOIN runs USING (source_id, page, i) JOIN extra USING (source_id, ord)),
parts AS (SELECT *, '### ' || array_to_string(candidate_ids, ',') || ' | PDF ' || array_to_string(pdf_pages, ',') || {_NL} || {_NL}
  || concat_ws({_NL}, '- 來源脈絡：' || array_to_string(hs, ' / '), CASE WHEN len(sh) > 0 THEN '- 來源空間提示：' || array_to_string(sh, '、') END, CASE WHEN mixed THEN '- 文字狀態：mixed_topics' END, '- 來源形式：source')
  || {_NL} || {_NL} || {_QUOTED} || {_NL} AS part FROM segs),
bodies AS (SELECT source_id, page, bin, count(*) AS n, string_agg(part, {_NL} ORDER BY record_no) AS body, flatten(list(pdf_pages ORDER BY record_no)) AS ps, flatten(list(hs ORDER BY record_no)) AS hs FROM parts GROUP BY 1, 2, 3),
rendered AS (SELECT source_id, group_no, n, 'EGRP-' || lpad(group_no::VARCHAR, 4, '0') AS evidence_group_id, '## EGRP-' || lpad(group_no::VARCHAR, 4, '0') || ' | PDF ' || array_to_string({firsts('ps')}, ',') || ' | ' || array_to_string({firsts('hs')}, ' / ') || {_NL} || {_NL}
  || '<!-- evidence_group:EGRP-' || lpad(group_no::VARCHAR, 4, '0') || ' pages:' || array_to_string({firsts('ps')}, ',') || ' candidate_ids:' || replace(ids, '|', ',') || ' -->' || {_NL} || {_NL}
  || {_context('前文', 'a')} || body || {_NL} || {_context('後文', 'b')} || '---' || {_NL} AS markdown
  FROM groups JOIN bodies USING (source_id, page, bin) LEFT JOIN (SELECT source_id, record_no, candidate_ids FROM records) a ON a.source_id = groups.source_id AND a.record_no = first - 1 LEFT JOIN (SELECT source_id, record_no, candidate_ids FROM records) b ON b.source_id = groups.source_id AND b.record_no = last + 1)"""
REQ = """req AS (SELECT 'REQ-M1-' || lpad(c_custkey::VARCHAR, 4, '0') AS requirement_id, 'serve ' || c_name || ' in ' || c_mktsegment AS text, r_name AS system, n_name AS "group", c_mktsegment AS space,
  CASE WHEN c_acctbal < 0 THEN '需人工確認' WHEN c_acctbal < 5000 THEN '跨章整合' ELSE '來源明示' END AS status, 'PDF ' || (c_custkey % 30 + 1) AS source, c_name AS quote, c_custkey AS ord
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
