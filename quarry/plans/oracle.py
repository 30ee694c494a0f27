"""DuckDB SQL for every catalogue query: the independent correctness oracle.

Written directly in SQL over the pre-registered driver tables; the fixture
relations are inlined as CTEs. Column names equal the Spark queries'.
"""

from __future__ import annotations

from quarry.operators.profiles import PARAMS, STRATEGY_WORDS
from quarry.operators.properties import BUILTIN_RULES
from quarry.functions.meta import STASH_TAG
from quarry.functions.html import ENTITIES, NUMBER
from quarry.plans import catalogue as C
from quarry.plans.fixture_profiles import FAILURE_LABELS, FAILURE_PARAMS, LABELS, PARAMS as PROFILE_PARAMS, values_sql

UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = "abcdefghijklmnopqrstuvwxyz"
TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(0) || chr(11)"


def lower_ascii(x):
    return f"translate({x}, '{UP}', '{LOW}')"


def esc(x):
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), '''', '&#039;')")


def ts_text(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def norm(x):
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STRATEGY_WORDS.items())
    return f"(CASE {x} {cases} ELSE {x} END)"


FILES = """files AS (
  SELECT doc_id AS file_id,
    '/files/' || source || '/' || CAST(doc_id AS VARCHAR) AS path,
    CASE doc_id % 6 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'image/jpeg'
      WHEN 3 THEN 'application/msword' WHEN 4 THEN 'application/x-blocked' ELSE 'audio/mpeg' END AS mime,
    doc_id % 6 IN (1, 2) AS has_native,
    CASE WHEN doc_id % 6 IN (1, 2) THEN CASE (doc_id // 6) % 3 WHEN 1 THEN '' WHEN 2 THEN text END END AS native_text,
    text AS content, lang, source, n_chars
  FROM documents)"""


def _bool(p):
    return f"max(value) FILTER (WHERE param = '{p}') = 'true' AS {p}"


def profiles_cte(labels, params):
    return f"""labels AS (SELECT * FROM {values_sql(labels, ['label', 'kind', 'ref'])}),
params AS (SELECT * FROM {values_sql(params, ['label', 'param', 'value'])}),
walk(root, label, depth, visited) AS (
  SELECT label, label, 0, [label] FROM labels
  UNION ALL
  SELECT w.root, l.ref, w.depth + 1, list_append(w.visited, l.ref)
  FROM walk w JOIN labels l ON l.label = w.label
  WHERE l.kind IN ('ref', 'block') AND l.ref IS NOT NULL AND NOT list_contains(w.visited, l.ref)),
rlong AS (
  SELECT w.root AS label, p.param, arg_min(p.value, w.depth) AS value
  FROM walk w JOIN labels b ON b.label = w.label AND b.kind = 'block'
  JOIN params p ON p.label = w.label
  GROUP BY w.root, p.param),
prof AS (
  SELECT label, count(*) AS n_params,
    max(value) FILTER (WHERE param = 'handler_strategy') AS handler_strategy,
    {_bool('allow_ocr')},
    max(value) FILTER (WHERE param = 'ocr_languages') AS ocr_languages,
    {norm("max(value) FILTER (WHERE param = 'content_strategy')")} AS content_strategy,
    max(value) FILTER (WHERE param = 'content_composition') AS content_composition,
    {norm("max(value) FILTER (WHERE param = 'metadata_strategy')")} AS metadata_strategy,
    {_bool('ignore_content_service_errors')}, {_bool('ignore_content_parsing_errors')},
    {_bool('ignore_metadata_service_errors')}, {_bool('ignore_metadata_parsing_errors')},
    {", ".join(f"bool_or(param = '{p}') AS has_{p}" for p in PARAMS)}
  FROM rlong GROUP BY label),
fp AS (
  SELECT f.*,
    CASE WHEN f.mime IN (SELECT label FROM labels WHERE label <> '*') THEN f.mime
         WHEN (SELECT count(*) FROM labels WHERE label = '*') > 0 THEN '*' END AS label
  FROM files f),
fprof AS (
  SELECT fp.*, p.label IS NOT NULL AS profile_ok, p.handler_strategy, p.allow_ocr, p.ocr_languages,
    p.content_strategy, p.content_composition, p.metadata_strategy,
    p.ignore_content_service_errors, p.ignore_content_parsing_errors,
    p.ignore_metadata_service_errors, p.ignore_metadata_parsing_errors
  FROM fp LEFT JOIN (SELECT * FROM prof WHERE n_params = {len(PARAMS)}) p ON p.label = fp.label),
routed AS (
  SELECT *, CASE route WHEN 'solo' THEN NULL WHEN 'wrapping' THEN nullif(native_text, '') ELSE native_text END AS nt,
    CASE WHEN route <> 'solo' THEN native_text IS NOT NULL ELSE false END AS has_nm
  FROM (SELECT *,
    CASE WHEN NOT profile_ok THEN CASE WHEN has_native THEN 'native' ELSE 'none' END
         WHEN handler_strategy = 'fallback' THEN CASE WHEN has_native THEN 'native' ELSE 'solo' END
         WHEN handler_strategy = 'override' THEN 'solo'
         WHEN handler_strategy = 'wrapping' THEN CASE WHEN has_native THEN 'wrapping' ELSE 'solo' END
    END AS route FROM fprof)),
req AS (
  SELECT *,
    CASE WHEN route IN ('solo', 'wrapping') AND NOT (content_strategy = 'no_extracted'
              OR (content_strategy = 'prefer_native' AND nt IS NOT NULL))
         THEN CASE WHEN content_composition = 'metadata' THEN 'metadata' ELSE 'full' END
         ELSE 'none' END AS content_request,
    CASE WHEN route IN ('solo', 'wrapping') AND NOT (metadata_strategy = 'no_extracted'
              OR (metadata_strategy = 'prefer_native' AND has_nm))
         THEN 'metadata' ELSE 'none' END AS metadata_request
  FROM routed)"""


PROFILES = profiles_cte(LABELS, PROFILE_PARAMS)
FAILURES = profiles_cte(FAILURE_LABELS, FAILURE_PARAMS)

ATTEMPTS = """attempts AS (
  SELECT l_orderkey AS request_id,
    CAST(l_linenumber AS BIGINT) AS attempt,
    CASE l_partkey % 9 WHEN 0 THEN 200 WHEN 1 THEN 204 WHEN 2 THEN 422 WHEN 3 THEN 500 WHEN 4 THEN 503 END AS http_status,
    CASE l_partkey % 9 WHEN 5 THEN 28 WHEN 6 THEN 52 WHEN 7 THEN 7 WHEN 8 THEN 56 END AS transport_errno
  FROM lineitem),
classified AS (
  SELECT request_id, attempt,
    CASE WHEN http_status = 200 THEN 'success' WHEN http_status = 204 THEN 'empty'
         WHEN http_status = 422 THEN 'parser_failure' WHEN http_status IS NOT NULL THEN 'transient'
         WHEN transport_errno IN (28, 52) THEN 'parser_failure' ELSE 'transient' END AS class
  FROM attempts)"""

OUTCOMES = """outcomes AS (
  SELECT event_id, sha1(CAST(user_id AS VARCHAR)) AS sha1, ts,
    CASE WHEN event_type IN ('click', 'signup') THEN 'metadata' ELSE 'full' END AS request_kind,
    CASE WHEN event_type IN ('view', 'click') THEN 'success'
         WHEN event_type IN ('error', 'signup') THEN 'parser_failure'
         ELSE 'service_failure' END AS outcome
  FROM events)"""


def fold_cte(name, where="true"):
    m = "(outcome = 'success' OR (outcome = 'parser_failure' AND request_kind = 'metadata'))"
    c = "(request_kind = 'full' AND outcome IN ('success', 'parser_failure'))"
    return f"""{name}_raw AS (
  SELECT sha1,
    arg_max(outcome, (ts, event_id)) FILTER (WHERE {m}) AS m_out,
    arg_max(ts, (ts, event_id)) FILTER (WHERE {m}) AS m_ts,
    arg_max(outcome, (ts, event_id)) FILTER (WHERE {c}) AS c_out,
    arg_max(ts, (ts, event_id)) FILTER (WHERE {c}) AS c_ts,
    max(ts) FILTER (WHERE outcome = 'success') AS success_ts
  FROM outcomes WHERE {where} GROUP BY sha1),
{name} AS (
  SELECT sha1,
    CASE WHEN m_out IS NULL THEN 'unknown' WHEN m_out = 'success' THEN 'good' ELSE 'fail' END AS m_state,
    CASE WHEN c_out IS NULL THEN 'unknown' WHEN c_out = 'success' THEN 'good' ELSE 'fail' END AS c_state,
    success_ts,
    CASE WHEN m_out = 'parser_failure' THEN m_ts END AS m_fail_ts,
    CASE WHEN c_out = 'parser_failure' THEN c_ts END AS c_fail_ts
  FROM {name}_raw)"""


def state_cols(t="", extra=""):
    p = f"{t}." if t else ""
    return (f"{p}sha1 AS sha1, {p}m_state AS m_state, {p}c_state AS c_state, {ts_text(p + 'success_ts')} AS success_ts, "
            f"{ts_text(p + 'm_fail_ts')} AS m_fail_ts, {ts_text(p + 'c_fail_ts')} AS c_fail_ts{extra}")


EXPIRED = f"""exp0 AS (
  SELECT *,
    success_ts IS NOT NULL AND success_ts <= TIMESTAMP '{C.SUCCESS_BEFORE}' AS s_exp,
    coalesce(m_state = 'fail' AND m_fail_ts <= TIMESTAMP '{C.FAILURE_BEFORE}', false) AS m_fexp,
    coalesce(c_state = 'fail' AND c_fail_ts <= TIMESTAMP '{C.FAILURE_BEFORE}', false) AS c_fexp
  FROM st),
expd AS (
  SELECT sha1,
    CASE WHEN (s_exp AND m_state = 'good') OR m_fexp THEN 'unknown' ELSE m_state END AS m_state,
    CASE WHEN (s_exp AND c_state = 'good') OR c_fexp THEN 'unknown' ELSE c_state END AS c_state,
    CASE WHEN NOT s_exp THEN success_ts END AS success_ts,
    CASE WHEN NOT m_fexp THEN m_fail_ts END AS m_fail_ts,
    CASE WHEN NOT c_fexp THEN c_fail_ts END AS c_fail_ts,
    s_exp OR m_fexp OR c_fexp AS expired
  FROM exp0)"""

RULES = f"rules AS (SELECT * FROM {values_sql(BUILTIN_RULES, ['rname', 'action', 'tag'])})"

PROPS = """props AS (
  SELECT file_id, 0 AS pos, 'dc:language' AS name, 0 AS vpos, lang AS value FROM files
  UNION ALL SELECT file_id, 1, 'dc:source', 0, source FROM files
  UNION ALL SELECT file_id, 2, 'meta:character-count', 0, CAST(n_chars AS VARCHAR) FROM files
  UNION ALL SELECT file_id, 3, 'X-TIKA:content', 0, content FROM files
  UNION ALL SELECT file_id, 4, 'meta:keyword', 0, 'dropped' FROM files
  UNION ALL SELECT file_id, 5, 'Custom:Note', 0, 'a<b & "c"' FROM files
  UNION ALL SELECT file_id, 6, 'dc:creator', 0, 'first ' || source FROM files
  UNION ALL SELECT file_id, 6, 'dc:creator', 1, 'second ' || lang FROM files
  UNION ALL SELECT file_id, 7, 'geo:lat', 0, lang FROM files)"""

NATIVE = """native AS (
  SELECT file_id, 'visible' AS grp, 0 AS pos, 'exif-title' AS id, 'Title' AS name, 'Doc ' || CAST(file_id AS VARCHAR) AS value
  FROM files WHERE native_text IS NOT NULL
  UNION ALL SELECT file_id, 'collapsed', 0, 'exif-length', 'Length', CAST(n_chars AS VARCHAR)
  FROM files WHERE native_text IS NOT NULL
  UNION ALL SELECT file_id, 'collapsed', 1, '""" + STASH_TAG + """', '""" + STASH_TAG + """', 'hidden'
  FROM files WHERE native_text IS NOT NULL)"""


def mapped_cte(src="props"):
    vis = ", ".join(f"'{v}'" for v in __import__("quarry.operators.properties", fromlist=["x"]).DEFAULT_VISIBLE_FIELDS)
    return f"""mapped AS (
  SELECT p.file_id, p.pos, p.vpos,
    CASE WHEN r.action = 'display' THEN r.tag ELSE {esc('p.name')} END AS name,
    CASE WHEN r.action = 'display' THEN p.value ELSE {esc('p.value')} END AS value,
    {lower_ascii("CASE WHEN r.action = 'display' THEN r.tag ELSE p.name END")} AS visibility_tag,
    'exif-' || CASE WHEN r.action = 'display' THEN {lower_ascii('r.tag')} ELSE p.name END AS id
  FROM {src} p LEFT JOIN rules r ON r.rname = p.name
  WHERE coalesce(r.action, 'plain') <> 'drop'),
mprop AS (
  SELECT file_id, pos, any_value(name) AS name, any_value(id) AS id, any_value(visibility_tag) AS visibility_tag,
    string_agg(coalesce(value, ''), ' ' ORDER BY vpos) AS joined, count(*) AS n_values,
    CASE WHEN count(*) = 1 THEN coalesce(any_value(value), '')
         ELSE '<ul>' || string_agg('<li>' || coalesce(value, '') || '</li>', chr(10) ORDER BY vpos) || '</ul>' END AS shown,
    any_value(visibility_tag) IN ({vis}) AS is_visible
  FROM mapped GROUP BY file_id, pos)"""


STRATS = "strats AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}')" for s in C.STRATEGIES) + ") AS t(strategy))"


def md_text_cte(strategy_src, ext_src="mprop", nat_src="native", nat_cond="true"):
    """Metadata text per (file_id, strategy)."""
    return f"""ext_l AS (
  SELECT file_id, string_agg(name || ': ' || joined || chr(10), '' ORDER BY pos) AS lines, count(*) AS n
  FROM {ext_src} GROUP BY file_id),
nat_l AS (
  SELECT file_id, string_agg(name || ': ' || coalesce(value, '') || chr(10), ''
    ORDER BY CASE grp WHEN 'visible' THEN 0 ELSE 1 END, pos) AS lines, count(*) AS n
  FROM {nat_src} WHERE name <> '{STASH_TAG}' AND {nat_cond} GROUP BY file_id),
mdt AS (
  SELECT s.file_id, s.strategy,
    CASE WHEN s.strategy = 'only_extracted' THEN NULL ELSE n.lines END AS nl,
    CASE WHEN s.strategy = 'no_extracted' THEN NULL ELSE e.lines END AS el
  FROM {strategy_src} s LEFT JOIN ext_l e ON e.file_id = s.file_id LEFT JOIN nat_l n ON n.file_id = s.file_id),
md AS (
  SELECT file_id, strategy,
    CASE strategy WHEN 'no_extracted' THEN nl
      WHEN 'prefer_native' THEN coalesce(nl, el)
      WHEN 'combine' THEN CASE WHEN el IS NULL AND nl IS NULL THEN NULL ELSE coalesce(el, '') || coalesce(nl, '') END
      WHEN 'prefer_extracted' THEN coalesce(el, nl)
      WHEN 'only_extracted' THEN el END AS text
  FROM mdt)"""


def display_rows_cte(strategy_src, ext_src, nat_src, ext_present):
    """Display entries per (file_id, strategy, grp, pos)."""
    return f"""ext_d AS (
  SELECT file_id, CASE WHEN is_visible THEN 'visible' ELSE 'collapsed' END AS grp, id, name, shown AS value,
    row_number() OVER (PARTITION BY file_id, is_visible ORDER BY {lower_ascii('name')}, pos) AS k
  FROM {ext_src}),
nat_d AS (
  SELECT file_id, grp, id, name, value, pos + 1 AS k FROM {nat_src} WHERE name <> '{STASH_TAG}'),
nat_p AS (SELECT DISTINCT file_id FROM {nat_src}),
choice AS (
  SELECT s.file_id, s.strategy, np.file_id IS NOT NULL AS has_nat, ({ext_present}) AS has_ext
  FROM {strategy_src} s LEFT JOIN nat_p np ON np.file_id = s.file_id),
pick AS (
  SELECT file_id, strategy,
    CASE strategy WHEN 'no_extracted' THEN has_nat WHEN 'prefer_native' THEN has_nat
      WHEN 'combine' THEN has_nat WHEN 'prefer_extracted' THEN has_nat AND NOT has_ext ELSE false END AS use_nat,
    CASE strategy WHEN 'no_extracted' THEN false WHEN 'prefer_native' THEN NOT has_nat AND has_ext
      WHEN 'combine' THEN has_ext WHEN 'prefer_extracted' THEN has_ext ELSE has_ext END AS use_ext
  FROM choice),
disp AS (
  SELECT p.file_id, p.strategy, d.grp, 0 AS src, d.k, d.id, d.name, d.value
  FROM pick p JOIN nat_d d ON d.file_id = p.file_id WHERE p.use_nat
  UNION ALL
  SELECT p.file_id, p.strategy, d.grp, 1, d.k, d.id, d.name, d.value
  FROM pick p JOIN ext_d d ON d.file_id = p.file_id WHERE p.use_ext),
disp_rows AS (
  SELECT file_id, strategy, grp,
    CAST(row_number() OVER (PARTITION BY file_id, strategy, grp ORDER BY src, k) - 1 AS BIGINT) AS pos, id, name, value
  FROM disp)"""


EXTRACTED = """xprops AS (
  SELECT file_id, 0 AS pos, 'Content-Type' AS name, 0 AS vpos, 'text/plain; charset=UTF-8' AS value FROM req
  UNION ALL SELECT file_id, 1, 'X-TIKA:Parsed-By', 0, 'quarry.TextParser' FROM req
  UNION ALL SELECT file_id, 1, 'X-TIKA:Parsed-By', 1, 'quarry.Utf8Decoder' FROM req
  UNION ALL SELECT file_id, 2, 'meta:character-count', 0, CAST(length(content) AS VARCHAR) FROM req
  UNION ALL SELECT file_id, 3, 'meta:line-count', 0, CAST(len(string_split(content, chr(10))) AS VARCHAR) FROM req)"""


def W(*ctes):
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def sql() -> dict:
    q = {}
    q["q_content_key"] = "SELECT doc_id, sha1(text) AS sha1 FROM documents"
    q["q_distinct_content"] = ("SELECT sha1(text) AS sha1, count(*) AS n_files, min(doc_id) AS representative "
                               "FROM documents GROUP BY 1")
    path = "'/files/' || source || '/' || lang || '.txt'"
    q["q_path_conflicts"] = (f"SELECT {path} AS path, count(DISTINCT sha1(text)) AS n_hashes FROM documents "
                             "GROUP BY 1 HAVING count(DISTINCT sha1(text)) > 1")
    q["q_path_index"] = (f"WITH idx AS (SELECT {path} AS path, arg_max(sha1(text), doc_id) AS known FROM documents WHERE lang <> 'de' GROUP BY 1) "
                         f"SELECT d.doc_id, coalesce(i.known, sha1(d.text)) AS sha1, "
                         f"CASE WHEN i.known IS NOT NULL THEN 'index' ELSE 'computed' END AS sha1_source "
                         f"FROM documents d LEFT JOIN idx i ON i.path = {path.replace('source', 'd.source').replace('lang', 'd.lang')}")
    q["q_match_profile"] = W(FILES, PROFILES) + (
        "SELECT file_id AS doc_id, label, profile_ok, handler_strategy, content_strategy, content_composition, "
        "metadata_strategy FROM fprof")
    mimes = [x[0] for x in LABELS if x[0] != "*"] + ["x/unknown"]
    round_ = f"files AS (SELECT doc_id AS file_id, list_extract({mimes!r}, CAST(doc_id % {len(mimes)} + 1 AS BIGINT)) AS mime, false AS has_native, NULL AS native_text FROM documents)"
    q["q_resolve_profiles"] = W(round_, PROFILES) + (
        "SELECT fp.file_id AS doc_id, fp.label, r.param, r.value FROM fp JOIN rlong r ON r.label = fp.label")
    missing = "concat_ws(', ', " + ", ".join(f"CASE WHEN NOT coalesce(p.has_{x}, false) THEN '{x}' END" for x in PARAMS) + ")"
    q["q_profile_report"] = W(round_, PROFILES) + (
        f"SELECT fp.file_id AS doc_id, coalesce(fp.label, '(none)') AS label, "
        f"CASE WHEN fp.label IS NULL THEN 'no_label' WHEN coalesce(p.n_params, 0) = {len(PARAMS)} THEN 'complete' ELSE 'incomplete' END AS status, "
        f"CASE WHEN fp.label IS NULL THEN '' ELSE {missing} END AS missing "
        "FROM fp LEFT JOIN prof p ON p.label = fp.label")
    q["q_route"] = W(FILES, PROFILES) + "SELECT file_id AS doc_id, route FROM routed"
    q["q_request_kind"] = W(FILES, PROFILES) + (
        "SELECT file_id AS doc_id, content_request, metadata_request, "
        "content_request = 'full' AND coalesce(allow_ocr, false) AS ocr, "
        "CASE WHEN content_request <> 'none' AND ocr_languages <> '' THEN ocr_languages END AS ocr_languages FROM req")
    q["q_classify_attempts"] = W(ATTEMPTS) + "SELECT request_id, attempt, class FROM classified"
    term = "class IN ('success', 'empty', 'parser_failure')"
    q["q_resolve_attempts"] = W(ATTEMPTS) + (
        f"SELECT request_id, coalesce(arg_min(class, (attempt, class)) FILTER (WHERE attempt <= 3 AND {term}), "
        f"CASE WHEN count(*) FILTER (WHERE attempt <= 3) >= 3 THEN 'exhausted' ELSE 'pending' END) AS outcome, "
        f"CAST(coalesce(min(attempt) FILTER (WHERE attempt <= 3 AND {term}), count(*) FILTER (WHERE attempt <= 3)) AS BIGINT) AS attempts_used "
        "FROM classified GROUP BY request_id")
    q["q_fold_outcomes"] = W(OUTCOMES, fold_cte("st")) + f"SELECT {state_cols()} FROM st"
    q["q_invariants"] = W(OUTCOMES, fold_cte("st")) + (
        "SELECT sha1, 'contents_good_metadata_not_good' AS violation FROM st WHERE c_state = 'good' AND m_state <> 'good' "
        "UNION ALL SELECT sha1, 'metadata_good_without_stamp' FROM st WHERE m_state = 'good' AND success_ts IS NULL "
        "UNION ALL SELECT sha1, 'stamp_without_metadata_good' FROM st WHERE m_state <> 'good' AND success_ts IS NOT NULL")
    q["q_expire"] = W(OUTCOMES, fold_cte("st"), EXPIRED) + f"SELECT {state_cols(extra=', expired')} FROM expd"
    q["q_action"] = W(OUTCOMES, fold_cte("st"), EXPIRED) + """SELECT sha1, request,
  CASE WHEN res AND m_state = 'fail' THEN 'report_m_failure'
       WHEN res AND request = 'full' AND c_state = 'fail' THEN 'report_c_failure'
       WHEN res THEN 'hit'
       WHEN request = 'metadata' OR c_state <> 'unknown' THEN 'extract_metadata'
       ELSE 'extract_full' END AS action
FROM (SELECT e.*, r.request, e.m_state <> 'unknown' AND (r.request = 'metadata' OR e.c_state <> 'unknown') AS res
      FROM expd e CROSS JOIN (VALUES ('metadata'), ('full')) AS r(request))"""
    q["q_probe_store"] = ("WITH k AS (SELECT sha1(text) AS sha1, bool_or(lang = 'en') AS en, bool_or(lang = 'fr') AS fr FROM documents GROUP BY 1) "
                          "SELECT d.doc_id, k.sha1, k.en AS hit, k.fr AS hit_other FROM documents d JOIN k ON k.sha1 = sha1(d.text)")
    cut = f"TIMESTAMP '{C.CUT}'"
    q["q_resolve_layers"] = W(OUTCOMES, fold_cte("h", f"ts >= {cut}"), fold_cte("c", f"ts < {cut}")) + """,
j AS (
  SELECT coalesce(h.sha1, c.sha1) AS sha1,
    coalesce(h.m_state, 'unknown') AS hm, coalesce(h.c_state, 'unknown') AS hc,
    coalesce(c.m_state, 'unknown') AS cm, coalesce(c.c_state, 'unknown') AS cc,
    h.success_ts AS h_ts, c.success_ts AS c_ts, h.m_fail_ts AS h_mf, c.m_fail_ts AS c_mf,
    h.c_fail_ts AS h_cf, c.c_fail_ts AS c_cf
  FROM h FULL OUTER JOIN c ON h.sha1 = c.sha1),
k AS (SELECT *, hm = 'unknown' AND cm <> 'unknown' AS take_m, hc = 'unknown' AND cc <> 'unknown' AS take_c FROM j),
r AS (
  SELECT sha1,
    CASE WHEN take_m THEN cm ELSE hm END AS m_state, CASE WHEN take_c THEN cc ELSE hc END AS c_state,
    CASE WHEN take_m THEN c_ts ELSE h_ts END AS success_ts,
    CASE WHEN take_m THEN c_mf ELSE h_mf END AS m_fail_ts, CASE WHEN take_c THEN c_cf ELSE h_cf END AS c_fail_ts,
    take_c AND cc = 'good' AND (CASE WHEN take_m THEN c_ts ELSE h_ts END) IS DISTINCT FROM c_ts AS conflict
  FROM k)
""".replace("\n,\nj AS", ",\nj AS") + f"SELECT {state_cols(extra=', conflict')} FROM r"
    q["q_upsert_store"] = W(OUTCOMES, fold_cte("o", f"ts < {cut}"), fold_cte("n", f"ts >= {cut}")) + (
        "SELECT sha1, 'old' AS version, m_state, c_state, c_state = 'good' AS keeps_contents FROM o "
        "WHERE sha1 NOT IN (SELECT sha1 FROM n) "
        "UNION ALL SELECT sha1, 'new', m_state, c_state, c_state = 'good' FROM n")
    # what becomes of a content: asked by the strongest request of its files (per store), then for metadata alone
    failed = """asked AS (
  SELECT CASE WHEN label = 'application/pdf' THEN 'pdf-store' ELSE '-' END AS store, sha1(content) AS sha1, substr(sha1(content), 1, 1) AS d,
    content_request, metadata_request FROM req WHERE content_request <> 'none' OR metadata_request <> 'none'),
need AS (
  SELECT store, sha1, d, bool_or(content_request = 'full') AS is_full, bool_or(content_request = 'metadata' OR metadata_request = 'metadata') AS wants
  FROM asked GROUP BY ALL),
one AS (SELECT sha1, bool_or(is_full) AS is_full FROM need GROUP BY sha1),
first AS (
  SELECT n.*, n.is_full AND d IN ('0', '1', '2', '3') AS unparsed, n.is_full AND d IN ('4', '5', '6') AS unanswered,
    o.is_full AND d IN ('0', '1', '2', '3', '4', '5', '6') AS lost FROM need n JOIN one o USING (sha1)),
entry AS (
  SELECT store, sha1, is_full, unparsed OR (lost AND wants) AS second_pass,
    CASE WHEN is_full AND NOT unparsed AND NOT unanswered THEN 'good'
         WHEN is_full AND unanswered AND NOT wants THEN 'unknown'
         ELSE CASE d WHEN '0' THEN 'fail' WHEN '1' THEN 'unknown' ELSE 'good' END END AS m_state,
    CASE WHEN NOT is_full THEN 'unknown' WHEN unparsed THEN 'fail' WHEN unanswered THEN 'unknown' ELSE 'good' END AS c_state
  FROM first),
judged AS (
  SELECT r.*, sha1(r.content) AS sha1, e.m_state, e.c_state FROM req r LEFT JOIN entry e
    ON e.sha1 = sha1(r.content) AND e.store = CASE WHEN r.label = 'application/pdf' THEN 'pdf-store' ELSE '-' END),
err AS (
  SELECT *,
    CASE WHEN content_request = 'none' THEN NULL WHEN m_state = 'unknown' OR (content_request = 'full' AND c_state = 'unknown') THEN 'service_failure'
         WHEN m_state = 'fail' OR (content_request = 'full' AND c_state = 'fail') THEN 'parser_failure' END AS ce,
    CASE WHEN metadata_request = 'none' THEN NULL WHEN m_state = 'unknown' THEN 'service_failure' WHEN m_state = 'fail' THEN 'parser_failure' END AS me
  FROM judged),
told AS (
  SELECT *,
    CASE ce WHEN 'parser_failure' THEN ignore_content_parsing_errors WHEN 'service_failure' THEN ignore_content_service_errors END AS ci,
    CASE me WHEN 'parser_failure' THEN ignore_metadata_parsing_errors WHEN 'service_failure' THEN ignore_metadata_service_errors END AS mi
  FROM err)"""
    q["q_fallback_metadata"] = W(FILES, FAILURES, failed) + "SELECT store, sha1, second_pass, m_state, c_state FROM entry"
    q["q_errors"] = W(FILES, FAILURES, failed) + (
        "SELECT file_id AS doc_id, 'content' AS kind, ce AS error_class, CASE WHEN ce = 'parser_failure' THEN "
        "CASE WHEN m_state = 'fail' THEN 'metadata' ELSE 'contents' END END AS error_part, ci AS ignored FROM told WHERE ce IS NOT NULL "
        "UNION ALL SELECT file_id, 'metadata', me, CASE WHEN me = 'parser_failure' THEN 'metadata' END, mi FROM told WHERE me IS NOT NULL")
    q["q_search_content_failures"] = W(FILES, FAILURES, failed) + f"""SELECT file_id AS doc_id, route,
  sha1(CASE route WHEN 'native' THEN native_text WHEN 'none' THEN NULL
       ELSE CASE WHEN ce IS NOT NULL AND NOT ci THEN NULL WHEN ce IS NOT NULL THEN '' ELSE trim(content, {TRIM}) END END) AS content_sha1,
  CASE WHEN metadata_request = 'none' OR (me IS NOT NULL AND NOT mi) THEN NULL WHEN me IS NOT NULL THEN 0 ELSE 4 END AS n_properties
FROM told WHERE route <> 'wrapping'"""
    q["q_refresh"] = ("SELECT 'main' AS store, sha1(text) AS sha1, CASE WHEN bool_or(lang = 'en') THEN '2025-01-01 00:00:00.000000' "
                      "ELSE '2024-02-01 00:00:00.000000' END AS success_ts FROM documents WHERE doc_id % 6 NOT IN (1, 2) GROUP BY 2")
    q["q_error_policy"] = W(OUTCOMES, fold_cte("st"), "files AS (SELECT 1 AS x WHERE false)", PROFILES) + """SELECT sha1, label,
  CASE WHEN res THEN err END AS error_class, CASE WHEN res THEN part END AS error_part,
  CASE WHEN NOT res THEN 'extract' WHEN err IS NULL THEN 'data'
       WHEN coalesce(ignore_content_parsing_errors, false) THEN 'ignored_empty' ELSE 'error' END AS result
FROM (
  SELECT s.sha1, s.label, p.ignore_content_parsing_errors,
    s.m_state <> 'unknown' AND s.c_state <> 'unknown' AS res,
    CASE WHEN s.m_state = 'fail' OR s.c_state = 'fail' THEN 'parser_failure' END AS err,
    CASE WHEN s.m_state = 'fail' THEN 'metadata' WHEN s.c_state = 'fail' THEN 'contents' END AS part
  FROM (SELECT *, CASE WHEN substr(sha1, 1, 1) < '8' THEN 'image/jpeg' ELSE '*' END AS label FROM st) s
  JOIN prof p ON p.label = s.label)"""
    ms = lambda x: ts_text(f"date_trunc('millisecond', {x})")
    quoted = "'a \"b\" \\ ' || sha1"
    q["q_record_roundtrip"] = W(OUTCOMES, fold_cte("st")) + (
        f"SELECT sha1, m_state, c_state, {ms('success_ts')} AS success_ts, {ms('m_fail_ts')} AS m_fail_ts, {ms('c_fail_ts')} AS c_fail_ts, "
        f"CASE WHEN m_state = 'good' THEN '0 z:last false ' || {quoted} || ';1 a:list true ' || sha1 || ',x' END AS properties, "
        f"CASE WHEN c_state = 'good' THEN 'line' || chr(10) || {quoted} END AS text, "
        "CASE WHEN m_state = 'fail' THEN 'bad \"m\"' END AS m_message, CASE WHEN c_state = 'fail' THEN 'bad c' END AS c_message, "
        "'' AS missing, true AS version_ok FROM st")
    q["q_missing_keys"] = W(OUTCOMES, fold_cte("st")) + """, lost AS (
  SELECT *, CASE WHEN substr(sha1, 1, 1) < '4' THEN 'contents'
                 WHEN substr(sha1, 1, 1) > 'b' THEN concat_ws(',', CASE WHEN m_state = 'fail' THEN 'metadataFailure.onlyMetadata' END,
                                                              CASE WHEN c_state = 'fail' THEN 'contentsFailure.onlyMetadata' END)
                 ELSE '' END AS missing FROM st)
SELECT sha1, missing, CASE WHEN missing = '' THEN m_state ELSE 'unknown' END AS m_state, CASE WHEN missing = '' THEN c_state ELSE 'unknown' END AS c_state
FROM lost""".replace(", lost AS", ",\nlost AS", 1).lstrip("\n")
    q["q_unstash"] = W(FILES, PROPS) + (
        "SELECT p.file_id AS doc_id, f.form, p.name, p.pos = 6 AS is_list, CAST(p.vpos AS BIGINT) AS vpos, p.value "
        "FROM props p CROSS JOIN (VALUES ('object'), ('array')) AS f(form) WHERE p.pos <> 3")
    resp = f"""responses AS (
  SELECT -doc_id - 1 AS response_id, '{{bad' AS body FROM documents WHERE n_chars < 100
  UNION ALL
  SELECT doc_id,
      '{{"X-TIKA:content":' || to_json(text) || ',"dc:language":"' || lang || '","dc:creator":["' || source
      || '","' || lang || '"],"meta:character-count":' || CAST(n_chars AS VARCHAR) || ',"dc:source":"' || source
      || '","pdf:encrypted":false,"dc:source":"' || lang || '","Custom:Empty":null}}'
  FROM documents),
ok AS (SELECT *, CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END AS parsed_ok FROM responses),
each AS (
  SELECT o.response_id, e.key, e.value, e.type, e.id
  FROM ok o, json_each(CASE WHEN o.parsed_ok THEN o.body ELSE '{{}}' END) e),
canon AS (
  SELECT response_id, key, min(id) AS first_id, arg_max(value, id) AS value, arg_max(type, id) AS type
  FROM each GROUP BY response_id, key),
rprops AS (
  SELECT response_id, key AS name, value, type,
    CAST(row_number() OVER (PARTITION BY response_id ORDER BY first_id) - 1 AS BIGINT) AS pos
  FROM canon WHERE key <> 'X-TIKA:content')"""
    q["q_parse_properties"] = W(resp) + """SELECT response_id, pos, name, false AS is_list, CAST(0 AS BIGINT) AS vpos,
  json_extract_string(value, '$') AS value FROM rprops WHERE type <> 'ARRAY'
UNION ALL
SELECT p.response_id, p.pos, p.name, true, CAST(e.key AS BIGINT), json_extract_string(e.value, '$')
FROM rprops p, json_each(p.value) e WHERE p.type = 'ARRAY'"""
    q["q_response_text"] = W(resp) + f""", txt AS (
  SELECT response_id, trim(coalesce(json_extract_string(value, '$'), ''), {TRIM}) AS t
  FROM canon WHERE key = 'X-TIKA:content')
SELECT o.response_id, o.parsed_ok, sha1(coalesce(t.t, '')) AS text_sha1, length(coalesce(t.t, '')) AS text_chars
FROM ok o LEFT JOIN txt t ON t.response_id = o.response_id""".replace("\n, txt AS", ",\ntxt AS")
    q["q_map_properties"] = W(FILES, PROPS, RULES, mapped_cte()) + (
        "SELECT file_id AS doc_id, CAST(pos AS BIGINT) AS pos, name, visibility_tag, id, "
        "CAST(vpos AS BIGINT) AS vpos, value FROM mapped")
    q["q_user_rules"] = W(FILES, PROPS, RULES) + f"""SELECT file_id AS doc_id, 'bang' AS rules, pos,
  CASE WHEN pos = 0 THEN 'dc:language' ELSE 'Bang' END AS name, CASE WHEN pos = 0 THEN 'dc:language' ELSE 'bang' END AS visibility_tag,
  CASE WHEN pos = 0 THEN 'exif-dc:language' ELSE 'exif-bang' END AS id, CAST(vpos AS BIGINT) AS vpos, CASE WHEN pos = 0 THEN {esc('value')} ELSE value END AS value
FROM props
UNION ALL SELECT file_id, 'star', pos, 'Lang&lt;uage&gt;', 'lang<uage>', 'exif-lang<uage>', vpos, '*Tongue* ' || value FROM props WHERE pos = 0
UNION ALL SELECT file_id, 'star', pos, 'meta:character-count', 'meta:character-count', 'exif-meta:character-count', vpos, value FROM props WHERE pos = 2 AND length(value) > 3
UNION ALL SELECT file_id, 'star', pos, 'meta:keyword', 'meta:keyword', 'exif-meta:keyword', vpos, value FROM props WHERE pos = 4
UNION ALL SELECT file_id, 'star', pos, 'CUSTOM:NOTE', 'note', 'exif-note', vpos, '[' || value || ']' FROM props WHERE pos = 5
UNION ALL SELECT p.file_id, 'star', p.pos, CASE WHEN lower(r.tag) = 'artist' THEN 'Künstler' ELSE r.tag END, lower(r.tag), 'exif-' || lower(r.tag), p.vpos,
  '*' || r.tag || '* ' || p.value
FROM props p JOIN rules r ON r.rname = p.name WHERE p.pos IN (3, 6, 7) AND r.action = 'display'
UNION ALL SELECT p.file_id, 'star', p.pos, p.name, lower(p.name), 'exif-' || p.name, p.vpos, {esc('p.value')}
FROM props p JOIN rules r ON r.rname = p.name WHERE p.pos IN (3, 6, 7) AND r.action = 'plain'"""
    q["q_metadata_text"] = W(FILES, PROPS, RULES, NATIVE, mapped_cte(), STRATS,
                             "fs AS (SELECT f.file_id, s.strategy FROM files f CROSS JOIN strats s)",
                             md_text_cte("fs")) + "SELECT file_id AS doc_id, strategy, text FROM md"
    q["q_metadata_display"] = W(FILES, PROPS, RULES, NATIVE, mapped_cte(), STRATS,
                                "fs AS (SELECT f.file_id, s.strategy FROM files f CROSS JOIN strats s)",
                                display_rows_cte("fs", "mprop", "native", "true")) + (
        "SELECT file_id AS doc_id, strategy, grp, pos, id, name, value FROM disp_rows")
    e = f"trim(content, {TRIM})"
    q["q_merge_content"] = W(FILES, STRATS) + f"""SELECT f.file_id AS doc_id, s.strategy,
  CASE s.strategy WHEN 'no_extracted' THEN native_text
    WHEN 'prefer_native' THEN coalesce(native_text, {e})
    WHEN 'combine' THEN CASE WHEN coalesce(native_text, '') = '' THEN {e} WHEN {e} = '' THEN native_text
                             ELSE native_text || chr(10) || {e} END
    WHEN 'prefer_extracted' THEN CASE WHEN {e} <> '' THEN {e} ELSE native_text END
    ELSE {e} END AS content
FROM files f CROSS JOIN strats s"""
    q["q_append_metadata"] = W(FILES, PROPS, RULES, NATIVE, mapped_cte(),
                               "fs AS (SELECT file_id, 'combine' AS strategy FROM files)", md_text_cte("fs"),
                               "comps AS (SELECT * FROM (VALUES ('text'), ('metadata'), ('text_and_metadata')) AS t(composition))") + f"""SELECT f.file_id AS doc_id, c.composition,
  CASE WHEN c.composition = 'text' THEN {e}
       WHEN m.text IS NOT NULL AND m.text <> '' THEN (CASE WHEN c.composition = 'metadata' THEN '' ELSE {e} END) || ' ' || m.text
       ELSE (CASE WHEN c.composition = 'metadata' THEN '' ELSE {e} END) END AS content
FROM files f CROSS JOIN comps c JOIN md m ON m.file_id = f.file_id"""
    q["q_search_content_failures_wrapping"] = W(
        FILES, FAILURES, failed, RULES, EXTRACTED, NATIVE,
        "answered AS (SELECT x.* FROM xprops x JOIN told t ON t.file_id = x.file_id WHERE t.ce IS NULL)", mapped_cte("answered"),
        "nat_r AS (SELECT n.* FROM native n JOIN req r ON r.file_id = n.file_id WHERE r.has_nm)",
        "fs AS (SELECT file_id, metadata_strategy AS strategy FROM req WHERE route = 'wrapping')", md_text_cte("fs", "mprop", "nat_r")) + f"""SELECT r.file_id AS doc_id, r.route,
  sha1(CASE WHEN r.ce IS NOT NULL AND NOT r.ci THEN NULL WHEN r.content_request = 'none' THEN r.nt ELSE (
    {_merge_sql()}) END) AS content_sha1,
  CASE WHEN r.metadata_request = 'none' OR (r.me IS NOT NULL AND NOT r.mi) THEN NULL WHEN r.me IS NOT NULL THEN 0 ELSE 4 END AS n_properties
FROM (SELECT * REPLACE (CASE WHEN ce IS NULL THEN content ELSE '' END AS content) FROM told) r LEFT JOIN md m ON m.file_id = r.file_id
WHERE r.route = 'wrapping'"""
    # ---- end to end ----
    e2e = [FILES, PROFILES, RULES, EXTRACTED,
           mapped_cte("xprops"),
           "nat_r AS (SELECT n.* FROM native n JOIN req r ON r.file_id = n.file_id WHERE r.has_nm)",
           NATIVE,
           "fs AS (SELECT file_id, metadata_strategy AS strategy FROM req WHERE content_composition IN ('metadata', 'text_and_metadata'))",
           md_text_cte("fs", "mprop", "nat_r")]
    e2e = [c for c in e2e if c is not NATIVE]
    e2e.insert(4, NATIVE)
    q["q_search_content"] = W(*e2e) + f""", fin AS (
  SELECT r.file_id, sha1(r.content) AS sha1, r.route,
    CASE WHEN r.route = 'native' THEN r.native_text WHEN r.route = 'none' THEN NULL
         WHEN r.content_request = 'none' THEN r.nt
         ELSE (
           WITH_X
         ) END AS content
  FROM req r LEFT JOIN md m ON m.file_id = r.file_id)
SELECT file_id AS doc_id, sha1, route, content FROM fin""".replace("\n, fin AS", ",\nfin AS").replace("WITH_X", _merge_sql())
    q["q_ingest_stream"] = q["q_search_content"]
    q["q_outcome_stream"] = q["q_fold_outcomes"]
    q["q_generate_metadata"] = W(FILES, PROFILES, EXTRACTED, NATIVE) + """SELECT x.file_id AS doc_id, 'extracted' AS source, CAST(x.pos AS INTEGER) AS pos, x.name,
  string_agg(x.value, ' ' ORDER BY x.vpos) AS value
FROM xprops x JOIN req r ON r.file_id = x.file_id WHERE r.metadata_request <> 'none'
GROUP BY x.file_id, x.pos, x.name
UNION ALL
SELECT n.file_id, 'native', CAST(CASE WHEN n.grp = 'visible' THEN 0 ELSE 1 END AS INTEGER), n.name, n.value
FROM native n JOIN req r ON r.file_id = n.file_id
WHERE r.has_nm AND n.name <> '""" + STASH_TAG + "'"
    q["q_display_metadata"] = W(FILES, PROFILES, RULES, EXTRACTED, NATIVE,
                                "xreq AS (SELECT x.* FROM xprops x JOIN req r ON r.file_id = x.file_id WHERE r.metadata_request <> 'none')",
                                mapped_cte("xreq"),
                                "nat_r AS (SELECT n.* FROM native n JOIN req r ON r.file_id = n.file_id WHERE r.has_nm)",
                                "fs AS (SELECT file_id, metadata_strategy AS strategy, metadata_request FROM req WHERE route IN ('solo', 'wrapping'))",
                                display_rows_cte("fs", "mprop", "nat_r", "s.metadata_request <> 'none'")) + (
        "SELECT file_id AS doc_id, grp, pos, name, value FROM disp_rows")
    h = "html"
    def dec(x):
        named = x
        for a, b in ENTITIES[:-1]:
            named = f"replace({named}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
        code = ("CASE WHEN lower(m[1]) = 'x' THEN list_reduce(list_prepend(0::BIGINT, list_transform(string_split(lower(m[2:]), ''), "
                "lambda h: CAST(strpos('0123456789abcdef', h) - 1 AS BIGINT))), lambda u, w: u * 16 + w) ELSE TRY_CAST(m AS BIGINT) END")
        char = (f"list_transform([{code}], lambda k: CASE WHEN k = 38 THEN '&amp;' WHEN k = 160 THEN ' ' "
                "WHEN k > 0 AND k <= 1114111 AND NOT k BETWEEN 55296 AND 57343 THEN chr(CAST(k AS INT)) ELSE chr(65533) END)[1]")
        one = (f"list_transform([regexp_extract(p, '{NUMBER}', 1)], lambda m: CASE WHEN m = '' THEN '&#' || p ELSE {char} || substr(p, length(m) + 2) END)[1]")
        pieces = f"string_split({named}, '&#')"
        return f"replace({pieces}[1] || list_reduce(list_prepend('', list_transform({pieces}[2:], lambda p: {one})), lambda u, w: u || w), '&amp;', '&')"

    def ws(x):
        return f"trim(regexp_replace({x}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"
    body = f"regexp_replace({h}, '(?s)<!--.*?(?:-->|\\z)', ' ', 'g')"
    body = f"regexp_replace({body}, '(?is)<script[^>]*>.*?(?:</script>|\\z)', ' ', 'g')"
    body = f"regexp_replace({body}, '(?is)<style[^>]*>.*?(?:</style>|\\z)', ' ', 'g')"
    body = f"regexp_replace({body}, '(?is)<head[^>]*>.*?</head>', ' ', 'g')"
    body = f"regexp_replace({body}, '<[^>]*>', ' ', 'g')"
    body = ws(dec(body))
    title = f"regexp_extract({h}, '(?is)<title[^>]*>(.*?)</title>', 1)"
    lang = f"regexp_extract({h}, '(?is)<html[^>]*[ \\t\\n]lang=\"([^\"]*)\"', 1)"
    cs = f"regexp_extract({h}, '(?is)<meta[^>]*charset=\"?([A-Za-z0-9_-]+)', 1)"
    q["q_html_extract"] = f"""SELECT page_id,
  CASE WHEN {title} <> '' THEN {ws(dec(title))} END AS title,
  CASE WHEN {lang} <> '' THEN lower({lang}) END AS lang,
  CASE WHEN {cs} <> '' THEN lower({cs}) END AS charset,
  length({body}) AS text_chars, sha1({body}) AS text_sha1
FROM pages"""
    # by the first digit of the hash: attempts and their classes
    plan = {"6": "transient success", "7": "transient success", "8": "transient transient success", "9": "transient empty", "a": "transient parser_failure",
            "b": "parser_failure", "c": "transient transient parser_failure", "d": "transient transient transient", "e": "transient success"}
    cases = " ".join(f"WHEN '{d}' THEN '{c}'" for d, c in plan.items())
    q["q_extract_retries"] = f"""WITH one AS (SELECT DISTINCT sha1(text) AS sha1, substr(sha1(text), 1, 1) AS d, text FROM documents WHERE text IS NOT NULL),
r AS (SELECT *, CASE d {cases} ELSE 'success' END AS classes FROM one),
n AS (SELECT *, len(string_split(classes, ' ')) AS attempts, string_split(classes, ' ')[-1] AS last FROM r)
SELECT sha1, attempts, classes,
  CASE WHEN last = 'transient' THEN 'service_failure' WHEN last = 'parser_failure' OR d = 'f' THEN 'parser_failure' ELSE 'success' END AS outcome,
  CASE WHEN last = 'empty' THEN 0 WHEN last = 'success' AND d <> 'f' THEN 2 END AS n_properties,
  CASE WHEN last = 'empty' THEN sha1('') WHEN last = 'success' THEN sha1(CASE WHEN d = 'f' THEN '' ELSE trim(text, {TRIM}) END) END AS text_sha1,
  CASE WHEN last = 'transient' THEN 'retries exhausted' WHEN last = 'parser_failure' THEN 'unprocessable' WHEN d = 'f' THEN 'malformed response' END AS message,
  strftime(TIMESTAMP '2024-06-01' + INTERVAL (attempts) HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM n"""
    q["q_path_index_loads"] = """SELECT doc_id, sha1(coalesce(text, '') || CASE WHEN lang = 'fr' THEN ' changed' ELSE '' END) AS sha1,
  CASE WHEN lang = 'en' THEN 'index' ELSE 'computed' END AS sha1_source FROM documents"""
    q["q_files_search_content"] = f"""SELECT doc_id, sha1(coalesce(text, '')) AS sha1, 'solo' AS route, trim(coalesce(text, ''), {TRIM}) AS content FROM documents"""
    loads = f"""WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS old, coalesce(text, '') || CASE WHEN lang = 'fr' THEN ' changed' ELSE '' END AS new FROM documents),
l AS (SELECT *, lang <> 'de' AS was, lang <> 'en' AND sha1(new)[1] <> '0' AS there FROM d)"""
    q["q_output_changes"] = loads + f""" SELECT doc_id, CASE WHEN NOT was THEN 'insert' WHEN there THEN 'update' ELSE 'remove' END AS change,
  CASE WHEN there THEN sha1(trim(new, {TRIM})) END AS content_sha1 FROM l WHERE was <> there OR (was AND there AND old <> new)"""
    q["q_output_table"] = loads + f""" SELECT doc_id, sha1(new) AS sha1, sha1(trim(new, {TRIM})) AS content_sha1, 4 AS n_collapsed FROM l WHERE there"""
    q["q_search_content_failures"] = f"SELECT * FROM ({q['q_search_content_failures']}) UNION ALL SELECT * FROM ({q['q_search_content_failures_wrapping']})"
    names = [*(r[0] for r in BUILTIN_RULES), "Unknown:Name", "unknown <name>"]
    listed = ", ".join("'" + n.replace("'", "''") + "'" for n in names)
    q["q_builtin_rules"] = W(f"""props AS (
  SELECT doc_id AS file_id, k AS pos, ([{listed}])[CAST((doc_id * 12 + k) % {len(names)} AS INT) + 1] AS name, 0 AS vpos, 'a < ' || coalesce(lang, '-') AS value
  FROM documents, range(12) AS r(k))""", RULES, mapped_cte()) + (
        "SELECT file_id AS doc_id, CAST(pos AS BIGINT) AS pos, name, visibility_tag, id, CAST(vpos AS BIGINT) AS vpos, value FROM mapped")
    q["q_user_rules"] = f"WITH u AS ({q['q_user_rules']}) SELECT * FROM u UNION ALL SELECT * REPLACE ('star_arrow' AS rules) FROM u WHERE rules = 'star'"
    q["q_warm_store"] = q["q_search_content"]
    q["q_warm_metadata"] = q["q_generate_metadata"]
    q["q_extract_pages"] = f"SELECT page_id, sha1({body}) AS text_sha1, CASE WHEN {title} <> '' THEN {ws(dec(title))} END AS title FROM pages"
    return q


def _merge_sql():
    e = f"trim(r.content, {TRIM})"
    ext = (f"CASE WHEN r.content_composition IN ('metadata', 'text_and_metadata') AND m.text IS NOT NULL AND m.text <> '' "
           f"THEN (CASE WHEN r.content_request = 'full' THEN {e} ELSE '' END) || ' ' || m.text "
           f"ELSE (CASE WHEN r.content_request = 'full' THEN {e} ELSE '' END) END")
    return f"""CASE r.content_strategy WHEN 'no_extracted' THEN r.nt
             WHEN 'prefer_native' THEN coalesce(r.nt, {ext})
             WHEN 'combine' THEN CASE WHEN coalesce(r.nt, '') = '' THEN {ext} WHEN ({ext}) = '' THEN r.nt
                                      ELSE r.nt || chr(10) || ({ext}) END
             WHEN 'prefer_extracted' THEN CASE WHEN ({ext}) <> '' THEN {ext} ELSE r.nt END
             ELSE {ext} END"""
