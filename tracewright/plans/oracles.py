"""The SQL that queries of the core are compared with, written for another engine from the same fixed values."""

from __future__ import annotations

import re

from tracewright.functions import steps as S
from tracewright.functions.errors import INTENT_PATTERNS, PIPELINE_ERRORS, TAXONOMY_ERRORS
from tracewright.operators import pairing, preferences, scoring, specialist, taxonomy
from tracewright.operators.facts import PLANNING


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_of(col: str, needles: list[str]) -> str:
    return f"coalesce(regexp_matches(lower({col}), {_q('|'.join(map(re.escape, needles)))}), false)"


def lookup(col: str, table: dict[str, list[str]], default: str) -> str:
    word = f"lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"
    arms = " ".join(f"WHEN {word} IN ({', '.join(map(_q, v))}) THEN {_q(k)}" for k, v in table.items())
    return f"CASE {arms} ELSE {_q(default)} END"


def ladder(col: str, table: dict[str, list[str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {any_of(col, v)} THEN {_q(k)}" for k, v in table.items()) + f" ELSE {_q(default)} END"


def quantised(x: str, digits: int = 4) -> str:
    return f"floor(({x}) * {10**digits}.0::DOUBLE + 0.5) / {10**digits}.0::DOUBLE"


_SID = r"nullif(lower(regexp_replace(session_id, '^\s+|\s+$', '', 'g')), '')"
_INFERRED = f"""(coalesce(error, '') = '' AND (status IS NULL OR {lookup('status', S.STATUSES, 'pending')} IN ('pending', 'success')) AND {any_of('output', S.ERROR_TEXTS)})"""
_SHOWN = f"""CASE WHEN {_INFERRED} THEN 'inferred_error_from_text' ELSE coalesce(nullif(error, ''), nullif(output, '')) END"""
_ERR_BLANK = r"(error IS NULL OR NOT regexp_matches(error, '\S'))"
_ST = f"""CASE WHEN (status IS NULL OR {lookup('status', S.STATUSES, 'pending')} = 'pending' OR ({lookup('status', S.STATUSES, 'pending')} = 'success' AND coalesce(error, '') = ''))
  AND (NOT {_ERR_BLANK} OR {any_of('output', S.ERROR_TEXTS)}) THEN 'error' ELSE {lookup('status', S.STATUSES, 'pending')} END"""
_RECOVER_TEXT = "CASE WHEN coalesce(content, '') <> '' THEN content WHEN kind = 'tool_result' THEN coalesce(error, '') || coalesce(output, '') END"
_PARAMS = """CASE WHEN kind = 'tool_call' AND input_params IS NOT NULL AND json_valid(input_params) AND len(json_keys(input_params)) > 0 THEN
  array_to_string(list_sort(list_transform(list_filter(json_keys(input_params), lambda k: k NOT IN ('call_id', 'result_call_id')),
    lambda k: k || '=' || left(coalesce(input_params ->> k, ''), 200))), chr(1)) END"""

#: Steps once each, normal and placed: the SQL of the canonical layer.
CANON = f"""
raw AS (SELECT {_SID} AS sid, min(step_row) AS "row", session_key, source, step_id, step_type, ts, content, tool_name, skill_context, input_params, call_id, status, output, error, latency_ms
  FROM steps WHERE step_id IS NOT NULL AND {_SID} IS NOT NULL GROUP BY ALL),
kinds AS (SELECT *, {lookup('step_type', S.STEP_TYPES, 'unknown')} AS kind, {_ST} AS stx FROM raw),
f AS (SELECT *, nullif(tool_name, '') AS tool, nullif(skill_context, '') AS skill, CASE WHEN kind = 'tool_result' THEN stx END AS st,
  length(coalesce(content, '')) AS chars, {any_of(_RECOVER_TEXT, S.RECOVERY_TEXTS)} AS recovers,
  CASE WHEN kind = 'tool_result' AND stx = 'error' THEN CASE WHEN {_SHOWN} IS NULL THEN 'unknown' ELSE {ladder(_SHOWN, PIPELINE_ERRORS, 'other_error')} END END AS error_class,
  CASE WHEN kind = 'tool_result' AND stx = 'error' THEN {ladder("concat_ws(' ', error, output)", PIPELINE_ERRORS, 'other_error')} END AS error_bucket,
  CASE WHEN kind = 'tool_result' AND stx = 'error' THEN {ladder(_SHOWN, TAXONOMY_ERRORS, 'other')} END AS error_kind,
  coalesce(regexp_matches(content, {_q('(?i)' + '|'.join(INTENT_PATTERNS))}), false) AS announces,
  coalesce(starts_with(content, '[任务理解]'), false) AS task_note,
  coalesce(regexp_matches(content, '(?i)error|失败|exception'), false) AS speaks_error,
  coalesce(regexp_matches(content, {_q(PLANNING)}), false) AS plans,
  CASE WHEN kind = 'tool_call' THEN coalesce(input_params ->> '$.action', '') END AS action,
  CASE WHEN kind = 'tool_call' THEN coalesce(input_params ->> '$.command', '') END AS command,
  {_PARAMS} AS params,
  row_number() OVER (PARTITION BY sid ORDER BY step_id, "row") AS pos FROM kinds)"""

_OWNED = f"""(split_part(lower(tool), '_', 1) IN ({', '.join(map(_q, S.UNIVERSAL_TOOLS))}) OR core = '' OR contains(nm, core)
  OR (length(nm) >= 3 AND contains(core, left(nm, greatest(3, least(length(nm), length(core)))))) OR (abs(length(nm) - length(core)) <= 3 AND levenshtein(nm, core) <= 2))"""

SESSIONS = f"""
sess AS (SELECT * FROM (SELECT {_SID} AS sid, *, row_number() OVER (PARTITION BY {_SID} ORDER BY ingested_at DESC NULLS LAST, traj_id DESC) AS rn FROM trajectories) WHERE rn = 1 AND sid IS NOT NULL),
calls AS (SELECT sid, pos, tool, skill, replace(lower(tool), '_', '') AS nm, trim(replace(replace(lower(skill), 'skill', ''), '_', ''), ' ') AS core FROM f WHERE kind = 'tool_call'),
sw AS (SELECT sid, count(*) FILTER (skill <> prev) AS switches FROM (SELECT sid, skill, lag(skill) OVER (PARTITION BY sid ORDER BY pos) AS prev FROM calls WHERE skill IS NOT NULL) GROUP BY sid),
viol AS (SELECT sid, bool_or(tool IS NOT NULL AND skill IS NOT NULL AND NOT {_OWNED}) AS violates FROM calls GROUP BY sid),
st AS (SELECT sid, count(*) AS steps, count(*) FILTER (kind = 'tool_call') AS tool_calls, count(*) FILTER (kind = 'tool_result') AS tool_results,
  count(*) FILTER (st = 'error') AS error_steps, count(*) FILTER (kind = 'reasoning') AS thoughts, count(*) FILTER (kind = 'reasoning' AND recovers) AS recoveries,
  coalesce(sum(chars) FILTER (kind = 'reasoning'), 0) AS thought_chars,
  coalesce(list_sort(list(DISTINCT tool) FILTER (kind = 'tool_call' AND tool IS NOT NULL)), []) AS tools, coalesce(list_sort(list(DISTINCT skill) FILTER (skill IS NOT NULL)), []) AS skills,
  arg_max(kind, pos) AS last_kind, arg_max(speaks_error, pos) AS last_speaks FROM f GROUP BY sid),
stats AS (SELECT st.*, coalesce(sw.switches, 0) AS switches, coalesce(viol.violates, false) AS violates FROM st LEFT JOIN sw USING (sid) LEFT JOIN viol USING (sid)),
sc0 AS (SELECT sess.*, stats.* EXCLUDE (sid), {lookup('session_outcome', S.OUTCOMES, 'unknown')} AS outcome0,
  {quantised("least(1.0, steps / 15.0::DOUBLE) * 0.4::DOUBLE + least(1.0, len(tools) / 5.0::DOUBLE) * 0.3::DOUBLE + least(1.0, len(skills) / 3.0::DOUBLE) * 0.2::DOUBLE + least(1.0, switches / 3.0::DOUBLE) * 0.1::DOUBLE")} AS complexity,
  CASE WHEN error_steps > 0 AND recoveries > 0 THEN 1.0 WHEN error_steps > 0 THEN 0.3 ELSE 0.0 END::DOUBLE AS recovery_value,
  CASE WHEN thoughts > 0 THEN least(1.0::DOUBLE, thought_chars::DOUBLE / thoughts / 200.0::DOUBLE) ELSE 0.0 END::DOUBLE AS planning,
  CASE WHEN violates THEN 0.0 ELSE 1.0 END::DOUBLE AS compliance FROM sess JOIN stats USING (sid)),
sc1 AS (SELECT *, {quantised("complexity * 0.20::DOUBLE + 0.5::DOUBLE * 0.25::DOUBLE + recovery_value * 0.25::DOUBLE + planning * 0.15::DOUBLE + compliance * 0.15::DOUBLE")} AS total,
  CASE WHEN outcome0 <> 'unknown' THEN outcome0 WHEN coalesce(regexp_matches(lower(final_output), {_q(scoring.ADMITS)}), false) THEN 'failure'
    WHEN last_kind = 'output' AND NOT last_speaks AND error_steps <= recoveries THEN 'likely_success' WHEN error_steps > recoveries THEN 'likely_failure'
    WHEN coalesce(final_output, '') <> '' THEN 'likely_success' ELSE 'unknown' END AS outcome FROM sc0),
sc AS (SELECT *, CASE WHEN violates THEN 'skill_violation_neg' WHEN outcome IN ('abandoned', 'partial') AND tool_calls >= 1 AND error_steps = 0 AND steps >= 3 THEN 'graceful_abort'
  WHEN recovery_value > 0.3::DOUBLE AND error_steps > 0 THEN 'recovery_training' WHEN outcome IN ('success', 'likely_success') AND compliance = 1 AND total >= 0.5 THEN 'sft_positive'
  WHEN outcome IN ('success', 'likely_success', 'failure', 'likely_failure') AND total >= 0.35 THEN 'dpo_candidate' ELSE 'low_value' END AS use FROM sc1)"""

_NEXT = "row_number() OVER (PARTITION BY sid, epos ORDER BY pos)"
RETRIES = """
e AS (SELECT sid, pos, step_id, error_class, lag(kind) OVER w AS ck, lag(tool) OVER w AS ct, lag(params) OVER w AS cp FROM f WINDOW w AS (PARTITION BY sid ORDER BY pos)),
e1 AS (SELECT sid, pos, step_id, error_class, CASE WHEN ck = 'tool_call' THEN ct END AS ct, CASE WHEN ck = 'tool_call' THEN cp END AS cp FROM e WHERE error_class IS NOT NULL),
ah AS (SELECT e1.sid, e1.pos AS epos, e1.ct, e1.cp, f.pos - e1.pos AS d, f.kind, f.st, f.tool, f.params, f.command, f.announces FROM e1 JOIN f ON f.sid = e1.sid AND f.pos BETWEEN e1.pos + 1 AND e1.pos + 8),
fs AS (SELECT sid, epos, min(d) FILTER (kind = 'tool_call' AND tool = ct) AS first_same, min(d) FILTER (d <= 4 AND kind IN ('reasoning', 'output')) AS said_at,
  coalesce(bool_or(kind = 'tool_call' AND tool = 'exec' AND regexp_matches(command, 'sleep|delay|wait')), false) AS pauses,
  coalesce(bool_or(kind = 'tool_call' AND tool = ct AND params <> cp), false) AS changed FROM ah GROUP BY ALL),
af AS (SELECT ah.sid, ah.epos, count(*) FILTER (kind = 'tool_result' AND st = 'success' AND d > first_same) AS good, count(*) FILTER (kind = 'tool_result' AND st = 'error' AND d > first_same) AS bad,
  coalesce(bool_or(d = said_at AND announces), false) AS announced, count(*) FILTER (kind = 'tool_call' AND d > said_at AND d <= said_at + 3) AS acts FROM ah JOIN fs USING (sid, epos) GROUP BY ALL),
r0 AS (SELECT e1.sid, e1.pos, e1.step_id, e1.error_class, e1.ct AS failed_tool, CASE WHEN pauses THEN 'backoff_retry' WHEN changed THEN 'adaptive_retry' WHEN first_same IS NOT NULL THEN 'plain_retry' ELSE 'no_retry' END AS recovery_kind,
  coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, coalesce(announced, false) AND coalesce(acts, 0) = 0 AS intent_only
  FROM e1 LEFT JOIN fs ON fs.sid = e1.sid AND fs.epos = e1.pos LEFT JOIN af ON af.sid = e1.sid AND af.epos = e1.pos),
ret AS (SELECT sid, pos, step_id, error_class, failed_tool, recovery_kind, recovery_kind <> 'no_retry' AND good > 0 AS resolved, recovery_kind <> 'no_retry' AND bad >= 2 AS retry_loop, intent_only FROM r0),
pr AS (SELECT *, CASE WHEN intent_only THEN 1 WHEN recovery_kind IN ('adaptive_retry', 'backoff_retry') AND resolved THEN 2 WHEN recovery_kind IN ('adaptive_retry', 'backoff_retry') THEN 3
  WHEN recovery_kind = 'plain_retry' AND resolved THEN 4 ELSE 5 END AS priority FROM ret),
dv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY priority, CASE WHEN priority = 5 THEN -pos ELSE pos END) AS rn FROM pr) WHERE rn = 1),
it AS (SELECT sid, pos, kind, CASE WHEN kind = 'tool_call' AND json_valid(input_params) THEN list_transform(['block_id', 'doc_token', 'url', 'path', 'file_id', 'message_id', 'page_id'],
  lambda k: {'k': k, 'there': list_contains(json_keys(input_params), k), 'v': input_params ->> k}) END AS ks FROM f),
ir AS (SELECT DISTINCT e.sid, e.pos FROM f e JOIN it c ON c.sid = e.sid AND c.pos = e.pos - 1 AND c.ks IS NOT NULL AND len(list_filter(c.ks, lambda x: x.there)) > 0
  JOIN it l ON l.sid = e.sid AND l.kind = 'tool_call' AND l.pos > e.pos AND len(list_filter(c.ks, lambda x: x.there AND NOT (list_filter(l.ks, lambda y: y.k = x.k)[1].v IS NOT DISTINCT FROM x.v))) = 0
  JOIN f g ON g.sid = l.sid AND g.pos = l.pos + 1 AND g.st = 'success' WHERE e.st = 'error')"""

EVENTS = f"""
ev AS (SELECT e.sid, e."row", e.step_id, e.pos, e.error_kind, coalesce((SELECT arg_max(coalesce(c.tool, ''), c.pos) FROM f c WHERE c.sid = e.sid AND c.kind = 'tool_call' AND c.pos BETWEEN e.pos - 2 AND e.pos - 1), '') AS tool FROM f e WHERE e.st = 'error'),
evr AS (SELECT ev.*, EXISTS (SELECT 1 FROM f r JOIN f c ON c.sid = r.sid AND c.kind = 'tool_call' AND c.pos BETWEEN r.pos - 2 AND r.pos - 1 WHERE r.sid = ev.sid AND r.pos BETWEEN ev.pos + 1 AND ev.pos + 4
  AND r.kind = 'tool_result' AND r.st = 'success' AND coalesce(c.tool, '') = ev.tool) AS recovered FROM ev),
pt AS (SELECT error_kind, tool, count(*) AS n, row_number() OVER (PARTITION BY error_kind ORDER BY count(*) DESC, tool) AS rk FROM evr GROUP BY 1, 2),
tax0 AS (SELECT error_kind, count(*) AS c, count(DISTINCT sid) AS sc, count(*) FILTER (recovered) AS rc FROM evr GROUP BY 1),
tax AS (SELECT error_kind AS error_type, c AS count, sc AS session_count, rc AS recovery_count, {quantised('rc::DOUBLE / c', 3)} AS recovery_rate,
  (SELECT string_agg(tool || '=' || n, ',' ORDER BY rk) FROM pt WHERE pt.error_kind = tax0.error_kind AND rk <= 5) AS top_tools,
  CASE WHEN c >= 10 AND rc::DOUBLE / c < 0.3 THEN 'high' WHEN c >= 5 THEN 'medium' ELSE 'low' END AS rl_priority,
  (CASE error_kind {' '.join(f'WHEN {_q(k)} THEN {_q(v)}' for k, v in taxonomy.ADVICE.items())} ELSE '人工分析' END) || CASE WHEN rc::DOUBLE / c > 0.7 THEN {_q(taxonomy.RECOVERS_WELL)} ELSE '' END AS fi_recommendation FROM tax0)"""

_BETTER = "recovery_kind IN ('adaptive_retry', 'backoff_retry')"
_PIECE = f"""CASE WHEN kind = 'reasoning' AND coalesce(content, '') <> '' AND NOT task_note THEN '<thinking>' || chr(10) || content || chr(10) || '</thinking>'
  WHEN kind = 'tool_call' THEN '<tool_call>' || chr(10) || '{{"tool": "' || coalesce(tool_name, '') || '", "params": ' || coalesce(nullif(input_params, ''), '{{}}') || '}}' || chr(10) || '</tool_call>'
  WHEN kind = 'tool_result' THEN '<tool_result status="' || st || '">' || chr(10) || left(coalesce(nullif(output, ''), nullif(error, ''), ''), CUT) || chr(10) || '</tool_result>'
  WHEN kind = 'output' AND coalesce(content, '') <> '' THEN content END"""
_DOMAIN = "CASE t " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in pairing.TOOL_DOMAINS.items()) + " ELSE 'other' END"
_DOMAINS = _DOMAIN.replace("CASE t", "CASE x")
_FP = f"array_to_string(list_sort(list_distinct(list_transform(tools, lambda x: {_DOMAINS}))), '|') || '::' || array_to_string(tools[1:5], '|')"
PAIRS = f"""
cand AS (SELECT sid, outcome, use, total, tools, steps, user_input, {_FP} AS fp FROM sc WHERE tool_calls > 0 AND steps > 4 AND len(tools) > 0),
good AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY total DESC, sid) AS rk FROM cand WHERE outcome IN ('success', 'likely_success') AND use <> 'recovery_training'),
bad AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY total, sid) AS rk FROM cand WHERE use = 'recovery_training' OR outcome IN ('failure', 'likely_failure', 'unknown', 'partial')),
pc0 AS (SELECT sid, pos, kind, content, {_PIECE.replace('CUT', '2000')} AS piece, left(coalesce(nullif(output, ''), nullif(error, ''), ''), 1000) AS failure FROM f),
pc AS (SELECT *, sum(length(piece)) OVER (PARTITION BY sid ORDER BY pos) AS cum FROM pc0 WHERE piece IS NOT NULL),
hd AS (SELECT sid, string_agg(piece, chr(10) ORDER BY pos) FILTER (cum <= 6000 AND pos <= 12) AS h12, string_agg(piece, chr(10) ORDER BY pos) FILTER (cum <= 6000 AND pos <= 10) AS h10 FROM pc GROUP BY sid),
ax AS (SELECT dv.sid, dv.pos AS e, pc0.pos - dv.pos AS d, kind, content, piece, failure FROM dv JOIN pc0 ON pc0.sid = dv.sid AND pc0.pos BETWEEN dv.pos - 1 AND dv.pos + 8),
ay AS (SELECT *, sum(length(piece)) FILTER (d >= 1 AND kind IN ('tool_call', 'output')) OVER (PARTITION BY sid ORDER BY d) AS ca, sum(length(piece)) FILTER (d >= 1) OVER (PARTITION BY sid ORDER BY d) AS cl FROM ax),
az AS (SELECT sid, max(failure) FILTER (d = 0) AS error, coalesce(string_agg(piece, chr(10) ORDER BY d) FILTER (d >= 1 AND kind IN ('tool_call', 'output') AND ca <= 6000), '') AS chosen,
  coalesce(string_agg(piece, chr(10) ORDER BY d) FILTER (d BETWEEN 1 AND 4 AND cl <= 6000), '') AS lp, coalesce(string_agg(piece, chr(10) ORDER BY d) FILTER (d BETWEEN 1 AND 2 AND cl <= 6000), '') AS instead,
  max(piece) FILTER (d = -1 AND kind = 'tool_call') AS call, coalesce(left(arg_min(coalesce(content, ''), d) FILTER (d BETWEEN 1 AND 4 AND kind IN ('reasoning', 'output')), 2000), '') AS declared FROM ay GROUP BY sid),
bf AS (SELECT dv.sid, coalesce(string_agg(piece, chr(10) ORDER BY pc.pos) FILTER (cum <= 6000), '') AS before FROM dv LEFT JOIN pc ON pc.sid = dv.sid AND pc.pos < dv.pos GROUP BY dv.sid),
es AS (SELECT dv.*, az.error, chosen, before, call, ir.pos IS NOT NULL AS item_resolved, CASE WHEN intent_only THEN declared WHEN retry_loop THEN lp ELSE coalesce(call, instead) END AS rejected,
  coalesce(c.tool, '') AS tool, coalesce(c.action, '') AS action
  FROM dv LEFT JOIN az USING (sid) LEFT JOIN bf USING (sid) LEFT JOIN ir ON ir.sid = dv.sid AND ir.pos = dv.pos LEFT JOIN f c ON c.sid = dv.sid AND c.pos = dv.pos - 1 AND c.kind = 'tool_call'),
jp AS (SELECT g.fp, g.sid AS s_sid, b.sid AS f_sid, g.rk AS s_rank, b.rk AS f_rank, g.total AS s_total, b.total AS f_total, g.steps AS s_steps, b.steps AS f_steps, coalesce(b.user_input, '') AS prompt_user,
  len(list_intersect(g.tools, b.tools))::DOUBLE / len(list_distinct(list_concat(g.tools, b.tools))) AS raw FROM good g JOIN bad b USING (fp) WHERE g.rk <= 5 AND b.rk <= 10),
jq AS (SELECT jp.*, {quantised('raw', 3)} AS tool_similarity, es.* EXCLUDE (sid), coalesce(chosen <> '' AND rejected <> '', false) AS at_error, a.h12 AS s_text, b.h12 AS f_text
  FROM jp LEFT JOIN es ON es.sid = f_sid LEFT JOIN hd a ON a.sid = s_sid LEFT JOIN hd b ON b.sid = f_sid WHERE raw >= 0.5),
jr AS (SELECT *, row_number() OVER (PARTITION BY fp, f_sid ORDER BY tool_similarity DESC, s_rank) AS k FROM jq WHERE tool_similarity > 0 AND CASE WHEN at_error THEN chosen <> rejected ELSE coalesce(s_text <> f_text, false) END),
js AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY f_rank) AS n FROM jr WHERE k = 1),
ep AS (SELECT sha256('error:' || f_sid || ':' || s_sid) AS pair_id, CASE WHEN at_error THEN 'success_vs_failure_at_error' ELSE 'global_success_vs_failure' END AS pair_type,
  CASE WHEN NOT at_error THEN 'low' WHEN retry_loop AND NOT resolved THEN 'low' WHEN intent_only THEN 'high' WHEN {_BETTER} AND resolved AND error_class = 'rate_limit' AND NOT item_resolved THEN 'medium'
    WHEN {_BETTER} AND resolved THEN 'high' ELSE 'medium' END AS pair_quality, fp AS task_type, n,
  CASE WHEN NOT at_error THEN 'unknown' ELSE CASE error_class WHEN 'rate_limit' THEN 'rate_limit_retry' WHEN 'timeout' THEN 'timeout_recovery' WHEN 'auth_error' THEN 'auth_error_handling' WHEN 'not_found' THEN 'not_found_recovery'
    WHEN 'server_error' THEN 'server_error_recovery' ELSE 'generic_error_recovery' END END AS diverge_reason,
  CASE WHEN at_error THEN error_class ELSE 'none' END AS error_type, at_error AND intent_only AS intent_only_failure, tool_similarity, prompt_user, CASE WHEN at_error THEN before END AS prompt_before,
  CASE WHEN at_error THEN '[ERROR] ' || error END AS prompt_error, CASE WHEN at_error THEN chosen ELSE s_text END AS chosen, CASE WHEN at_error THEN rejected ELSE f_text END AS rejected, s_sid AS success_session, f_sid AS failure_session,
  CASE WHEN at_error THEN s_total END AS success_score, CASE WHEN at_error THEN f_total END AS failure_score, CASE WHEN at_error THEN s_steps END AS success_steps, CASE WHEN at_error THEN f_steps END AS failure_steps,
  CASE WHEN at_error THEN pos END AS error_at_step, CASE WHEN at_error THEN recovery_kind END AS recovery_kind,
  CASE WHEN at_error THEN CASE recovery_kind WHEN 'backoff_retry' THEN 'backoff' WHEN 'adaptive_retry' THEN 'param_change' WHEN 'plain_retry' THEN 'same_tool' ELSE 'none' END END AS retry_type,
  CASE WHEN at_error THEN resolved END AS resolved, CASE WHEN at_error THEN retry_loop END AS retry_loop, CASE WHEN at_error THEN 'same_session_recovery' END AS chosen_source,
  CASE WHEN at_error THEN CASE WHEN intent_only THEN 'intent_without_action' WHEN retry_loop THEN 'real_retry_loop' WHEN call IS NOT NULL THEN 'synthetic_plain_retry' ELSE 'error_after_steps' END END AS rejected_source,
  CASE WHEN at_error THEN CASE WHEN intent_only OR retry_loop THEN 'strong' WHEN error_class IN ('rate_limit', 'not_found', 'auth_error', 'parse_error') AND {_BETTER} AND (error_class <> 'rate_limit' OR item_resolved) THEN 'strong' ELSE 'medium' END END AS preference_strength,
  CASE WHEN at_error THEN 'same_session_recovery_vs_synthetic_plain_retry' END AS pair_construction, CASE WHEN at_error THEN NOT intent_only AND NOT retry_loop AND call IS NOT NULL END AS synthetic_rejected,
  CASE WHEN at_error THEN item_resolved END AS failed_item_eventually_resolved, CASE WHEN at_error THEN left(f_sid, 8) || ':' || error_class || ':' || tool || ':' || action END AS near_duplicate_group_id, NULL::DOUBLE AS score_gap FROM js WHERE n <= 10),
ql AS (SELECT h.fp, h.sid AS b, l.sid AS w, h.total AS ht, l.total AS lt, h.steps AS hs, l.steps AS ls, coalesce(h.user_input, '') AS prompt_user, x.h10 AS chosen, y.h10 AS rejected,
  len(list_intersect(h.tools, l.tools))::DOUBLE / len(list_distinct(list_concat(h.tools, l.tools))) AS raw, row_number() OVER (PARTITION BY h.fp ORDER BY h.rk, l.rk) AS m
  FROM good h JOIN good l ON l.fp = h.fp AND h.rk < l.rk JOIN hd x ON x.sid = h.sid JOIN hd y ON y.sid = l.sid
  WHERE floor(h.total * 10000 + 0.5) - floor(l.total * 10000 + 0.5) >= 500 AND x.h10 <> y.h10 AND len(list_intersect(h.tools, l.tools))::DOUBLE / len(list_distinct(list_concat(h.tools, l.tools))) >= 0.5),
qp AS (SELECT sha256('quality:' || b || ':' || w) AS pair_id, 'quality_comparison' AS pair_type, 'medium' AS pair_quality, fp AS task_type, m + coalesce(taken, 0) AS n, 'efficiency_difference' AS diverge_reason, 'none' AS error_type,
  false AS intent_only_failure, {quantised('raw', 3)} AS tool_similarity, prompt_user, NULL::VARCHAR AS prompt_before, NULL::VARCHAR AS prompt_error, chosen, rejected, b AS success_session, w AS failure_session, ht AS success_score, lt AS failure_score,
  hs AS success_steps, ls AS failure_steps, NULL::BIGINT AS error_at_step, NULL::VARCHAR AS recovery_kind, NULL::VARCHAR AS retry_type, NULL::BOOLEAN AS resolved, NULL::BOOLEAN AS retry_loop, NULL::VARCHAR AS chosen_source,
  NULL::VARCHAR AS rejected_source, NULL::VARCHAR AS preference_strength, NULL::VARCHAR AS pair_construction, NULL::BOOLEAN AS synthetic_rejected, NULL::BOOLEAN AS failed_item_eventually_resolved, NULL::VARCHAR AS near_duplicate_group_id,
  {quantised('ht - lt')} AS score_gap FROM ql LEFT JOIN (SELECT task_type AS fp, count(*) AS taken FROM ep GROUP BY 1) USING (fp) WHERE m + coalesce(taken, 0) <= 10),
allp AS (SELECT * FROM ep UNION ALL SELECT * FROM qp),
u2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chosen, rejected, pair_quality ORDER BY task_type, n) AS k2 FROM allp) WHERE k2 = 1),
u3 AS (SELECT *, row_number() OVER g AS k3, first_value(pair_quality) OVER g AS bestq FROM u2 WINDOW g AS (PARTITION BY near_duplicate_group_id ORDER BY CASE WHEN preference_strength = 'strong' THEN 0 ELSE 1 END,
  CASE WHEN failed_item_eventually_resolved THEN 0 ELSE 1 END, task_type, n)),
dd AS (SELECT * FROM u3 WHERE near_duplicate_group_id IS NULL OR k3 <= CASE WHEN bestq = 'high' THEN 1 ELSE 2 END)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def _reason(col: str) -> str:
    return ladder(col, specialist.ABORT_REASONS, "other")


def _first(v: str, *keys: str) -> str:
    """The first value that is not null, empty, zero or false, as text."""
    arms = [f"CASE WHEN ({v} -> '$.{k}')::VARCHAR NOT IN ('\"\"', '0', '0.0', 'false', 'null', '[]', '{{}}') THEN {v} ->> '$.{k}' END" for k in keys]
    return f"coalesce({', '.join(arms)})" if len(arms) > 1 else arms[0]


_RECORDS = """rec AS (SELECT record_no, feed, file_no, line_no, record::JSON AS r FROM (SELECT * FROM session_files WHERE json_valid(record))
  WHERE json_type(record) = 'OBJECT' AND list_has_all(json_keys(record), ['session_id', 'trajectory', 'user_input']))"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["error_taxonomy_recovery"] = _with(CANON) + f"""
SELECT error_type, count, recovered, {quantised('recovered::DOUBLE / count')} AS rate,
  CASE WHEN 1 - recovered::DOUBLE / count >= 0.7 THEN 'critical' WHEN 1 - recovered::DOUBLE / count >= 0.4 THEN 'high' WHEN 1 - recovered::DOUBLE / count >= 0.15 THEN 'medium' ELSE 'low' END AS level
FROM (SELECT error_bucket AS error_type, count(*) AS count, count(*) FILTER (EXISTS (SELECT 1 FROM f n WHERE n.sid = e.sid AND n.step_id BETWEEN e.step_id + 1 AND e.step_id + 4
  AND (n.kind = 'tool_call' OR (n.kind = 'reasoning' AND n.recovers)))) AS recovered FROM f e WHERE st = 'error' GROUP BY 1)"""
    out["error_taxonomy_tools"] = _with(CANON, EVENTS) + "SELECT * FROM tax"
    out["error_samples"] = _with(CANON, EVENTS) + """
SELECT error_kind AS error_type, rank, s.sid, s.pos, tool, recovered, (SELECT string_agg(kind, '>' ORDER BY f.pos) FROM f WHERE f.sid = s.sid AND f.pos BETWEEN s.pos - 2 AND s.pos + 2) AS context
FROM (SELECT *, row_number() OVER (PARTITION BY error_kind ORDER BY sid, pos) AS rank FROM evr) s WHERE rank <= 5"""
    out["fault_injection_targets"] = _with(CANON, EVENTS) + f"""
SELECT error_type, count AS occurrence_count, session_count, recovery_rate, rl_priority, CASE rl_priority WHEN 'high' THEN 0.3 WHEN 'medium' THEN 0.15 ELSE 0.05 END::DOUBLE AS injection_rate,
  {quantised('0.8::DOUBLE - recovery_rate', 3)} AS gap FROM tax"""
    out["step_type_normalise"] = f"SELECT {lookup('step_type', S.STEP_TYPES, 'unknown')} AS kind, count(*) AS n FROM steps GROUP BY 1"
    out["status_normalise"] = f"SELECT status, {lookup('status', S.STATUSES, 'pending')} AS written, {_ST} AS resolved, count(*) AS n FROM steps GROUP BY ALL"
    out["outcome_normalise"] = f"SELECT session_outcome, {lookup('session_outcome', S.OUTCOMES, 'unknown')} AS outcome, count(*) AS n FROM trajectories GROUP BY ALL"
    out["error_text_inference"] = f"SELECT source, count(*) FILTER ({any_of('output', S.ERROR_TEXTS)}) AS by_text, count(*) FILTER (NOT {_ERR_BLANK}) AS by_field, count(*) AS n FROM steps GROUP BY 1"
    out["call_pairing_check"] = _with(CANON) + """
SELECT sid, call_id, bool_or(kind = 'tool_call') AS called, bool_or(kind = 'tool_result') AS answered FROM f WHERE kind IN ('tool_call', 'tool_result') AND coalesce(call_id, '') <> ''
GROUP BY ALL HAVING bool_or(kind = 'tool_call') <> bool_or(kind = 'tool_result')"""
    out["step_continuity_check"] = _with(CANON) + "SELECT sid, count(*) AS steps, min(step_id) AS first_id, max(step_id) AS last_id FROM f GROUP BY sid HAVING bool_or(step_id <> pos)"
    out["session_stats"] = _with(CANON, SESSIONS) + "SELECT sid, steps, tool_calls, tool_results, error_steps, thoughts, recoveries, switches, violates, array_to_string(tools, ',') AS tools, array_to_string(skills, ',') AS skills FROM stats"
    out["value_score"] = _with(CANON, SESSIONS) + "SELECT sid, complexity, recovery_value, planning, compliance, total FROM sc"
    out["outcome_inference"] = _with(CANON, SESSIONS) + "SELECT outcome0 AS written, outcome, count(*) AS n FROM sc GROUP BY ALL"
    out["training_use_buckets"] = _with(CANON, SESSIONS) + """
SELECT sid, use, CASE WHEN use = 'low_value' THEN 'rejected' WHEN outcome <> 'unknown' OR use IN ('dpo_candidate', 'recovery_training', 'skill_violation_neg', 'graceful_abort') THEN use END AS bucket,
  outcome = 'unknown' AND use <> 'low_value' AS review FROM sc WHERE steps >= 2"""
    out["retry_kind"] = _with(CANON, RETRIES) + "SELECT sid, pos, error_class, failed_tool, recovery_kind, resolved, retry_loop, intent_only FROM ret"
    out["diverge_point"] = _with(CANON, RETRIES) + "SELECT sid, pos, error_class, recovery_kind, priority FROM dv"
    out["abort_reasons"] = f"""
SELECT source, coalesce(regexp_matches(final_output, {_q("|".join(map(re.escape, specialist.ABORT_SIGNALS)))}), false) AS stops, {_reason("coalesce(final_output, '')")} AS reason, count(*) AS n FROM trajectories GROUP BY ALL"""
    out["item_resolved"] = _with(CANON, RETRIES) + "SELECT sid, pos FROM ir"
    out["fingerprint_clusters"] = _with(CANON, SESSIONS, RETRIES, PAIRS) + "SELECT fp, count(*) AS sessions, count(*) FILTER (outcome IN ('success', 'likely_success')) AS good FROM cand GROUP BY fp"
    pairs = _with(CANON, SESSIONS, RETRIES, PAIRS)
    out["pairs_full"] = pairs + "SELECT * FROM allp"
    out["pair_error_state"] = pairs + """
SELECT pair_id, pair_type, pair_quality, task_type, error_type, success_session, failure_session, tool_similarity, error_at_step, recovery_kind, resolved, retry_loop, intent_only_failure,
  failed_item_eventually_resolved, rejected_source, preference_strength FROM ep"""
    out["pair_quality"] = pairs + "SELECT pair_id, task_type, success_session AS chosen_session, failure_session AS rejected_session, score_gap FROM qp"
    out["pair_dedup_full"] = pairs + "SELECT pair_id, pair_quality, near_duplicate_group_id, preference_strength FROM dd"
    out["export_weighted"] = pairs + """
SELECT pair_id, diverge_reason, preference_strength, synthetic_rejected, CASE WHEN preference_strength = 'strong' THEN 1.0 WHEN synthetic_rejected THEN 0.5 ELSE 1.0 END::DOUBLE AS loss_weight
FROM dd WHERE pair_quality = 'high' AND pair_type = 'success_vs_failure_at_error'"""
    out["session_redeliveries"] = f"""
SELECT sid, count(*) AS "rows", count(DISTINCT t::VARCHAR) AS contents FROM (SELECT {_SID} AS sid, * EXCLUDE (session_id, traj_id, ingested_at) FROM trajectories) t WHERE sid IS NOT NULL GROUP BY sid HAVING count(*) > 1"""
    out["pair_dedup"] = """
WITH u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chosen, rejected, pair_quality ORDER BY pair_no) AS rn FROM dpo_pairs) WHERE rn = 1),
g AS (SELECT pair_no, pair_quality, left(failure_session, 8) || ':' || error_type AS grp FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY CASE pair_quality WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, pair_no) AS k, first_value(pair_quality) OVER (PARTITION BY grp ORDER BY CASE pair_quality WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, pair_no) AS best FROM g)
SELECT pair_no, pair_quality, grp FROM r WHERE grp IS NULL OR k <= CASE WHEN best = 'high' THEN 1 ELSE 2 END"""
    out["export_counts"] = """
SELECT export, pair_type, pair_quality, count(*) AS n FROM (SELECT 'main' AS export, * FROM dpo_pairs WHERE pair_quality = 'high' AND pair_type = 'success_vs_failure_at_error'
UNION ALL SELECT 'extended', * FROM dpo_pairs WHERE pair_quality = 'medium' AND pair_type = 'quality_comparison') GROUP BY ALL"""
    out["pair_distribution"] = "SELECT pair_type, pair_quality, error_type, count(*) AS n FROM dpo_pairs GROUP BY ROLLUP (pair_type, pair_quality, error_type)"
    dom = f"""dm AS (SELECT sid, domain FROM (SELECT sid, domain, row_number() OVER (PARTITION BY sid ORDER BY count(*) DESC, domain) AS rn FROM (SELECT sid, {_DOMAIN} AS domain FROM (SELECT sid, unnest(tools) AS t FROM sc)) GROUP BY sid, domain) WHERE rn = 1),
sx AS (SELECT sc.sid, use, outcome, unnest(list_filter([CASE WHEN tool_calls BETWEEN 1 AND 3 THEN 'tool_light' WHEN tool_calls BETWEEN 4 AND 10 THEN 'tool_medium' WHEN tool_calls > 10 THEN 'tool_heavy' END,
  CASE WHEN steps >= 20 THEN 'long_plan' END, CASE WHEN recoveries > 0 THEN 'error_recovery' END, CASE WHEN use = 'graceful_abort' THEN 'graceful_abort' END,
  CASE WHEN list_has_any(tools, ['sessions_spawn', 'sessions_yield']) THEN 'multi_agent' END, 'domain_' || coalesce(domain, 'other')], lambda x: x IS NOT NULL)) AS stratum FROM sc LEFT JOIN dm USING (sid))"""
    out["strata"] = _with(CANON, SESSIONS, dom) + "SELECT stratum, count(*) AS n FROM sx GROUP BY 1"
    out["stratified_sample"] = _with(CANON, SESSIONS, dom) + """
SELECT stratum, sid, rank FROM (SELECT stratum, sid, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || sid), sid) AS rank FROM sx WHERE use <> 'low_value') WHERE rank <= 10"""
    diff = "CASE WHEN steps * 0.4::DOUBLE + tool_calls * 0.6::DOUBLE >= 20 THEN 'hard' WHEN steps * 0.4::DOUBLE + tool_calls * 0.6::DOUBLE >= 8 THEN 'medium' ELSE 'easy' END"
    out["label_queue"] = _with(CANON, SESSIONS) + f"""
SELECT sid, priority, outcome, difficulty FROM (SELECT sid, outcome, {diff} AS difficulty, CASE WHEN outcome = 'unknown' THEN 0 WHEN {diff} = 'hard' THEN 1 END AS priority FROM sc) WHERE priority IS NOT NULL ORDER BY priority, md5('42:' || sid), sid LIMIT 200"""
    out["eval_criteria"] = _with(CANON, SESSIONS) + f""",
x AS (SELECT *, CASE WHEN outcome IN ('success', 'likely_success') THEN 'task_completed' WHEN outcome IN ('failure', 'likely_failure') THEN 'task_failed' WHEN use = 'graceful_abort' THEN 'graceful_abort_with_reason' ELSE 'unknown' END AS ex,
  concat_ws('、', 'task_completion', CASE WHEN tool_calls > 0 THEN 'tool_call_accuracy' END, CASE WHEN recoveries > 0 THEN 'error_recovery_quality' END, CASE WHEN steps >= 20 THEN 'planning_coherence' END,
    CASE WHEN list_has_any(tools, ['sessions_spawn', 'sessions_yield']) THEN 'subagent_delegation_quality' END, CASE WHEN use = 'graceful_abort' THEN 'boundary_recognition' END, CASE WHEN use = 'graceful_abort' THEN 'user_communication_quality' END) AS dims FROM sc)
SELECT sid, ex AS expected_outcome, dims AS dimensions, {diff} AS difficulty, '任务描述：' || left(coalesce(user_input, ''), 200) || chr(10) || '预期结果：' || ex || chr(10) || '实际输出：' || left(coalesce(final_output, ''), 200) || chr(10)
  || '请从以下维度评估（1-5分）：' || dims || chr(10) || '输出格式：JSON，每个维度一个字段，外加 overall_score 和 reasoning。' AS judge_prompt FROM x"""
    out["tool_call_pairs"] = _with(CANON, SESSIONS) + """,
n AS (SELECT sid, pos, kind, tool, CASE WHEN lead(kind, 1) OVER w = 'tool_result' THEN lead(st, 1) OVER w WHEN lead(kind, 2) OVER w = 'tool_result' THEN lead(st, 2) OVER w END AS rst FROM f WINDOW w AS (PARTITION BY sid ORDER BY pos)),
g AS (SELECT n.sid, tool, rst, pos, row_number() OVER (PARTITION BY n.sid ORDER BY pos) AS k FROM n JOIN sc ON sc.sid = n.sid WHERE sc.outcome IN ('success', 'likely_success') AND sc.tool_calls >= 2 AND kind = 'tool_call' AND tool IS NOT NULL AND pos > 2 AND rst IS NOT NULL AND rst <> 'error')
SELECT sid, k - 1 AS call_index, tool AS tool_name, rst AS result_status, pos - 1 AS context_steps FROM g WHERE k <= 20"""
    out["long_plan"] = _with(CANON, SESSIONS) + """,
c AS (SELECT sid, min(pos) - 1 AS cut FROM f WHERE st = 'error' GROUP BY sid),
s AS (SELECT sc.sid, outcome IN ('success', 'likely_success') AS whole, CASE WHEN outcome IN ('success', 'likely_success') THEN steps ELSE cut END AS used, len(tools) AS nt FROM sc LEFT JOIN c USING (sid)
  WHERE (outcome IN ('success', 'likely_success') AND steps >= 20) OR (outcome NOT IN ('success', 'likely_success') AND cut >= 20)),
o AS (SELECT f.sid, pos, kind, says, plans, task_note, skill, used FROM (SELECT *, coalesce(content, '') <> '' AS says FROM f) f JOIN s ON s.sid = f.sid AND f.pos <= s.used),
k AS (SELECT sid, count(*) FILTER (skill IS DISTINCT FROM prev) AS switches FROM (SELECT sid, skill, lag(skill) OVER (PARTITION BY sid ORDER BY pos) AS prev FROM o WHERE skill IS NOT NULL) GROUP BY sid),
p AS (SELECT sid, count(*) FILTER (kind = 'reasoning' AND says AND NOT task_note) AS plan_nodes, count(*) FILTER (kind = 'reasoning' AND says AND NOT task_note AND plans) AS planning_nodes FROM o GROUP BY sid)
SELECT s.sid, CASE WHEN whole THEN 'complete' ELSE 'partial_until_error' END AS plan_outcome, CASE WHEN used >= 30 AND nt >= 4 THEN 'tier1' WHEN used >= 20 THEN 'tier2' ELSE 'tier3' END AS complexity_tier, used AS total_steps,
  coalesce(plan_nodes, 0) AS plan_nodes, coalesce(planning_nodes, 0) AS planning_nodes, coalesce(switches, 0) AS skill_switches FROM s LEFT JOIN p USING (sid) LEFT JOIN k USING (sid)"""
    out["tool_call_samples"] = _with(CANON, SESSIONS) + f""",
n AS (SELECT sid, pos, kind, tool, input_params, CASE WHEN lead(kind, 1) OVER w = 'tool_result' THEN 1 WHEN lead(kind, 2) OVER w = 'tool_result' THEN 2 END AS d, CASE WHEN lead(kind, 1) OVER w = 'tool_result' THEN lead(st, 1) OVER w WHEN lead(kind, 2) OVER w = 'tool_result' THEN lead(st, 2) OVER w END AS rst
  FROM f WINDOW w AS (PARTITION BY sid ORDER BY pos)),
g AS (SELECT n.sid, tool, rst, pos, d, input_params, row_number() OVER (PARTITION BY n.sid ORDER BY pos) AS k FROM n JOIN sc ON sc.sid = n.sid WHERE sc.outcome IN ('success', 'likely_success') AND sc.tool_calls >= 2 AND kind = 'tool_call' AND tool IS NOT NULL AND pos > 2 AND rst IS NOT NULL AND rst <> 'error'),
p AS (SELECT sid, pos, {_PIECE.replace('CUT', '2000')} AS piece FROM f)
SELECT g.sid, k - 1 AS call_index, tool AS tool_name, rst AS result_status, g.pos - 1 AS context_steps, coalesce(nullif(g.input_params, ''), '{{}}') AS input_params,
  coalesce(string_agg(piece, chr(10) ORDER BY p.pos) FILTER (p.pos < g.pos), '') AS context, string_agg(piece, chr(10) ORDER BY p.pos) FILTER (p.pos = g.pos OR p.pos = g.pos + d) AS chosen
FROM g JOIN p ON p.sid = g.sid AND p.pos <= g.pos + d AND piece IS NOT NULL WHERE k <= 20 GROUP BY ALL"""
    out["long_plan_switches"] = _with(CANON, SESSIONS) + """,
c AS (SELECT sid, min(pos) - 1 AS cut FROM f WHERE st = 'error' GROUP BY sid),
u AS (SELECT sc.sid, CASE WHEN outcome IN ('success', 'likely_success') THEN steps ELSE cut END AS used FROM sc LEFT JOIN c USING (sid) WHERE CASE WHEN outcome IN ('success', 'likely_success') THEN steps ELSE cut END >= 20),
o AS (SELECT f.sid, pos, skill, lag(skill) OVER (PARTITION BY f.sid ORDER BY pos) AS prev FROM f JOIN u ON u.sid = f.sid AND f.pos <= u.used WHERE skill IS NOT NULL)
SELECT sid, pos, prev AS from_skill, skill AS to_skill FROM o WHERE prev IS DISTINCT FROM skill"""
    sig = _q("|".join(map(re.escape, specialist.ABORT_SIGNALS)))
    out["graceful_abort"] = _with(CANON, SESSIONS) + f""",
l AS (SELECT sid, arg_max(content, pos) FILTER (content IS NOT NULL) AS any_output, arg_max(coalesce(content, ''), pos) AS last_output FROM f WHERE kind = 'output' GROUP BY sid)
SELECT sid, outcome, {_reason("coalesce(nullif(final_output, ''), any_output, '')")} AS abort_reason, left(coalesce(final_output, ''), 500) AS abort_signal, steps, tool_calls FROM sc LEFT JOIN l USING (sid)
WHERE tool_calls > 0 AND error_steps = 0 AND (coalesce(regexp_matches(final_output, {sig}), false) OR coalesce(regexp_matches(any_output, {sig}), false))"""
    out["subagent_collab"] = _with(CANON, SESSIONS) + """,
c AS (SELECT sid, pos, (lower(coalesce(tool, '')) IN ('sessions_spawn', 'sessions_yield', 'subagent') OR contains(lower(coalesce(tool, '')), 'spawn')) AS sp, contains(lower(coalesce(tool, '')), 'yield') AS yi FROM f WHERE kind = 'tool_call'),
p AS (SELECT sid, count(*) FILTER (sp) AS spawn_count, count(*) FILTER (yi) AS yield_count, count(*) FILTER (sp AND NOT yi) AS spawn_only_count,
  count(*) FILTER (yi AND EXISTS (SELECT 1 FROM f WHERE f.sid = c.sid AND f.kind = 'reasoning' AND f.pos BETWEEN c.pos + 1 AND c.pos + 2)) AS aggregations FROM c WHERE sp OR yi GROUP BY sid)
SELECT sid, outcome, CASE WHEN spawn_count = 1 THEN 'single_subagent' WHEN spawn_count >= 2 AND len(tools) >= 3 THEN 'parallel_subagents' WHEN spawn_count >= 2 THEN 'sequential_subagents' ELSE 'yield_only' END AS collab_type,
  spawn_count, yield_count, spawn_only_count, aggregations, CASE WHEN spawn_count >= 3 AND outcome IN ('success', 'likely_success') THEN 'tier1' ELSE 'tier2' END AS value_tier FROM p JOIN sc USING (sid)"""
    msgs = f"""
p AS (SELECT sid, pos, kind, CASE WHEN kind = 'skill_route' THEN '<skill_route skill="" confidence=""></skill_route>' ELSE {_PIECE.replace('CUT', '3000')} END AS piece FROM f),
g AS (SELECT sid, pos, kind, piece, sum(CASE WHEN kind = 'tool_result' THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY pos) * 2 - CASE WHEN kind = 'tool_result' THEN 1 ELSE 0 END AS no FROM p WHERE piece IS NOT NULL),
msgs AS (SELECT sid, no::BIGINT AS msg_no, CASE WHEN kind = 'tool_result' THEN 'tool' ELSE 'assistant' END AS role, string_agg(piece, chr(10) ORDER BY pos) AS content FROM g GROUP BY sid, no, kind = 'tool_result')"""
    msgs = msgs.replace("CASE WHEN kind = 'tool_result' THEN 'tool' ELSE 'assistant' END AS role, string_agg", "CASE WHEN bool_or(kind = 'tool_result') THEN 'tool' ELSE 'assistant' END AS role, string_agg")
    out["sft_messages"] = _with(CANON, msgs) + "SELECT * FROM msgs"
    uses = """
us AS (SELECT * FROM sc WHERE steps >= 2 AND use IN ('sft_positive', 'recovery_training', 'graceful_abort') AND (outcome <> 'unknown' OR use IN ('recovery_training', 'graceful_abort'))),
rows_ AS (SELECT sid, -2::BIGINT AS msg_no, 'system' AS role, SYS AS content FROM us UNION ALL SELECT sid, -1, 'user', coalesce(user_input, '') FROM us UNION ALL SELECT * FROM msgs WHERE sid IN (SELECT sid FROM us)
  UNION ALL SELECT sid, 0, 'assistant', final_output FROM us WHERE final_output <> '' AND sid NOT IN (SELECT sid FROM msgs))""".replace("SYS", _q(preferences.SYSTEM))
    out["sft_rows"] = _with(CANON, SESSIONS, msgs, uses) + "SELECT * FROM rows_"
    out["export_sft"] = _with(CANON, SESSIONS, msgs, uses) + "SELECT sid, count(*) AS messages, sum(length(content))::BIGINT AS chars FROM rows_ WHERE sid IN (SELECT sid FROM us WHERE use = 'sft_positive') GROUP BY sid HAVING count(*) >= 3"
    ids = lambda cond: f"coalesce(string_agg(step_id, ',' ORDER BY step_id) FILTER ({cond}), '')"
    thought = "kind IN ('reasoning', 'output') AND recovers"
    out["training_samples"] = _with(CANON, SESSIONS) + f""",
a AS (SELECT sid, coalesce(bool_or({thought}), false) AS any_recovery, {ids("st = 'error'")} AS errs, {ids(thought)} AS recs, {ids("kind = 'tool_call'")} AS calls, count(*) FILTER (kind = 'output') AS outs,
  max(pos) FILTER (kind = 'output') AS lo FROM f GROUP BY sid),
b AS (SELECT sc.*, a.* EXCLUDE (sid), coalesce(CASE WHEN outs > 0 THEN (SELECT content FROM f WHERE f.sid = sc.sid AND f.pos = a.lo) ELSE final_output END, '') AS said FROM sc JOIN a USING (sid)
  WHERE steps >= 2 AND use <> 'low_value' AND (outcome <> 'unknown' OR use IN ('dpo_candidate', 'recovery_training', 'skill_violation_neg', 'graceful_abort')))
SELECT sid, use AS training_use, any_recovery, CASE WHEN use = 'recovery_training' THEN recs <> '' END AS has_recovery, CASE WHEN use = 'recovery_training' THEN errs END AS error_steps,
  CASE WHEN use = 'recovery_training' THEN recs END AS recovery_steps, CASE WHEN use = 'skill_violation_neg' THEN calls END AS violation_steps, CASE WHEN use = 'graceful_abort' THEN left(said, 500) END AS abort_signal,
  CASE WHEN use = 'graceful_abort' THEN {_reason('said')} END AS abort_reason FROM b"""
    out["budgeted_render"] = _with(CANON) + f""",
p AS (SELECT sid, pos, {_PIECE.replace('CUT', '2000')} AS piece FROM f WHERE pos <= 12),
g AS (SELECT sid, pos, piece, sum(length(piece)) OVER (PARTITION BY sid ORDER BY pos) AS total FROM p WHERE piece IS NOT NULL)
SELECT sid, coalesce(string_agg(piece, chr(10) ORDER BY pos) FILTER (total <= 6000), '') AS text FROM g GROUP BY sid"""
    rows = """er0 AS (SELECT min(event_row) AS "row", * EXCLUDE (event_row, ingested_at) FROM raw_events GROUP BY ALL),
er AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY no, "row") AS ord FROM (SELECT coalesce(nullif(session_id, ''), nullif(trace_id, '')) AS sid, coalesce(seq, source_seq, 0) AS no, *, CASE WHEN json_valid(data) THEN data END AS d FROM er0) WHERE sid IS NOT NULL)"""
    speak = lambda t: rf"array_to_string(list_filter(list_transform(regexp_split_to_array({t}, '(?s)<thinking>.*?</thinking>'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10))"
    status = "coalesce(nullif(d ->> '$.finalStatus', ''), nullif(d ->> '$.status', ''))"
    turn = r"regexp_replace(split_part(regexp_split_to_array(prompt, '\n(?:Human|User):\s*')[-1], chr(10) || 'Assistant:', 1), '^\s+|\s+$', '', 'g')"
    out["event_sessions"] = _with(rows) + rf""",
a AS (SELECT sid, (arg_min([agent_id], ord))[1] AS a, (arg_min([session_key], ord))[1] AS k, (arg_min([model_id], ord))[1] AS m1, (arg_max([model_id], ord))[1] AS m2, (arg_min([provider], ord))[1] AS provider,
  arg_max({status}, ord) FILTER (event_type IN ('trace.artifacts', 'session.ended') AND {status} IS NOT NULL) AS final_status,
  arg_min(d ->> '$.prompt', ord) FILTER (event_type IN ('context.compiled', 'prompt.submitted') AND coalesce(d ->> '$.prompt', '') <> '') AS prompt, (arg_max([d ->> '$.assistantTexts[#-1]'], ord) FILTER (event_type = 'model.completed'))[1] AS t,
  count(*) FILTER (event_type IN ('context.compiled', 'prompt.submitted')) AS rounds, count(*) AS events FROM er GROUP BY sid)
SELECT sid, coalesce(CASE WHEN starts_with(k, 'agent:') THEN split_part(k, ':', 2) END, nullif(a, ''), 'unnamed') AS agent, coalesce(nullif(m1, ''), m2) AS model_version, provider, final_status, rounds, events,
  left(CASE WHEN contains(prompt, '[Subagent Task]') THEN regexp_replace(regexp_extract(prompt, '(?s)\[Subagent Task\](.*?)(?:\[|\z)', 1), '^\s+|\s+$', '', 'g') WHEN len(regexp_split_to_array(prompt, '\n(?:Human|User):\s*')) > 1 AND {turn} <> '' THEN {turn} ELSE prompt END, 5000) AS user_input,
  left(CASE WHEN {speak('t')} <> '' THEN {speak('t')} ELSE t END, 10000) AS final_output FROM a"""
    out["thinking_split"] = _with(rows) + rf"""
SELECT sid, no, "row", array_to_string(list_transform(regexp_extract_all(t, '(?s)<thinking>(.*?)</thinking>', 1), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10) || chr(10)) AS thinking, {speak('t')} AS spoken
FROM (SELECT sid, no, "row", d ->> '$.assistantTexts[#-1]' AS t FROM er WHERE event_type = 'model.completed') WHERE t IS NOT NULL"""
    tool = "coalesce(nullif(m ->> '$.toolName', ''), nullif(m ->> '$.tool', ''))"
    meta = "coalesce(nullif(m ->> '$.meta', ''), nullif(m ->> '$.output', ''))"
    given = "coalesce(nullif(m ->> '$.input', ''), nullif(m ->> '$.args', ''))"
    named = ", ".join(f"nullif(CASE WHEN json_valid(x) THEN x ->> '$.{k}' END, '')" for k in ("sessionId", "childSessionId", "id"))
    out["subagent_spawns"] = _with(rows) + f""",
sm AS (SELECT sid, no, "row", unnest(ms) AS m, unnest(range(len(ms))) AS k FROM (SELECT sid, no, "row", CASE WHEN json_type(d, '$.toolMetas') = 'ARRAY' THEN from_json(d -> '$.toolMetas', '["JSON"]') END AS ms FROM er WHERE event_type = 'trace.artifacts')),
sp AS (SELECT sid, no, k, {meta} AS x, {given} AS g FROM sm WHERE contains(lower(coalesce({tool}, '')), 'spawn'))
SELECT sid, no, k, coalesce({named}) AS child_session_id, left(coalesce(CASE WHEN json_valid(g) THEN coalesce(nullif(g ->> '$.task', ''), nullif(g ->> '$.prompt', '')) END, g, '{{}}'), 300) AS task FROM sp"""
    prompts = "event_type IN ('context.compiled', 'prompt.submitted')"
    attrs = out["event_sessions"].removeprefix("WITH ").removeprefix(rows.strip()).strip().removeprefix(",").strip()
    head, tail = attrs.split("SELECT sid, coalesce(CASE", 1)
    # What the sessions say of themselves, then the greedy matching, turn by turn.
    greedy = f"""{head.rstrip()},
attrs AS (SELECT sid, coalesce(CASE{tail}),
mt AS (SELECT sid, no, "row", event_type = 'model.completed' AS model FROM er WHERE event_type = 'trace.artifacts' OR (event_type = 'model.completed' AND json_array_length(d, '$.assistantTexts') > 0)),
m0 AS (SELECT sid, coalesce(list({{'no': no, 'row': "row"}} ORDER BY no, "row") FILTER (model), []) AS ms, coalesce(list({{'no': no, 'row': "row"}} ORDER BY no, "row") FILTER (NOT model), []) AS arts FROM mt GROUP BY sid),
gr AS (SELECT sid, ms, arts AS lft, 1 AS i, NULL::STRUCT(d BIGINT, "no" BIGINT, "row" BIGINT) AS b FROM m0
  UNION ALL SELECT sid, ms, CASE WHEN b2 IS NULL THEN lft ELSE list_filter(lft, lambda a: NOT (a.no = b2.no AND a."row" = b2."row")) END, i + 1, b2 FROM (SELECT *,
    list_sort(list_transform(list_filter(lft, lambda a: abs(a.no - ms[i].no) <= 5), lambda a: {{'d': abs(a.no - ms[i].no), 'no': a.no, 'row': a."row"}}))[1] AS b2 FROM gr WHERE i <= len(ms))),
am AS (SELECT sid, b.no AS artifact_no, b."row" AS artifact_row, ms[i - 1].no AS model_no, ms[i - 1]."row" AS model_row FROM gr WHERE b IS NOT NULL
  UNION ALL SELECT sid, a.no, a."row", NULL, NULL FROM (SELECT sid, unnest(lft) AS a FROM gr WHERE i = len(ms) + 1))"""
    recursive = "WITH RECURSIVE " + rows.strip() + ",\n" + greedy
    out["artifact_match"] = recursive + "SELECT * FROM am".replace("SELECT", "\nSELECT", 1)
    shown = "coalesce(nullif(m ->> '$.meta', ''), nullif(m ->> '$.output', ''), nullif(m ->> '$.result', ''), '')"
    get = lambda k: f"(CASE WHEN json_valid(shown) THEN CASE WHEN json_type(shown) = 'OBJECT' THEN shown ->> '$.{k}' END END)"
    truthy = lambda k: f"coalesce({get(k)} NOT IN ('', 'false', '0', '[]', '{{}}', 'null'), false)"
    flagged = f"coalesce({get('isError')} = 'true', false) OR coalesce({get('is_error')} = 'true', false) OR {truthy('error')} OR {truthy('error_message')} OR coalesce({get('status')} = 'error', false)"
    clean = f"{truthy('success')} OR {truthy('block_id')} OR {truthy('blocks')}"
    failed = f"CASE WHEN NOT regexp_matches(shown, '\\S') THEN false WHEN {flagged} THEN true WHEN {clean} THEN false ELSE {any_of('shown', [*S.ERROR_TEXTS, 'connection refused'])} END"
    told = "coalesce(m ->> '$.isError' = 'true', false) OR coalesce(m ->> '$.error' NOT IN ('', 'false', 'null'), false)"
    metas = """mm AS (SELECT sid, no, "row", unnest(ms) AS m, unnest(range(len(ms))) AS k FROM (SELECT sid, no, "row", CASE WHEN json_type(d, '$.toolMetas') = 'ARRAY' THEN from_json(d -> '$.toolMetas', '["JSON"]') END AS ms FROM er WHERE event_type = 'trace.artifacts'))"""
    thought = r"array_to_string(list_transform(regexp_extract_all(t, '(?s)<thinking>(.*?)</thinking>', 1), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10) || chr(10))"
    assembled = f"""{metas},
me AS (SELECT am.sid, coalesce(model_no, artifact_no + 1099511627776) AS at_, coalesce(model_row, artifact_row) AS rw, k, {tool} AS tool, {shown} AS shown, {told} AS told FROM am JOIN mm ON mm.sid = am.sid AND mm."row" = am.artifact_row),
tu AS (SELECT sid, no, "row", d ->> '$.assistantTexts[#-1]' AS t FROM er WHERE event_type = 'model.completed' AND json_array_length(d, '$.assistantTexts') > 0),
fp AS (SELECT sid, arg_min(no, ord) AS no, arg_min("row", ord) AS rw FROM er WHERE {prompts} GROUP BY sid),
st0 AS (SELECT fp.sid, no AS at_, rw, 0 AS sub, 'reasoning' AS step_type, NULL::VARCHAR AS tool_name, '[任务理解] ' || left(user_input, 500) AS content, NULL::VARCHAR AS status FROM fp JOIN attrs USING (sid) WHERE user_input <> ''
  UNION ALL SELECT sid, no, "row", 0, 'reasoning', NULL, left({thought}, 8000), NULL FROM tu WHERE {thought} <> ''
  UNION ALL SELECT sid, no, "row", 1073741824, 'output', NULL, left({speak('t')}, 8000), NULL FROM tu WHERE {speak('t')} <> ''
  UNION ALL SELECT sid, at_, rw, k * 2 + 1, 'tool_call', tool, NULL, NULL FROM me WHERE tool IS NOT NULL
  UNION ALL SELECT sid, at_, rw, k * 2 + 2, 'tool_result', tool, left(shown, 5000), CASE WHEN told OR {failed} THEN 'error' ELSE 'success' END FROM me WHERE tool IS NOT NULL),
asm AS (SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY at_, rw, sub) AS step_id, step_type, tool_name, content, status FROM st0)"""
    out["event_assembly"] = recursive + ",\n" + assembled + "\nSELECT * FROM asm"
    parent = "(arg_max([coalesce(nullif(d ->> '$.parentSessionId', ''), nullif(d ->> '$.parent_session_id', ''), nullif(parent_session_id, ''))], ord) FILTER (event_type = 'session.started'))[1]"
    out["event_outcomes"] = recursive + ",\n" + assembled + f""",
pp AS (SELECT sid, {parent} AS parent_session_id FROM er GROUP BY sid),
ps AS (SELECT sid, count(*) AS steps, count(*) FILTER (step_type = 'tool_call') AS tool_count, coalesce(array_to_string(list_sort(list(DISTINCT tool_name) FILTER (step_type = 'tool_call')), ','), '') AS unique_tools,
  count(*) FILTER (step_type = 'tool_call' AND contains(lower(tool_name), 'spawn')) AS spawn_count, coalesce(bool_or(status = 'error'), false) AS failed FROM asm GROUP BY sid)
SELECT sid, agent, model_version, rounds, steps, tool_count, unique_tools, spawn_count, parent_session_id, CASE WHEN final_status = 'success' THEN 'success' WHEN final_status IN ('error', 'failed') THEN 'failure' WHEN failed THEN 'likely_failure'
  WHEN coalesce(final_output, '') <> '' THEN 'likely_success' ELSE 'unknown' END AS outcome FROM attrs JOIN ps USING (sid) JOIN pp USING (sid) WHERE steps >= 2"""
    no_params = lambda c: rf"""NOT coalesce(CASE WHEN json_valid({c}) THEN CASE WHEN json_type({c}) = 'OBJECT' THEN len(list_filter(json_keys({c}), lambda k: ({c}::JSON -> k)::VARCHAR NOT IN ('""', '0', '0.0', 'false', 'null', '[]', '{{}}'))) > 0 END END, false)"""
    out["call_backfill"] = _with(CANON, rows, metas) + f""",
us AS (SELECT nullif(lower(regexp_replace(sid, '^\\s+|\\s+$', '', 'g')), '') AS sid, no, "row", k, {tool} AS tool, coalesce(nullif(m ->> '$.input', ''), nullif(m ->> '$.args', ''), nullif(m ->> '$.arguments', '')) AS params, {shown} AS shown, {told} AS told FROM mm),
un AS (SELECT sid, tool, params, CASE WHEN regexp_matches(shown, '\\S') THEN shown END AS use_output, told OR {failed} AS bad, row_number() OVER (PARTITION BY sid, tool ORDER BY no, "row", k) AS nth FROM us WHERE sid IS NOT NULL AND tool IS NOT NULL),
ca AS (SELECT sid, pos, tool, nullif(call_id, '') AS call, input_params AS own, row_number() OVER (PARTITION BY sid, tool ORDER BY pos) AS nth FROM f WHERE kind = 'tool_call' AND tool IS NOT NULL),
re AS (SELECT sid, nullif(call_id, '') AS call, min(pos) AS result_pos, arg_min([output], pos)[1] AS output, arg_min(st, pos) AS status FROM f WHERE kind = 'tool_result' AND coalesce(call_id, '') <> '' GROUP BY 1, 2),
cj AS (SELECT ca.*, use_output, bad, result_pos, output, re.status, {no_params('own')} AS was_empty, CASE WHEN {no_params('own')} THEN coalesce(CASE WHEN NOT {no_params('un.params')} THEN un.params END, CASE WHEN regexp_matches(own, '\\S') THEN own END, '{{}}') ELSE own END AS params
  FROM ca LEFT JOIN un ON un.sid = ca.sid AND un.tool = ca.tool AND un.nth = ca.nth LEFT JOIN re ON re.sid = ca.sid AND re.call = ca.call)
SELECT sid, pos, tool, call, nth, params, was_empty AND NOT {no_params('params')} AS params_filled, {no_params('params')} AS params_missing, result_pos,
  CASE WHEN result_pos IS NOT NULL AND coalesce(output, '') = '' THEN use_output ELSE output END AS output, CASE WHEN result_pos IS NOT NULL AND coalesce(output, '') = '' AND coalesce(bad, false) THEN 'error' ELSE status END AS status,
  result_pos IS NOT NULL AND coalesce(output, '') = '' AND use_output IS NOT NULL AS output_filled, result_pos IS NULL OR (coalesce(output, '') = '' AND use_output IS NULL) AS output_missing FROM cj"""
    out["nth_occurrence_backfill"] = _with(CANON) + """
SELECT sid, tool, count(*) AS calls, count(*) FILTER (pos = first_pos) AS firsts FROM (SELECT sid, tool, pos, min(pos) OVER (PARTITION BY sid, tool) AS first_pos FROM f WHERE kind = 'tool_call' AND tool IS NOT NULL) GROUP BY ALL"""
    clean = lambda c: rf"string_split(regexp_replace(regexp_replace({c}, '\s+', ' ', 'g'), '^ | $', '', 'g'), ' ')"
    out["retry_by_ingestion"] = _with(CANON, SESSIONS) + f""",
t AS (SELECT sid, traj_id, epoch_us(ingested_at) AS us, outcome, coalesce(user_input, '') AS ask, left(coalesce(user_input, ''), 200) AS s FROM sc WHERE ingested_at IS NOT NULL),
tg AS (SELECT *, list_distinct(list_transform(range(1, length(s)), lambda i: substring(s, i, 2))) AS g FROM t),
fe AS (SELECT sid, arg_min(error_kind, pos) AS fail_reason FROM f WHERE st = 'error' GROUP BY sid),
p AS (SELECT a.sid AS failed_session, b.sid AS success_session, (b.us - a.us) // 1000000 AS time_gap_sec, len(list_intersect(a.g, b.g))::DOUBLE / len(list_distinct(list_concat(a.g, b.g))) AS sim, coalesce(fail_reason, 'unknown') AS fail_reason,
  array_to_string(list_filter({clean('b.ask')}, lambda w: NOT list_contains({clean('a.ask')}, w))[1:30], ' ') AS added_context
  FROM tg a JOIN tg b ON a.outcome IN ('failure', 'likely_failure') AND b.outcome IN ('success', 'likely_success') AND b.us >= a.us AND b.us - a.us <= 86400000000 AND (b.us > a.us OR b.traj_id > a.traj_id) AND len(a.g) > 0 AND len(b.g) > 0 LEFT JOIN fe ON fe.sid = a.sid)
SELECT failed_session, success_session, time_gap_sec, {quantised('sim', 3)} AS input_similarity, fail_reason, added_context FROM p WHERE sim >= 0.3"""
    out["parent_links"] = f"""
WITH s AS (SELECT * FROM (SELECT {_SID} AS sid, parent_session_id, row_number() OVER (PARTITION BY {_SID} ORDER BY ingested_at DESC NULLS LAST, traj_id DESC) AS rn FROM trajectories) WHERE rn = 1 AND sid IS NOT NULL),
k AS (SELECT sid AS child, nullif(lower(regexp_replace(parent_session_id, '^\\s+|\\s+$', '', 'g')), '') AS parent FROM s)
SELECT child, parent, parent IN (SELECT sid FROM s) AS known FROM k WHERE parent IS NOT NULL"""
    outcome = f"""CASE WHEN json_type(r, '$.session_outcome') = 'VARCHAR' THEN {lookup("(r ->> '$.session_outcome')", S.OUTCOMES, 'unknown')}
  WHEN lower(r ->> '$.session_outcome.status') IN ('success', 'failure', 'partial', 'abandoned') THEN lower(r ->> '$.session_outcome.status') ELSE 'unknown' END"""
    request = f"""CASE WHEN json_type(r, '$.user_input') = 'OBJECT' THEN coalesce({_first('r', 'user_input.raw', 'user_input.text')}, r ->> '$.user_input') ELSE r ->> '$.user_input' END"""
    out["structured_sessions"] = f"""
WITH {_RECORDS} SELECT record_no, feed, file_no, line_no, r ->> '$.session_id' AS session_id, {request} AS user_input, r ->> '$.final_output' AS final_output,
  CASE WHEN list_contains(json_keys(r), 'agent') THEN r ->> '$.agent' ELSE 'unnamed' END AS agent, r ->> '$.metadata.model_version' AS model_version, {outcome} AS outcome FROM rec"""
    kind = "CASE WHEN named IS NULL THEN 'unknown' ELSE " + lookup("(named ->> '$')", S.STEP_TYPES, "unknown") + " END"
    raw_status = "(s ->> '$.status')"
    out["structured_steps"] = rf"""
WITH {_RECORDS},
s0 AS (SELECT record_no, feed, file_no, line_no, unnest(x) AS s, unnest(range(1, len(x) + 1)) AS pos FROM (SELECT *, CASE WHEN json_type(r, '$.trajectory') = 'ARRAY' THEN from_json(r -> '$.trajectory', '["JSON"]') END AS x FROM rec)),
s1 AS (SELECT *, CASE WHEN list_contains(json_keys(s), 'type') THEN s -> '$.type' WHEN list_contains(json_keys(s), 'step_type') THEN s -> '$.step_type' END AS named FROM s0 WHERE json_type(s) = 'OBJECT'),
s2 AS (SELECT *, CASE WHEN NOT list_contains(json_keys(s), 'step_id') THEN pos WHEN json_type(s, '$.step_id') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN trunc((s ->> '$.step_id')::DOUBLE)::BIGINT
  WHEN json_type(s, '$.step_id') = 'BOOLEAN' THEN (s ->> '$.step_id')::BOOLEAN::BIGINT WHEN json_type(s, '$.step_id') = 'VARCHAR' AND regexp_full_match(s ->> '$.step_id', '\s*[+-]?\d{{1,18}}\s*') THEN trim(s ->> '$.step_id')::BIGINT END AS step_id,
  {kind} AS kind FROM s1 WHERE named IS NULL OR json_type(named) = 'VARCHAR'),
s3 AS (SELECT *, {_first('s', 'output', 'result', 'content')} AS o, {_first('s', 'error', 'error_message')} AS e, CASE WHEN NOT list_contains(json_keys(s), 'status') THEN 'success' ELSE {lookup(raw_status, S.STATUSES, 'pending')} END AS written,
  coalesce(json_type(s, '$.isError') = 'BOOLEAN' AND s ->> '$.isError' = 'true', false) OR coalesce(json_type(s, '$.is_error') = 'BOOLEAN' AND s ->> '$.is_error' = 'true', false) AS flag FROM s2 WHERE step_id IS NOT NULL),
s4 AS (SELECT *, kind = 'tool_result' AND ({raw_status} IS NULL OR written = 'pending' OR (written = 'success' AND e IS NULL)) AS unsure, flag OR coalesce(regexp_matches(e, '\S'), false) AS byf, {any_of('o', S.ERROR_TEXTS)} AS byt FROM s3)
SELECT record_no, feed, file_no, line_no, pos, step_id, kind AS step_type, s ->> '$.timestamp' AS ts, CASE kind WHEN 'reasoning' THEN {_first('s', 'content', 'text', 'thinking')} WHEN 'output' THEN {_first('s', 'content', 'text', 'output')} END AS content,
  CASE WHEN kind = 'tool_call' THEN {_first('s', 'tool_name', 'tool')} END AS tool_name, CASE WHEN kind = 'tool_call' THEN {_first('s', 'skill_context', 'skill')} END AS skill_context,
  CASE kind WHEN 'tool_call' THEN {_first('s', 'metadata.call_id', 'call_id', 'id')} WHEN 'tool_result' THEN {_first('s', 'call_id', 'result_call_id')} END AS call_id,
  CASE WHEN kind = 'tool_result' THEN CASE WHEN unsure AND (byf OR byt) THEN 'error' ELSE written END END AS status,
  CASE WHEN kind = 'tool_result' THEN CASE WHEN unsure AND byf THEN coalesce(e, 'inferred_error') WHEN unsure AND byt THEN coalesce(e, 'inferred_error_from_text') ELSE e END END AS error,
  CASE WHEN kind = 'tool_result' THEN TRY_CAST(coalesce({_first('s', 'latency_ms')}, {_first('s', 'metadata.latency_ms')}) AS DOUBLE) END AS latency_ms,
  CASE WHEN kind = 'skill_route' THEN {_first('s', 'skill_selected', 'skill')} END AS skill_selected, CASE WHEN kind = 'skill_route' THEN {_first('s', 'routing_reason', 'reason')} END AS routing_reason,
  CASE WHEN kind = 'tool_result' THEN length(o) END AS output_chars FROM s4"""
    out["loss_weights"] = f"SELECT loss_weight, diverge_reason, count(*) AS n FROM ({out['export_weighted']}) GROUP BY ALL"
    out["bucket_counters"] = _with(CANON, SESSIONS) + f""",
c AS (SELECT unnest(list_filter(['total', CASE WHEN steps < 2 THEN 'filtered_min_steps' END, CASE WHEN steps >= 2 THEN 'use.' || use END, CASE WHEN steps >= 2 AND outcome = 'unknown' AND use <> 'low_value' THEN 'needs_review' END,
  CASE WHEN steps >= 2 AND use <> 'low_value' AND (outcome <> 'unknown' OR use IN ('dpo_candidate', 'recovery_training', 'skill_violation_neg', 'graceful_abort')) THEN 'extracted' END], lambda x: x IS NOT NULL)) AS counter FROM sc)
SELECT counter, count(*) AS n, {quantised('count(*)::DOUBLE * 100 / (SELECT count(*) FROM sc)', 2)} AS share FROM c GROUP BY counter"""
    out["fault_injection_contexts"] = _with(CANON, EVENTS) + f""",
sm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY error_kind ORDER BY sid, pos) AS rank FROM evr) WHERE rank <= 3),
p AS (SELECT sid, pos, {_PIECE.replace('CUT', '2000')} AS piece, left(coalesce(nullif(output, ''), nullif(error, '')), 300) AS failure FROM f)
SELECT error_kind AS error_type, rank, coalesce(max(failure) FILTER (p.pos = sm.pos), '') AS error_text, coalesce(string_agg(piece, chr(10) ORDER BY p.pos), '') AS context
FROM sm JOIN p ON p.sid = sm.sid AND p.pos BETWEEN sm.pos - 2 AND sm.pos + 2 GROUP BY ALL"""
    sets = {"tool_call_pairs": "tool_call_pairs", "long_plan": "long_plan", "graceful_abort": "graceful_abort", "error_taxonomy": "error_taxonomy_tools", "retry_sequences": "retry_by_ingestion", "subagent_collab": "subagent_collab"}
    out["extractor_counts"] = " UNION ALL ".join(f"SELECT {_q(name)} AS data_set, count(*) AS n FROM ({out[q]})" for name, q in sets.items())
    return out
