"""The queries of this subpackage, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import conversations, overlap, packing, pairs, personal, reading_level, tokenizer, truncation
from tracewright.sources import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The conversations left out; those that no row names, which silence sets apart, are in `p1_conversations` if sound."""
    found = conversations.left_out(table(spark, d, "raw_events"), table(spark, d, "steps"))
    return found.filter(~F.col("session_id").startswith(conversations.SILENCE))


def p1_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How many written sessions the cut at silences finds."""
    return conversations.agreement(table(spark, d, "raw_events"))


def p1_conversations(spark: SparkSession, d: str) -> DataFrame:
    return conversations.rebuilt(table(spark, d, "raw_events"), table(spark, d, "steps"), table(spark, d, "trajectories"))


def p1_turns(spark: SparkSession, d: str) -> DataFrame:
    """The turns of `p1_conversations` by number, role and length; that of artifacts, whose JSON engines write in their own ways, is left out."""
    chars = F.when((F.col("role") != "tool") | (F.col("stored_in") == "steps"), F.length("text")).cast("bigint")
    return p1_conversations(spark, d).select("stored_in", "session_id", "turn_no", "role", chars.alias("chars"))


def p1_sessionized(spark: SparkSession, d: str) -> DataFrame:
    """Raw events parted by silence within a channel, the gap calibrated on all rows; sessions without a reply left out."""
    return conversations.by_silence(table(spark, d, "raw_events"))


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    return overlap.split_overlaps(table(spark, d, "trajectories"), "traj_id", "split", "session_id", "user_input", "source")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_pairs(_overlaps(spark, d))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(_overlaps(spark, d), table(spark, d, "trajectories"), "traj_id", "split", "source")


_PERSONAL_FIELDS = {"user_input": ("trajectories", "traj_id"), "input_params": ("steps", "step_row"), "output": ("steps", "step_row")}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = personal.find(_texts(spark, d, _PERSONAL_FIELDS))
    return found.select("field_name", "row_id", "kind", "span_text").distinct()


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(_texts(spark, d, _PERSONAL_FIELDS))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defective_sides(table(spark, d, "dpo_pairs"))


def _texts(spark: SparkSession, d: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """The columns of `fields` (name to table and row number) as rows of `field_name`, `row_id`, `source`, `text`."""
    parts = []
    for name in sorted({t for t, _ in fields.values()}):
        own = {f: row for f, (t, row) in fields.items() if t == name}
        rows = table(spark, d, name)
        pairs_ = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(r).cast("bigint").alias("r"), F.col(f).alias("t")) for f, r in own.items()]))
        parts.append(rows.select("source", pairs_.alias("x")).select(F.col("x.f").alias("field_name"), F.col("x.r").alias("row_id"), "source", F.col("x.t").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("text is not null")


_CUT_FIELDS = {"user_input": ("trajectories", "traj_id"), "content": ("steps", "step_row"), "output": ("steps", "step_row")}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(truncation.judged(_texts(spark, d, _CUT_FIELDS)))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_report(truncation.judged(_texts(spark, d, _CUT_FIELDS)))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_column(table(spark, d, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = tokenizer.encode_column(table(spark, d, "documents"), "doc_id", "text", counts_only=True)
    return packing.pack(sizes, "doc_id", "n_tokens")


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    own = p9_containers(spark, d).groupBy("container").agg(F.sum("n").alias("n"))
    return own.agg(
        F.count("*").alias("containers"),
        F.sum("n").alias("tokens"),
        F.max("n").alias("fullest"),
        (F.count("*") * packing.CAPACITY - F.sum("n")).alias("unused"),
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    own = docs.filter((F.col("lang") == "en") & F.col("doc_kind").isin("runbook", "postmortem", "faq", "task_brief"))
    return reading_level.judged(own, table(spark, d, "doc_levels"), least_words=40).select("doc_id", "band")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    """The level of every document that has a text, of any language, kind and length; `known` tells how far the models know its words."""
    return reading_level.judged(table(spark, d, "documents"), table(spark, d, "doc_levels"))


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents, difficulty, surprisal and share of known words per language, kind and band, over every document that has a text."""
    kinds = table(spark, d, "documents").select("doc_id", "lang", "doc_kind")
    return (
        p10_levels(spark, d)
        .join(kinds, "doc_id")
        .groupBy("lang", "doc_kind", "band")
        .agg(
            F.count("*").alias("documents"),
            F.avg("grade").alias("grade"),
            F.avg("surprisal_mean").alias("surprisal_mean"),
            F.avg("surprisal_p90").alias("surprisal_p90"),
            F.avg("known").alias("known"),
        )
    )


def queries() -> dict:
    own = (p1_found, p1_conversations, p1_turns, p1_sessionized, p1_agreement, p3_found, p3_report, p4_found, p4_redacted, p5_found, p6_found, p6_report, p8_ids, p9_containers, p9_fill, p10_found, p10_levels, p10_profile)
    return {f.__name__: f for f in own}


_P1 = r"""
WITH ev AS (SELECT DISTINCT CASE WHEN session_id IS NULL OR NOT regexp_matches(session_id, '\S') THEN trace_id ELSE session_id END AS sid, coalesce(seq, source_seq) AS no, event_type, data FROM raw_events),
e AS (SELECT sid, no, event_type, data, data IS NOT NULL AND NOT json_valid(data) AS bad, CASE WHEN json_valid(data) THEN data END AS d FROM ev WHERE sid IS NOT NULL AND regexp_matches(sid, '\S') AND no IS NOT NULL),
t AS (SELECT sid, no, event_type, data, bad, CASE WHEN event_type = 'prompt.submitted' AND coalesce(regexp_matches(d ->> '$.prompt', '\S'), false) THEN 'u'
  WHEN event_type = 'model.completed' AND coalesce(regexp_matches(regexp_replace(d ->> '$.assistantTexts[#-1]', '(?s)<thinking>.*?</thinking>', '', 'g'), '\S'), false) THEN 'a' END AS role FROM e),
n AS (SELECT sid, no, count(*) > 1 AS clash, bool_or(bad) AS bad, max(role) AS role FROM t GROUP BY sid, no),
w AS (SELECT sid, no, role, lead(role) OVER (PARTITION BY sid ORDER BY no) AS nxt FROM n WHERE role IS NOT NULL),
c AS (SELECT n.sid, bool_or(clash OR bad) AS broken, count(role) AS turns, max(no) - min(no) + 1 <> count(*) AS gap, arg_min(role, no) AS first_role FROM n GROUP BY n.sid),
m AS (SELECT sid, bool_or(role = 'u' AND coalesce(nxt, 'u') = 'u') AS missing FROM w GROUP BY sid),
x AS (SELECT c.sid, CASE WHEN broken THEN 'broken' WHEN turns = 0 THEN 'empty' WHEN gap OR first_role <> 'u' THEN 'broken' WHEN missing THEN 'missing_reply' END AS defect FROM c LEFT JOIN m USING (sid)),
s0 AS (SELECT DISTINCT * EXCLUDE (step_row, ingested_at), lower(regexp_replace(step_type, '^\s+|\s+$', '', 'g')) AS k FROM steps WHERE session_id IS NOT NULL AND step_id IS NOT NULL),
s AS (SELECT *, k IN ('tool_call', 'tool', 'function_call') AS c, k IN ('tool_result', 'tool_response', 'function_result') AS r,
  k IN ('output', 'response', 'final') AND coalesce(regexp_matches(content, '\S'), false) AS o,
  coalesce(regexp_matches(concat_ws('', content, tool_name, output, error), '\S'), false) AS worded FROM s0),
sn AS (SELECT session_id, step_id, count(DISTINCT (coalesce(step_type, chr(1)), coalesce(content, chr(1)), coalesce(call_id, chr(1)), coalesce(output, chr(1)))) > 1 AS clash FROM s GROUP BY ALL),
sp AS (SELECT session_id, bool_or(hc <> hr) AS unpaired FROM (SELECT session_id, call_id, coalesce(bool_or(c), false) AS hc, coalesce(bool_or(r), false) AS hr FROM s WHERE (c OR r) AND coalesce(regexp_matches(call_id, '\S'), false) GROUP BY ALL) GROUP BY 1),
sc AS (SELECT session_id, bool_or(clash) AS clash, min(step_id) <> 1 OR max(step_id) <> count(*) AS gap FROM sn GROUP BY 1),
sw AS (SELECT session_id, bool_or(worded) AS worded, max(step_id) FILTER (r) AS lr, max(step_id) FILTER (o) AS lo FROM s GROUP BY 1),
y AS (SELECT session_id, CASE WHEN clash THEN 'broken' WHEN NOT worded THEN 'empty' WHEN gap OR coalesce(unpaired, false) THEN 'broken' WHEN lo IS NULL OR lo <= coalesce(lr, -1) THEN 'missing_reply' END AS defect
  FROM sc JOIN sw USING (session_id) LEFT JOIN sp USING (session_id))
SELECT 'raw_events' AS stored_in, sid AS session_id, defect FROM x WHERE defect IS NOT NULL UNION ALL SELECT 'steps', session_id, defect FROM y WHERE defect IS NOT NULL"""
_P3 = r"""
WITH r AS (SELECT traj_id, split = 'train' AS tr, nullif(lower(regexp_replace(session_id, '^\s+|\s+$', '', 'g')), '') AS sid,
  regexp_extract_all(lower(coalesce(user_input, '')), '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{3005}-\x{3007}\x{3040}-\x{30ff}\x{f900}-\x{faff}]|[a-z0-9\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2c1}]+') AS ws FROM trajectories WHERE split IN ('train', 'dev', 'test')),
w AS (SELECT traj_id, tr, len(ws) AS n, x, row_number() OVER (PARTITION BY traj_id, x) AS k FROM (SELECT traj_id, tr, ws, unnest(ws) AS x FROM r WHERE len(ws) >= 8)),
c AS (SELECT a.traj_id AS ta, b.traj_id AS tb, count(*) AS common, any_value(greatest(a.n, b.n)) AS longer FROM w a JOIN w b ON a.x = b.x AND a.k = b.k WHERE a.tr AND NOT b.tr GROUP BY 1, 2),
p AS (SELECT ta, tb FROM c WHERE common * 10 >= longer * 8 UNION SELECT a.traj_id, b.traj_id FROM r a JOIN r b ON a.sid = b.sid WHERE a.tr AND NOT b.tr)
SELECT DISTINCT least(ta, tb) AS traj_id_a, greatest(ta, tb) AS traj_id_b FROM p"""


_P3_REPORT = (
    _P3.split("SELECT DISTINCT least")[0].rstrip()
    + """,
al AS (SELECT DISTINCT tb FROM c WHERE common * 10 >= longer * 8),
k AS (SELECT tb, count(*) AS pairs FROM (SELECT DISTINCT ta, tb FROM p) GROUP BY tb)
SELECT split, source, count(*) AS "rows", count(pairs) AS rows_in_training, count(al.tb) AS rows_alike, coalesce(sum(pairs), 0)::BIGINT AS pairs
FROM trajectories LEFT JOIN k ON k.tb = traj_id LEFT JOIN al ON al.tb = traj_id WHERE split IN ('dev', 'test') GROUP BY ALL"""
)
_P1_TURNS = (
    _P1.split("SELECT 'raw_events' AS stored_in, sid AS session_id")[0].rstrip()
    + r""",
et AS (SELECT sid, no, CASE WHEN role = 'u' THEN 'user' WHEN role = 'a' THEN 'assistant' WHEN event_type = 'context.compiled' AND coalesce(regexp_matches(d ->> '$.prompt', '\S'), false) THEN 'system'
  WHEN event_type = 'trace.artifacts' AND list_contains(coalesce(json_keys(d), []), 'toolMetas') THEN 'tool' END AS role, coalesce(CASE WHEN event_type IN ('prompt.submitted', 'context.compiled') THEN d ->> '$.prompt' END,
  CASE WHEN event_type = 'model.completed' THEN d ->> '$.assistantTexts[#-1]' END) AS txt FROM (SELECT t.*, CASE WHEN json_valid(data) THEN data END AS d FROM t)),
en AS (SELECT DISTINCT sid, no, role, txt FROM et WHERE role IS NOT NULL AND sid NOT IN (SELECT sid FROM x WHERE defect IS NOT NULL)),
kk AS (SELECT session_id, step_id, CASE WHEN c THEN 'tool_call' WHEN r THEN 'tool_result' WHEN k IN ('output', 'response', 'final') THEN 'output' WHEN k IN ('reasoning', 'think', 'thinking', 'thought') THEN 'reasoning' WHEN k IN ('skill_route', 'route', 'routing') THEN 'skill_route' END AS kind,
  nullif(CASE WHEN regexp_matches(content, '\S') THEN content END, '') AS ct, CASE WHEN regexp_matches(skill_context, '\S') THEN skill_context END AS sk, CASE WHEN regexp_matches(tool_name, '\S') THEN tool_name END AS tn, CASE WHEN regexp_matches(input_params, '\S') THEN input_params END AS ip,
  CASE WHEN regexp_matches(output, '\S') THEN output END AS ou, CASE WHEN regexp_matches(error, '\S') THEN error END AS er FROM s),
su AS (SELECT session_id, step_id AS no, CASE WHEN kind = 'tool_result' THEN 'tool' WHEN kind = 'skill_route' AND coalesce(ct, sk) IS NOT NULL THEN 'system' WHEN kind = 'tool_call' OR (kind IN ('reasoning', 'output') AND ct IS NOT NULL) THEN 'assistant' END AS role,
  CASE kind WHEN 'tool_call' THEN concat_ws(' ', ct, tn, ip) WHEN 'tool_result' THEN coalesce(ou, er, ct, '') WHEN 'skill_route' THEN coalesce(ct, sk) ELSE ct END AS txt FROM kk),
rq AS (SELECT lower(regexp_replace(session_id, '^\s+|\s+$', '', 'g')) AS key, arg_min(user_input, traj_id) AS txt FROM trajectories WHERE coalesce(regexp_matches(user_input, '\S'), false) GROUP BY 1),
sn2 AS (SELECT session_id, no, min(role) AS role, min(txt) AS txt FROM (SELECT * FROM su WHERE role IS NOT NULL UNION ALL SELECT n.session_id, 0, 'user', rq.txt FROM (SELECT DISTINCT session_id FROM s) n JOIN rq ON rq.key = lower(regexp_replace(n.session_id, '^\s+|\s+$', '', 'g')))
  WHERE session_id NOT IN (SELECT session_id FROM y WHERE defect IS NOT NULL) GROUP BY 1, 2),
al AS (SELECT 'raw_events' AS stored_in, sid AS session_id, no, min(role) AS role, min(txt) AS txt FROM en GROUP BY ALL UNION ALL SELECT 'steps', session_id, no, role, txt FROM sn2)
SELECT stored_in, session_id, row_number() OVER (PARTITION BY stored_in, session_id ORDER BY no) AS turn_no, role,
  CASE WHEN role <> 'tool' OR stored_in = 'steps' THEN length(regexp_replace(txt, '^\s+|\s+$', '', 'g')) END AS chars FROM al"""
)


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express on whole tables; the others are tested against brute force, round trips and held-out rows."""
    return {"p1_found": _P1, "p1_turns": _P1_TURNS, "p3_found": _P3, "p3_report": _P3_REPORT}
