"""All queries of the core, by name, and the SQL each is compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.text import contains_any, is_blank
from tracewright.operators import assembly, evalset, facts, pairing, preferences, render, samples, scoring, sequence, specialist, taxonomy
from tracewright.operators.schema_drift import drift, unified
from tracewright.operators.timestamps import normalise_timestamps
from tracewright.plans import oracles
from tracewright.sources import cut_lineage, once, parse, table

FLAGSHIP = "error_taxonomy_recovery"


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """The facts of a folder, written once per session, since most queries read them in several branches."""
    return once(spark, d, "steps", lambda: cut_lineage(facts.step_facts(table(spark, d, "steps"))))


def _scored(spark: SparkSession, d: str, own: DataFrame | None = None) -> DataFrame:
    own = _facts(spark, d) if own is None else own
    return scoring.scored(facts.session_rows(table(spark, d, "trajectories")), facts.session_stats(own))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "raw_events", lambda: cut_lineage(assembly.event_rows(table(spark, d, "raw_events"))))


def error_taxonomy_recovery(spark, d):
    return taxonomy.recovery_by_class(_facts(spark, d))


def error_taxonomy_tools(spark, d):
    return taxonomy.taxonomy(taxonomy.error_events(_facts(spark, d)))


def error_samples(spark, d):
    own = _facts(spark, d)
    return taxonomy.samples(taxonomy.error_events(own), own)


def fault_injection_targets(spark, d):
    return taxonomy.injection_targets(error_taxonomy_tools(spark, d))


def step_type_normalise(spark, d):
    return table(spark, d, "steps").groupBy(S.step_type(F.col("step_type")).alias("kind")).agg(F.count("*").alias("n"))


def status_normalise(spark, d):
    resolved = S.resolved_status(F.col("status"), F.col("output"), F.col("error"))
    return table(spark, d, "steps").groupBy("status", S.status(F.col("status")).alias("written"), resolved.alias("resolved")).agg(F.count("*").alias("n"))


def outcome_normalise(spark, d):
    return table(spark, d, "trajectories").groupBy("session_outcome", S.outcome(F.col("session_outcome")).alias("outcome")).agg(F.count("*").alias("n"))


def error_text_inference(spark, d):
    return table(spark, d, "steps").groupBy("source").agg(
        F.count_if(contains_any(F.col("output"), S.ERROR_TEXTS)).alias("by_text"), F.count_if(~is_blank(F.col("error"))).alias("by_field"), F.count("*").alias("n")
    )


def call_pairing_check(spark, d):
    own = _facts(spark, d).filter(F.col("kind").isin("tool_call", "tool_result") & F.col("call").isNotNull())
    per = own.groupBy("sid", F.col("call").alias("call_id")).agg(F.max(F.col("kind") == "tool_call").alias("called"), F.max(F.col("kind") == "tool_result").alias("answered"))
    return per.filter("called <> answered")


def step_continuity_check(spark, d):
    per = _facts(spark, d).groupBy("sid").agg(
        F.count("*").alias("steps"), F.min("step_id").alias("first_id"), F.max("step_id").alias("last_id"), F.max(F.col("step_id") != F.col("pos")).alias("bad")
    )
    return per.filter("bad").drop("bad")


def session_stats(spark, d):
    s = facts.session_stats(_facts(spark, d))
    return s.select(
        "sid", "steps", "tool_calls", "tool_results", "error_steps", "thoughts", "recoveries", "switches", "violates",
        F.array_join("tools", ",").alias("tools"), F.array_join("skills", ",").alias("skills"),
    )


def value_score(spark, d):
    return _scored(spark, d).select("sid", "complexity", "recovery_value", "planning", "compliance", "total")


def outcome_inference(spark, d):
    return _scored(spark, d).groupBy(S.outcome(F.col("session_outcome")).alias("written"), "outcome").agg(F.count("*").alias("n"))


def training_use_buckets(spark, d):
    return scoring.routed(_scored(spark, d)).select("sid", "use", "bucket", "review")


def retry_kind(spark, d):
    return sequence.retries(_facts(spark, d)).select("sid", "pos", "error_class", "failed_tool", "recovery_kind", "resolved", "retry_loop", "intent_only")


def diverge_point(spark, d):
    return sequence.diverge_points(sequence.retries(_facts(spark, d))).select("sid", "pos", "error_class", "recovery_kind", "priority")


def item_resolved(spark, d):
    return sequence.items_resolved(_facts(spark, d))


def abort_reasons(spark, d):
    """What the final outputs of all sessions would be taken for: whether they say that they stop, and why."""
    out = table(spark, d, "trajectories").select("source", specialist.signals_abort(F.col("final_output")).alias("stops"), specialist.abort_reason(F.coalesce("final_output", F.lit(""))).alias("reason"))
    return out.groupBy("source", "stops", "reason").agg(F.count("*").alias("n"))


def fingerprint_clusters(spark, d):
    c = pairing.candidates(_scored(spark, d))
    return c.groupBy("fp").agg(F.count("*").alias("sessions"), F.count_if(F.col("outcome").isin("success", "likely_success")).alias("good"))


def bucket_counters(spark, d):
    return scoring.counters(_scored(spark, d))


def fault_injection_contexts(spark, d):
    own = _facts(spark, d)
    return taxonomy.injection_contexts(taxonomy.error_events(own), own, table(spark, d, "steps"))


def extractor_counts(spark, d):
    """How many samples each specialist data set has, retries by ingestion over a day."""
    own, sessions = _facts(spark, d), table(spark, d, "trajectories")
    instants = sessions.select("traj_id", F.unix_micros(F.col("ingested_at").cast("timestamp")).alias("us")).filter("us is not null")
    scored = cut_lineage(_scored(spark, d, own).select("sid", "traj_id", "outcome", "steps", "tools", "tool_calls", "error_steps", "user_input", "final_output"))  # read by five of them
    found = specialist.run_all(own, scored, render.last_outputs(table(spark, d, "steps")), instants, minutes=1440)
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("data_set"), "n") for name, df in found.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def loss_weights(spark, d):
    return export_weighted(spark, d).groupBy("loss_weight", "diverge_reason").agg(F.count("*").alias("n"))


def _pairs(spark, d):
    own = _facts(spark, d)
    found = sequence.diverge_points(sequence.retries(own))
    return preferences.run_pairing(pairing.candidates(_scored(spark, d, own)), own, table(spark, d, "steps"), found, sequence.items_resolved(own))


def pairs_full(spark, d):
    """All pairs with prompt, chosen, rejected and what they rest on, before dedup."""
    return _pairs(spark, d)


def pair_error_state(spark, d):
    own = _facts(spark, d)
    c, found = pairing.candidates(_scored(spark, d, own)), sequence.diverge_points(sequence.retries(own))
    pairs = preferences.error_pairs(c, own, table(spark, d, "steps"), found, sequence.items_resolved(own))
    return pairs.select(
        "pair_id", "pair_type", "pair_quality", "task_type", "error_type", "success_session", "failure_session", "tool_similarity", "error_at_step", "recovery_kind", "resolved", "retry_loop",
        "intent_only_failure", "failed_item_eventually_resolved", "rejected_source", "preference_strength",
    )


def pair_quality(spark, d):
    return _pairs(spark, d).filter("pair_type = 'quality_comparison'").select("pair_id", "task_type", F.col("success_session").alias("chosen_session"), F.col("failure_session").alias("rejected_session"), "score_gap")


def pair_dedup_full(spark, d):
    """The pairs of `pairs_full` that stand after both dedups."""
    return preferences.deduplicated(_pairs(spark, d)).select("pair_id", "pair_quality", "near_duplicate_group_id", "preference_strength")


def export_weighted(spark, d):
    """The main export of own pairs with the weight each has in the loss."""
    return preferences.export_main(preferences.deduplicated(_pairs(spark, d))).select("pair_id", "diverge_reason", "preference_strength", "synthetic_rejected", "loss_weight")


def session_redeliveries(spark, d):
    return facts.redeliveries(table(spark, d, "trajectories"))


def pair_dedup(spark, d):
    pairs = table(spark, d, "dpo_pairs").withColumn("grp", F.concat(F.left("failure_session", F.lit(8)), F.lit(":"), F.col("error_type")))
    once = pairing.first_of_each(pairs, ["chosen", "rejected", "pair_quality"], "pair_no").select("pair_no", "pair_quality", "grp")
    order = F.when(F.col("pair_quality") == "high", 0).when(F.col("pair_quality") == "medium", 1).otherwise(2)
    return pairing.capped_groups(once, "grp", [order, F.col("pair_no")])


def export_counts(spark, d):
    pairs = table(spark, d, "dpo_pairs")
    both = pairing.export_main(pairs).withColumn("export", F.lit("main")).unionByName(pairing.export_extended(pairs).withColumn("export", F.lit("extended")))
    return both.groupBy("export", "pair_type", "pair_quality").agg(F.count("*").alias("n"))


def pair_distribution(spark, d):
    return table(spark, d, "dpo_pairs").rollup("pair_type", "pair_quality", "error_type").agg(F.count("*").alias("n"))


def strata(spark, d):
    return evalset.strata(_scored(spark, d)).groupBy("stratum").agg(F.count("*").alias("n"))


def stratified_sample(spark, d):
    return evalset.stratified(evalset.strata(_scored(spark, d)).filter("use <> 'low_value'")).select("stratum", "sid", "rank")


def label_queue(spark, d):
    return evalset.label_queue(_scored(spark, d))


def eval_criteria(spark, d):
    return evalset.criteria(_scored(spark, d))


def tool_call_pairs(spark, d):
    own = _facts(spark, d)
    return specialist.tool_call_pairs(own, _scored(spark, d, own))


def long_plan(spark, d):
    own = _facts(spark, d)
    return specialist.long_plans(own, _scored(spark, d, own))


def graceful_abort(spark, d):
    return specialist.graceful_aborts(render.last_outputs(table(spark, d, "steps")), _scored(spark, d))


def subagent_collab(spark, d):
    own = _facts(spark, d)
    return specialist.subagent_work(own, _scored(spark, d, own))


def retry_sequences(spark, d):
    own = _facts(spark, d)
    instants = normalise_timestamps(table(spark, d, "trajectories"), "created_at", "traj_id", "source", table(spark, d, "sources"))
    return specialist.retry_sequences(_scored(spark, d, own), instants.toDF("traj_id", "us"), specialist.first_errors(own))


def retry_by_ingestion(spark, d):
    """Retries by the time a session was ingested, over a day: times that SQL can read as well."""
    own, sessions = _facts(spark, d), table(spark, d, "trajectories")
    instants = sessions.select("traj_id", F.unix_micros(F.col("ingested_at").cast("timestamp")).alias("us")).filter("us is not null")
    return specialist.retry_sequences(_scored(spark, d, own), instants, specialist.first_errors(own), minutes=1440)


def sft_messages(spark, d):
    return render.messages(table(spark, d, "steps"))


def budgeted_render(spark, d):
    return render.budgeted(table(spark, d, "steps"))


def _routed(spark, d, own):
    return scoring.routed(_scored(spark, d, own))


def sft_rows(spark, d):
    """The conversations of supervised positives, recoveries and aborts, message by message."""
    own = _routed(spark, d, _facts(spark, d)).filter(F.col("bucket").isin(*samples.WITH_MESSAGES))
    return render.conversations(own.select("sid", "user_input", "final_output"), render.messages(table(spark, d, "steps")), preferences.SYSTEM)


def export_sft(spark, d):
    """Supervised positives that are long enough for the export, with the number and the characters of their messages."""
    own = _routed(spark, d, _facts(spark, d)).filter("bucket = 'sft_positive'")
    rows = render.conversations(own.select("sid", "user_input", "final_output"), render.messages(table(spark, d, "steps")), preferences.SYSTEM)
    return rows.groupBy("sid").agg(F.count("*").alias("messages"), F.sum(F.length("content")).alias("chars")).filter(F.col("messages") >= samples.LEAST_MESSAGES)


def training_samples(spark, d):
    own = _facts(spark, d)
    s = samples.training_samples(_routed(spark, d, own), own, table(spark, d, "steps"))
    listed = [F.array_join(c, ",").alias(c) for c in ("error_steps", "recovery_steps", "violation_steps")]
    return s.select("sid", "training_use", "any_recovery", "has_recovery", *listed, "abort_signal", "abort_reason")


def tool_call_samples(spark, d):
    own = _facts(spark, d)
    return samples.tool_call_samples(specialist.tool_call_pairs(own, _scored(spark, d, own)), own, table(spark, d, "steps"))


def long_plan_switches(spark, d):
    own = _facts(spark, d)
    used = specialist.long_plans(own, _scored(spark, d, own)).select("sid", F.col("total_steps").alias("used"))
    return samples.switch_points(own, used)


def retry_preferences(spark, d):
    return samples.retry_preferences(retry_sequences(spark, d), _facts(spark, d), table(spark, d, "steps"))


def subagent_spawns(spark, d):
    return assembly.subagent_spawns(_events(spark, d))


def event_sessions(spark, d):
    return assembly.session_attributes(_events(spark, d)).drop("created_at", "parent_session_id")


def thinking_split(spark, d):
    rows = _events(spark, d).filter("type = 'model.completed'").withColumn("t", F.try_element_at("texts", F.lit(-1))).filter("t is not null")
    return rows.select("sid", "no", "row", assembly.thinking(F.col("t")).alias("thinking"), assembly.spoken(F.col("t")).alias("spoken"))


def artifact_match(spark, d):
    return assembly.match_artifacts(_events(spark, d))


def event_assembly(spark, d):
    return assembly.assembled_steps(_events(spark, d))


def event_outcomes(spark, d):
    rows = _events(spark, d)
    return assembly.session_outcomes(rows, assembly.assembled_steps(rows))


def _filled_calls(spark, d):
    """Calls of steps, filled from the artifacts of raw events; texts of steps join the narrow facts by row number."""
    steps = table(spark, d, "steps")
    texts = steps.select(F.col("step_row").alias("row"), "input_params", "output").dropDuplicates(["row"])
    own = _facts(spark, d).filter("kind in ('tool_call', 'tool_result')").select("sid", "pos", "row", "kind", "tool", "call", "st").join(texts, "row")
    calls = own.filter("kind = 'tool_call' and tool is not null").select("sid", "pos", "tool", "call", F.col("input_params").alias("params"), F.col("input_params").alias("own_params"))
    results = own.filter("kind = 'tool_result'").select("sid", "pos", "call", "output", F.col("st").alias("status"))
    return assembly.filled_calls(calls, results, assembly.tool_uses(_events(spark, d)))


def call_backfill(spark, d):
    """Every call with the parameters, output and status that the uses of its tool in raw events could fill."""
    return _filled_calls(spark, d)


def nth_occurrence_backfill(spark, d):
    """Calls per session and tool of `call_backfill`, which has the filled rows; its SQL sees these counts only."""
    return _filled_calls(spark, d).groupBy("sid", "tool").agg(F.count("*").alias("calls"), F.count_if(F.col("nth") == 1).alias("firsts"))


def parent_links(spark, d):
    return assembly.parent_links(table(spark, d, "trajectories"))


_RECORD = ["record_no", "feed", "file_no", "line_no"]


def _records(spark, d):
    own = table(spark, d, "session_files")
    return own.filter("record is not null").select("record_no", "feed", "file_no", "line_no", F.try_parse_json("record").alias("v")).filter("v is not null")


def structured_sessions(spark, d):
    return parse.structured_sessions(_records(spark, d), _RECORD).drop("created_at")


def structured_steps(spark, d):
    """Steps of structured records; arrays, and JSON texts of other shapes than text, are left to `parse.structured_steps`."""
    return parse.structured_steps(_records(spark, d), _RECORD).select(
        *_RECORD, "pos", "step_id", "step_type", "ts", "content", "tool_name", "skill_context", "call_id", "status", "error", "latency_ms", "skill_selected", "routing_reason", F.length("output").alias("output_chars"),
    ).withColumn("output_chars", F.when(F.col("step_type") == "tool_result", F.col("output_chars")))


def parsed_sessions(spark, d):
    """Sessions of all records by the rules of their format."""
    return parse.parsed(_records(spark, d), _RECORD)[0].groupBy("format", "outcome", "agent").agg(F.count("*").alias("n"), F.sum(F.length("user_input")).alias("chars"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift(table(spark, d, "session_files"))


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    return unified(table(spark, d, "session_files"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    sources = table(spark, d, "sources")
    created = normalise_timestamps(table(spark, d, "trajectories"), "created_at", "traj_id", "source", sources)
    steps = normalise_timestamps(table(spark, d, "steps"), "ts", "step_row", "source", sources)
    name = lambda df, n: df.select(F.lit(n).alias("field_name"), "row_id", "epoch_us")
    return name(created, "created_at").unionByName(name(steps, "ts"))


_QUERIES = (
    error_taxonomy_recovery, error_taxonomy_tools, error_samples, fault_injection_targets, step_type_normalise, status_normalise, outcome_normalise,
    error_text_inference, call_pairing_check, step_continuity_check, session_stats, value_score, outcome_inference, training_use_buckets, retry_kind,
    diverge_point, item_resolved, abort_reasons, fingerprint_clusters, pair_error_state, pair_quality, pairs_full, pair_dedup_full, export_weighted, loss_weights, bucket_counters, fault_injection_contexts, extractor_counts, session_redeliveries, pair_dedup, export_counts, pair_distribution, strata,
    stratified_sample, label_queue, eval_criteria, tool_call_pairs, long_plan, graceful_abort, subagent_collab, retry_sequences, retry_by_ingestion, sft_messages,
    sft_rows, export_sft, training_samples, tool_call_samples, long_plan_switches, retry_preferences, subagent_spawns, budgeted_render, event_sessions, thinking_split, artifact_match, event_assembly, event_outcomes, nth_occurrence_backfill, call_backfill, parent_links,
    structured_sessions, structured_steps, parsed_sessions,
    p2_found, p2_unified, p7_found,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
