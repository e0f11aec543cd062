"""Steps as messages and as budgeted assistant text.

Positions and message numbers are found on narrow rows; the texts join them by row number and are shuffled twice, to the
row and to the message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.pieces import TASK_NOTE, piece, within
from tracewright.functions.text import fingerprint
from tracewright.operators.facts import BUSINESS, session_name
from tracewright.operators.ordered import with_position, with_running_sum
from tracewright.sources.tables import cut_lineage


def placed_rows(steps: DataFrame) -> DataFrame:
    """Every step once as a narrow row: `sid`, `pos`, `row` (of the first delivery), `kind`, `shown` (whether it has a piece)."""
    named = steps.withColumn("sid", session_name(F.col("session_id"))).filter("sid is not null and step_id is not null")
    kind = S.step_type(F.col("step_type"))
    content = F.coalesce("content", F.lit(""))
    shown = kind.isin("tool_call", "tool_result") | ((kind == "output") & (content != "")) | ((kind == "reasoning") & (content != "") & ~content.startswith(TASK_NOTE))
    narrow = named.select(
        "sid", F.col("step_id").cast("bigint").alias("step_id"), F.col("step_row").alias("row"), kind.alias("kind"), shown.alias("shown"),
        fingerprint(*[F.col(c) for c in BUSINESS]).alias("_mark"),
    )
    once = narrow.groupBy("sid", "step_id", "_mark").agg(F.min("row").alias("row"), F.first("kind").alias("kind"), F.first("shown").alias("shown")).drop("_mark")
    return cut_lineage(with_position(once, "sid", "step_id", "row"))


def _pieces(steps: DataFrame, most: int, routes: bool = False) -> DataFrame:
    """`row`, `piece` of every step row that has one, with `routes` also of routes; a row number that comes twice counts once."""
    own = steps.withColumn("kind", S.step_type(F.col("step_type"))).withColumn("st", S.resolved_status(F.col("status"), F.col("output"), F.col("error")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in steps.columns else F.lit("")
    route = F.concat(
        F.lit('<skill_route skill="'), text("skill_selected"), F.lit('" confidence="'), text("routing_confidence"), F.lit('">'), text("routing_reason"), F.lit("</skill_route>")
    )
    shown = F.coalesce(piece(most), F.when(F.col("kind") == "skill_route", route)) if routes else piece(most)
    return own.select(F.col("step_row").alias("row"), shown.alias("piece")).filter("piece is not null").dropDuplicates(["row"])


def messages(steps: DataFrame, most: int = 3000) -> DataFrame:
    """`sid`, `msg_no`, `role`, `content`: a result is a tool message, the pieces between two results, routes among them, one assistant message.

    Results are counted by a running sum over runs of positions, so that no session is sorted as a whole.
    """
    result = F.col("kind") == "tool_result"
    cut = with_running_sum(placed_rows(steps).filter("shown or kind = 'skill_route'"), "sid", "pos", F.when(result, 1).otherwise(0), "results")
    no = F.col("results") * 2 - F.when(result, 1).otherwise(0)
    numbered = cut.select("row", "sid", "pos", no.cast("bigint").alias("msg_no"), F.when(result, "tool").otherwise("assistant").alias("role"))
    parts = numbered.join(_pieces(steps, most, True), "row").groupBy("sid", "msg_no", "role").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
    return parts.select("sid", "msg_no", "role", F.array_join(F.transform("parts", lambda x: x["piece"]), "\n").alias("content"))


def conversations(sessions: DataFrame, own: DataFrame, system: str) -> DataFrame:
    """`sid`, `msg_no`, `role`, `content` of supervised samples: the system's text (-2), the request (-1), then the `messages` of the session.

    A session without a message ends in its final output, where it has one.
    """
    fixed = lambda no, role, c: sessions.select("sid", F.lit(no).cast("bigint").alias("msg_no"), F.lit(role).alias("role"), c.alias("content"))
    heads = fixed(-2, "system", F.lit(system)).unionByName(fixed(-1, "user", F.coalesce("user_input", F.lit(""))))
    said = own.join(sessions.select("sid"), "sid", "left_semi")
    silent = sessions.filter("final_output <> ''").join(own.select("sid").distinct(), "sid", "left_anti")
    return heads.unionByName(said).unionByName(silent.select("sid", F.lit(0).cast("bigint").alias("msg_no"), F.lit("assistant").alias("role"), F.col("final_output").alias("content")))


def whole_texts(steps: DataFrame, sids: DataFrame) -> DataFrame:
    """`sid`, `text`: all pieces of each of the sessions `sids` as the one assistant message of the plain supervised form."""
    rows = placed_rows(steps).filter("shown").join(sids, "sid", "left_semi").select("row", "sid", "pos")
    parts = rows.join(_pieces(steps, 2000), "row").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
    return parts.select("sid", F.array_join(F.transform("parts", lambda x: x["piece"]), "\n").alias("text"))


def budgeted(steps: DataFrame, last: int = 12, budget: int = 6000) -> DataFrame:
    """`sid`, `text`: the pieces of the first `last` steps as far as their lengths sum to at most `budget`, up to the first that does not fit."""
    first = placed_rows(steps).filter((F.col("pos") <= last) & F.col("shown")).select("row", "sid", "pos")
    lists = first.join(_pieces(steps, 2000), "row").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
    return lists.select("sid", within(F.col("parts"), budget).alias("text"))


def last_outputs(steps: DataFrame) -> DataFrame:
    """`sid`, `last_output`: what the last output step of each session that says anything says."""
    last = placed_rows(steps).filter("kind = 'output' and shown").groupBy("sid").agg(F.max_by("row", "pos").alias("row"))
    said = steps.select(F.col("step_row").alias("row"), F.col("content").alias("last_output")).dropDuplicates(["row"])
    return last.join(said, "row").select("sid", "last_output")
