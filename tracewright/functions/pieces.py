"""A step as a piece of text, and the longest run of pieces that fits a budget."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.text import truthy_coalesce

# The note that repeats the request, and the forms of pieces.
TASK_NOTE = "[任务理解]"
_THOUGHT, _CALL, _RESULT = ("<thinking>\n", "\n</thinking>"), ('<tool_call>\n{"tool": "', '", "params": ', "}\n</tool_call>"), ('<tool_result status="', '">\n', "\n</tool_result>")


def _parts(most: int) -> tuple[Column, Column, Column, Column, Column, Column]:
    content, kind = F.coalesce("content", F.lit("")), F.col("kind")
    thought = (kind == "reasoning") & (content != "") & ~content.startswith(TASK_NOTE)
    said = (kind == "output") & (content != "")
    params = F.coalesce(F.nullif("input_params", F.lit("")), F.lit("{}"))
    shown = F.left(F.coalesce(truthy_coalesce(F.col("output"), F.col("error")), F.lit("")), F.lit(most))
    return content, thought, said, F.coalesce("tool_name", F.lit("")), params, shown


def piece(most: int) -> Column:
    """A step (`kind`, `st` and its texts) as text: thought, call, result cut at `most`, or output; null for others and for the note of the task."""
    content, thought, said, tool, params, shown = _parts(most)
    call = F.concat(F.lit(_CALL[0]), tool, F.lit(_CALL[1]), params, F.lit(_CALL[2]))
    result = F.concat(F.lit(_RESULT[0]), F.col("st"), F.lit(_RESULT[1]), shown, F.lit(_RESULT[2]))
    return (
        F.when(thought, F.concat(F.lit(_THOUGHT[0]), content, F.lit(_THOUGHT[1])))
        .when(F.col("kind") == "tool_call", call).when(F.col("kind") == "tool_result", result).when(said, content)
    )


def piece_size(most: int) -> Column:
    """The length of `piece` in characters, without building it."""
    content, thought, said, tool, params, shown = _parts(most)
    fixed = lambda marks: F.lit(sum(map(len, marks)))
    return (
        F.when(thought, F.length(content) + fixed(_THOUGHT)).when(F.col("kind") == "tool_call", F.length(tool) + F.length(params) + fixed(_CALL))
        .when(F.col("kind") == "tool_result", F.length("st") + F.length(shown) + fixed(_RESULT)).when(said, F.length(content))
    )


def piece_mark(most: int) -> Column:
    """A hash that pieces of equal text share."""
    content, thought, said, tool, params, shown = _parts(most)
    return F.when(thought | said, F.xxhash64("kind", content)).when(F.col("kind") == "tool_call", F.xxhash64("kind", tool, params)).when(F.col("kind") == "tool_result", F.xxhash64("kind", "st", shown))


def within(parts: Column, budget: int) -> Column:
    """The `piece` texts of the ordered array `parts` as far as their lengths sum to at most `budget`, up to the first that does not fit, joined by line ends."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("go"), F.array().cast("array<string>").alias("kept"))

    def add(state: Column, x: Column) -> Column:
        n = state["n"] + F.length(x["piece"])
        fits = state["go"] & (n <= budget)
        return F.struct(F.when(fits, n).otherwise(state["n"]).alias("n"), fits.alias("go"), F.when(fits, F.array_append(state["kept"], x["piece"])).otherwise(state["kept"]).alias("kept"))

    return F.array_join(F.aggregate(parts, start, add)["kept"], "\n")
