"""Classes of errors by the text they show, and what is said about each class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.text import contains_any, holds_any

# The classes of the pipeline and of pairing, first match wins.
PIPELINE_ERRORS = {
    "rate_limit": ["429", "rate limit", "rate_limit", "too many requests", "quota"],
    "timeout": ["timeout", "timed out", "connection timeout", "read timeout"],
    "auth_error": ["401", "403", "unauthorized", "forbidden", "permission denied"],
    "not_found": ["404", "not found", "does not exist", "no such file"],
    "server_error": ["500", "502", "503", "internal server error", "bad gateway"],
    "parse_error": ["json decode", "parse error", "invalid format", "syntax error"],
    "tool_missing": ["tool not found", "unknown tool", "no tool"],
}
# The finer classes of the taxonomy, first match wins.
TAXONOMY_ERRORS = {
    "rate_limit": ["429", "rate limit", "rate_limit", "too many requests", "quota exceeded"],
    "timeout": ["timeout", "timed out", "connection timeout", "deadline exceeded"],
    "auth_error": ["401", "403", "unauthorized", "forbidden", "permission denied", "access denied"],
    "not_found": ["404", "not found", "does not exist", "no such file", "missing"],
    "server_error": ["500", "502", "503", "504", "internal server error", "bad gateway"],
    "parse_error": ["json decode", "parse error", "invalid format", "syntax error", "malformed"],
    "network_error": ["connection refused", "network error", "dns", "unreachable", "eof"],
    "tool_missing": ["tool not found", "unknown tool", "no such tool"],
    "data_error": ["type error", "key error", "index error", "attribute error", "valueerror"],
}
# Wordings that announce another attempt or give up.
INTENT_PATTERNS = [
    r"(应该|需要|要).{0,20}(重试|retry|再试|try again)",
    r"(let me|let's|i will|i should|i would|i'm going to|i plan to|will|should|would|going to|plan to).{0,20}(retry|try again)",
    r"(等待|wait).{0,15}(重试|retry)",
    r"(标记为|mark(ed)? as).{0,10}(失败|failed|error)",
    r"(无法|can'?t|cannot|unable to).{0,15}(继续|proceed|continue)",
    r"任务.{0,20}(失败|终止|中止|结束)",
    r"(task|operation).{0,20}(failed|aborted|terminated)",
]


# One of these is in every text that INTENT_PATTERNS match.
INTENT_MARKS = ["重试", "再试", "retry", "try again", "失败", "failed", "error", "继续", "proceed", "continue", "终止", "中止", "结束", "aborted", "terminated"]


def error_class(text: Column, table: dict[str, list[str]], default: str) -> Column:
    """The first class of `table` whose wording `text` contains, else `default`."""
    out = F.when(F.lit(False), F.lit(""))
    for name, needles in table.items():
        out = out.when(contains_any(text, needles), name)
    return out.otherwise(default)


def announces_retry(text: Column, lowered: Column | None = None) -> Column:
    """True where `text` announces another attempt or gives up; the patterns run only where one of their marks is present."""
    marked = holds_any(F.lower(text) if lowered is None else lowered, INTENT_MARKS)
    return F.coalesce(F.when(marked, text.rlike("(?i)" + "|".join(INTENT_PATTERNS))), F.lit(False))
