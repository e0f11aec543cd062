"""Normal forms of step types, statuses and outcomes, and the predicates on single steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.text import contains_any, is_blank, strip

# Written step types and the type each stands for.
STEP_TYPES = {
    "reasoning": ["reasoning", "think", "thinking", "thought"],
    "skill_route": ["skill_route", "route", "routing"],
    "tool_call": ["tool_call", "tool", "function_call"],
    "tool_result": ["tool_result", "tool_response", "function_result"],
    "output": ["output", "response", "final"],
}
# Written statuses and the status each stands for; all others are pending.
STATUSES = {
    "success": ["success", "ok", "200", "true"],
    "error": ["error", "failed", "fail", "false"],
    "timeout": ["timeout", "timed_out"],
}
# Written outcomes and the outcome each stands for; all others are unknown.
OUTCOMES = {
    "success": ["success", "ok", "completed", "done", "成功"],
    "failure": ["failure", "failed", "error", "失败"],
    "partial": ["partial"],
    "abandoned": ["abandoned", "cancelled", "放弃"],
}
# Texts that mark an output as an error.
ERROR_TEXTS = [
    "429", "rate limit", "rate_limit", "too many requests",
    "timeout", "timed out", "connection timeout", "read timeout",
    "unauthorized", "forbidden", "permission denied",
    "internal server error", "bad gateway",
    "exception", "traceback",
    "cannot read properties", "err_aborted",
    "not found", "does not exist", "no such file",
    "连接超时", "连接被拒绝", "连接失败",
    "请求超时", "请求被拒绝", "请求失败",
    "权限不足", "权限被拒绝", "未授权",
    "找不到", "不存在", "无此文件",
    "服务器错误", "服务不可用", "内部错误",
    "限流", "频率限制", "访问过快",
    "异常", "错误", "失败", "出错",
]
# Fixed value: the error text of results whose output alone shows an error.
INFERRED = "inferred_error_from_text"
# Texts that mark a thought or result as a recovery.
RECOVERY_TEXTS = [
    "重试", "错误", "失败", "回退", "纠正", "换一种", "重新",
    "尝试另", "改用", "换个", "出错了", "不对", "问题",
    "retry", "error", "failed", "fallback", "alternative",
    "try again", "try another", "instead", "wrong", "mistake",
    "unexpected", "exception", "traceback", "let me try",
    "doesn't work", "not working", "issue", "problem",
    "correct approach", "different approach", "switch to",
]
# Tools that belong to every skill.
UNIVERSAL_TOOLS = ["read", "write", "exec", "browser", "process", "shell"]


def _lookup(c: Column, table: dict[str, list[str]], default: str) -> Column:
    word = F.lower(strip(c))
    out = F.when(F.lit(False), F.lit(""))
    for name, spellings in table.items():
        out = out.when(word.isin(spellings), name)
    return out.otherwise(default)


def step_type(c: Column) -> Column:
    """reasoning, skill_route, tool_call, tool_result, output or unknown (also for null)."""
    return _lookup(c, STEP_TYPES, "unknown")


def status(c: Column) -> Column:
    """success, error, timeout or pending (also for null and unknown spellings)."""
    return _lookup(c, STATUSES, "pending")


def outcome(c: Column) -> Column:
    """success, failure, partial, abandoned or unknown (also for null)."""
    return _lookup(c, OUTCOMES, "unknown")


def resolved_status(raw: Column, output: Column, error: Column, shows_error: Column | None = None) -> Column:
    """The status of a result: a written error stays; a missing, unknown or clean one is checked against the texts.

    `shows_error` may say whether the output holds one of ERROR_TEXTS, where the caller knows it already.
    """
    written = status(raw)
    unsure = raw.isNull() | (written == "pending") | ((written == "success") & (F.coalesce(error, F.lit("")) == ""))
    bad = ~is_blank(error) | (contains_any(output, ERROR_TEXTS) if shows_error is None else shows_error)
    return F.when(unsure & bad, "error").otherwise(written)


def resolved_error(raw: Column, output: Column, error: Column, shows_error: Column | None = None) -> Column:
    """The error text of a result: what is written, or the mark of an error that only the wording of its output shows."""
    written = status(raw)
    unsure = raw.isNull() | written.isin("pending", "success")
    shows = contains_any(output, ERROR_TEXTS) if shows_error is None else shows_error
    return F.when((F.coalesce(error, F.lit("")) == "") & unsure & shows, F.lit(INFERRED)).otherwise(error)


def owned_by_skill(tool: Column, skill: Column) -> Column:
    """True where `tool` may be called under `skill`: universal, sharing the name's core, or spelt nearly like it."""
    base = F.split_part(F.lower(tool), F.lit("_"), F.lit(1))
    core = F.trim(F.replace(F.replace(F.lower(skill), F.lit("skill"), F.lit("")), F.lit("_"), F.lit("")))
    name = F.replace(F.lower(tool), F.lit("_"), F.lit(""))
    width = F.greatest(F.lit(3), F.least(F.length(name), F.length(core)))
    near = (F.abs(F.length(name) - F.length(core)) <= 3) & (F.levenshtein(name, core) <= 2)
    shares = name.contains(core) | ((F.length(name) >= 3) & core.contains(F.left(name, width)))
    return base.isin(UNIVERSAL_TOOLS) | (core == "") | shares | near
