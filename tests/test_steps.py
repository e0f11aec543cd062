import pytest
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.errors import PIPELINE_ERRORS, announces_retry, error_class
from tracewright.functions.text import fingerprint, is_blank, strip, truthy_coalesce


def values(spark, rows, expr, names):
    return [r[0] for r in spark.createDataFrame(rows, names).select(expr).collect()]


def test_status_spellings(spark):
    words = [None, "", "  ", "unknown", "pending", "running", "maybe", "???", "none", "OK ", "200", "True", "FAILED", "timed_out"]
    got = values(spark, [(w,) for w in words], S.status(F.col("s")), "s string")
    assert got == ["pending"] * 9 + ["success"] * 3 + ["error", "timeout"]


def test_step_types(spark):
    got = values(spark, [(w,) for w in (" Thought", "FINAL\n", "function_result", "memo", None)], S.step_type(F.col("s")), "s string")
    assert got == ["reasoning", "output", "tool_result", "unknown", "unknown"]


@pytest.mark.parametrize("text", ["HTTP 429", "连接超时", "权限不足", "Traceback (most recent call last)", "No such file"])
def test_error_texts_turn_success_into_error(spark, text):
    got = values(spark, [("success", text, None), ("success", "fine", None), (None, "fine", "boom"), ("timeout", text, None)], S.resolved_status(F.col("a"), F.col("b"), F.col("c")), "a string, b string, c string")
    assert got == ["error", "success", "error", "timeout"]


def test_skill_ownership(spark):
    bad = [("feishu_doc", "DataSkill"), ("db_write", "FileSkill"), ("fs_list", "FileSkill")]
    good = [("data_query", "DataSkill"), ("report_generate", "ReportSkill"), ("email_send", "EmailSkill"), ("file_read", "FileSkill"), ("exec", "DataSkill"), ("x", "Skill")]
    got = values(spark, bad + good, S.owned_by_skill(F.col("t"), F.col("s")), "t string, s string")
    assert got == [False] * len(bad) + [True] * len(good)


def test_error_classes_first_match_wins(spark):
    got = values(spark, [("HTTP 429 not found",), ("tool not found",), ("odd",), (None,)], error_class(F.col("t"), PIPELINE_ERRORS, "other_error"), "t string")
    assert got == ["rate_limit", "not_found", "other_error", "other_error"]


def test_announcements(spark):
    got = values(spark, [("I will now RETRY it",), ("需要马上重试",), ("cannot continue",), ("all is well",), (None,)], announces_retry(F.col("t")), "t string")
    assert got == [True, True, True, False, False]


def test_text_helpers(spark):
    rows = [("\n a \t",), ("　",), ("",), (None,)]
    assert values(spark, rows, strip(F.col("t")), "t string") == ["a", "", "", None]
    assert values(spark, rows, is_blank(F.col("t")), "t string") == [False, True, True, True]
    assert values(spark, [("", " ")], truthy_coalesce(F.col("a"), F.col("b")), "a string, b string") == [" "]
    marks = values(spark, [("a", None), (None, "a"), ("", None), (None, None)], fingerprint(F.col("a"), F.col("b")), "a string, b string")
    assert len(set(marks)) == 4
