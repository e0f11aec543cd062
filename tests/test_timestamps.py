import datetime as dt

from tracewright.operators.timestamps import Costs, normalise_timestamps

SOURCES = [("us", "America/New_York", "en_US"), ("de", "Europe/Berlin", "de_DE"), ("in", "Asia/Kolkata", "en_IN"), ("cn", "Asia/Shanghai", "zh_CN"), ("free", "UTC", None)]


def run(spark, rows, **kw):
    src = spark.createDataFrame(SOURCES, "source string, host_tz string, locale string")
    df = spark.createDataFrame([(i, s, v, "x", "y") for i, (s, v) in enumerate(rows)], "id bigint, source string, v string, row string, us string")
    got = normalise_timestamps(df, "v", "id", "source", src, **kw)
    return {r["row_id"]: r["epoch_us"] for r in got.collect()}


def us(y, mo, d, h=0, mi=0, s=0, micro=0):
    return int(dt.datetime(y, mo, d, h, mi, s, micro, dt.timezone.utc).timestamp() * 1_000_000 + 0.5) // 1000 * 1000 + micro % 1000


def test_forms(spark):
    rows = [
        ("de", "2025-09-01T15:49:23Z"), ("de", "2025-09-02 04:49:09-07:00"), ("us", "Thu, 04 Sep 2025 02:47:34 +1000"), ("us", "1757781887642"), ("us", "1758994691"),
        ("us", "1761842723.752"), ("us", "1756963272236253"), ("de", "08.09.2025 11:38:10"), ("de", "6/9/2025 12:11"), ("us", "9/6/2025 12:11"), ("us", "09/06/2025 12:11:05 AM"),
        ("cn", "2025年09月11日 05:49:32"), ("us", "20251102T065710Z"), ("us", "2025-09-05T04:11:42.4375978-04:00"), ("in", "2025-10-01 10:00:00 IST"), ("cn", "2025-10-01 10:00:00 CST"), ("us", "2025-12-01 10:00:00 CST"),
        ("de", "2025-10-26 02:35:53"), ("de", "2025-10-26 02:35:53 CET"), (None, "2025-10-26 02:35:53"),
    ]
    got = run(spark, rows)
    want = [
        us(2025, 9, 1, 15, 49, 23), us(2025, 9, 2, 11, 49, 9), us(2025, 9, 3, 16, 47, 34), 1757781887642000, 1758994691000000, 1761842723752000, 1756963272236253,
        us(2025, 9, 8, 9, 38, 10), us(2025, 9, 6, 10, 11), us(2025, 9, 6, 16, 11), us(2025, 9, 6, 4, 11, 5), us(2025, 9, 10, 21, 49, 32), us(2025, 11, 2, 6, 57, 10),
        us(2025, 9, 5, 8, 11, 42) + 437597, us(2025, 10, 1, 4, 30), us(2025, 10, 1, 2), us(2025, 12, 1, 16), us(2025, 10, 26, 0, 35, 53), us(2025, 10, 26, 1, 35, 53), us(2025, 10, 26, 2, 35, 53),
    ]
    assert [got[i] for i in range(len(rows))] == want


def test_stand_ins_and_nonsense_give_no_row(spark):
    assert run(spark, [("us", v) for v in (None, "", "  ", "pending", "0", "n/a", "0001-01-01T00:00:00", "2025-13-40 10:00:00", "1970-01-01T00:00:00Z", "x" * 50_000, "99999999999999999999")]) == {}
    assert run(spark, []) == {}


def test_repeated_rows_and_ties(spark):
    assert run(spark, [("us", "1758994691")] * 3) == {0: 1758994691000000, 1: 1758994691000000, 2: 1758994691000000}


def test_order_of_a_source_without_locale_follows_its_neighbours(spark):
    rows = [("free", f"{d}/09/2025 10:00") for d in (20, 21, 22)] + [("free", "05/10/2025 10:00")]
    assert run(spark, rows)[3] == us(2025, 10, 5, 10)
    rows = [("free", f"09/{d}/2025 10:00") for d in (20, 21, 22)] + [("free", "10/05/2025 10:00")]
    assert run(spark, rows)[3] == us(2025, 10, 5, 10)


def test_blocks_do_not_change_the_choice(spark):
    rows = [("free", f"{d:02d}/{m:02d}/2025 10:00") for m in (9, 10, 11) for d in range(1, 29)]
    assert run(spark, rows, costs=Costs(block=16, context=12)) == run(spark, rows)
