"""Timestamps of mixed formats, precisions and zones as one UTC instant each.

Every value is turned into the array of its valid readings (Unix seconds to nanoseconds, ISO forms with or
without zone, compact, dotted, slashed in either order, CJK, RFC 2822). A Viterbi pass over the record order
of each source then takes one reading per value: it pays for a reading against the usual order of the
source's locale, for a change of form from one record to the next and for a large jump back in time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Offsets in minutes of zone abbreviations. An abbreviation that names several zones is read as
# the one of the source's own zone where that fits, see _abbreviation_minutes.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "AEST": 600, "AEDT": 660, "ACST": 570,
    "ACDT": 630, "AWST": 480, "JST": 540, "KST": 540, "HKT": 480, "SGT": 480, "NZST": 720, "NZDT": 780,
}
# Abbreviations with more than one meaning, by the zone prefix that decides, then the default.
SHARED_ABBREVIATIONS = {
    "CST": [("Asia/", 480), ("", -360)],
    "IST": [("Europe/", 60), ("Asia/Jerusalem", 120), ("", 330)],
    "BST": [("Asia/", 360), ("", 60)],
}
# Locales that write the month before the day in numeric dates, and those that begin with the year.
MONTH_FIRST = ["en_US", "en_PH", "es_US"]
# English month names by their first three letters.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_ZONE = r"\s*(Z|z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Z]{2,5})?"
_ISO = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})[T\s]\s*{_TIME}{_ZONE}$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(?:[.,](\d+))?\s*(Z|z|[+-]\d{2}:?\d{2})?$"
_CJK = rf"^(\d{{4}})年(\d{{1,2}})月(\d{{1,2}})日\s*{_TIME}{_ZONE}$"
_NUMERIC = rf"^(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}})[,\s]\s*{_TIME}\s*([AaPp]\.?[Mm]\.?)?{_ZONE}$"
_MAIL = rf"^(?:[A-Za-z]{{3}},\s*)?(\d{{1,2}})\s+([A-Za-z]{{3}})[a-z]*\s+(\d{{4}})\s+{_TIME}{_ZONE}$"


@dataclass(frozen=True)
class Costs:
    """Weights of the Viterbi pass. `locale` outweighs any run of switches, so that a known locale decides."""

    locale: float = 1e6
    switch: float = 1.0
    backward: float = 2.0
    slack_us: int = 2 * 86_400_000_000
    block: int = 1024
    context: int = 16


# Each form's pattern and the groups of year, month, day, hour, minute, second, fraction, half of day and zone (0: none).
_FORMS = {
    20: (_ISO, (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    30: (_NUMERIC, (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    40: (_CJK, (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    50: (_MAIL, (3, 2, 1, 4, 5, 6, 7, 0, 8)),
    60: (_COMPACT, (1, 2, 3, 4, 5, 6, 7, 0, 8)),
}
_UNIX = r"^\d{9,20}([.,]\d+)?$"
_PARTS = ("y", "mo", "d", "h", "mi", "s", "frac", "half", "zone")


def _offset_minutes(zone: Column, host: Column) -> Column:
    """Minutes east of UTC of a written zone, null where none is written or it is unknown."""
    digits = F.regexp_replace(zone, ":", "")
    hours = F.substring(digits, 2, 2).try_cast("int")
    rest = F.coalesce(F.substring(digits, 4, 2).try_cast("int"), F.lit(0))
    signed = (hours * 60 + rest) * F.when(digits.startswith("-"), -1).otherwise(1)
    by_minutes: dict[int, list[str]] = {}
    for name, minutes in ZONE_MINUTES.items():
        by_minutes.setdefault(minutes, []).append(name)
    named = F.when(F.lit(False), F.lit(0))
    for minutes, names in by_minutes.items():
        named = named.when(F.upper(zone).isin(names), minutes)
    for name, readings in SHARED_ABBREVIATIONS.items():
        by_host = F.coalesce(*[F.when(F.coalesce(host, F.lit("")).startswith(p), m) for p, m in readings])
        named = named.when(F.upper(zone) == name, by_host)
    return F.when(zone.rlike(r"^[+-]"), signed).when(zone != "", named)


def _wall(y: str, mo: str, d: str) -> Column:
    """Microseconds of the wall time of a row's parts read as if in UTC; null where there is no such date or time."""
    date = F.try_make_timestamp(F.col(y), F.col(mo), F.col(d), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    ok = F.col("h").between(0, 23) & F.col("mi").between(0, 59) & F.col("s").between(0, 60)
    return F.when(ok, F.unix_micros(date) + ((F.col("h") * 60 + F.col("mi")) * 60 + F.col("s")).cast("bigint") * 1_000_000 + F.col("us"))


def _instant(wall: str) -> Column:
    """UTC microseconds of a wall time with its written zone, else in the host's zone, the earlier of two."""
    in_host = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), F.coalesce("tz", F.lit("UTC"))))
    return F.when(F.col("zone") == "", in_host).otherwise(F.col(wall) - F.col("offset").cast("bigint") * 60_000_000)


def with_readings(rows: DataFrame, first_us: int, end_us: int) -> DataFrame:
    """`rows` (`row`, `src`, `v`, `tz`, `loc`) as `row`, `src` and `options`, the array of valid readings (`cost`, `us`, `form`) of `v`.

    It is empty where `v` names no instant in range: stand-in texts, impossible dates, unknown zones. Each step is a
    projection of its own, so that every part is taken from the text once.
    """
    v = F.col("v")
    known = rows.select("row", "src", F.regexp_replace(v, r"(?U)^\s+|\s+$", "").alias("v"), "tz", "loc")
    form = F.when(v.rlike(_UNIX) & ~v.rlike(r"^20\d{12}$"), 10)
    for code, (pattern, _) in _FORMS.items():
        form = form.when(v.rlike(pattern), code)
    known = known.withColumn("form", form)

    def part(k: int) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for code, (pattern, groups) in _FORMS.items():
            if groups[k]:
                out = out.when(F.col("form") == code, F.regexp_extract(v, pattern, groups[k]))
        return F.coalesce(out, F.lit(""))

    cut = known.select("row", "src", "v", "tz", "loc", "form", *[part(k).alias(p) for k, p in enumerate(_PARTS)])
    month = F.when(F.col("form") == 50, ((F.instr(F.lit(MONTHS.lower()), F.lower("mo")) + 2) / 3).cast("int")).otherwise(F.col("mo").try_cast("int"))
    hour, half = F.col("h").try_cast("int"), F.lower(F.left("half", F.lit(1)))
    hour = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), 0).otherwise(hour)
    micros = F.coalesce(F.rpad(F.left("frac", F.lit(6)), 6, "0").try_cast("bigint"), F.lit(0))
    number = F.when(F.col("form") == 10, F.regexp_replace("v", ",", ".").try_cast("decimal(38,9)"))
    parts = cut.select(
        "row", "src", "tz", "loc", "form", "zone", F.col("y").try_cast("int").alias("y"), month.alias("mo"), F.col("d").try_cast("int").alias("d"), hour.alias("h"),
        F.col("mi").try_cast("int").alias("mi"), F.coalesce(F.col("s").try_cast("int"), F.lit(0)).alias("s"), micros.alias("us"), number.alias("number"),
        _offset_minutes(F.col("zone"), F.col("tz")).alias("offset"),
    )
    swapped = F.when(F.col("form") == 30, _wall("y", "d", "mo"))
    walls = parts.select("row", "src", "tz", "loc", "form", "zone", "offset", "number", _wall("y", "mo", "d").alias("wall"), swapped.alias("swapped"))
    instants = walls.select("row", "src", "loc", "form", "number", _instant("wall").alias("a"), _instant("swapped").alias("b"))

    def reading(code: Column, us: Column, cost: Column | float) -> Column:
        cost = cost if isinstance(cost, Column) else F.lit(cost)
        return F.struct(cost.cast("double").alias("cost"), us.try_cast("bigint").alias("us"), code.cast("int").alias("form"))

    # Of the units of a Unix time at most one falls into the range; the range is far from its own thousandfold.
    unix = [reading(F.lit(10 + k), F.floor(F.col("number") * F.lit(10 ** (6 - k))) if k <= 6 else F.floor(F.col("number") / 1000), 0.0) for k in (0, 3, 6, 9)]
    month_first, against = F.col("loc").isin(MONTH_FIRST), Costs().locale
    both = [
        reading(F.lit(30), F.col("a"), F.when(month_first, against).otherwise(0.0)),
        reading(F.lit(31), F.col("b"), F.when(month_first | F.col("loc").isNull(), 0.0).otherwise(against)),
    ]
    found = F.when(F.col("form") == 10, F.array(*unix)).when(F.col("form") == 30, F.array(*both)).otherwise(F.array(reading(F.col("form"), F.col("a"), 0.0)))
    kept = instants.select("row", "src", F.filter(found, lambda r: (r["us"] >= first_us) & (r["us"] < end_us)).alias("k"))
    # Two orders of one date that name the same instant (05/05) are one reading.
    same = (F.size("k") == 2) & (F.get("k", F.lit(0))["us"] == F.get("k", F.lit(1))["us"])
    return kept.select("row", "src", F.when(same, F.slice(F.array_sort("k"), 1, 1)).otherwise(F.col("k")).alias("options"))


def _viterbi(records: Column, costs: Costs) -> Column:
    """The chosen `us` of every record of the ordered array `records` (`row`, `own`, `options`)."""

    def step(alive: Column, rec: Column) -> Column:
        def extend(option: Column) -> Column:
            def arrive(state: Column) -> Column:
                cost = (
                    state["cost"]
                    + option["cost"]
                    + F.when(state["form"] != option["form"], costs.switch).otherwise(0.0)
                    + F.when(option["us"] < state["us"] - costs.slack_us, costs.backward).otherwise(0.0)
                )
                return F.struct(
                    cost.alias("cost"), option["us"].alias("us"), option["form"].alias("form"), F.array_append(state["path"], option["us"]).alias("path")
                )

            return F.array_min(F.transform(alive, arrive))

        def skip(state: Column) -> Column:
            none = F.lit(None).cast("bigint")
            return F.struct(state["cost"].alias("cost"), state["us"].alias("us"), state["form"].alias("form"), F.array_append(state["path"], none).alias("path"))

        return F.when(F.size(rec["options"]) == 0, F.transform(alive, skip)).otherwise(F.transform(rec["options"], extend))

    start = F.array(
        F.struct(
            F.lit(0.0).alias("cost"), F.lit(0).cast("bigint").alias("us"), F.lit(0).alias("form"), F.array().cast("array<bigint>").alias("path")
        )
    )
    return F.array_min(F.aggregate(records, start, step))["path"]


def normalise_timestamps(
    df: DataFrame,
    value: str,
    row_id: str,
    source: str,
    sources: DataFrame,
    first: str = "2025-01-01",
    end: str = "2027-01-01",
    costs: Costs | None = None,
) -> DataFrame:
    """One row (`row_id`, `epoch_us`) for every row of `df` whose `value` names an instant in [`first`, `end`).

    `sources` gives `source`, `host_tz` and `locale`, one row each (a small fixed dimension of exporters).
    `row_id` is a number that follows the order of arrival. Null, empty and stand-in values give no row; a row
    without a known source is read in UTC; repeated values give one row per row number, and a repeated row number
    one row per row; an empty table gives an empty result; other columns of `df` play no part, whatever their names.
    Records are ordered per source in blocks of at most `costs.block` row numbers, each with `costs.context` row numbers of the blocks on either side, so that a source
    that holds any share of the rows is spread over many tasks.
    """
    costs = costs or Costs()
    lo_us, hi_us = (int(datetime.fromisoformat(f"{t}T00:00:00+00:00").timestamp()) * 1_000_000 for t in (first, end))
    dim = sources.groupBy(F.col("source").alias("_src")).agg(F.min("host_tz").alias("tz"), F.min("locale").alias("loc"))
    rows = df.select(F.col(row_id).cast("bigint").alias("row"), F.col(source).alias("src"), F.col(value).cast("string").alias("v"))
    rows = rows.filter(F.col("v").rlike(r"\d{4}")).join(dim, F.col("src") == F.col("_src"), "left").drop("_src")
    parsed = with_readings(rows, lo_us, hi_us)
    block = F.expr(f"row div {costs.block}")
    place = F.pmod("row", F.lit(costs.block))
    into = F.array_compact(F.array(block, F.when(place >= costs.block - costs.context, block + 1), F.when(place < costs.context, block - 1)))
    spread = parsed.withColumn("_at", F.explode(into))
    own = (F.expr(f"row div {costs.block}") == F.col("_at")).alias("own")
    ordered = spread.groupBy("src", "_at").agg(F.array_sort(F.collect_list(F.struct("row", own, "options"))).alias("recs"))
    chosen = ordered.select(F.explode(F.arrays_zip(F.col("recs"), _viterbi(F.col("recs"), costs).alias("us"))).alias("z"))
    return chosen.filter("z.recs.own and z.us is not null").select(F.col("z.recs.row").alias("row_id"), F.col("z.us").alias("epoch_us"))
