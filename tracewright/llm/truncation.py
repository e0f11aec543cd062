"""Texts cut by a field limit or on their way: which values, and how often each source cuts.

Per field and source the lengths, in characters and in bytes, are fitted by a log-normal law that is right-censored at
each candidate limit, by maximum likelihood; what a limit holds beyond the fitted density is its share of censored values. How a
value ends is the other evidence: endings are counted among values at a limit and among all others, so that the ends of
whole texts (a full stop, a closed block, a log's last line, a signature) are learned from the corpus. Both are combined to a
posterior per value; values away from any limit have the source's own rate of cuts in transfer as their prior.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.pairs import EXTENSIONS, Stack
from tracewright.sources import cut_lineage, lookup, lookup_join

# Marks that programs leave where they cut.
_MARK = regex.compile(
    r"(?:\s*(?:…|\.\.\.)?\s*[\[(<{](?:\.\.\.|…|cut|truncated|snip(?:ped)?|clipped|abridged|shortened|continued|more|gekürzt|recortado|truncado|截断|已截断|省略)[^\[\](){}<>\n]{0,24}[\])>}]"
    r"|\s*(?:…|\.\.\.)?\s*[\[(]\+?\s*\d+\s*(?:more\s+)?(?:chars?|characters?|bytes?|lines?|words?|tokens?|字符?|Zeichen|caracteres)[^\[\]()\n]{0,12}[\])]|…|\.\.\.)\s*$",
    regex.IGNORECASE,
)
_STOP = regex.compile(r"(?:[.!?。！？]|[.!?。！？][\"'”’»)\]）」』]+)$")
_SEGMENT = regex.compile(r"[\n。！？]|[.!?](?=\s)")
_PATH = regex.compile(r"[\w-]+(?:/[\w.-]*)+", regex.ASCII)
# Closings of letters, after which a name ends a text without a full stop.
_SIGNED = regex.compile(
    r"(?:\b(?:[Rr]egards|[Bb]est(?: wishes)?|[Cc]heers|[Tt]hanks|[Tt]hank you|[Ss]incerely|[Yy]ours(?: truly)?|Grüßen|Grüße|Gruß|[Ss]aludos|[Aa]tentamente|[Cc]ordialmente)|此致|敬礼|祝好|谢谢)[,，]?\s*"
    r"(?:\p{Lu}[\p{L}.'’-]*[,\s]+)+\p{Lu}[\p{L}.'’-]+$|(?:此致|敬礼|祝好|谢谢)[,，]?\s*[\p{Han}·]{2,12}$"
)
_LOG = regex.compile(r"(?m)^\[?\d{1,2}:\d{2}(?::\d{2})?|^(?:DEBUG|INFO|WARN|ERROR)\b|^\[?\d{4}-\d\d-\d\d")


def unmarked(text: str) -> tuple[str, bool]:
    """`text` without a closing mark of a cut and without broken last characters, and whether it had one."""
    bare = _MARK.sub("", text)
    whole = bare.rstrip("�")
    return whole, len(whole) < len(text.rstrip())


def _shape(segment: str) -> str:
    def path(m) -> str:
        name = m.group().rstrip(".").rsplit("/", 1)[-1]
        return "P" if name.rpartition(".")[2] in EXTENSIONS and "." in name else "p"

    s = _PATH.sub(path, segment.strip())
    s = regex.sub(r"\d+", "9", s)
    s = regex.sub(r"\p{Lu}[\p{Ll}'’]+", "A", s) if len(s) < 60 else s
    return s[:80]


def ending(text: str) -> str:
    """How `text` ends, as a key: the name of a closed form, or the shape of its open last piece."""
    bare, marked = unmarked(text)
    if marked:
        return "mark"
    t = bare.rstrip()
    head = t[:1]
    if head == "{" or (head == "[" and not _LOG.match(t)):
        try:
            json.loads(t)
            return "json"
        except ValueError:
            if t[-1:] not in "}]" or len(Stack("```" + t).open) < 1:
                return "json open"
            return "json odd"
    if head == "<" and t.endswith(">"):
        return "markup"
    if _LOG.match(t):
        line = t.rsplit("\n", 1)[-1]
        return "log line" if _LOG.match(line) or line.startswith("[") else "log " + _shape(line)[:24]
    if t.count("```") % 2:
        return "fence open"
    if t.endswith("```"):
        return "fence"
    last = t.rsplit(None, 1)[-1] if t else ""
    at = _PATH.search(last)
    if at and _shape(last.rstrip(".")) == "p" and at.end() >= len(last) - 1:
        return "path open"
    if _STOP.search(t):
        return "stop" if len(t) == len(bare) else "stop space"
    if _SIGNED.search(t[-80:]):
        return "signed"
    pieces = _SEGMENT.split(t)
    return f"{'whole' if len(pieces) == 1 else 'last'} {_shape(pieces[-1] if pieces[-1].strip() else t[-30:])}"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, chars, size, marks, ends, digests = [], [], [], [], [], []
        for i, t in enumerate(batch.column(3).to_pylist()):
            if not t or t.isspace():
                continue
            bare, marked = unmarked(t)
            keep.append(i)
            chars.append(len(bare))
            size.append(len(bare.encode("utf-8", "surrogatepass")))
            marks.append(marked)
            ends.append(ending(t))
            digests.append(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63))
        part = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), part.column(2), pa.array(chars, pa.int64()), pa.array(size, pa.int64()), pa.array(marks, pa.bool_()), pa.array(ends, pa.string()), pa.array(digests, pa.int64())],
            ["field_name", "row_id", "source", "chars", "bytes", "marked", "ending", "digest"],
        )


def describe(values: DataFrame) -> DataFrame:
    """Length, mark and ending of every value of (`field_name`, `row_id`, `source`, `text`) that is not blank."""
    schema = "field_name string, row_id bigint, source string, chars bigint, bytes bigint, marked boolean, ending string, digest bigint"
    return values.select("field_name", "row_id", "source", "text").mapInArrow(_describe, schema)


def fit_censored(lengths: np.ndarray, counts: np.ndarray, limit: float, rounds: int = 200) -> tuple[float, float]:
    """Mean and deviation of the log-normal law of `lengths` of which those at `limit` and beyond are censored, by EM."""
    x, n = np.log(np.maximum(lengths, 1)), counts.astype(float)
    cut, lim = lengths >= limit, math.log(limit)
    free_n, cut_n = n[~cut].sum(), n[cut].sum()
    if free_n < 2:
        return lim, 1.0
    mu = float((x * n).sum() / n.sum())
    sd = max(0.05, math.sqrt(float((n * (x - mu) ** 2).sum() / n.sum())))
    s1, s2 = float((x[~cut] * n[~cut]).sum()), float((x[~cut] ** 2 * n[~cut]).sum())
    for _ in range(rounds):
        a = (lim - mu) / sd
        tail = max(0.5 * math.erfc(a / math.sqrt(2)), 1e-12)
        ratio = math.exp(-0.5 * a * a) / math.sqrt(2 * math.pi) / tail
        e1 = mu + sd * ratio
        e2 = sd * sd * (1 + a * ratio) + 2 * mu * e1 - mu * mu
        new = (s1 + cut_n * e1) / (free_n + cut_n)
        var = (s2 + cut_n * e2) / (free_n + cut_n) - new * new
        moved, mu, sd = abs(new - mu), new, math.sqrt(max(var, 1e-4))
        if moved < 1e-6:
            break
    return mu, sd


#: Counts that an unseen ending is thought to have, among whole and among cut values; sources and other texts that an open
#: ending must recur in to be a whole one, else its count weighs little.
_WHOLE, _CUT, _SOURCES, _TEXTS, _RARE = 0.001, 0.9, 3, 3, 0.002
_RATE = 0.002
# Endings that no whole text has, and endings whose form is closed.
_OPEN = ("json open", "fence open", "path open")
_CLOSED = ("stop", "stop space", "json", "fence", "markup", "signed")


def find_limits(lengths: np.ndarray, counts: np.ndarray, opened: np.ndarray) -> list[tuple[int, float, int]]:
    """(limit, share of values there that are censored, values there) of every limit that the lengths of one source run against.

    `counts` are different texts per length, `opened` those of them that end in no closed form. A candidate stands out from the lengths just below
    it: four texts and eight times their mean where nearly all lengths from there on are that one; eight texts, twelve times the mean on either side
    and mostly open endings where longer values exist, as after a limit was raised.
    """
    order = np.argsort(lengths)
    lengths, counts, opened = lengths[order], counts[order], opened[order]
    above = counts[::-1].cumsum()[::-1]
    before = np.concatenate([[0], counts.cumsum()])
    found = []
    for k in range(len(lengths)):
        n, at = int(counts[k]), int(lengths[k])
        last = n >= 4 and n >= 0.98 * above[k]
        if not (last or (n >= 8 and opened[k] >= 0.6 * n)):
            continue
        near = (before[k] - before[np.searchsorted(lengths, at * 0.93 - 2)]) / max(1.0, at * 0.07 + 2)
        beyond = (before[np.searchsorted(lengths, at * 1.07 + 2, side="right")] - before[k + 1]) / max(1.0, at * 0.07 + 2)
        if n < (8 * near if last else 12 * max(near, beyond)):
            continue
        mu, sd = fit_censored(lengths.astype(float), counts, at)
        cdf = lambda v: 0.5 * math.erfc(-(math.log(max(v, 0.5)) - mu) / sd / math.sqrt(2))  # noqa: B023,E731
        natural = counts.sum() * max(0.0, cdf(at + 0.5) - cdf(at - 0.5))
        posterior = 1 - min(1.0, max(natural, near, 0.02) / n)
        if posterior > 0.5:
            found.append((at, posterior, n))
    return found


def limits(described: DataFrame) -> DataFrame:
    """`field_name`, `source`, `limits`: all limits of a field and source, each with `unit` (chars, bytes), `at` and `censored`.

    Works on counts of different texts per length, so that a source with any share of the values is one small table. A limit that shows in
    both units is in the one that more texts keep to.
    """
    texts = described.groupBy("field_name", "source", "digest").agg(F.first("chars").alias("chars"), F.first("bytes").alias("bytes"), F.max(~F.col("ending").isin(*_CLOSED)).alias("open"))
    both = texts.select("field_name", "source", "open", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("n")))).alias("x"))
    hist = both.groupBy("field_name", "source", F.col("x.unit").alias("unit"), F.col("x.n").alias("length")).agg(F.count("*").alias("count"), F.count_if("open").alias("opened"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, tuple] = {}
        for unit in ("chars", "bytes"):
            own = frame[frame["unit"] == unit]
            for at, censored, held in find_limits(own["length"].to_numpy(), own["count"].to_numpy(), own["opened"].to_numpy()):
                if at not in best or held > best[at][2]:
                    best[at] = (unit, float(censored), held)
        rows = [(frame["field_name"].iloc[0], frame["source"].iloc[0], unit, at, censored) for at, (unit, censored, _) in sorted(best.items())]
        return pd.DataFrame(rows, columns=["field_name", "source", "unit", "at", "censored"])

    found = hist.groupBy("field_name", "source").applyInPandas(fit, "field_name string, source string, unit string, at bigint, censored double")
    return found.groupBy("field_name", "source").agg(F.collect_list(F.struct("unit", "at", "censored")).alias("limits"))


def judged(values: DataFrame) -> DataFrame:
    """Every value that is not blank with `posterior`, the probability that it was cut, `at_limit` and `ending`.

    `values` has `field_name`, `row_id`, `source`, `text`. Null and blank values have no row; a null source is a source of its own; repeated
    rows are judged alike, and a text that a source repeats counts once; an empty table gives an empty result. What is learned
    (limits, counts of endings, rates of cuts in transfer) covers all values.
    """
    seen = cut_lineage(describe(values.withColumn("source", F.coalesce("source", F.lit("")))))
    found = lookup(limits(seen))
    length = lambda x: F.when(x["unit"] == "chars", F.col("chars")).otherwise(F.col("bytes"))
    met = F.filter("limits", lambda x: (length(x) == x["at"]) | (F.col("marked") & (length(x) <= x["at"]) & (length(x) > x["at"] - 4)))
    censored = F.array_max(F.transform(met, lambda x: x["censored"]))
    placed = seen.join(found, ["field_name", "source"], "left").select(
        "field_name", "row_id", "source", "marked", "ending", "digest", censored.isNotNull().alias("at_limit"), F.coalesce(censored, F.lit(0.0)).alias("censored")
    )
    once = cut_lineage(placed.groupBy("field_name", "source", "ending", "digest").agg(F.max("at_limit").alias("at_limit"), F.count("*").alias("rows")))
    at, open_end = F.col("at_limit"), F.col("ending").isin(*_OPEN)
    ends = once.groupBy("field_name", "ending").agg(
        F.count_if(at).alias("cut_n"), F.count_if(~at).alias("whole_n"), F.count_distinct(F.when(~at, F.col("source"))).alias("sources"),
        F.sum("rows").alias("rows"),
    )
    fields = once.groupBy("field_name").agg(
        (F.count_if(at) + 1).alias("cut_all"), (F.count_if(~at) + 1).alias("whole_all"), F.count_if(at & open_end).alias("cut_open"), F.count_if(~at & open_end).alias("whole_open")
    )
    rates = once.groupBy("field_name", "source").agg(F.count_if(~at).alias("own_all"), F.count_if(~at & open_end).alias("own_open"))
    # Forms that cannot be whole measure the rate of cuts in transfer, by their share among values cut at a limit.
    share = F.when(F.col("cut_all") > 20, F.greatest(F.col("cut_open") / F.col("cut_all"), F.lit(0.05))).otherwise(0.25)
    # The fewer of the cuts show such a form, the less its absence says: gamma priors of the field's and the source's rate.
    field_rate = (F.col("whole_open") + 0.5) / (share * F.col("whole_all") + 0.5 / _RATE)
    rate = F.least(F.lit(0.2), (F.col("own_open") + 1) / (share * F.col("own_all") + 1 / field_rate))
    rates = rates.join(fields, "field_name").select("field_name", "source", "cut_all", "whole_all", rate.alias("rate"), field_rate.alias("field_rate"))
    scored = lookup_join(placed.join(lookup(rates), ["field_name", "source"]), ends.filter("rows > 1"), ["field_name", "ending"], "rows")
    closed = F.col("ending").isin(*_CLOSED)
    cut_n = F.greatest(F.coalesce("cut_n", F.lit(0)) - F.when(at & ~closed, 1).otherwise(0), F.lit(0))
    others = F.greatest(F.coalesce("whole_n", F.lit(0)) - F.when(~at & ~closed, 1).otherwise(0), F.lit(0))
    recurs = (F.coalesce("sources", F.lit(0)) >= _SOURCES) & (others >= _TEXTS)
    # Of an ending's values away from the limit, those that cuts in transfer account for are not whole.
    stray = 3 * F.col("field_rate") * F.col("whole_all") * cut_n / F.col("cut_all")
    whole_n = F.when(recurs, F.greatest(others - stray, F.lit(0))).otherwise(others * _RARE)
    p_cut = F.when(closed, (cut_n + 0.5) / (F.col("cut_all") + 50)).otherwise((cut_n + _CUT) / F.col("cut_all"))
    p_whole = F.when(closed, (others + 5) / (F.col("whole_all") + 5)).otherwise((whole_n + _WHOLE) / F.col("whole_all"))
    ratio = F.when(F.col("marked") | open_end, 1e6).otherwise(F.least(F.lit(1e6), p_cut / p_whole))
    prior = F.when(at, F.least(F.col("censored"), F.lit(0.999))).otherwise(F.col("rate"))
    odds = prior / (1 - prior) * ratio
    return scored.select("field_name", "row_id", "source", "at_limit", "ending", (odds / (1 + odds)).alias("posterior"))


def cut_values(judgements: DataFrame, least: float = 0.5) -> DataFrame:
    """`field_name`, `row_id` of the values more likely cut than not."""
    return judgements.filter(F.col("posterior") > least).select("field_name", "row_id")


def cut_report(judgements: DataFrame) -> DataFrame:
    """Per field and source: values, those cut, of these at the limit, and the share cut."""
    cut = F.col("posterior") > 0.5
    return judgements.groupBy("field_name", "source").agg(
        F.count("*").alias("values"), F.count_if(cut).alias("cut"), F.count_if(cut & F.col("at_limit")).alias("cut_at_limit"), (F.count_if(cut) / F.count("*")).alias("share")
    )
