"""Defects of prompt and response pairs: empty, copied, refused, cut off, or in another language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.languages import asked_language, language
from tracewright.llm.overlap import words

_TAG = regex.compile(r"</?[A-Za-z][\w-]*(?:\s[^<>]*)?/?>")
_ALNUM = regex.compile(r"[\p{L}\p{N}]")
# Extensions of file names that may end an answer's list.
EXTENSIONS = frozenset(
    "py txt log yaml yml json jsonl ndjson parquet md toml sql csv tsv xml html htm ini cfg conf sh pdf png jpg svg zip gz js ts java go rs c h cpp ipynb xlsx docx".split()
)


class Stack:
    """A pushdown reader of fences, tags, and the brackets and strings of code; `open` names what the text leaves open."""

    _TOKEN = regex.compile(r"```|`|<(/?)([A-Za-z][\w-]*)(?:\s[^<>]*)?(/?)>|<[/A-Za-z][^<>]*$|[{}\[\]()“”「」《》（）【】]|\"|\\.", regex.DOTALL)
    _PAIRS = {"}": "{", "]": "[", ")": "(", "”": "“", "」": "「", "》": "《", "）": "（", "】": "【"}

    def __init__(self, text: str):
        self.open: list[str] = []
        for m in self._TOKEN.finditer(text):
            self._read(m)

    def _in_code(self) -> bool:
        return "```" in self.open or any(x in ("<tool_call>", "<tool_result>") for x in self.open)

    def _read(self, m) -> None:
        t, top = m.group(), self.open[-1] if self.open else ""
        if top == '"' and t != '"':
            if t == "```" or t.startswith("</"):
                self.open.pop()
                self._read(m)
            return
        if t == "```":
            if t in self.open:
                del self.open[self.open.index(t) :]
            else:
                self.open.append(t)
        elif "```" in self.open and not t.startswith("<"):
            return
        elif t == "`":
            self.open.pop() if top == t else self.open.append(t)
        elif m.group(2):
            name = f"<{m.group(2).lower()}>"
            if m.group(1):
                if name in self.open:
                    del self.open[len(self.open) - 1 - self.open[::-1].index(name) :]
            elif not m.group(3):
                self.open.append(name)
        elif t.startswith("<"):
            self.open.append("<")
        elif t == '"':
            if top == t:
                self.open.pop()
            elif self._in_code() or top in ("{", "["):
                self.open.append(t)
        elif t in self._PAIRS:
            if top == self._PAIRS[t]:
                self.open.pop()
        elif not t.startswith("\\"):
            self.open.append(t)


_STOP = regex.compile(r"(?:[.!?。！？;；…]|[.!?。！？][\"'”’»)\]）」』*_]+|[:：]-?[)\]])\s*$")
_LIST = regex.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+(.*)$")
_PATH = regex.compile(r"(?:[\w.-]+/)+[\w.-]*$", regex.ASCII)


def truncated(text: str) -> bool:
    """True where `text` stops inside a word, sentence, path, code block or markup block."""
    t = text.rstrip()
    left = Stack(t).open
    if any(x != '"' and x != "`" for x in left) or '"' in left:
        return True
    if t.endswith(("```", ">")) and _TAG.search(t[-40:]) or t.endswith("```"):
        return False
    line = t.rsplit("\n", 1)[-1]
    bare = line.rstrip(".。!?\"'”)")
    path = _PATH.search(bare)
    if path and bare.endswith(path.group()):
        ext = path.group().rsplit("/", 1)[-1].rpartition(".")
        if not ext[1] or ext[2].lower() not in EXTENSIONS:
            return True
    if (item := _LIST.match(line)) is not None:
        return not _ALNUM.search(item.group(1)) or item.group(1).rstrip()[-1:] in ",-/(" or (path is None and "/" in item.group(1) and not _STOP.search(t))
    if t.endswith(("...", "…")) and _ALNUM.search(t[-5:-1].rstrip(".…")[-1:] or " "):
        return True
    return not _STOP.search(t)


# What a refusal says, per language; and what shows that the work was done all the same.
REFUSALS = regex.compile(
    r"""(?xi)
    \b(?:i|we)(?:'m|’m|\ am|'re|\ are)?\s+(?:so\ |very\ |really\ |truly\ |terribly\ )?(?:sorry|afraid)\b.{0,40}\b(?:can(?:'t|’t|not|\ not)|won(?:'t|’t)|will\ not|unable|not\ able|not\ allowed|may\ not)
    | \b(?:i|we)\s+(?:really\ |simply\ |just\ )?(?:can(?:'t|’t|not|\ not)|won(?:'t|’t)|will\ not|may\ not|must\ not|could\ not|couldn(?:'t|’t)|shall\ not|shan(?:'t|’t))\b
    | \b(?:i|we)(?:'m|’m|\ am|\ are|'re)\s+(?:not\ (?:able|allowed|permitted|authori[sz]ed|comfortable|in\ a\ position|willing|going)|unable|unwilling)\b
    | \b(?:i|we)\s+(?:must|have\ to|need\ to|will|would|'d|am\ going\ to|am\ obliged\ to|am\ forced\ to)?\s*(?:respectfully\ |politely\ )?(?:decline|refuse|refrain)\b
    | \b(?:i|we)(?:\ would|'d|’d)\s+(?:rather|prefer)\s+(?:not|to\ stay\ out)
    | \b(?:my|our|the)\s+(?:guidelines?|polic(?:y|ies)|rules?|instructions?)\s+(?:do(?:es)?\ not|don(?:'t|’t)|doesn(?:'t|’t)|forbids?|prohibits?|prevents?|keeps?)\b
    | (?:isn(?:'t|’t)|is\ not)\s+(?:possible|something)\s+(?:for\ me|i\ (?:can|may|will|am))
    | \b(?:outside|beyond)\s+(?:of\ )?what\s+i\s+(?:may|can|am)
    | \bnot\s+something\s+i\s+(?:can|may|will|do)
    | \btut\ mir\ (?:sehr\ )?leid\b.*\bnicht\b | \bich\s+(?:kann|darf|werde|möchte|will)\b.{0,80}\bnicht\b | \bkann\ ich\ (?:leider\ )?nicht\b | \bdarf\ ich\ (?:leider\ )?nicht\b
    | \bmuss\ ich\ (?:leider\ )?(?:ablehnen|verweigern)\b | \bich\s+(?:muss|lehne)\b.{0,80}\bab(?:lehnen)?\b | \bist\ mir\ (?:leider\ )?nicht\ (?:möglich|erlaubt|gestattet)\b | \bbin\ ich\ nicht\ befugt\b | \bich\ bin\ nicht\ befugt\b
    | \bno\ (?:me\ es\ posible|puedo|podemos|voy\ a|debo|estoy\ autorizad[oa]|me\ est[áa]\ permitido|me\ corresponde|tengo\ permi(?:so|tido))\b | \bdebo\ (?:rechazar|negarme|declinar|abstenerme)\b | \bme\ niego\b | \btengo\ que\ (?:rechazar|declinar)\b | \b(?:rechazo|declino)\b | \bprefiero\ no\b | \bno\ est[áa]\ (?:dentro\ de|entre)\ (?:mis|lo\ que)\b
    | 恕(?:不|难|我) | 抱歉.{0,6}(?:无法|不能|不便|不会) | 对不起.{0,6}(?:无法|不能|不便|不会) | 我(?:无法|不能|不便|不会|拒绝|只能拒绝|不得不拒绝|没有权限|无权) | 超出(?:了)?我的(?:权限|能力|范围) | 不能协助 | 无法(?:协助|提供帮助|帮助) | 不允许我 | 只能谢绝 | 婉拒
    """
)
DONE_ANYWAY = regex.compile(
    r"(?i)\bso\s+i\s+\w+|\b(?:but|then|instead)\s+(?:\w+\s+)?i\s+\w+ed\b|\bat first\b|\b(?:yet|until|before|without)\b.*\bso\b|;\s*the\b.*\b(?:is|are)\s+(?:now\s+)?\w+(?:ed|t)\b"
    r"|\bdeshalb habe ich|\bdaher habe ich|\bpor eso|\basí que he|所以我|因此我|已(?:经)?(?:完成|处理|改|存|用)"
)
_SENTENCE = regex.compile(r"[^.!?。！？\n]+(?:\.(?=\S)[^.!?。！？\n]+)*[.!?。！？]*")


def refusal(text: str) -> bool:
    """True where a sentence declines the task and no work follows: no tool call, code block or list."""
    body = _TAG.sub(" ", text)
    if "<tool_call>" in text or "```" in text:
        return False
    return any(REFUSALS.search(s) and not DONE_ANYWAY.search(s) for s in _SENTENCE.findall(body))


_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def tiles(a: list[str], b: list[str], least: int = 3) -> int:
    """Words of `a` covered by greedy string tiling with `b`: the longest free common run again and again, at least `least` long.

    Runs are found by extending equal openings of `least` words, longest first; each word belongs to one tile at most. Openings are kept by the
    word before them, so a repetitive text is not met at every place that only continues a run; long runs are measured by hashes of what
    stands before each word, not word by word.
    """
    sums: list[list[int]] = []
    powers: list[int] = []

    def alike(i: int, j: int, k: int) -> bool:
        if not sums:
            ids = {w: n for n, w in enumerate(dict.fromkeys(a + b), 1)}
            sums.extend(list(accumulate((ids[w] for w in x), lambda h, v: (h * _BASE + v) % _PRIME, initial=0)) for x in (a, b))
            powers.extend(accumulate(range(min(len(a), len(b))), lambda h, _: h * _BASE % _PRIME, initial=1))
        return (sums[0][i + k] - sums[1][j + k] - (sums[0][i] - sums[1][j]) * powers[k]) % _PRIME == 0

    at: dict[tuple, dict[str | None, list[int]]] = {}
    for j in range(len(b) - least + 1):
        at.setdefault(tuple(b[j : j + least]), {}).setdefault(b[j - 1] if j else None, []).append(j)
    runs = []
    for i in range(len(a) - least + 1):
        for before, places in at.get(tuple(a[i : i + least]), {}).items():
            if i and before is not None and before == a[i - 1]:
                continue
            for j in places:
                k, most = least, min(len(a) - i, len(b) - j)
                while k < most and k < 16 and a[i + k] == b[j + k]:
                    k += 1
                if k == 16:
                    while k < most:
                        half = (k + most + 1) // 2
                        k, most = (half, most) if alike(i, j, half) else (k, half - 1)
                runs.append((k, i, j))
    used_a, used_b, covered = bytearray(len(a)), bytearray(len(b)), 0
    for k, i, j in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
        if covered > min(len(a), len(b)) - least:
            break
        start = 0
        while start < k:
            if used_a[i + start] or used_b[j + start]:
                start += 1
                continue
            stop = start
            while stop < k and not used_a[i + stop] and not used_b[j + stop]:
                stop += 1
            if stop - start >= least:
                used_a[i + start : i + stop] = used_b[j + start : j + stop] = b"\1" * (stop - start)
                covered += stop - start
            start = stop
    return covered


#: Shares of the answer's and of the request's words in common tiles from which an answer is a copy.
COPY_OF_ANSWER, COPY_OF_REQUEST = 0.7, 0.6


def copied(request: list[str], text: str) -> bool:
    """True where the answer is the request again, bar slight alterations and a short opening."""
    own = words(_TAG.sub(" ", text))
    if not request or not own or len(own) > 2 * len(request) + 20:
        return False
    enough = max(COPY_OF_ANSWER * len(own), COPY_OF_REQUEST * len(request))
    # Tiles cover no more words than both have in common, whatever their order.
    return (Counter(own) & Counter(request)).total() >= enough and tiles(own, request, 2 if len(request) < 8 else 3) >= enough


@lru_cache(maxsize=4)
def _request_words(request: str) -> list[str]:
    return words(request)


@lru_cache(maxsize=4)
def _wanted_language(request: str) -> str | None:
    return asked_language(request) or language(request)


def defect(request: str | None, text: str | None) -> str | None:
    """The first defect that holds of empty, copy_of_prompt, refusal, truncated, other_language; None for a sound answer."""
    if text is None or not _ALNUM.search(_TAG.sub(" ", text)):
        return "empty"
    request = request or ""
    if copied(_request_words(request), text):
        return "copy_of_prompt"
    if refusal(text):
        return "refusal"
    if truncated(text):
        return "truncated"
    wanted, own = _wanted_language(request), language(text)
    return "other_language" if wanted and own and wanted != own else None


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for no, request, chosen, rejected in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            rows += [(no, side, d) for side, text in (("chosen", chosen), ("rejected", rejected)) if (d := defect(request, text))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
            ["pair_no", "side", "defect"],
        )


def defective_sides(pairs: DataFrame) -> DataFrame:
    """`pair_no`, `side` (chosen, rejected) and `defect` of each unusable answer, at most one row per side.

    The request is the last user message of `prompt`; without one, only rules that need no request hold. Null and blank
    answers are empty; a row repeated under another number is judged again; an empty table gives an empty result. Each row
    stands alone, so nothing is shuffled.
    """
    users = F.filter("prompt", lambda m: m["role"] == "user")
    request = F.try_element_at(users, F.lit(-1))["content"]
    rows = pairs.select(F.col("pair_no").cast("bigint").alias("pair_no"), request.alias("request"), "chosen", "rejected")
    return rows.mapInArrow(_judge, "pair_no bigint, side string, defect string")
