"""Personal data in free text: found by weakly supervised labelers and replaced by typed placeholders.

Patterns propose spans (email, phone, id_number, street_address, person_name), widely and with overlaps: nothing is left out before
the vote. Labelers vote on each span or abstain: its form, gazetteers, the words around it, the key of a JSON field it fills, and
signs against it. Spans of all values are counted per pattern of votes; expectation-maximisation estimates from the shares of these
counts how reliable each labeler is. The final span classifier is trained on the resulting probabilities and also sees the form of the
span and the words next to it. Of overlapping spans the most probable one stays.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tracewright.sources import cut_lineage

KINDS = ("email", "phone", "id_number", "street_address", "person_name")

# Given names of many languages, a gazetteer for person names.
GIVEN_NAMES = frozenset(
    "Aisha Ali Alice Amir Ana Anders Andrea Andrei Anna Antonio Astrid Bjorn Boris Bruno Carla Carlos Carmen Chen Clara Claire Dalia Dana Daniel David "
    "Diego Dmitri Elena Elias Elif Elisa Elsa Emil Emma Erik Eva Fatima Felix Fernando Finn Francesca Freya Gabriel Giulia Greta Hana Hannah Hans Hassan "
    "Helena Henrik Hugo Ines Ingrid Irina Isabel Ivan Jakob James Jan Javier Jens Johan Johanna John Jonas Jorge Jose Juan Julia Julian Karim Karin Katja Kofi "
    "Kwame Lars Laura Layla Lea Leila Lena Leo Liam Lina Lotte Louis Lucas Lucia Luis Luka Maja Malik Marco Maria Marie Mariam Marta Martin Mateo Matteo Maya "
    "Mehmet Mia Michael Miguel Mikhail Mila Milan Mira Mohammed Nadia Natalia Nikolai Nils Nina Noah Noor Nora Olga Oliver Olivia Omar Oscar Oskar Pablo Paul "
    "Paula Pavel Pedro Peter Petra Pierre Priya Rafael Rahul Raj Ravi Rosa Samir Samuel Sara Sarah Sofia Sophie Stefan Sven Tariq Thomas Tomas Vera Viktor "
    "Yara Yuki Yusuf Zara Zoe".split()
)
# Capitalised words that open sentences or name days, months and places in time, not persons.
_COMMON = frozenset(
    "The A An In On At Last Next Some We My You It If When While There Both Two One Three No Not Nothing Since Before After Keep Leave Limit Mark Report Send Use "
    "Finish Take Find Please Can Could Would Will Look Draft Write Set Help Go Call Reach Pick Ship Ask Build See Job Row Range Ticket Note First Right Hi Hello Dear "
    "Dr Mr Mrs Ms Prof Frau Herr Der Die Das Den Dem Ein Eine Am Im Bitte Danach Wenn Wir Ich Um Zum Mit El La Los Las Un Una Monday Tuesday Wednesday Thursday "
    "Friday Saturday Sunday January February March April May June July August September October November December Montag Dienstag Mittwoch Donnerstag Freitag "
    "Samstag Sonntag Januar Februar März Mai Juni Juli Oktober Dezember Street Avenue Road Regards Grüßen Grüße Gruß Saludos Thanks Cheers Release Grant Harbor".split()
)
_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’]+"
_NAME = rf"{_CAP}(?:-{_CAP})?"

_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*(?:\s?(?:@|＠)\s?|\s?[\[({<]\s?(?:at|AT|At|@|ät|arroba)\s?[\])}>]\s?| (?:at|AT) (?=[A-Za-z0-9-]+ (?:dot|DOT) ))"
    r"[A-Za-z0-9][A-Za-z0-9-]*(?:(?:\.|\s?[\[({]\s?(?:dot|DOT|punkt)\s?[\])}]\s?| (?:dot|DOT) )[A-Za-z0-9][A-Za-z0-9-]*)+"
)
_PHONE = re.compile(r"(?<![\w./:+-])(?:\+\s?|00\s?)?(?:\(\+?\d{1,4}\)|\d)(?:[ ./-]?\(?\d+\)?){2,7}(?![\w/:-]|\.\d)|(?<![\w./:+-])\(\d{2,5}\)\s?\d[\d -]{4,12}\d(?![\w/:-])", re.ASCII)
_ID = re.compile(r"(?<![A-Za-z0-9_./-])(?:\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]|[A-Z]{1,2}\d{6,8}|[XYZ]?\d{7,8}-?[A-Z]|\d{17}[\dXx]|\d{15}|\d{9,11})(?![A-Za-z0-9_/-])")
_KINDS_OF_STREET = r"(?:Street|Avenue|Road|Lane|Drive|Boulevard|Court|Place|Square|Way|Terrace|Crescent|(?:St|Ave|Rd|Ln|Dr|Blvd|Ct|Pl|Sq)\b\.?)"
_STREET = re.compile(
    rf"(?<![A-Za-z0-9_/-])\d{{1,5}}(?:\s?(?:bis|ter)|-?[A-Za-z])?,? (?:rue|avenue|boulevard|place|chemin|impasse|quai|via|viale|calle|rua) (?:de la |de l'|de |des |du |d'|del |della )?{_NAME}"
    rf"|(?<![A-Za-z0-9_/-])\d{{1,5}}(?:-?[A-Za-z])?,? {_NAME}(?: {_NAME}){{0,2}} {_KINDS_OF_STREET}"
    rf"|(?:{_CAP}[- ])?[A-ZÄÖÜ][a-zäöüß]+(?:straße|strasse|str\.|weg|platz|gasse|allee|damm|ufer|ring)\s\d{{1,4}}\s?[a-z]?(?![A-Za-z0-9])|{_CAP}[- ](?:Straße|Str\.|Weg|Platz|Allee|Gasse) \d{{1,4}}\s?[a-z]?(?![A-Za-z0-9])"
    rf"|(?:Calle|Avenida|Paseo|Plaza|Carrera|Via|Viale|Rua) (?:de la |del |de )?{_NAME},? (?:n[.º°]+ ?)?\d{{1,5}}"
    r"|[一-鿿]{2,8}(?:路|街|大道|巷|胡同)\d{1,5}(?:弄\d{1,4})?号"
)
_HAN_LEAD = re.compile(r".*[是为由给向找问请叫与和:：]")

# Words before or after a span that speak for its kind, and names of fields that hold it.
_BEFORE = {
    "email": r"(?:mail|address|cc|to|an|发到|邮箱|contact|write|correo)\W*$",
    "phone": r"(?:\b(?:tel|phone|call|line|under|mobile|cell|fax|whatsapp|number|dial|callback|telefon\w*|rückruf|unter|rufnummer|durchwahl|tel[eé]fono)(?: is|:|\.)?|电话|手机|致电)\W*$",
    "id_number": r"(?:\b(?:id|id no|identity number|passport|national id|holder|ssn|tax id|social security|kennnummer|ausweis\w*|pass\w*|identifica\w*|dni|nif)\b(?: is| no|:|\.|,)*|证件号|身份证号?|护照号?|证号)\W*$",
    "street_address": r"(?:\b(?:to|at|in|address|an|ist|lives|office|nach|en)|地点是|地址是?|位于|寄到)\W*$",
    "person_name": r"(?:\b(?:regards|belongs to|name is|ask|contact|by|from|with|dear|hi|hello|thanks|owner|grüßen|gruß|grüße|an|von|bei|saludos|signed|sincerely|cheers|best)|负责人是|联系人是?|姓名是?|致)\W*$",
}
_AFTER = {
    "email": r"^\W*(?:asked|wrote|said|replied|senden|schicken|。|$)",
    "phone": r"^\W*(?:ext|x\d|if|after|before|zu erreichen|erreichbar|午后|可打)",
    "id_number": r"^\W*(?:belongs|expires?|issued|was|steht|fehlt|需要)",
    "street_address": r"^\W*(?:on \w+day|last|second|first|third|ground|floor|Hinterhaus|Vorderhaus|请|,? \d{5})",
    "person_name": r"^\W*(?:about|and I|and me|\w+ed the|kennt|hat|ist|asked|said|wrote|called|请先)",
}
_FIELDS = {
    "email": r"(?:to|cc|bcc|from|mail|email|e_mail|reply_to|contact|sender|recipient)",
    "phone": r"(?:callback|phone|tel|telephone|mobile|fax|contact_number|cell)",
    "id_number": r"(?:holder_id|id_number|passport|national_id|ssn|identity|document_no|person_id)",
    "street_address": r"(?:ship_to|address|street|location|addr|deliver_to|billing)",
    "person_name": r"(?:assignee|name|owner|author|contact|full_name|signed_by|requester|reviewer)",
}
_BEFORE_RX = {k: re.compile(v, re.IGNORECASE) for k, v in _BEFORE.items()}
_AFTER_RX = {k: re.compile(v, re.IGNORECASE) for k, v in _AFTER.items()}
_FIELD_RX = {k: re.compile(rf'"{v}"\s*:\s*"$', re.IGNORECASE) for k, v in _FIELDS.items()}
_KEY = re.compile(r'"([\w-]+)"\s*:\s*"$')
_TITLE = re.compile(r"(?:\b(?:Dr|Prof|Mr|Mrs|Ms|Mx)\.?|\b(?:Frau|Herr|Señora?|Sra?\.|Madame|Monsieur|Mme)) $")
# Words before a number that make it a technical one.
_TECHNICAL = re.compile(
    r"(?:\b(?:job|row|rows|ids?|row ids|build|batch|chunk|range|version|ticket|order|line|lines|port|offset|limit|size|bytes|count|total|no|page|step|code|issue|commit|release|as \w+|\d+ to|to)[ #:=]*|[=#x])$",
    re.IGNORECASE,
)
_DATE = re.compile(r"^(?:19|20)\d{2}[-./ ]\d{1,2}[-./ ]\d{1,2}\b|^\d{1,2}[-./]\d{1,2}[-./]\d{2,4}\b|^\d{1,3}(?:\.\d{1,3}){3}$")
_PHONE_FORMS = re.compile(
    r"^(?:(?:\+1|1)?[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}|\+\d{8,15}|(?:\+|00)\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6}|\(0?\d{2,5}\)[ -]?\d{3,4}[ -]?\d{3,5}|0\d{2,4}[ /-]\d{3,8}(?:[ -]\d{2,5})?|1[3-9]\d[ -]?\d{4}[ -]?\d{4})$"
)

#: What votes for and against, by bit; a labeler that has nothing to say abstains.
FOR, AGAINST = ("form", "gazetteer", "before", "after", "field", "title"), ("not_form", "technical", "common")
VOTES = (*FOR, *AGAINST)
#: Hash buckets of the words beside a span, and of its form, in the classifier.
WORDS, FORMS = 128, 64
#: Spans per kind and pattern of votes that the classifier is trained on at most, those with the smallest hashes of their context.
SAMPLED = 64


def _pattern(names: list[str]) -> int:
    return sum(1 << VOTES.index(n) for n in set(names))


def _bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


_LAST = re.compile(r"([^\W\d_]+|[一-鿿]|[^\w\s])\W*$")
_NEXT = re.compile(r"^\W*?([^\W\d_]+|[一-鿿]|[^\w\s])")


def _beside(left: str, right: str) -> tuple[int, int]:
    """Buckets of the last word before a span (or the key of the JSON field it fills) and of the first word after it."""
    key = _KEY.search(left)
    before = f"key {key.group(1)}" if key else (m.group(1) if (m := _LAST.search(left[-24:])) else "")
    after = m.group(1) if (m := _NEXT.search(right)) else ""
    return _bucket(before.lower(), WORDS), _bucket(after.lower(), WORDS)


def candidates(text: str) -> list[tuple[int, int, str, int, str, int, int]]:
    """(`start`, `end`, `kind`, votes, form, bucket of the word before, of the word after) of every proposed span; spans may overlap."""
    found: list[tuple[int, int, str, int, str, int, int]] = []

    def add(kind: str, start: int, end: int, votes: list[str], form: str) -> None:
        left, right = text[max(0, start - 48) : start], text[end : end + 24]
        if _BEFORE_RX[kind].search(left):
            votes.append("before")
        if _AFTER_RX[kind].search(right):
            votes.append("after")
        if left.endswith('"') and right.startswith('"') and _FIELD_RX[kind].search(left):
            votes.append("field")
        if kind in ("phone", "id_number") and "before" not in votes and "field" not in votes and _TECHNICAL.search(left):
            votes.append("technical")
        found.append((start, end, kind, _pattern(votes), form, *_beside(left, right)))

    if "@" in text or "at" in text or "＠" in text or "AT" in text:
        for m in _EMAIL.finditer(text):
            s = m.group()
            tld = re.split(r"[^A-Za-z0-9-]+|\bdot\b", s)[-1]
            add("email", m.start(), m.end(), ["form"] if tld.isalpha() and len(tld) >= 2 else ["not_form"], "plain" if "@" in s else "disguised")
    for m in _STREET.finditer(text):
        add("street_address", m.start(), m.end(), ["form"], "number first" if m.group()[0].isdigit() else "number last")
    for m in _ID.finditer(text):
        s = m.group()
        date = s[6:14] if s.isdigit() and len(s) == 18 else ""
        dated = date and "18" < date[:2] < "21" and "01" <= date[4:6] <= "12" and "01" <= date[6:] <= "31"
        add("id_number", m.start(), m.end(), ["form"] if dated or not s.isdigit() else ["not_form"], re.sub(r"[A-Za-z]", "A", re.sub(r"\d", "9", s)))
    for m in _PHONE.finditer(text):
        s = m.group()
        if not 7 <= sum(ch.isdigit() for ch in s) <= 15:
            continue
        votes = ["form"] if _PHONE_FORMS.match(s) else ["not_form"]
        if _DATE.match(s) or (s.isdigit() and not s.startswith("00") and len(s) != 11):
            votes = ["not_form", "common"]
        add("phone", m.start(), m.end(), votes, re.sub(r"\d+", "9", s)[:12])
    for m in _HAN_NAME.finditer(text):
        start, end, s = m.start(), m.end(), m.group()
        lead = _HAN_LEAD.match(s[: s.index("·")])
        if lead:
            start += lead.end()
        if text[start] != "·":
            add("person_name", start, end, ["form"], "transliterated")
    for m in _CAPITALS.finditer(text):
        for start, end, given, family, form in _names(m):
            votes = ["gazetteer"] if given in GIVEN_NAMES else []
            # A given name that no list has and whose form says nothing speaks against a name, if weakly.
            telling = form in ("initial", "middle") or (form == "family, given" and (votes or given.endswith(".")))
            votes += ["form"] if telling else [] if votes else ["not_form"]
            if {given, family} & _COMMON or (form == "family, given" and family in GIVEN_NAMES):
                votes.append("common")
            if _TITLE.search(text[max(0, start - 12) : start]):
                votes.append("title")
            add("person_name", start, end, votes, form)
    return found


_HAN_NAME = re.compile(r"[一-鿿]{1,9}·[一-鿿]{2,8}(?![一-鿿])|(?<=[是为:：])[一-鿿]{1,5}·[一-鿿]{2,8}")
_CAPITALS = re.compile(rf"(?<![A-Za-zÀ-ÿ0-9_/.'-])(?:{_NAME}|[A-Z]\.)(?:,? (?:{_NAME}|[A-Z]\.))+(?![A-Za-zÀ-ÿ0-9_/])")
_TOKEN = re.compile(rf"({_NAME}|[A-Z]\.)(,?)")


def _names(run: re.Match) -> list[tuple[int, int, str, str, str]]:
    """(`start`, `end`, given, family, form) of every name that a run of capitalised words could hold: two words, with an initial between, or turned."""
    parts = [(run.start() + t.start(), run.start() + t.end(1), t.group(1), bool(t.group(2))) for t in _TOKEN.finditer(run.group())]
    out = []
    for i, (start, _, word, comma) in enumerate(parts[:-1]):
        _, end, second, then = parts[i + 1]
        short, initial = word.endswith("."), second.endswith(".")
        third = parts[i + 2] if i + 2 < len(parts) and not then else None
        if comma:
            if not short:
                out.append((start, third[1] if third and third[2].endswith(".") and not initial else end, second, word, "family, given"))
        elif not initial:
            out.append((start, end, word, second, "initial" if short else "given family"))
        elif third and not third[2].endswith("."):
            out.append((start, third[1], word, third[2], "initial" if short else "middle"))
    return out


def fit_label_model(rows: list[tuple[str, int, int]], rounds: int = 200) -> dict[tuple[str, int], float]:
    """The probability of each (kind, votes) to be personal data, from (kind, votes, count).

    Per kind each labeler has a reliability, the share of its votes that are right, never below 0.55: a vote for personal data never
    lowers the probability, one against never raises it, and a labeler that abstains says nothing. Expectation-maximisation works on
    shares, and what is assumed beforehand weighs half as much as what is counted, so a corpus ten times as large is judged alike. Both
    classes count as equally likely before any vote: where nearly all spans of a kind are true, their share must not speak for the rest.
    """
    start = np.array([0.85 if v in FOR else 0.7 if v == "not_form" else 0.9 for v in VOTES])
    out: dict[tuple[str, int], float] = {}
    for kind in sorted({r[0] for r in rows}):
        own = sorted(r for r in rows if r[0] == kind)
        x = np.array([[(r[1] >> i) & 1 for i in range(len(VOTES))] for r in own], dtype=float)
        n = np.array([r[2] for r in own], dtype=float)
        n /= n.sum()
        sign = np.array([1.0 if v in FOR else -1.0 for v in VOTES])
        # Of emails, phones and numbers the form decides more than of names.
        right = np.where((np.array(VOTES) == "not_form") & (kind != "person_name"), 0.9, start)
        assumed, cast = right.copy(), n @ x
        q = np.full(len(own), 0.5)
        for _ in range(rounds):
            new = 1 / (1 + np.exp(-np.clip(x @ (sign * np.log(right / (1 - right))), -30, 30)))
            moved, q = np.abs(new - q).max(), new
            agree = np.where(sign > 0, (n * q) @ x, (n * (1 - q)) @ x) / np.maximum(cast, 1e-12)
            right = np.where(cast > 0, np.clip((agree + 0.5 * assumed) / 1.5, 0.55, 0.99), assumed)
            if moved < 1e-7:
                break
        out |= {(r[0], r[1]): float(v) for r, v in zip(own, q, strict=True)}
    return out


@dataclass(frozen=True)
class SpanClassifier:
    """Per kind the weights of votes, form and neighbouring words, and the bias."""

    weights: dict[str, np.ndarray]

    def probability(self, kind: str, votes: int, form: str, before: int, after: int) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        k = len(VOTES)
        z = w[0] + sum(w[1 + i] for i in range(k) if votes >> i & 1) + w[1 + k + _bucket(form, FORMS)] + w[1 + k + FORMS + before] + w[1 + k + FORMS + WORDS + after]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def chosen(self, spans: list[tuple], least: float) -> list[tuple]:
        """The spans of one text that are accepted, without overlaps: the most probable first, of equal ones the longer, then the earlier."""
        judged = sorted((-self.probability(*s[2:7]), s[0] - s[1], s) for s in spans)
        kept: list[tuple] = []
        for p, _, s in judged:
            if -p < least:
                break
            if all(s[1] <= o[0] or o[1] <= s[0] for o in kept):
                kept.append(s)
        return sorted(kept)


def fit_classifier(model: dict[tuple[str, int], float], counts: dict[tuple[str, int], int], sample: list[tuple[str, int, str, int, int]], rounds: int = 1500) -> SpanClassifier:
    """A logistic classifier per kind, trained on the label model's probabilities of sampled (kind, votes, form, word before, word after).

    A pattern of votes weighs by the square root of its share, however many of its spans are sampled. Weights of votes keep their sign,
    so one more vote for personal data never lowers a probability.
    """
    weights = {}
    k = len(VOTES)
    for kind in sorted({s[0] for s in sample}):
        own = sorted(s for s in sample if s[0] == kind)
        per, total = Counter(s[1] for s in own), sum(n for (x, _), n in counts.items() if x == kind)
        z = np.zeros((len(own), 1 + k + FORMS + 2 * WORDS))
        for row, (_, votes, form, before, after) in zip(z, own, strict=True):
            row[0] = 1
            row[1 : 1 + k] = [votes >> i & 1 for i in range(k)]
            row[[1 + k + _bucket(form, FORMS), 1 + k + FORMS + before, 1 + k + FORMS + WORDS + after]] = 1
        q = np.array([model[kind, s[1]] for s in own])
        share = np.array([math.sqrt(counts[kind, s[1]] / total) / per[s[1]] for s in own])
        share /= share.sum()
        decay = np.r_[0.0, np.full(k, 1e-4), np.full(FORMS, 1e-3), np.full(2 * WORDS, 2e-3)]
        low = np.r_[-np.inf, [0.0 if v in FOR else -np.inf for v in VOTES], np.full(FORMS + 2 * WORDS, -np.inf)]
        high = np.r_[np.inf, [np.inf if v in FOR else 0.0 for v in VOTES], np.full(FORMS + 2 * WORDS, np.inf)]
        w, ahead = np.zeros(z.shape[1]), np.zeros(z.shape[1])
        for t in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
            new = np.clip(ahead - 1.0 * (z.T @ (share * (p - q)) + decay * ahead), low, high)
            ahead, w = np.clip(new + t / (t + 3) * (new - w), low, high), new
        weights[kind] = w
    return SpanClassifier(weights)


_LIST = "array<struct<start:int,end:int,kind:string,votes:int,form:string,before:int,after:int>>"
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("votes", pa.int32()), ("form", pa.string()), ("before", pa.int32()), ("after", pa.int32())]))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _ARROW.value_type]
    for batch in batches:
        spans = [[dict(zip(names, c, strict=True)) for c in candidates(t)] for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _ARROW)], ["field_name", "row_id", "text", "spans"])


def proposed(values: DataFrame) -> DataFrame:
    """`field_name`, `row_id`, `text`, `spans` of every value that is not null, written once; every later step reads these spans."""
    own = values.filter("text is not null").select("field_name", "row_id", "text")
    return cut_lineage(own.mapInArrow(_spans, f"field_name string, row_id bigint, text string, spans {_LIST}"))


def learned(found: DataFrame) -> SpanClassifier:
    """The classifier of the spans of `found`. Counts per pattern of votes (at most 2^9 a kind) and SAMPLED spans of each come to the driver."""
    each = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.form", "s.before", "s.after")
    counts = {(r["kind"], r["votes"]): r["n"] for r in each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()}
    forms = each.distinct().withColumn("draw", F.xxhash64("kind", "votes", "form", "before", "after"))
    ranked = forms.withColumn("k", F.row_number().over(W.partitionBy("kind", "votes").orderBy("draw", "form", "before", "after")))
    sample = [tuple(r)[:5] for r in ranked.filter(F.col("k") <= SAMPLED).collect()]
    return fit_classifier(fit_label_model([(k, v, n) for (k, v), n in counts.items()]), counts, sample)


def _each_text(found: DataFrame, least: float, schema: str, rows_of) -> DataFrame:
    """`rows_of` each text and its accepted spans, in one pass over what is written already."""
    shared = found.sparkSession.sparkContext.broadcast(learned(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, row, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kept = shared.value.chosen([tuple(s.values()) for s in spans], least) if spans else []
                out += rows_of(name, row, text, kept)
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, r, strict=True)) for r in out], types)

    types = to_arrow_schema(StructType.fromDDL(schema))
    return found.mapInArrow(run, schema)


def find(values: DataFrame, least: float = 0.5) -> DataFrame:
    """`field_name`, `row_id`, `kind`, `span_text`, `start` (code points) of each piece of personal data in (`field_name`, `row_id`, `text`).

    Null and empty texts have none; a text that is repeated is searched again; an empty table gives an empty result; other columns
    play no part. The whole text is searched, whatever its length. Labelers are weighed on the spans of all values.
    """
    found = proposed(values).filter(F.size("spans") > 0)
    schema = "field_name string, row_id bigint, kind string, span_text string, start int"
    return _each_text(found, least, schema, lambda name, row, text, kept: [(name, row, s[2], text[s[0] : s[1]], s[0]) for s in kept])


def _redacted(name: str, row: int, text: str, kept: list[tuple]) -> list[tuple]:
    for start, end, kind, *_ in reversed(kept):
        text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
    return [(name, row, text)]


def redact(values: DataFrame, least: float = 0.5) -> DataFrame:
    """`field_name`, `row_id`, `text` with each piece of personal data replaced by its kind in brackets, as [EMAIL]; texts are searched once."""
    return _each_text(proposed(values), least, "field_name string, row_id bigint, text string", _redacted)
