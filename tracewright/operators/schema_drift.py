"""Records whose keys and value types drift from file to file: the changes, and one consistent table.

Every file of a feed is profiled per key (presence, types, a sketch of the values, nested keys), and each file is
matched with its predecessor by similarity flooding: a graph of key pairs is seeded with name and value similarity
and scores are propagated along levels, types and nested keys until they settle. Correspondences that are best for both
sides and carry enough evidence are renames; what is left is added or removed.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tracewright.sources.tables import cut_lineage

#: Width of the sketch of a key's values; beyond it stand the counts of its texts and of those that are prose.
WIDTH = 256
TEXTS, PROSE = WIDTH, WIDTH + 1
STEP = "step."
#: What the nested keys of a key that holds steps name besides.
HOLDS_STEPS = "\0steps"


@dataclass(frozen=True)
class Weights:
    """Seeds and thresholds of the matching."""

    name: float = 0.4
    value: float = 0.6
    prose: float = 0.9
    evidence: float = 0.4
    other_type: float = 0.8
    rounds: int = 60
    settled: float = 1e-3


def kind_of(v) -> str | None:
    """string, number, boolean, array or object; None for null."""
    if v is None:
        return None
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(v)]


def _unwrapped(v):
    """`v`, or what it holds where it is the text of a JSON array or object."""
    if isinstance(v, str) and v.lstrip()[:1] in ("[", "{"):
        try:
            return json.loads(v)
        except ValueError:
            return v
    return v


def _objects(v, depth: int = 3) -> list[dict] | None:
    """The objects of the first list of objects in `v`: the value itself, its JSON text, or within an object."""
    v = _unwrapped(v)
    if isinstance(v, list):
        inner = [x for x in map(_unwrapped, v) if isinstance(x, dict)]
        return inner if inner and len(inner) >= len([x for x in v if x is not None]) else None
    if isinstance(v, dict) and depth:
        for x in v.values():
            if (found := _objects(x, depth - 1)) is not None:
                return found
        values = [x for x in v.values() if x is not None]
        if len(values) > 1 and all(isinstance(x, dict) for x in values):
            return values
    return None


#: Keys of which a step object carries at least one.
_STEP_MARKS = re.compile(r"step_?id|step_?type|tool_?name|call_?id", re.IGNORECASE)


def steps_of(record: dict) -> tuple[str | None, list[dict]]:
    """The key that holds the steps of a session, however stored, and the step objects."""
    for key, v in record.items():
        found = _objects(v)
        if found and any(_STEP_MARKS.search(k) for k in found[0]):
            return key, found
    return None, []


_WORD = re.compile(r"[^\W\d_]+|\d+")
_NUMBER = re.compile(r"-?\d{1,18}(?:\.\d{1,18})?", re.ASCII)
_LONG = re.compile(r"(?:[\u3400-\u9fff].*){8}|(?:[^\W\d_]{2,}\W+(?=\w)){4}", re.DOTALL)


def _features(v, out: list[str], depth: int = 3) -> None:
    """Words of what `v` says, the same whether it is bare, in a list or in an object."""
    if isinstance(v, bool):
        out.append(f"b{v}")
    elif isinstance(v, (int, float)):
        out.append(f"n{int(math.log2(abs(v) + 1)) if math.isfinite(v) else 'x'}")
    elif isinstance(v, str):
        if _NUMBER.fullmatch(v):
            # A number says the same where it is written as text.
            out.append(f"n{int(math.log2(abs(float(v)) + 1))}")
        words = _WORD.findall(v.lower())
        out += [w if not w.isdigit() else f"d{len(w)}" for w in words]
        out.append(f"w{int(math.log2(len(words) + 1))}")
        if words and len(words) <= 8:
            out.append("s" + re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "9", v))[:40])
    elif isinstance(v, list) and depth:
        for x in v:
            _features(x, out, depth - 1)
    elif isinstance(v, dict) and depth:
        for k, x in v.items():
            out.append(f"k{k}")
            _features(x, out, depth - 1)


def parse_record(text: str | None) -> dict | None:
    """The session object of a line, None where the line is unreadable or something else."""
    try:
        v = json.loads(text)
    except (TypeError, ValueError):
        return None
    return v if isinstance(v, dict) else None


#: Keys whose partial profiles a task holds before it sends them on.
HELD = 20_000
_PARTIAL = "feed string, file_no bigint, field_path string, records bigint, kinds map<string,bigint>, sketch array<bigint>, nested array<string>"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial profiles: per feed, file and key one row with the readable records, the types, the sketch and the nested keys of a task's lines."""
    seen: dict[tuple, list] = {}

    def rows() -> pa.RecordBatch:
        cols = [[k[i] for k in seen] for i in range(3)] + [[own[0] for own in seen.values()], [list(own[1].items()) for own in seen.values()], [own[2].tolist() for own in seen.values()], [sorted(own[3]) for own in seen.values()]]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["feed", "file_no", "field_path", "records", "kinds", "sketch", "nested"])

    for batch in batches:
        feeds, files, texts = (batch.column(i).to_pylist() for i in range(3))
        for feed, file_no, text in zip(feeds, files, texts, strict=True):
            record = parse_record(text)
            if record is None:
                continue
            step_key, steps = steps_of(record)
            pairs = [(k, v) for k, v in record.items()] + [(STEP + k, v) for s in steps for k, v in s.items()]
            for path, v in pairs:
                own = seen.get((feed, file_no, path))
                if own is None:
                    own = seen[feed, file_no, path] = [0, Counter(), np.zeros(WIDTH + 2, np.int64), set()]
                own[0] += 1
                kind = kind_of(v)
                if kind is None:
                    continue
                own[1][kind] += 1
                words: list[str] = []
                v = _unwrapped(v)
                if path == step_key:
                    words = [f"k{k}" for s in steps for k in s]
                    own[3].add(HOLDS_STEPS)
                else:
                    _features(v, words)
                said = [x for x in (v if isinstance(v, list) else v.values() if isinstance(v, dict) else [v]) if isinstance(x, str)]
                sketch = own[2]
                sketch[TEXTS] += len(said)
                sketch[PROSE] += sum(1 for x in said if _LONG.search(x))
                for w in words:
                    sketch[zlib.crc32(w.encode("utf-8", "surrogatepass")) % WIDTH] += 1
                if isinstance(v, dict):
                    own[3].update(v.keys())
        if len(seen) >= HELD:
            yield rows()
            seen.clear()
    if seen:
        yield rows()


def profiles(lines: DataFrame) -> DataFrame:
    """One row per (feed, file, key): `records`, `kinds` (types and their counts), `sketch` (counts per bucket, then of texts and of prose) and `nested` keys.

    Each reader task sends one packed row per key, so a file or feed of any size is reduced before the shuffle, and a key's rows
    are as many as the tasks that met it.
    """
    rows = lines.filter("record is not null and feed is not null and file_no is not null").select(
        "feed", F.col("file_no").cast("bigint").alias("file_no"), "record"
    )
    partial = rows.mapInArrow(_profile, _PARTIAL)
    added = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), WIDTH + 2)
    kinds = F.flatten(F.collect_list(F.map_entries("kinds")))
    per = partial.groupBy("feed", "file_no", "field_path").agg(
        F.sum("records").alias("records"), kinds.alias("k"), F.aggregate(F.collect_list("sketch"), zeros, added).alias("sketch"), F.array_distinct(F.flatten(F.collect_list("nested"))).alias("nested")
    )
    count = lambda kind: F.aggregate(F.filter("k", lambda e: e["key"] == kind), F.lit(0).cast("bigint"), lambda s, e: s + e["value"])
    counts = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.transform("k", lambda e: e["key"]))), lambda k: F.struct(k.alias("key"), count(k).alias("value"))))
    return per.select("feed", "file_no", "field_path", "records", counts.alias("kinds"), "sketch", "nested")


def name_similarity(a: str, b: str) -> float:
    """Share of equal character trigrams of the names, without case and separators, and of equal words."""
    parts = [[w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", x)] for x in (a, b)]
    p, q = ("".join(x) for x in parts)
    if p == q:
        return 1.0
    grams = [Counter(f"##{x}#"[i : i + 3] for i in range(len(x) + 1)) for x in (p, q)]
    both = sum((grams[0] & grams[1]).values())
    words = len(set(parts[0]) & set(parts[1])) / max(1, min(len(set(parts[0])), len(set(parts[1]))))
    return max(2 * both / max(1, sum(grams[0].values()) + sum(grams[1].values())), 0.8 * words)


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two sketches, counts damped by their square root."""
    if not len(a) or not len(b):
        return 0.0
    a, b = a[:WIDTH], b[:WIDTH]
    return float(np.sqrt(a * b).sum() / math.sqrt(max(1, a.sum()) * max(1, b.sum())))


def value_similarity(a: np.ndarray, b: np.ndarray, w: Weights) -> float:
    """How alike the values of two keys are: shared words, or that both hold prose, whose words differ by nature."""
    share = [x[PROSE] / max(1, x[TEXTS]) if len(x) else 0.0 for x in (a, b)]
    return max(_cosine(a, b), w.prose * math.sqrt(share[0] * share[1]))


def flood(old: list[dict], new: list[dict], w: Weights = Weights()) -> tuple[np.ndarray, np.ndarray]:
    """Settled similarity of every old with every new key, and the seeds; keys of other levels stay at 0.

    The graph's nodes are pairs: of keys, of types, of nested keys and of the two levels. Keys that both files have are part of it: as pairs
    of a key with itself they start from the highest seed and hand score to the types and nested keys that others share. A pair hands its score to
    its neighbours in equal parts, in both directions; scores are scaled by the largest after each round. Unequal types lower a seed.
    """
    seed = np.zeros((len(old), len(new)))
    both = {x["path"] for x in old} & {x["path"] for x in new}
    for i, a in enumerate(old):
        for j, b in enumerate(new):
            if a["path"] == b["path"]:
                seed[i, j] = 1.0
            elif a["level"] == b["level"] and a["path"] not in both and b["path"] not in both:
                seed[i, j] = w.name * name_similarity(a["name"], b["name"]) + w.value * value_similarity(a["sketch"], b["sketch"], w)
                if a["kinds"] and b["kinds"] and a["kinds"] != b["kinds"]:
                    seed[i, j] *= w.other_type
    nodes: dict[tuple, int] = {}
    base: list[float] = []

    def node(key: tuple, start: float) -> int:
        if key not in nodes:
            nodes[key] = len(base)
            base.append(start)
        return nodes[key]

    links: list[tuple[int, int, str]] = []
    for i, a in enumerate(old):
        for j, b in enumerate(new):
            if seed[i, j] <= 0:
                continue
            here = node(("key", i, j), seed[i, j])
            links.append((node(("level", a["level"]), 1.0), here, "has"))
            for x in a["kinds"]:
                for y in b["kinds"]:
                    links.append((here, node(("kind", x, y), 1.0 if x == y else 0.0), "is"))
            for x in a["nested"]:
                if x in b["nested"]:
                    links.append((here, node(("nested", x), 1.0), "holds"))
    start = np.array(base) if base else np.zeros(0)
    if not links:
        return seed, seed
    outgoing, incoming = Counter((s, lab) for s, _, lab in links), Counter((t, lab) for _, t, lab in links)
    src = np.array([s for s, _, _ in links] + [t for _, t, _ in links])
    dst = np.array([t for _, t, _ in links] + [s for s, _, _ in links])
    weight = np.array([1 / outgoing[s, lab] for s, _, lab in links] + [1 / incoming[t, lab] for _, t, lab in links])
    score = start.copy()
    for _ in range(w.rounds):
        new_score = start + score + np.bincount(dst, weights=score[src] * weight, minlength=len(start))
        new_score /= max(new_score.max(), 1e-12)
        moved, score = np.linalg.norm(new_score - score), new_score
        if moved < w.settled:
            break
    out = np.zeros_like(seed)
    for key, k in nodes.items():
        if key[0] == "key":
            out[key[1], key[2]] = score[k]
    return out, seed


def changes_between(old: list[dict], new: list[dict], w: Weights = Weights()) -> list[tuple[str, str, str]]:
    """(`field_path`, `change_kind`, `new_path`) of the changes from one file's profile to the next."""
    before, after = {x["path"]: x for x in old}, {x["path"]: x for x in new}
    out = [
        (p, "type_changed", "") for p in before if p in after and before[p]["kinds"] and after[p]["kinds"] and before[p]["kinds"] != after[p]["kinds"]
    ]
    gone, come = [i for i, x in enumerate(old) if x["path"] not in after], [j for j, x in enumerate(new) if x["path"] not in before]
    if gone and come:
        score, seed = flood(old, new, w)
        left, right = set(gone), set(come)
        for _, i, j in sorted((-score[i, j], i, j) for i in gone for j in come if seed[i, j] >= w.evidence):
            if i in left and j in right:
                left.discard(i)
                right.discard(j)
                out.append((old[i]["path"], "renamed", new[j]["path"]))
        gone, come = sorted(left), sorted(right)
    gone, come = [old[i] for i in gone], [new[j] for j in come]
    out += [(x["path"], "removed", "") for x in gone] + [(x["path"], "added", "") for x in come]
    return out


def _as_keys(rows: list) -> list[dict]:
    out = []
    for r in rows:
        path = r["field_path"]
        level, name = (STEP, path[len(STEP) :]) if path.startswith(STEP) else ("", path)
        out.append({"path": path, "level": level, "name": name, "kinds": sorted(dict(r["kinds"])), "sketch": np.asarray(r["sketch"]), "nested": set(r["nested"])})
    return sorted(out, key=lambda x: x["path"])


def drift(lines: DataFrame, weights: Weights = Weights(), found: DataFrame | None = None) -> DataFrame:
    """`feed`, `file_no`, `field_path`, `change_kind`, `new_path`: each change of a file against the one before of its feed.

    `lines` has `feed`, `file_no` and `record` (a JSON line); unreadable lines, lines that hold no object and rows without
    feed or file number are passed over, repeated lines change nothing, and other columns play no part. A file without a
    readable record has no keys. An empty table gives an empty result. A change of type needs non-null values on
    both sides; a key whose values are all null has no type. Profiles hold one row per file and key, so the matching of
    two files never sees more than their keys. `found` may give the profiles, where the caller has them.
    """
    found = profiles(lines) if found is None else found
    files = lines.filter("feed is not null and file_no is not null").select("feed", F.col("file_no").cast("bigint").alias("file_no")).distinct()
    after = files.withColumn("next_no", F.lead("file_no").over(W.partitionBy("feed").orderBy("file_no"))).filter("next_no is not null")
    keys = found.groupBy("feed", "file_no").agg(F.collect_list(F.struct("field_path", "kinds", "sketch", "nested")).alias("keys"))
    pairs = (
        after.join(keys, ["feed", "file_no"], "left")
        .withColumnRenamed("keys", "old")
        .join(keys.select("feed", F.col("file_no").alias("next_no"), F.col("keys").alias("new")), ["feed", "next_no"], "left")
        .select("feed", "next_no", "old", "new")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (feed, no, *change)
                for feed, no, old, new in frame.itertuples(index=False)
                for change in changes_between(_as_keys(old if old is not None else []), _as_keys(new if new is not None else []), weights)
            ]
            yield pd.DataFrame(rows, columns=["feed", "file_no", "field_path", "change_kind", "new_path"])

    return pairs.mapInPandas(run, "feed string, file_no bigint, field_path string, change_kind string, new_path string")


def canonical_names(changes: DataFrame, found: DataFrame) -> dict[tuple[str, str], str]:
    """For each (feed, key) that goes under another name in the table, that name: of all keys that renames link, the one that most files use.

    A link that one feed shows holds for the others as well, unless one of their files has both keys at once: there they are different things
    and keep their names. Only keys that take part in a rename, and the sets of them that files have, come to the driver.
    """
    links = [tuple(r) for r in changes.filter("change_kind = 'renamed'").select("feed", "field_path", "new_path").distinct().collect()]
    if not links:
        return {}
    linked = changes.sparkSession.createDataFrame(sorted({(p,) for _, a, b in links for p in (a, b)}), "field_path string")
    sets = found.join(F.broadcast(linked), "field_path").groupBy("feed", "file_no").agg(F.array_sort(F.collect_set("field_path")).alias("keys"))
    files: Counter = Counter()
    together: dict[str, set[frozenset[str]]] = {}
    for feed, keys, n in (tuple(r) for r in sets.groupBy("feed", "keys").agg(F.count("*").alias("n")).collect()):
        together.setdefault(feed, set()).add(frozenset(keys))
        for k in keys:
            files[k] += n

    def joined(pairs: list[tuple[str, str]], groups: dict[str, frozenset[str]], allowed) -> dict[str, frozenset[str]]:
        for a, b in pairs:
            one = groups.setdefault(a, frozenset([a])) | groups.setdefault(b, frozenset([b]))
            if allowed(one):
                groups |= dict.fromkeys(one, one)
        return groups

    every = sorted({(a, b) for _, a, b in links}, key=lambda p: (-files[p[0]] - files[p[1]], p))
    out = {}
    for feed, sets_of in together.items():
        apart = lambda one, sets_of=sets_of: all(len(one & keys) < 2 for keys in sets_of)
        groups = joined([(a, b) for f, a, b in sorted(links) if f == feed], {}, lambda one: True)
        groups = joined(every, groups, apart)
        out |= {(feed, k): min(g, key=lambda x: (-files[x], x)) for k, g in groups.items()}
    return {k: name for k, name in out.items() if k[1] != name}


#: Keys that become columns of the unified table at most, those that most records hold; others stay in `rest`.
COLUMNS = 200
_TYPES = {"string": "string", "number": "double", "boolean": "boolean", "array": "string", "object": "string"}


def column_types(found: DataFrame, names: dict[tuple[str, str], str], most: int = COLUMNS) -> dict[str, str]:
    """The type that most values have, for the canonical keys (`step.` before those of steps) that most records hold."""
    spark = found.sparkSession
    renamed = spark.createDataFrame([(f, p, n) for (f, p), n in names.items()] or [("", "", "")], "feed string, field_path string, name string")
    named = found.join(F.broadcast(renamed), ["feed", "field_path"], "left").withColumn("name", F.coalesce("name", "field_path"))
    per = named.filter(~F.array_contains("nested", HOLDS_STEPS)).select("name", "records", F.explode("kinds").alias("kind", "n")).groupBy("name", "kind").agg(F.sum("n").alias("n"), F.sum("records").alias("records"))
    best = per.groupBy("name").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"), F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(most)
    return {r["name"]: r["kind"] for r in best.collect()}


def _cast(v, kind: str):
    """`v` as a value of `kind`, None where it cannot be one."""
    if kind == "string":
        return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if kind == "boolean":
        return v if isinstance(v, bool) else {"true": True, "false": False}.get(str(v).strip().lower())
    if kind == "number":
        try:
            return float(v) if not isinstance(v, (bool, list, dict)) and math.isfinite(float(v)) else None
        except (TypeError, ValueError, OverflowError):
            return None
    inner = _unwrapped(v)
    return json.dumps(inner, ensure_ascii=False) if kind_of(inner) == kind else None


def unified(lines: DataFrame, weights: Weights = Weights(), most: int = COLUMNS) -> DataFrame:
    """Every readable record in one typed table: `record_no`, `feed`, `file_no`, `line_no`, a column per canonical session key, `steps` and `rest`.

    A column has the type that most values of its key have, over all files: text, number (double), boolean, or JSON text of arrays and objects.
    `steps` is an array of structs of the steps' keys, typed alike, wherever and however the steps are stored. A value that cannot be cast, and keys beyond
    `most` and keys that hold the steps of other records, are kept as text in `rest` (`step.<number>.` before keys of steps), so nothing is lost. Of rows that repeat a line (feed, file,
    line) all are kept, with their own `record_no`. Of keys that differ only in case the rarer ones are numbered. Profiles are taken once, from the same lines.
    """
    found = cut_lineage(profiles(lines))
    names = canonical_names(drift(lines, weights, found), found)
    kinds = column_types(found, names, most)
    fixed = {"record_no", "feed", "file_no", "line_no", "steps", "rest"}

    def columns(keys: list[str], taken: set[str]) -> dict[str, str]:
        out: dict[str, str] = {}
        for k in keys:
            name, at = k, 1
            while name.lower() in taken:
                at, name = at + 1, f"{k}_{at + 1}"
            taken.add(name.lower())
            out[k] = name
        return out

    own = columns([k for k in kinds if not k.startswith(STEP)], set(fixed))
    inner = columns([k[len(STEP) :] for k in kinds if k.startswith(STEP)], set())
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    step_type = ", ".join(f"{quoted(n)}: {_TYPES[kinds[STEP + k]]}" for k, n in inner.items())
    ddl = ["record_no bigint", "feed string", "file_no bigint", "line_no bigint", *[f"{quoted(n)} {_TYPES[kinds[k]]}" for k, n in own.items()]]
    ddl += [f"steps array<struct<{step_type}>>"] if inner else []
    schema = ", ".join([*ddl, "rest map<string,string>"])
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def text(v) -> str | None:
        return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for no, feed, file_no, line_no, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = parse_record(line)
                if record is None:
                    continue
                key, steps = steps_of(record)
                row: dict = {"record_no": no, "feed": feed, "file_no": file_no, "line_no": line_no}
                rest: dict[str, str] = {}

                def put(target: dict, mapping: dict, level: str, k: str, v, where: str, feed=feed, rest=rest) -> None:
                    name = names.get((feed, level + k), level + k)[len(level) :]
                    value = None if v is None or name not in mapping else _cast(v, kinds[level + name])
                    if value is not None and target.get(mapping[name]) is None:
                        target[mapping[name]] = value
                    elif v is not None:
                        rest[where + name if where + name not in rest else where + k] = text(v)

                for k, v in record.items():
                    if k != key:
                        put(row, own, "", k, v, "")
                if inner:
                    row["steps"] = []
                    for at, s in enumerate(steps, 1):
                        step: dict = {}
                        for k, v in s.items():
                            put(step, inner, STEP, k, v, f"{STEP}{at}.")
                        row["steps"].append(step)
                row["rest"] = list(rest.items())
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, arrow)

    cols = [F.col(c).cast("bigint").alias(c) if c != "feed" else F.col(c) for c in ("record_no", "feed", "file_no", "line_no")]
    return lines.filter("record is not null").select(*cols, "record").mapInArrow(run, schema)
