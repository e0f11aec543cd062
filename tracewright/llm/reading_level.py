"""Reading level of documents from the surprisal of their words under graded language models.

An interpolated bigram model is trained for each grade on labelled documents. The distribution of the surprisal of a whole document's words
under each model (its mean and quantiles) is compared between the models: each of these figures expects a grade, and their non-negative mixture,
fitted on held-out documents, is the difficulty. Isotonic regression maps held-out difficulties of the labelled documents monotonically to the grade.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.overlap import words

BANDS = ("basic", "intermediate", "advanced")
#: Labelled documents that the models are fitted on at most; beyond, those with the smallest hashes of their number.
MAX_LABELLED = 20_000
FOLDS = 5

_TOKEN = re.compile(r"[a-z0-9_-]*/[\w./-]*|\d+|[\u3040-\u30ff\u3400-\u9fff]|[^\W\d_\u3040-\u30ff\u3400-\u9fff]+(?:[-'’][^\W\d_\u3040-\u30ff\u3400-\u9fff]+)*|[.!?\n:;,。！？；，：]+")


def tokens(text: str) -> list[str]:
    """Lower-case words (of any script, a CJK character each) and marks of `text`; numbers and paths are one word each."""
    return ["#" if w[0].isdigit() and "/" not in w else "/" if "/" in w else w for w in _TOKEN.findall(text.lower())]


@dataclass
class GradedModel:
    """Log-probabilities of words after words, for each grade: seen pairs in full, others by the unigram model."""

    vocabulary: dict[str, int]
    pairs: np.ndarray
    pair_logs: np.ndarray
    unigram_logs: np.ndarray
    back_off: np.ndarray

    def ids(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([0, *(get(w, 1) for w in tokens(text))], dtype=np.int64)

    def logs(self, ids: np.ndarray) -> np.ndarray:
        """A row per word, a column per grade."""
        before, word = ids[:-1], ids[1:]
        out = self.back_off[before] + self.unigram_logs[word]
        if len(self.pairs):
            code = before * len(self.unigram_logs) + word
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            hit = self.pairs[at] == code
            out[hit] = self.pair_logs[at[hit]]
        return out


def _counts(docs: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of word pairs in `docs`, sorted, and how often each occurs."""
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.concatenate([d[:-1] * size + d[1:] for d in docs])
    return np.unique(codes, return_counts=True)


def train(docs: list[np.ndarray], grades: np.ndarray, vocabulary: dict[str, int], grades_n: int = len(BANDS)) -> GradedModel:
    """Bigrams interpolated with unigrams and those with the uniform law, with the weights of Witten and Bell."""
    size = len(vocabulary)
    per_grade = [_counts([d for d, g in zip(docs, grades, strict=True) if g == k], size) for k in range(grades_n)]
    every = np.unique(np.concatenate([c for c, _ in per_grade]))
    pair_logs, uni_logs, back = np.zeros((len(every), grades_n)), np.zeros((size, grades_n)), np.zeros((size, grades_n))
    for k, (codes, n) in enumerate(per_grade):
        word_n = np.bincount(codes % size, weights=n, minlength=size)
        uni = (word_n + 0.5) / (word_n.sum() + 0.5 * size)
        after_n, kinds = np.bincount(codes // size, weights=n, minlength=size), np.bincount(codes // size, minlength=size)
        rest = (kinds + 1) / (after_n + kinds + 1)
        uni_logs[:, k], back[:, k] = np.log(uni), np.log(rest)
        full = np.zeros(len(every))
        full[np.searchsorted(every, codes)] = n
        before, word = every // size, every % size
        pair_logs[:, k] = np.log(full / (after_n[before] + kinds[before] + 1) + rest[before] * uni[word])
    return GradedModel(vocabulary, every, pair_logs, uni_logs, back)


#: Quantiles of the surprisal of a document's words that are compared besides the mean.
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)


def evidence(logs: np.ndarray) -> np.ndarray:
    """The grade expected by the mean, and by each quantile, of the surprisal of a whole document's words under the models of the grades."""
    z = np.vstack([logs.mean(axis=0), -np.quantile(-logs, QUANTILES, axis=0)])
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return (p @ np.arange(logs.shape[1])) / p.sum(axis=1)


def mixture(x: np.ndarray, y: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """Non-negative weights that sum to one and with which the columns of `x`, after the best line, fit `y` with least squared error."""
    a, b = x - x.mean(axis=0), y - y.mean()
    gram, right = a.T @ a, a.T @ b
    step = 1 / max(np.linalg.norm(gram, 2), 1e-12)
    w = np.full(x.shape[1], 1.0 / x.shape[1])
    for _ in range(rounds):
        w = np.maximum(0.0, w - step * (gram @ w - right))
    return w / w.sum() if w.sum() > 0 else np.eye(1, x.shape[1])[0]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of least squared error: pooled neighbours' mean `x` and value."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, sum of x, size
    for i in order:
        blocks.append([float(y[i]), float(x[i]), 1.0])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][2] >= blocks[-1][0] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[1] / b[2] for b in blocks]), np.array([b[0] / b[2] for b in blocks])


@dataclass
class Levels:
    """The models of the grades, the mixture of what their surprisals say, and the map from difficulty to grade."""

    model: GradedModel
    weights: np.ndarray
    at: np.ndarray
    grade: np.ndarray

    def judge(self, text: str) -> tuple[float, float, float, float, float, str]:
        """Difficulty, grade, mean and 90th percentile of the surprisal in bits, share of words that the models know, and band of a whole text."""
        ids = self.model.ids(text)
        if len(ids) < 2:
            return 0.0, 0.0, 0.0, 0.0, 0.0, BANDS[0]
        logs = self.model.logs(ids)
        d = float(evidence(logs) @ self.weights)
        grade = float(np.interp(d, self.at, self.grade))
        bits = -logs.max(axis=1) / np.log(2)
        return d, grade, float(bits.mean()), float(np.quantile(bits, 0.9)), float((ids[1:] != 1).mean()), BANDS[int(np.digitize(grade, [0.5, 1.5]))]


def fit(labelled: list[tuple[int, str, str]]) -> Levels:
    """The models of (number, text, band) rows; difficulties for the isotonic map come from models without the document's fold."""
    labelled = sorted((r for r in labelled if r[2] in BANDS and r[1]), key=lambda r: r[0])
    if not labelled:
        raise ValueError("no labelled document")
    words_of = [tokens(t) for _, t, _ in labelled]
    seen: dict[str, int] = {}
    for ws in words_of:
        for w in set(ws):
            seen[w] = seen.get(w, 0) + 1
    least = 3 if len(labelled) >= 100 else 2
    vocabulary = {"<start>": 0, "<rare>": 1} | {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= least), 2)}
    docs = [np.array([0, *(vocabulary.get(w, 1) for w in ws)], dtype=np.int64) for ws in words_of]
    grades = np.array([BANDS.index(b) for _, _, b in labelled])
    held = np.zeros((len(docs), 1 + len(QUANTILES)))
    folds = np.arange(len(docs)) % min(FOLDS, max(1, len(docs)))
    for f in np.unique(folds):
        rest = [i for i in range(len(docs)) if folds[i] != f] or list(range(len(docs)))
        model = train([docs[i] for i in rest], grades[rest], vocabulary)
        for i in np.flatnonzero(folds == f):
            held[i] = evidence(model.logs(docs[i])) if len(docs[i]) > 1 else 0.0
    weights = mixture(held, grades.astype(float))
    at, grade = isotonic(held @ weights, grades.astype(float))
    return Levels(train(docs, grades, vocabulary), weights, at, grade)


def labelled_rows(documents: DataFrame, levels: DataFrame, most: int = MAX_LABELLED) -> list[tuple[int, str, str]]:
    """At most `most` labelled documents with their texts, chosen by a hash of the number where there are more."""
    chosen = levels.filter(F.col("band").isin(*BANDS)).select(F.col("doc_id").alias("_id"), F.col("band").alias("_band"))
    chosen = chosen.groupBy("_id").agg(F.min("_band").alias("_band")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = documents.filter("text is not null").select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return [(r["doc_id"], r["text"], r["_band"]) for r in rows.select("doc_id", "text", "_band").collect()]


def word_count(text: str) -> int:
    return len(re.findall(r"[A-Za-z0-9]+", text)) if text.isascii() else len(words(text))


def judged(documents: DataFrame, levels: DataFrame, least_words: int = 0) -> DataFrame:
    """`doc_id`, `difficulty` (0 to 2), `grade`, `surprisal_mean`, `surprisal_p90` (bits), `known` (share of words the models know) and `band` of every document of at least `least_words` words.

    Null texts have no row; an empty text is of the lowest grade; repeated rows are judged alike; an empty table gives an empty
    result, as do levels without a known band. Models are fitted on at most MAX_LABELLED labelled documents and broadcast.
    """
    schema = "doc_id bigint, difficulty double, grade double, surprisal_mean double, surprisal_p90 double, known double, band string"
    labelled = labelled_rows(documents, levels)
    spark = documents.sparkSession
    if not labelled:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(fit(labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, *shared.value.judge(t)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if word_count(t) >= least_words
            ]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [pa.int64(), *[pa.float64()] * 5, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "difficulty", "grade", "surprisal_mean", "surprisal_p90", "known", "band"]
            )

    own = documents.filter("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return own.mapInArrow(run, schema)
