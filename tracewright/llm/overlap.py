"""Records of evaluation splits that recur, exactly or nearly, in the training split.

Word order does not count, so every text becomes the sequence of its words (repeats told apart by their number)
in one global order, rare words first. Of all these sequences a suffix array is built, partitioned by the first two words of a suffix and sorted
within each partition: suffixes that begin alike stand next to each other. Neighbours of different splits with a common prefix of two words or more
reveal a shared span, as long as the prefix; the spans of two texts are merged into how much of either they cover. A pair of texts
that has four fifths of its words in common has such a span among the first three fifths of either sequence (see `prefix_length`), so no
pair is lost, and suffixes that begin with frequent words are never compared. Texts of equal words form one class and are compared once.
Spans propose a pair; an exact count of common words decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tracewright.functions.text import filled, strip
from tracewright.sources import cut_lineage

#: Shares of the longer text that must be common, and the fewest words of a text that is compared.
SHARE_TENTHS, LEAST_WORDS = 8, 8
#: Buckets in which words are counted to order them; the only table that is broadcast, of fixed size. Of rare words only the few that share a
#: bucket with a frequent one are taken for frequent, however large the vocabulary.
BUCKETS = 1 << 18
_HAN = r"⺀-⿟々〇぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = regex.compile(rf"[{_HAN}]|[[\p{{L}}\p{{N}}]--[{_HAN}]]+", regex.V1)


def words(text: str) -> list[str]:
    """The words of `text` in lower case: one CJK character, or a longest run of other letters and digits."""
    return _WORD.findall(text.lower())


def numbered(ws: list[str]) -> list[int]:
    """A 64-bit key per word and repetition, so that a multiset becomes a set."""
    seen: dict[str, int] = {}
    out = []
    for w in ws:
        seen[w] = k = seen.get(w, 0) + 1
        out.append(xxhash.xxh3_64_intdigest(f"{w}\0{k}".encode("utf-8", "surrogatepass")) - (1 << 63))
    return out


def needed(n: int) -> int:
    """Common words that two texts need of which the longer has `n`."""
    return -(-n * SHARE_TENTHS // 10)


def prefix_length(n: int) -> int:
    """Leading words of a sequence of `n` that hold a shared span of two with every text like it.

    Let a >= b be the lengths and c >= 0.8 a the common words; x = a - c and y = b - c words stand alone. Among the first
    x + y + 2 common words some two neighbours have no lone word between them in either sequence. They end at most x + y + 2 + x
    words into the first and x + y + 2 + y into the second, which is at most 0.6 of its own length and 2, rounded up.
    """
    return min(n, math.ceil(0.6 * n) + 3)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [sorted(numbered(words(t))) for t in batch.column(4).to_pylist()]
        ok = [i for i, k in enumerate(keys) if len(k) >= LEAST_WORDS]
        part = batch.take(pa.array(ok, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [part.column(i) for i in range(4)] + [pa.array([keys[i] for i in ok], pa.list_(pa.int64()))], ["id", "train", "split", "source", "tokens"]
        )


def _bitmap(tokens: list[int]) -> tuple[int, int]:
    """128 bits in which tokens are marked by parity: differing bits never exceed differing tokens."""
    a = b = 0
    for t in tokens:
        if t & 64:
            a ^= 1 << (t & 63)
        else:
            b ^= 1 << (t & 63)
    return tuple(x - (1 << 64) if x >> 63 else x for x in (a, b))


#: Words of a suffix beyond its first two by which it is sorted, and up to which common prefixes are measured.
DEPTH = 6
_SUFFIX = "cls struct<a:bigint,b:bigint>, train boolean, held boolean, n int, ba bigint, bb bigint, pos int, key bigint, more array<int>"


def _suffixes(shared):
    """The suffixes of every class's sequence that may begin a shared span: `key` stands for the first two words, `more` for those after."""
    schema = to_arrow_schema(StructType.fromDDL(_SUFFIX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, key, pos, more = [], [], [], []
                n, ba, bb = [], [], []
                for i, tokens in enumerate(part.column(3).to_pylist()):
                    arr = np.array(tokens, dtype=np.int64)
                    arr = arr[np.lexsort((arr, counts[arr % BUCKETS]))]
                    m = prefix_length(len(arr)) - 1
                    first, second = arr[:m].view(np.uint64), arr[1 : m + 1].view(np.uint64)
                    with np.errstate(over="ignore"):
                        mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + np.uint64(0xD1B54A32D192ED03) + (first >> np.uint64(29)))
                    key.append(mixed.view(np.int64))
                    short = np.concatenate([(arr >> 16).astype(np.int32), np.zeros(DEPTH + 2, np.int32)])
                    more.append(np.lib.stride_tricks.sliding_window_view(short[2:], DEPTH)[:m].reshape(-1))
                    a, b = _bitmap(tokens)
                    n.append(len(tokens))
                    ba.append(a)
                    bb.append(b)
                    rows.append(np.full(m, i))
                    pos.append(np.arange(m))
                if not rows:
                    continue
                take = np.concatenate(rows)
                each = part.select(["cls", "train", "held"]).take(pa.array(take))
                cols = [*each.columns, *(pa.array(np.array(x)[take], t) for x, t in ((n, pa.int32()), (ba, pa.int64()), (bb, pa.int64()))), pa.array(np.concatenate(pos), pa.int32()), pa.array(np.concatenate(key))]
                starts = pa.array(np.arange(len(take) + 1) * DEPTH, pa.int32())
                yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(starts, pa.array(np.concatenate(more), pa.int32()))], schema=schema)

    return run


def suffix_array(classes: DataFrame, counts: np.ndarray, ordered: bool = False) -> DataFrame:
    """The suffixes of all `classes` (`cls`, `train`, `held`, `tokens`); `ordered`, in partitions of equal first words, each in order of its words.

    `shared_spans` leaves partitioning and sorting to its merge join, which splits the partition of a hot pair of words; one laid out here it could not split.
    """
    shared = classes.sparkSession.sparkContext.broadcast(counts)
    rows = classes.select("cls", "train", "held", "tokens").mapInArrow(_suffixes(shared), _SUFFIX)
    return rows.repartition("key").sortWithinPartitions("key", "more") if ordered else rows


def shared_spans(suffixes: DataFrame) -> DataFrame:
    """`ca` (held), `cb` (training), `spans` of every two classes with a common prefix of two suffixes that may be alike enough.

    A span is `at` and `till`, the words of the held sequence that are the common prefix; it ends at DEPTH + 2 words, where the next suffix
    carries on. The merge join partitions the suffixes of either side by their first two words and sorts them, so that equal beginnings are neighbours; Spark splits partitions
    that a hot pair of words makes large. Pairs that cannot reach the share by their lengths, by the words left after the span, or by their bitmaps are left out.
    """
    a, b = suffixes.filter("held").alias("a"), suffixes.filter("train").alias("b")
    least = F.expr(f"(greatest(a.n, b.n) * {SHARE_TENTHS} + 9) div 10")
    possible = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.cls") != F.col("b.cls"))
        & (F.least("a.n", "b.n") >= least)
        & (F.least("a.pos", "b.pos") + F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= least)
        & (F.expr("bit_count(a.ba ^ b.ba) + bit_count(a.bb ^ b.bb)") <= F.col("a.n") + F.col("b.n") - 2 * least)
    )
    prefix = F.expr("2" + "".join(f" + int({' and '.join(f'a.more[{j}] = b.more[{j}]' for j in range(i + 1))})" for i in range(DEPTH)))
    met = a.join(b.hint("merge"), possible).select(F.col("a.cls").alias("ca"), F.col("b.cls").alias("cb"), F.col("a.pos").alias("at"), F.least(F.col("a.n"), F.col("b.n") + F.col("a.pos") - F.col("b.pos"), F.col("a.pos") + prefix).alias("till"))
    return met.groupBy("ca", "cb").agg(F.array_sort(F.collect_set(F.struct("at", "till"))).alias("spans"))


def span_words(spans: Column) -> Column:
    """The number of words that the sorted `spans` cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    add = lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["till"] - F.greatest(x["at"], s["end"]))).alias("n"), F.greatest(s["end"], x["till"]).alias("end"))
    return F.aggregate(spans, start, add)["n"]


def split_overlaps(rows: DataFrame, row_id: str, split: str, session: str, text: str, source: str) -> DataFrame:
    """Every pair of an evaluation row (`eval_id`, `eval_split`, `eval_source`) and a training row (`train_id`).

    `by_session` says that the session names are equal apart from case and outer blanks, `coverage` is the share of the
    longer text's words that both have, `in_spans` the share of the evaluation text's words in the spans that revealed the pair (1 for equal
    words; both null where the texts are not alike). `split` is train, dev or test; rows of
    other splits, and blank session names, match nothing; texts of fewer than eight words and null texts match by session
    only; repeated rows pair one by one; an empty table gives an empty result; other columns play no part.
    """
    spark = rows.sparkSession
    base = rows.filter(F.col(split).isin("train", "dev", "test")).select(
        F.col(row_id).cast("bigint").alias("id"),
        (F.col(split) == "train").alias("train"),
        F.col(split).alias("split"),
        F.col(source).alias("source"),
        F.lower(strip(filled(F.col(session)))).alias("session"),
        F.col(text).alias("text"),
    )
    held, train = base.filter(~F.col("train")), base.filter("train")
    eval_side = [F.col("id").alias("eval_id"), F.col("split").alias("eval_split"), F.col("source").alias("eval_source")]
    by_name = held.select(*eval_side, "session").join(train.select(F.col("id").alias("train_id"), "session"), "session").drop("session")

    schema = "id bigint, train boolean, split string, source string, tokens array<bigint>"
    toks = base.filter("text is not null").select("id", "train", "split", "source", "text").mapInArrow(_tokens, schema)
    # Two independent hashes name a class: one alone would join different texts of a corpus of billions.
    toks = cut_lineage(toks.withColumn("cls", F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit("class"), "tokens").alias("b"))))
    members = toks.select("id", "train", "split", "source", "cls")
    classes = cut_lineage(
        toks.groupBy("cls").agg(F.first("tokens").alias("tokens"), F.max("train").alias("train"), F.max(~F.col("train")).alias("held"))
    )
    counted = classes.select(F.explode(F.transform("tokens", lambda t: F.pmod(t, F.lit(BUCKETS)).cast("int"))).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    got = counted.select("b", "n").toArrow()
    counts[got.column("b").to_numpy()] = got.column("n").to_numpy()
    near = shared_spans(suffix_array(classes, counts)).select("ca", "cb", span_words(F.col("spans")).alias("words"))
    tokens = classes.select("cls", "tokens")
    near = near.join(tokens.toDF("ca", "ta"), "ca").join(tokens.toDF("cb", "tb"), "cb")
    longer = F.greatest(F.size("ta"), F.size("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    near = near.filter(common * 10 >= longer * SHARE_TENTHS).select("ca", "cb", (common / longer).alias("coverage"), (F.col("words") / F.size("ta")).alias("in_spans"))
    same = classes.filter("held and train").select(F.col("cls").alias("ca"), F.col("cls").alias("cb"), F.lit(1.0).alias("coverage"), F.lit(1.0).alias("in_spans"))
    by_text = (
        near.unionByName(same)
        .join(members.filter(~F.col("train")).select(*eval_side, F.col("cls").alias("ca")), "ca")
        .join(members.filter("train").select(F.col("id").alias("train_id"), F.col("cls").alias("cb")), "cb")
    )
    both = by_name.select("eval_id", "train_id", "eval_split", "eval_source", F.lit(True).alias("by_session"), F.lit(None).cast("double").alias("coverage"), F.lit(None).cast("double").alias("in_spans")).unionByName(
        by_text.select("eval_id", "train_id", "eval_split", "eval_source", F.lit(False).alias("by_session"), "coverage", "in_spans")
    )
    return both.groupBy("eval_id", "train_id", "eval_split", "eval_source").agg(
        F.max("by_session").alias("by_session"), F.max("coverage").alias("coverage"), F.max("in_spans").alias("in_spans")
    )


def overlap_pairs(pairs: DataFrame) -> DataFrame:
    """`traj_id_a`, `traj_id_b` of each pair, the smaller first."""
    return pairs.select(F.least("eval_id", "train_id").alias("traj_id_a"), F.greatest("eval_id", "train_id").alias("traj_id_b")).distinct()


def overlap_report(pairs: DataFrame, rows: DataFrame, row_id: str, split: str, source: str) -> DataFrame:
    """Per evaluation split and source: rows, rows that recur in training, of these those alike in text, and pairs."""
    per_row = pairs.groupBy("eval_id").agg(F.count("*").alias("pairs"), F.max(F.col("coverage").isNotNull()).alias("alike"))
    held = rows.filter(F.col(split).isin("dev", "test")).select(F.col(row_id).cast("bigint").alias("eval_id"), F.col(split).alias("split"), F.col(source).alias("source"))
    joined = held.join(per_row, "eval_id", "left")
    return joined.groupBy("split", "source").agg(
        F.count("*").alias("rows"),
        F.count("pairs").alias("rows_in_training"),
        F.count_if(F.col("alike")).alias("rows_alike"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
    )
