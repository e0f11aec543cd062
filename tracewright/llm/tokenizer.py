"""Encoding of texts with a public byte-level BPE vocabulary, in two tiers.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens as a whole, a batch at a
time in NumPy. Tier two: the others are merged by rank with a heap over linked bytes. A bounded memo in front of
both keeps the pre-tokens a worker has met, so that a corpus costs one dictionary look-up per pre-token.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files; a parameter of every function that reads one.
FOLDER = os.environ.get("TRACEWRIGHT_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Entries that a worker's memo may hold before it is emptied.
MEMO = 300_000

# Fixed value: the published splitting pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for pure ASCII, where the built-in engine is faster; its white space is spelt out, since it has more of it.
_ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE = regex.compile(PATTERN.replace(r"[^\s", rf"[^{_SPACE}").replace(r"(?!\S)", rf"(?![^{_SPACE}])").replace(r"\s+", rf"[{_SPACE}]+"))


def pre_tokens(text: str) -> list[str]:
    return (_ASCII if text.isascii() else _WIDE).findall(text)


class PerfectHash:
    """A minimal perfect hash of byte strings: bucket by one hash, displace by a seed per bucket into n slots.

    Buckets of one key come last and name their free slot directly, as a negative seed.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.m = len(keys), max(1, len(keys) // 2)
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        self.seeds = np.zeros(self.m, dtype=np.int64)
        buckets = (h % np.uint64(self.m)).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        starts = np.searchsorted(buckets[order], np.arange(self.m + 1))
        taken = np.zeros(self.n, dtype=bool)
        self.keys: list[bytes] = [b""] * self.n
        self.values = np.zeros(self.n, dtype=np.int32)
        sizes, free = np.diff(starts), None
        for b in np.argsort(-sizes, kind="stable").tolist():
            own = order[starts[b] : starts[b + 1]].tolist()
            if not own:
                break
            if len(own) == 1:
                free = free if free is not None else iter(np.flatnonzero(~taken).tolist())
                at = [next(free)]
                self.seeds[b] = -1 - at[0]
            else:
                hashes, seed = [int(h[i]) for i in own], 0
                while len(set(at := [self._slot_int(x, seed) for x in hashes])) < len(at) or any(taken[x] for x in at):
                    seed += 1
                self.seeds[b] = seed
            for i, x in zip(own, at, strict=True):
                taken[x], self.keys[x], self.values[x] = True, keys[i], i

    def _slot_int(self, h: int, seed: int) -> int:
        x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) % self.n

    def find(self, queries: list[bytes]) -> list[int]:
        """The index of each query among the keys, -1 where it is none of them."""
        if not queries or not self.n:
            return [-1] * len(queries)
        h = np.array([xxhash.xxh3_64_intdigest(q) for q in queries], dtype=np.uint64)
        seeds = self.seeds[(h % np.uint64(self.m)).astype(np.int64)]
        with np.errstate(over="ignore"):
            x = h ^ (seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            slots = ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)
        slots = np.where(seeds < 0, -1 - seeds, slots)
        keys, values = self.keys, self.values
        return [int(values[s]) if keys[s] == q else -1 for s, q in zip(slots.tolist(), queries, strict=True)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The tokens of `piece` by lowest rank first, leftmost among equals: a heap of pairs over linked bytes."""
    n = len(piece)
    right, left, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := right[i]) >= n or end[j] != stop or end[i] != j:
            continue
        alive[j], end[i], right[i] = False, stop, right[j]
        if right[j] < n:
            left[right[j]] = i
            k = right[j]
            if (r := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (k := left[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])


class Encoder:
    """Both tiers over one vocabulary, with the memo."""

    def __init__(self, tokens: list[bytes], table: PerfectHash | None = None, memo: int = MEMO):
        self.limit, self.table = memo, table or PerfectHash(tokens)
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.sizes: dict[str, int] = {}

    def split(self, texts: list[str]) -> list[list[str]]:
        """The pre-tokens of each text, all of them in the memo afterwards."""
        words = [pre_tokens(t) for t in texts]
        if len(self.memo) > self.limit:
            self.memo.clear()
            self.sizes.clear()
        new = list(set().union(*words) - self.memo.keys()) if words else []
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        for w, b, i in zip(new, raw, self.table.find(raw), strict=True):
            ids = (i,) if i >= 0 else merge(b, self.ranks)
            self.memo[w], self.sizes[w] = ids, len(ids)
        return words

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        get = self.memo.__getitem__
        return [list(chain.from_iterable(map(get, ws))) for ws in self.split(texts)]

    def count_batch(self, texts: list[str]) -> list[int]:
        get = self.sizes.__getitem__
        return [sum(map(get, ws)) for ws in self.split(texts)]


def read_vocabulary(folder: str = FOLDER, name: str = VOCABULARY) -> list[bytes]:
    """The tokens of a rank file, by id; a few hundred kilobytes, whatever the corpus."""
    with open(os.path.join(folder, name), "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ids = {int(i): base64.b64decode(t) for t, i in pairs}
    return [ids[i] for i in range(len(ids))]


_OWN: dict[tuple[str, str], Encoder] = {}


def _worker_encoder(key: tuple[str, str], shared) -> Encoder:
    """One encoder per Python worker, built from the broadcast vocabulary when first needed."""
    if key not in _OWN:
        _OWN[key] = Encoder(*shared.value)
    return _OWN[key]


_BATCH = 256


def encode_column(df: DataFrame, doc_id: str, text: str, folder: str = FOLDER, name: str = VOCABULARY, counts_only: bool = False) -> DataFrame:
    """`doc_id` and `ids` (without special tokens) of every row of `df`; with `counts_only` `n_tokens` instead.

    An empty text and a null text both have the empty array (0 tokens). Texts that look like control tokens are
    ordinary text. Rows that repeat a number or a text give one row each; an empty table gives an empty result; other
    columns are not read. The vocabulary, whose size is fixed by its file, is read by the driver and broadcast.
    """
    spark = df.sparkSession
    tokens = read_vocabulary(folder, name)
    shared = spark.sparkContext.broadcast((tokens, PerfectHash(tokens)))
    key = (folder, name)
    kind = df.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _worker_encoder(key, shared)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                texts = [t or "" for t in part.column(1).to_pylist()]
                if counts_only:
                    out = pa.array(enc.count_batch(texts), pa.int64())
                else:
                    ids = enc.encode_batch(texts)
                    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
                    out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), out], [doc_id, "n_tokens" if counts_only else "ids"])

    schema = f"`{doc_id}` {kind}, " + ("n_tokens bigint" if counts_only else "ids array<int>")
    return df.select(doc_id, text).mapInArrow(run, schema)
