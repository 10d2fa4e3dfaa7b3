"""Benchmark decontamination by Wu-Manber search for windows of test text.

A benchmark item gives windows of `WINDOW` consecutive words; an item of fewer
words, but not none, is one window.  Windows of one length form a pattern set:

* a shift table by the hash of a block of two words tells how far the search may
  jump from a position, so that most words of a text are never looked at;
* where the shift is 0, the suffix hash selects the bucket of windows that end in
  that block, and the hash of the words before it the window within the bucket;
* the words themselves are compared before an occurrence counts.

Positions of many texts are searched at once: each lane is a run of possible end
positions, and all lanes jump in step.

Windows are sent to the tasks in blocks of at most `BLOCK_OF_ITEMS` bytes of item
text, and each block meets every document, in one pass over the documents.

Defined cases: a NULL or wordless text has no words and no hits; a NULL or
wordless item has no windows and never occurs; repeated item ids count once;
a NULL item id is reported as the string `null`; an empty benchmark hits nothing.
Rows are judged one by one, so repeated rows get equal results, and further
columns are passed through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketmill.llm import arrowtext as A
from docketmill.llm.common import fresh

WINDOW = 10
#: Bytes of item text whose windows are held by a task at once.
BLOCK_OF_ITEMS = 16 << 20
#: Consecutive end positions that one lane walks through.
LANE = 256

RESULT = pa.struct(
    [("n_words", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.string()))])
RESULT_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("hits", T.BinaryType()),
    T.StructField("items", T.ArrayType(T.StringType()))])


@dataclass
class PatternSet:
    """Distinct windows of one length with their shift table and suffix buckets."""

    length: int
    shifts: np.ndarray
    suffixes: np.ndarray  # sorted hashes of the last block of the windows
    keys: np.ndarray  # sorted hashes of (suffix, words before it)
    windows: list[bytes]  # by position in `keys`: the words, joined by a space
    items: list[list[str]]

    @property
    def block(self) -> int:
        return min(2, self.length)


def _block_hash(hashes: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    """Hash of the `block` words that end at each position."""
    last = hashes[ends]
    if block == 1:
        return last
    return A.mixed(hashes[ends - 1] * np.uint64(3) + last)


def _window_hash(hashes: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words that end at each position."""
    h = np.zeros(len(ends), dtype=np.uint64)
    for back in range(length - 1, -1, -1):
        h = A.mixed(h * np.uint64(5) + hashes[ends - back])
    return h


def pattern_sets(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[PatternSet]:
    """Pattern sets, one per window length, of (item id, text) pairs."""
    found: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
    for block in A.blocks(pa.array([text for _, text in items], pa.string())):
        block = block.lowered()
        w = A.words(block, A.WORD_BYTES)
        raw = block.data.tobytes()
        spelled = [raw[s:e] for s, e in zip(w.starts.tolist(), w.ends.tolist(), strict=True)]
        edges = np.searchsorted(w.owner, np.arange(block.n_texts + 1)).tolist()
        for i in range(block.n_texts):
            low, high = edges[i], edges[i + 1]
            length = min(window, high - low)
            for at in range(low, high - length + 1) if length else ():
                joined = b" ".join(spelled[at : at + length])
                entry = found.setdefault(length, {}).setdefault(joined, (w.hashes[at : at + length], set()))
                entry[1].add(items[block.first + i][0])
    return [_pattern_set(length, windows) for length, windows in sorted(found.items())]


def _pattern_set(length: int, windows: dict[bytes, tuple[np.ndarray, set[str]]]) -> PatternSet:
    block = min(2, length)
    matrix = np.array([h for h, _ in windows.values()], dtype=np.uint64)
    flat, count = matrix.ravel(), len(matrix)
    bits = max(16, math.ceil(math.log2(8 * count * length)))
    shifts = np.full(1 << bits, length - block + 1, dtype=np.uint8 if length < 250 else np.uint32)
    for end in range(block - 1, length):
        slots = _block_hash(flat, np.arange(count) * length + end, block) & np.uint64(len(shifts) - 1)
        shifts[slots] = np.minimum(shifts[slots], length - 1 - end)
    ends = np.arange(count) * length + length - 1
    keys = _window_hash(flat, ends, length)
    order = np.argsort(keys, kind="stable")
    spelled, owners = list(windows), [sorted(ids) for _, ids in windows.values()]
    return PatternSet(
        length, shifts, np.unique(_block_hash(flat, ends, block)), keys[order],
        [spelled[i] for i in order], [owners[i] for i in order])


def _candidates(w: A.Words, patterns: PatternSet) -> np.ndarray:
    """End positions where the shift is 0 and a window has the suffix."""
    n, block = len(w.hashes), patterns.block
    first = patterns.length - 1
    if n <= first:
        return np.empty(0, dtype=np.int64)
    at = np.arange(first, n, LANE)
    stop = np.minimum(at + LANE, n)
    mask = np.uint64(len(patterns.shifts) - 1)
    found = []
    while len(at):
        h = _block_hash(w.hashes, at, block)
        shift = patterns.shifts[h & mask].astype(np.int64)
        zero = shift == 0
        if zero.any():
            ends, suffix = at[zero], h[zero]
            slot = np.searchsorted(patterns.suffixes, suffix)
            slot[slot == len(patterns.suffixes)] = 0
            found.append(ends[patterns.suffixes[slot] == suffix])
        at = at + np.maximum(shift, 1)
        live = at < stop
        at, stop = at[live], stop[live]
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def occurrences(w: A.Words, raw: bytes, patterns: PatternSet) -> Iterator[tuple[int, int]]:
    """(end position, window) of every occurrence within one text."""
    length = patterns.length
    ends = _candidates(w, patterns)
    ends = ends[w.owner[ends] == w.owner[ends - (length - 1)]]
    keys = _window_hash(w.hashes, ends, length)
    low = np.searchsorted(patterns.keys, keys, side="left")
    high = np.searchsorted(patterns.keys, keys, side="right")
    some = high > low
    for end, a, b in zip(ends[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
        here = slice(end - length + 1, end + 1)
        spelled = b" ".join(
            raw[s:e] for s, e in zip(w.starts[here].tolist(), w.ends[here].tolist(), strict=True))
        for i in range(a, b):
            if patterns.windows[i] == spelled:
                yield end, i


def search(texts: pa.Array, sets: list[PatternSet]) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    """For each text: number of words, mask of the words that are hit, items that occur."""
    for block in A.blocks(texts):
        block = block.lowered()
        w = A.words(block, A.WORD_BYTES)
        raw = block.data.tobytes()
        hit = np.zeros(len(w.hashes), dtype=bool)
        items: dict[int, set[str]] = {}
        for patterns in sets:
            for end, i in occurrences(w, raw, patterns):
                hit[end - patterns.length + 1 : end + 1] = True
                items.setdefault(int(w.owner[end]), set()).update(patterns.items[i])
        edges = np.searchsorted(w.owner, np.arange(block.n_texts + 1))
        for i in range(block.n_texts):
            yield int(edges[i + 1] - edges[i]), hit[edges[i] : edges[i + 1]], items.get(i, set())


def _scan(sets_of_block) -> Column:
    """An Arrow function (text, result of the blocks before) -> result."""

    @F.arrow_udf(RESULT_TYPE)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sets = sets_of_block.value
        for texts, before in batches:
            rows = []
            for (n, hit, items), old in zip(search(texts, sets), before, strict=True):
                if old.is_valid:
                    earlier = old["hits"].as_py()
                    if earlier:
                        bits = np.unpackbits(np.frombuffer(earlier, dtype=np.uint8), count=n)
                        hit = hit | bits.astype(bool)
                    items = items | set(old["items"].as_py())
                packed = np.packbits(hit).tobytes() if hit.any() else b""
                rows.append({"n_words": n, "hits": packed, "items": sorted(items)})
            yield pa.array(rows, RESULT)

    return scan


def _item_blocks(benchmark: DataFrame, limit: int, id_col: str, text_col: str) -> Iterator[list]:
    """Items in blocks of about `limit` bytes of text; one block is collected at a time."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / limit))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.toLocalIterator()]


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_OF_ITEMS,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    into: str = "benchmark_hits",
) -> DataFrame:
    """`docs` with a column `into`: number of words, packed mask of hit words, items found."""
    context = docs.sparkSession.sparkContext
    found = F.lit(None).cast(RESULT_TYPE)
    for items in _item_blocks(benchmark, limit, item_col, item_text_col):
        sets = context.broadcast(pattern_sets(items, window))
        found = _scan(sets)(F.col(text_col).cast("string"), found)
    return docs.withColumn(into, found)


@F.arrow_udf(T.LongType())
def _ones(masks: pa.Array) -> pa.Array:
    return pa.array([int.from_bytes(m, "big").bit_count() for m in masks.to_pylist()], pa.int64())


def report(found: DataFrame, column: str = "benchmark_hits") -> DataFrame:
    """The result of `find_benchmark` as counts and digests, one row per document."""
    hits, items = F.col(f"{column}.hits"), F.col(f"{column}.items")
    return found.select(
        "doc_id", F.col(f"{column}.n_words").alias("n_words"),
        F.when(F.octet_length(hits) == 0, F.lit(0).cast("bigint")).otherwise(_ones(hits)).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.octet_length(hits) > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in which no window of the benchmark occurs."""
    mark = fresh("benchmark_hits", docs)
    found = find_benchmark(docs, benchmark, into=mark, **options)
    return found.where(F.octet_length(F.col(f"{mark}.hits")) == 0).select(*docs.columns)


