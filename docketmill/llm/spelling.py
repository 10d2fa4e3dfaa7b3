"""Spelling variants: each word and the frequent word one edit away.

Words are counted by tasks before they are shuffled.  The vocabulary's hashes then
fill a blocked Bloom filter, sharded by word length, and every word generates the
edits of its neighbourhood against it: all its deletions, looked up among the words
one shorter, and all replacements by a smaller character, looked up among those of
its length.  Two words one edit apart are found from the longer or the greater one,
so insertions and the other replacements need no probes.  Hashes are polynomials of
the code points, so an edit's hash follows from the word's without spelling it.

Only the positives are shuffled, as two longs each: an exact join with the
vocabulary finds the words behind them, and the words themselves decide, which
removes the filter's false positives.

The filter has `BITS` bits a word.  At most `ROUND_BLOCKS` blocks of it are
broadcast at a time; a larger vocabulary is probed range by range of the filter,
each edit in the one range that its block lies in, so no broadcast and no collected
part grows with the corpus.  Forms are followed to their roots by pointer doubling.

Defined cases: NULL, empty and wordless texts have no words; a NULL id is written
`null` before the hash; rows that repeat an id count each; an empty table gives no
rows.  A text is worked through in pieces that end with a run, so memory does not
follow its length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.llm import arrowtext as A
from docketmill.llm.common import materialized

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is this many times as frequent as its variant.
FACTOR = 10
#: One run in so many, by the hash of id and run, loses a code point.
EVERY = 31

#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Characters of a text whose words are taken at once.
PIECE = 1 << 20

#: The filter: bits a word, blocks of 8 lanes of 32 bits, blocks that are broadcast at once (32 MiB).
BITS = 16
LANES = 8
ROUND_BLOCKS = 1 << 20
#: Blocks that one task fills at once.
SEGMENT = 1 << 13
#: Words of this length and longer share a shard.
LONG = 64
#: Code points whose edits are generated at once.
_POINTS = 1 << 15

_RUN = re.compile("[a-zÀ-ÿ]+")
_LONG_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def _runs(text: str) -> Iterator[list[str]]:
    """Maximal runs of at least `LEAST_LENGTH` letters, piece by piece of a lower-cased text."""
    at = 0
    while len(text) - at > PIECE:
        inside = _RUN.match(text, at + PIECE)
        end = inside.end() if inside else at + PIECE
        yield _LONG_RUN.findall(text, at, end)
        at = end
    yield _LONG_RUN.findall(text, at)


def document_words(doc_id: int | None, text: str) -> Counter:
    """Words of one lower-cased text and how often they occur in it."""
    prefix = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    runs: Counter = Counter()
    for some in _runs(text):
        runs.update(some)
    words: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % EVERY == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        words[run] += n
    return words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts of a task, in parts of bounded size."""
    held: Counter = Counter()

    def part() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return found

    for batch in batches:
        ids = batch.column(0)
        for block in A.blocks(batch.column(1)):
            raw, bounds = block.lowered().data.tobytes(), block.bounds.tolist()
            for k, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False)):
                held.update(document_words(ids[block.first + k].as_py(), raw[s:e].decode()))
                if len(held) >= HELD_WORDS:
                    yield part()
    if held:
        yield part()


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of the words of all texts that are frequent enough."""
    counted = docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class _Spelled:
    """Words of an Arrow column as flat code points, with polynomial prefix hashes."""

    def __init__(self, words: pa.Array, start: int = 0, length: int | None = None):
        values = words.slice(start, length).to_pylist()
        self.sizes = np.array([len(w) for w in values], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.points = np.frombuffer("".join(values).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        self.owner = np.repeat(np.arange(len(values)), self.sizes)
        self.places = np.arange(len(self.points)) - self.starts[self.owner]
        steps = np.full(int(self.sizes.max(initial=0)) + 1, _P, dtype=np.uint64)
        steps[0] = 1
        self.powers = np.cumprod(steps)
        sums = np.zeros(len(self.points) + 1, dtype=np.uint64)
        np.cumsum((self.points + np.uint64(1)) * self.powers[self.places], out=sums[1:])
        self.before = sums[:-1] - sums[self.starts][self.owner]  # hash of what precedes a code point
        self.hashes = sums[self.ends] - sums[self.starts]


def keys(words: pa.Array) -> np.ndarray:
    """Polynomial hash of each word."""
    return _Spelled(words).hashes if len(words) else np.empty(0, dtype=np.uint64)


def edits(spelled: _Spelled, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the word, hash of the edit, its length) of deletions and of smaller replacements.

    One of several equal deletions is enough, that of the first of equal neighbours.
    """
    for at in range(0, len(spelled.points), _POINTS):
        part = slice(at, at + _POINTS)
        points, owner, place = spelled.points[part], spelled.owner[part], spelled.places[part]
        power, before = spelled.powers[place], spelled.before[part]
        own = (points + np.uint64(1)) * power
        after = spelled.hashes[owner] - before - own
        previous = spelled.points[np.maximum(np.arange(at, at + len(points)) - 1, 0)]
        first = (place == 0) | (previous != points)
        rows = owner[first]
        yield rows, (before + after * np.uint64(_P_INVERSE))[first], spelled.sizes[rows] - 1
        smaller = np.searchsorted(alphabet, points)
        rows = np.repeat(np.arange(len(points)), smaller)
        letter = alphabet[np.arange(len(rows)) - np.repeat(np.cumsum(smaller) - smaller, smaller)]
        changed = spelled.hashes[owner[rows]] - own[rows] + (letter + np.uint64(1)) * power[rows]
        yield owner[rows], changed, spelled.sizes[owner[rows]]


class Layout:
    """Where the shard of each word length lies in the filter."""

    def __init__(self, counts: dict[int, int]):
        self.sizes = np.zeros(LONG + 1, dtype=np.int64)
        for length, n in counts.items():
            self.sizes[min(length, LONG)] += -(-n * BITS // (32 * LANES))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.blocks = int(self.sizes.sum())

    def places(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block, or -1 where no word has the length, and the bits' positions packed in a number."""
        shard = np.clip(lengths, 0, LONG)
        h = A.mixed(hashes)
        at = (h >> np.uint64(32)) * self.sizes[shard].astype(np.uint64) >> np.uint64(32)
        block = np.where(self.sizes[shard] > 0, self.starts[shard] + at.astype(np.int64), -1)
        return block, A.mixed(hashes ^ np.uint64(_P))


def _lane_bits(bits: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((bits >> np.uint64(5 * lane)) & np.uint64(31)).astype(np.uint32)


def filled(blocks: np.ndarray, bits: np.ndarray, n: int) -> np.ndarray:
    """`n` blocks of `LANES` numbers with a bit set in each lane of the words' blocks."""
    found = np.zeros((n, LANES), dtype=np.uint32)
    for lane in range(LANES):
        np.bitwise_or.at(found[:, lane], blocks, _lane_bits(bits, lane))
    return found


def contains(table: np.ndarray, blocks: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of the probes that the filter does not rule out."""
    at = np.arange(len(blocks))
    for lane in range(LANES):
        some = _lane_bits(bits[at], lane)
        at = at[table[blocks[at], lane] & some != 0]
    return at


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(keys(batch.column(0)).view(np.int64))], ["word", "n", "key"])


def _filter(words: DataFrame, layout: Layout, low: int, high: int) -> np.ndarray:
    """Blocks `low` to `high` of the filter, filled segment by segment in tasks."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            block, bits = layout.places(hashes, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
            here = np.flatnonzero((block >= low) & (block < high))
            at = block[here] - low
            yield pa.RecordBatch.from_arrays(
                [pa.array((at // SEGMENT).astype(np.int32)), pa.array((at % SEGMENT).astype(np.int32)),
                 pa.array(bits[here].view(np.int64))], ["segment", "at", "bits"])

    def fill(rows: pa.Table) -> pa.Table:
        found = filled(rows["at"].to_numpy(), rows["bits"].to_numpy().view(np.uint64), SEGMENT)
        return pa.table({"segment": rows["segment"][:1], "filter": pa.array([found.tobytes()], pa.binary())})

    placed = words.select("key", F.length("word").alias("size")).mapInArrow(
        place, "segment int, at int, bits bigint")
    parts = placed.groupBy("segment").applyInArrow(fill, "segment int, filter binary")
    table = np.zeros((-(-(high - low) // SEGMENT) * SEGMENT, LANES), dtype=np.uint32)
    for row in parts.collect():  # at most ROUND_BLOCKS blocks of 32 bytes
        at = row["segment"] * SEGMENT
        table[at : at + SEGMENT] = np.frombuffer(row["filter"], dtype=np.uint32).reshape(-1, LANES)
    return table


def positives(words: DataFrame, layout: Layout, alphabet: np.ndarray, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """(a, b): keys of words, and of edits of theirs that the filter does not rule out."""
    spark = words.sparkSession
    found = None
    for low in range(0, max(layout.blocks, 1), round_blocks):
        high = min(low + round_blocks, layout.blocks)
        sent = spark.sparkContext.broadcast(_filter(words, layout, low, high))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, low=low, high=high) -> Iterator[pa.RecordBatch]:
            table = sent.value
            for batch in batches:
                for start in range(0, batch.num_rows, 4096):
                    spelled = _Spelled(batch.column(0), start, 4096)
                    for rows, hashes, lengths in edits(spelled, alphabet):
                        block, bits = layout.places(hashes, lengths)
                        here = np.flatnonzero((block >= low) & (block < high))
                        here = here[contains(table, block[here] - low, bits[here])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(spelled.hashes[rows[here]].view(np.int64)), pa.array(hashes[here].view(np.int64))],
                            ["a", "b"])

        part = materialized(words.select("word").mapInArrow(probe, "a bigint, b bigint"), "positives")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def near_pairs(words: DataFrame, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """(word, n, other, other_n) of all words (word, n) that are one edit apart, in both directions."""
    keyed = materialized(words.select("word", "n").mapInArrow(_with_keys, "word string, n bigint, key bigint"), "words")
    # One row a length, and one a character of the words' alphabet.
    counts = {r["size"]: r["count"] for r in keyed.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("size")).count().collect()}
    letters = keyed.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), dtype=np.uint64)
    found = positives(keyed, Layout(counts), alphabet, round_blocks)

    def named(key: str, word: str, n: str) -> DataFrame:
        return keyed.select(F.col("key").alias(key), F.col("word").alias(word), F.col("n").alias(n))

    both = found.join(named("b", "other", "other_n"), "b").join(named("a", "word", "n"), "a")
    pairs = both.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n").distinct()
    return pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _roots(links: DataFrame, steps: int) -> DataFrame:
    """(word, root): the end of the chain of forms from every word with a form; no chain is longer than `steps`."""
    at = links.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        at = materialized(at, "forms")
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return at


def grouped(words: DataFrame, factor: int = FACTOR, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n)."""
    words = materialized(words.select("word", "n"), "vocabulary")
    best: Column = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form")))
    near = near_pairs(words, round_blocks).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= factor * F.col("n")
    formed = materialized(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, -F.col("best.m")).alias("form_n")), "formed")
    links = formed.where("form is not null")
    most = links.agg(F.max("form_n")).first()[0] or 0
    # Along a chain the counts grow by the factor each step, from one at least.
    roots = _roots(links, 1 + math.floor(math.log(most, factor)) if most else 0)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts."""
    return grouped(vocabulary(docs, text))
