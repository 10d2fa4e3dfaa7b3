"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within `RADIUS` bits have a common neighbour at half the radius
from both.  So every fingerprint emits the variants of its ball, variants are
shuffled, and fingerprints that meet at a variant are compared.

A ball of radius 2 in 64 bits has 2,081 variants.  The 64 bits are therefore cut
into two halves: of 4 differing bits at most 2 lie in one of the halves, and in
that half the two fingerprints meet within radius 1, at 33 variants a half.  The
pairs that meet are verified on all 64 bits, so the links are the same.

Fingerprints that share a half by chance, or a family of near copies, can crowd a
variant.  Up to `CROWD` of them are compared there, and a spanning forest of their
links is kept, not all pairs.  The members of a larger crowd go through the whole
ball of 2,081 variants instead, where everything that meets is linked (2 + 2
bits), so that the smallest member stands for all.  Both ways are exact.  `CROWD`
is about where 33 comparisons for each member cost what 2,081 shuffled rows do.

`classes` names the component of every row; `without_near_copies` keeps one row of
each.  Texts are not shuffled by component, only left out by id, so a component may
hold any part of the table.

Defined cases: NULL, empty and wordless texts have fingerprint zero and are copies
of one another; equal texts have equal fingerprints and are one node; rows without
an id keep their place but name no component (unless a component has no other),
and are never dropped as copies; rows that repeat an id are linked one by one, so
a text is not lost because another text of its id is a copy; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketmill.llm import arrowtext as A
from docketmill.llm.common import fresh, materialized
from docketmill.llm.components import roots

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints at one variant that are compared with one another.
CROWD = 512
#: Hashes whose bits are counted at once.
_HASHES = 1 << 15


def _voted(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed long."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _HASHES):
        part = hashes[at : at + _HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def simhash(text: bytes, width: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        shingles = [joined]
    else:
        ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
        starts = [0, *(end + 1 for end in ends)]
        shingles = [joined[s:e] for s, e in zip(starts, ends[width - 1 :], strict=False)]
    return _voted(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)))


def _texts(texts: pa.Array) -> Iterator[bytes]:
    for block in A.blocks(texts):
        raw, bounds = block.data.tobytes(), block.bounds.tolist()
        for s, e in zip(bounds, bounds[1:], strict=False):
            yield raw[s:e]


@F.arrow_udf(T.LongType())
def _simhashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([simhash(t) for t in _texts(texts)], pa.int64())


def fingerprint(text: str = "text") -> Column:
    """SimHash of a text column as a signed long."""
    return _simhashes(F.col(text).cast("string"))


def _ball(bits: int, radius: int) -> Column:
    """XOR masks of all variants within `radius` of a value of `bits` bits, as signed longs."""
    masks = [sum(1 << b for b in at) for r in range(radius + 1) for at in combinations(range(bits), r)]
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in masks])


def _half_variants(prints: Sequence[str], radius: int) -> Column:
    """Variants of both halves of every fingerprint, marked with the half they belong to."""
    masks = _ball(32, radius // 4)

    def ball(half: Column, mark: int) -> Column:
        return F.transform(masks, lambda m: half.bitwiseXOR(m).bitwiseOR(F.lit(mark << 32)))

    halves = []
    for i, name in enumerate(prints):
        halves.append(ball(F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)), 2 * i))
        halves.append(ball(F.shiftrightunsigned(name, 32), 2 * i + 1))
    return F.concat(*halves)


def spanning_edges(prints: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a least spanning forest of the links within `limit` bits; a print is a column."""
    far = 1 << 30
    reached = np.full(len(prints), far)
    parent = np.zeros(len(prints), dtype=np.int64)
    open_ = np.ones(len(prints), dtype=bool)
    a, b = [], []
    for _ in range(len(prints)):
        at = int(np.argmin(np.where(open_, reached, far + 1)))
        if reached[at] <= limit:
            a.append(parent[at])
            b.append(at)
        open_[at] = False
        bits = np.bitwise_count(prints ^ prints[at]).sum(axis=1, dtype=np.int64)
        nearer = open_ & (bits < reached)
        reached[nearer], parent[nearer] = bits[nearer], at
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def near_pairs(prints: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs within `limit` bits."""
    bits = np.bitwise_count(prints[:, None] ^ prints).sum(axis=2, dtype=np.int64)
    a, b = np.nonzero(np.triu(bits <= limit, 1))
    return a, b


def _forest(n_prints: int, limit: int, all_pairs: int):
    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])))
    def forest(crowds: pa.Array) -> pa.Array:
        members = crowds.flatten()
        nodes = members.field(0).to_numpy(zero_copy_only=False)
        prints = np.stack([members.field(1 + i).to_numpy(zero_copy_only=False) for i in range(n_prints)], axis=1)
        prints = prints.astype(np.int64).view(np.uint64)
        sizes = crowds.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = [np.empty((2, 0), dtype=np.int64)]
        counts = np.zeros(len(sizes) + 1, dtype=np.int32)
        for k, (end, n) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)):
            here = prints[end - n : end]
            if n == 2 and int(here[0, 0] ^ here[1, 0]).bit_count() > limit:
                continue
            a, b = near_pairs(here, limit) if n <= max(2, all_pairs) else spanning_edges(here, limit)
            if len(a):
                ends.append(np.stack([a, b]) + (end - n))
                counts[k + 1] = len(a)
        a, b = nodes[np.concatenate(ends, axis=1)]
        edges = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), edges)

    return forest


def _met(nodes: DataFrame, prints: Sequence[str], radius: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Members (node, prints) by variant, of small and of larger crowds; the latter with their `size`.

    Sizes are summed before they are shuffled, and members that meet nobody go no further.
    """
    member = F.struct(F.col("node").alias("node"), *[F.col(p).alias(f"p{i}") for i, p in enumerate(prints)])
    met = nodes.select(member.alias("member"), F.explode(_half_variants(prints, radius)).alias("variant"))
    sizes = met.groupBy("variant").agg(F.count("*").alias("size")).where("size > 1")
    small = met.join(sizes.where(F.col("size") <= crowd).select("variant"), "variant")
    return small, met.join(sizes.where(F.col("size") > crowd), "variant")


def _edges(crowds: DataFrame, n_prints: int, limit: int, all_pairs: int) -> DataFrame:
    """Edges (a, b) of the columns `members`."""
    edges = crowds.select(F.explode(_forest(n_prints, limit, all_pairs)(F.col("members"))).alias("e"))
    return edges.select(F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b")).distinct()


def links(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that connect all of the distinct `node` fingerprints within `radius` bits of each other.

    `radius` is a multiple of 4, so that the share of half a half is whole.
    """
    if radius % 4:
        raise ValueError("the radius must be a multiple of 4")
    small, large = _met(nodes, ["node"], radius, crowd)
    crowds = small.groupBy("variant").agg(F.sort_array(F.collect_list("member")).alias("members"))
    edges = _edges(crowds, 1, radius, 2)
    whole = large.select("member.node").distinct().select("node", F.explode(F.transform(
        _ball(64, radius // 2), lambda m: F.col("node").bitwiseXOR(m))).alias("variant"))
    first = whole.groupBy("variant").agg(F.min("node").alias("a"))
    chains = whole.join(first, "variant").where("a < node").select("a", F.col("node").alias("b")).distinct()
    return edges.unionByName(chains)


def classes(docs: DataFrame, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; ids are longs.

    `component_id` is the smallest doc_id among all rows that are reachable
    through links, the row's own included.
    """
    marked = materialized(docs.select("doc_id", fingerprint(text).alias("node")), "fingerprints")
    nodes = marked.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    found = roots(links(nodes, radius))
    members = nodes.join(found, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    names = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(members.join(names, "root").select("node", "component_id"), "node").select(
        "doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component: that of its smallest doc_id.

    Of several rows of that id in the component the one with the smallest hash of the
    text stays.  Rows without an id cannot be told apart and stay.
    """
    found = materialized(classes(docs.where("doc_id is not null"), text, radius), "classes")
    stays = F.col("doc_id") == F.col("component_id")
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(stays).alias("kept"))
    single = docs.join(ids.where("kept = 0 or n > 1").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    several = materialized(ids.where("kept > 0 and n > 1").select("doc_id"), "repeated-ids")
    if several.isEmpty():
        return single
    # An id names its rows' component only in the one where it is the smallest.
    mark, order = fresh("near_copy_print", docs), fresh("copy_number", docs)
    own = found.where(stays).join(several, "doc_id", "left_semi").select(
        "doc_id", F.conv("fingerprint", 16, -10).cast("bigint").alias(mark)).distinct()
    rows = docs.join(several, "doc_id", "left_semi").withColumn(mark, fingerprint(text)).join(own, ["doc_id", mark], "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(F.col(text)), mark)
    chosen = rows.withColumn(order, F.row_number().over(first)).where(F.col(order) == 1)
    return single.unionByName(chosen.select(*docs.columns))
