"""Document fingerprints: 128-bit SimHash, and search by permuted block tables.

Terms are the words of a text and its pairs of neighbouring words, in lower case.
Every occurrence votes with the length of its term on 128 signed bits, those of
two 64-bit hashes; a bit of the fingerprint is the side with more weight.  Votes
are sums of long columns, two 32-bit counters in each, so that they stay in
generated code; weights of one text below 4 GiB cannot overflow them.  Votes add up:
the words that a text and its edited text begin with are counted once for both.

A search cuts fingerprints into `radius + 2` blocks.  Two fingerprints that differ
in at most `radius` bits agree in two blocks at least, so one table for each pair
of blocks, keyed by what the two hold, finds them all; candidates are verified on
all bits, and a pair counts in the first table where it agrees, and only there.

Everything is DataFrame functions.

Defined cases: a NULL text is empty; a text without words has fingerprint zero;
equal texts have equal fingerprints; rows without an id come after all others, in
the order of a hash of their text; rows that repeat an id come in that order too;
a single document is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketmill.llm.common import materialized

SPACES = "[\\x20\\x09-\\x0D]+"
BITS = 128
#: Differing bits within which a search finds fingerprints.
RADIUS = 4
#: Documents on average that are put in order by one group.
ROWS_OF_BLOCK = 1024

_LANES = 0x100000001
_LOW = 0xFFFFFFFF


def words(text: Column) -> Column:
    """Words of a text in lower case."""
    return F.array_remove(F.split(F.lower(text), SPACES), "")


def shared_start(text: Column, kept: Column) -> Column:
    """What lies before the last word, maybe a cut one, of the first `kept` characters of a text."""
    return F.regexp_extract(F.substring(text, F.lit(1), kept), f"(?s)^.*{SPACES[:-1]}", 0)


def _votes() -> list[Column]:
    """Weighted counts of every bit of both hashes, two to a sum, and the sum of weights."""
    lanes = []
    for h in ("0", "1"):
        for i in range(32):
            of_word, of_pair = [
                F.shiftrightunsigned(f"{kind}{h}", i).bitwiseAND(F.lit(_LANES)) * F.col(f"{kind}_weight")
                for kind in ("word", "pair")]
            lanes.append(F.sum(of_word + of_pair).alias(f"h{h}_{i}"))
    return [*lanes, F.sum(F.col("word_weight") + F.col("pair_weight")).alias("weights")]


def _voted(h: str) -> Column:
    """One 64-bit half of the fingerprint from the sums of `_votes`."""
    def bit(i: int) -> Column:
        lane = F.col(f"{h}_{i % 32}")
        count = lane.bitwiseAND(F.lit(_LOW)) if i < 32 else F.shiftrightunsigned(lane, 32)
        value = (1 << i) - (1 << 64 if i == 63 else 0)
        return F.when(2 * count > F.col("weights"), F.lit(value)).otherwise(F.lit(0)).cast("bigint")

    return reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(64)])


def votes(spoken: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, sums of `_votes`) of every row with `words` and `before`, the word ahead of them or NULL; keys tell rows apart.

    A word votes together with the pair that it ends.  A table that is already spread
    by some of the keys is not shuffled.
    """
    ahead = F.slice(F.concat(F.array("before"), "words"), F.lit(1), F.size("words"))
    placed = spoken.select(*keys, F.explode_outer(F.arrays_zip(ahead.alias("before"), F.col("words").alias("word"))).alias("t"))
    # A word without one ahead ends no pair; a text without words has one row with neither.
    said = placed.select(*keys, F.col("t.word").alias("word"), F.concat("t.before", F.lit(" "), "t.word").alias("pair"))
    hashed = said.select(*keys, *[
        column for kind in ("word", "pair") for column in (
            F.xxhash64(kind).alias(f"{kind}0"), F.xxhash64(F.lit(1), kind).alias(f"{kind}1"),
            F.coalesce(F.octet_length(kind), F.lit(0)).cast("bigint").alias(f"{kind}_weight"))])
    return hashed.groupBy(*keys).agg(*_votes())


def simhashes(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(*keys, f0, f1): the halves of the fingerprint of every row; keys tell rows apart."""
    spoken = texts.select(*keys, words(F.coalesce(text, F.lit(""))).alias("words"), F.lit(None).cast("string").alias("before"))
    return votes(spoken, keys).select(*keys, _voted("h0").alias("f0"), _voted("h1").alias("f1"))


def spelled(f0: str, f1: str) -> Column:
    """The fingerprint as 32 lowercase hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in (f0, f1)]))


def differing(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def likeness(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - differing(a0, a1, b0, b1) / F.lit(float(BITS))


def _cuts(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of n blocks of 128 bits, none of which crosses the middle."""
    low = n // 2
    found = []
    for start, count in ((0, low), (64, n - low)):
        edges = [start + 64 * i // count for i in range(count + 1)]
        found += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return found


def _blocks(f0: Column, f1: Column, radius: int) -> list[Column]:
    found = []
    for first, bits in _cuts(radius + 2):
        half = f0 if first < 64 else f1
        mask = (1 << bits) - 1 if bits < 64 else -1
        found.append(F.shiftrightunsigned(half, first % 64).bitwiseAND(F.lit(mask).cast("bigint")))
    return found


def _keyed(fps: DataFrame, radius: int, names: tuple[str, str]) -> DataFrame:
    """A row for each table: (*names, table, key)."""
    blocks = _blocks(F.col(names[0]), F.col(names[1]), radius)
    rows = [F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), blocks[i], blocks[j]).alias("key"))
            for t, (i, j) in enumerate(combinations(range(radius + 2), 2))]
    return fps.select(*names, F.explode(F.array(*rows)).alias("r")).select(*names, "r.table", "r.key")


def _first_table(radius: int, a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Number of the first table in which two fingerprints agree."""
    same = [x == y for x, y in zip(_blocks(*a, radius), _blocks(*b, radius), strict=True)]
    found = F.lit(None).cast("int")
    for t, (i, j) in reversed(list(enumerate(combinations(range(radius + 2), 2)))):
        found = F.when(same[i] & same[j], F.lit(t)).otherwise(found)
    return found


def search(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (q0, q1, f0, f1) of the distinct queries (q0, q1) and fingerprints within `radius` bits."""
    if radius < 1:
        raise ValueError("the radius must be at least 1")
    asked = _keyed(queries.select("q0", "q1").distinct(), radius, ("q0", "q1"))
    kept = _keyed(fps.select("f0", "f1").distinct(), radius, ("f0", "f1"))
    q, f = (F.col("q0"), F.col("q1")), (F.col("f0"), F.col("f1"))
    near = (differing(*q, *f) <= radius) & (_first_table(radius, q, f) == F.col("table"))
    return asked.join(kept.withColumnRenamed("table", "kept_table"), "key").where(
        (F.col("table") == F.col("kept_table")) & near).select("q0", "q1", "f0", "f1")


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with the `block` of consecutive ids they are ordered in; blocks descend with ids."""
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    groups = max(1, -(-n // ROWS_OF_BLOCK))
    width = float(max(1, -(-((high or 0) - (low or 0) + 1) // groups)))
    above = F.floor((F.lit(float(high or 0)) - F.col("doc_id").cast("double")) / width)
    nameless = F.lit(1 << 40) + F.pmod(F.xxhash64("text"), F.lit(groups))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "block", F.coalesce(above, nameless))


def with_next(docs: DataFrame) -> DataFrame:
    """(block, place, doc_id, text, next_text, last): documents and the next in descending order of ids.

    Texts are shuffled once, in blocks of ids; only the first document of each
    block is sent to the block before it.  `last` marks the last of a block.
    """
    blocked = _numbered(docs)
    order = Window.partitionBy("block").orderBy(
        F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    rows = blocked.select(
        "block", F.row_number().over(order).alias("place"), "doc_id", "text",
        F.lead("text").over(order).alias("following"))
    firsts = blocked.withColumn("place", F.row_number().over(order)).where("place = 1").select(
        F.col("block").alias("next_block"), F.col("text").alias("first_text"))
    # One row for each block: all documents divided by ROWS_OF_BLOCK.
    turn = Window.orderBy("block")
    blocks = blocked.select("block").distinct().select(
        "block", F.lead("block").over(turn).alias("next_block"),
        F.first("block").over(turn.rowsBetween(Window.unboundedPreceding, 0)).alias("first_block"))
    heads = blocks.select("block", F.coalesce("next_block", "first_block").alias("next_block")).join(
        firsts, "next_block").select(F.col("block").alias("head_block"), "first_text")
    last = F.col("following").isNull()
    return rows.join(heads, (F.col("block") == F.col("head_block")) & last, "left").select(
        "block", "place", "doc_id", "text", F.coalesce("following", "first_text").alias("next_text"),
        last.alias("last"))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by as many first characters of the next one."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(next_text, F.lit(1), third))


def compared(docs: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    `n_near`, for documents whose id is divisible by `every`, is the number of
    other documents with a fingerprint within `radius` bits.
    """
    rows = with_next(docs)
    changed = edited(F.col("text"), F.col("next_text"))
    keys = ["block", "place", "doc_id", "n_chars", "edited_sha256", "last"]
    n = F.char_length("text")
    cut = rows.withColumns({"changed": changed, "shared": shared_start(F.col("text"), n - F.floor(n / 3).cast("int"))})
    rest = F.char_length("shared") + 1
    spoken = cut.select(
        "block", "place", "doc_id", n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"), "last",
        words(F.col("shared")).alias("both"), words(F.substr("text", rest)).alias("own"),
        words(F.substr("changed", rest)).alias("new"), F.when(F.col("last"), words(F.col("next_text"))).alias("following"))
    ahead, nothing = F.get("both", F.size("both") - 1), F.lit(None).cast("string")
    # Both texts begin with the same words, which vote once for the two.
    parts = F.array(*[
        F.struct(F.lit(i).alias("part"), before.alias("before"), F.col(name).alias("words"))
        for i, (name, before) in enumerate([("both", nothing), ("own", ahead), ("new", ahead), ("following", nothing)])])
    spread = spoken.select(*keys, F.explode(F.filter(parts, lambda p: p["words"].isNotNull())).alias("p"))
    counted = votes(spread.select(*keys, "p.part", "p.before", "p.words"), [*keys, "part"])
    kinds = F.when(F.col("part") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.col("part") - 1))
    lanes = [c for c in counted.columns if c not in (*keys, "part")]
    prints = counted.select(*keys, F.explode(kinds).alias("kind"), *lanes).groupBy(*keys, "kind").agg(
        *[F.sum(c).alias(c) for c in lanes]).select(*keys, "kind", _voted("h0").alias("f0"), _voted("h1").alias("f1"))

    def of(kind: int, half: str, name: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(half))).alias(name)

    per_doc = prints.groupBy(*keys).agg(
        of(0, "f0", "f0"), of(0, "f1", "f1"), of(1, "f0", "e0"), of(1, "f1", "e1"), of(2, "f0", "n0"),
        of(2, "f1", "n1"))
    order = Window.partitionBy("block").orderBy("place")
    following = per_doc.select(
        "doc_id", "n_chars", "edited_sha256", "f0", "f1", "e0", "e1",
        F.coalesce("n0", F.lead("f0").over(order)).alias("n0"),
        F.coalesce("n1", F.lead("f1").over(order)).alias("n1"))
    found = materialized(following, "fingerprints")
    counts = found.groupBy("f0", "f1").agg(F.count("*").alias("n"))
    asked = found.where(F.col("doc_id") % every == 0).select(F.col("f0").alias("q0"), F.col("f1").alias("q1"))
    near = search(asked, counts, radius).join(counts, ["f0", "f1"]).groupBy("q0", "q1").agg(
        F.sum("n").alias("around")).select(F.col("q0").alias("f0"), F.col("q1").alias("f1"), "around")
    f, e, n = [(F.col(f"{c}0"), F.col(f"{c}1")) for c in "fen"]
    return found.join(near, ["f0", "f1"], "left").select(
        "doc_id", "n_chars", "edited_sha256", spelled("f0", "f1").alias("fingerprint"),
        spelled("e0", "e1").alias("edited_fingerprint"), likeness(*f, *e).alias("near_edited"),
        likeness(*f, *n).alias("near_next"),
        F.when(F.col("doc_id") % every == 0, F.col("around") - 1).alias("n_near"))
