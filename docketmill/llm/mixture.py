"""Mixing sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources that hold them).
Words flow from patterns to the quotas of their sources; a pattern can be taken
once for nothing, and every repetition costs more than the one before, so no
document is repeated while another could serve.  Within a pattern, every document
is taken as often as all of them can be, and the rest of the words come from the
documents with the smallest seeded hashes.

All sums are exact whole numbers and the hash depends on the seed, the id and the
text alone, so runs agree.  The hash cut of a pattern is found in two steps, by
sums of `BINS` hash ranges and then within one of them, so that no task orders
the documents of a large source.  What reaches the driver are sums by pattern.

Defined cases: a NULL text has no words: it adds nothing, and is taken as its hash says; a
NULL source is a source of its own, the last; rows that repeat an id and a text
have one hash and are taken together; an empty table gives no rows; the words
taken of a source differ from its target by less than one document.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketmill.llm.common import fresh, materialized

SEED = 7_919
WEIGHTS = (5.0, 2.0, 1.0)
#: Times a document is taken at most.
REPEATS = 3
#: Hash ranges of the first step, as a power of two.
BIN_BITS = 12
#: Membership patterns that the driver routes at most; more are an error.
MAX_PATTERNS = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS,
            total: float | None = None) -> dict[str | None, float]:
    """Target words by source: `total` shared by weight, at most `repeats` times a source's size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = float(sum(sizes.values()) if total is None else total)
    found: dict[str | None, float] = {}
    active = list(order)
    while active:
        shares = sum(weight[s] for s in active)
        over = [s for s in active if left * weight[s] / shares > repeats * sizes[s]]
        if not over:
            return found | {s: left * weight[s] / shares for s in active}
        for s in over:
            found[s] = float(repeats * sizes[s])
            active.remove(s)
        left -= sum(found[s] for s in over)
    return found


class _Flow:
    """Maximum flow by level graphs; arcs may be widened between runs."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        return len(self.to) - 2

    def _levels(self, start: int) -> list[int]:
        level = [-1] * len(self.out)
        level[start] = 0
        queue = deque([start])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def fill(self, start: int, end: int) -> None:
        while (level := self._levels(start))[end] >= 0:
            turn = [0] * len(self.out)
            path: list[int] = []
            at = start
            while True:
                if at == end:
                    pushed = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= pushed
                        self.room[e ^ 1] += pushed
                    cut = next(i for i, e in enumerate(path) if not self.room[e])
                    at = self.to[path[cut] ^ 1]
                    del path[cut:]
                elif turn[at] < len(self.out[at]):
                    e = self.out[at][turn[at]]
                    if self.room[e] and level[self.to[e]] == level[at] + 1:
                        path.append(e)
                        at = self.to[e]
                    else:
                        turn[at] += 1
                elif path:
                    e = path.pop()
                    at = self.to[e ^ 1]
                    turn[at] += 1
                else:
                    break


def route(patterns: dict[tuple, int], quotas: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple, int]:
    """Words to take from each pattern, at the least cost of repetitions.

    The k-th time costs more than the one before wherever it is used, and an
    augmenting path leaves the start only once.  So the shortest paths are those
    that use the first time until none is left, then the second, and so on.
    """
    names = list(patterns)
    sources = {s: len(names) + 1 + i for i, s in enumerate(quotas)}
    end = len(names) + len(sources) + 1
    flow = _Flow(end + 1)
    entry = {}
    for i, p in enumerate(names, 1):
        entry[p] = flow.arc(0, i, 0)
        for s in p:
            flow.arc(i, sources[s], repeats * patterns[p])
    for s, node in sources.items():
        flow.arc(node, end, quotas[s])
    for _ in range(repeats):
        for p in names:
            flow.room[entry[p]] += patterns[p]
        flow.fill(0, end)
    return {p: flow.room[entry[p] ^ 1] for p in names}


@dataclass
class Plan:
    """What to take: by pattern key, whole repetitions, the hash up to which documents are
    taken once more, and one hash beyond."""

    sizes: dict[str | None, int]
    targets: dict[str | None, float]
    takes: dict[str, tuple[int, int, int]]


def pattern_key(sources: Column) -> Column:
    """The set of sources as JSON text; NULL members stay."""
    return F.to_json(F.array_sort(F.array_distinct(sources)))


def draw(seed: int = SEED) -> Column:
    """Seeded hash of a document, from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)


def sized(docs: DataFrame, sources: Column, seed: int = SEED) -> DataFrame:
    """(doc_id, pattern, size, draw) of every document, written to the shared folder."""
    return materialized(docs.select(
        "doc_id", pattern_key(sources).alias("pattern"), n_words(F.col("text")).alias("size"),
        draw(seed).alias("draw")), "sizes")


def plan(marked: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS,
         total: float | None = None) -> Plan:
    """The plan for documents as `sized` gives them."""
    spark = marked.sparkSession
    sums = marked.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    members = {r["pattern"]: tuple(json.loads(r["pattern"])) for r in sums}
    size = {members[r["pattern"]]: r["size"] for r in sums}
    sizes: dict[str | None, int] = {}
    for p, n in sorted(size.items(), key=str):
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    words = sum(size.values()) if total is None else total
    goal = targets(sizes, weights, repeats, words)
    taken = route(dict(sorted(size.items(), key=str)), {s: round(t) for s, t in goal.items()}, repeats)
    whole = {key: min(repeats, taken[p] // size[p]) if size[p] else 0 for key, p in members.items()}
    rest = {key: taken[p] - whole[key] * size[p] for key, p in members.items()}
    cuts = _cuts(marked, spark.createDataFrame(
        [(k, n) for k, n in rest.items() if n > 0], "pattern string, rest bigint"))
    return Plan(sizes, goal, {key: (whole[key], *cuts.get(key, (-1, -1))) for key in members})


def _cuts(marked: DataFrame, rests: DataFrame) -> dict[str, tuple[int, int]]:
    """By pattern, the hash up to which documents make up the rest, and one hash beyond it.

    Collected is one row for each pattern at most.
    """
    bin_of = F.shiftright("draw", 63 - BIN_BITS)
    rests = F.broadcast(rests)  # at most MAX_PATTERNS rows
    draws = marked.groupBy("pattern", "draw").agg(F.sum("size").alias("size")).join(rests, "pattern")
    bins = marked.groupBy("pattern", bin_of.alias("bin")).agg(F.sum("size").alias("size")).join(rests, "pattern")
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("bin"))
    bins = bins.select("pattern", "bin", "rest", (upto - F.col("size")).alias("before"), "size")
    cut = bins.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("size")))
    cut = F.broadcast(cut.select("pattern", "bin", "before"))  # one row for each pattern
    inside = draws.withColumn("bin", bin_of).join(cut, ["pattern", "bin"])
    reached = F.sum("size").over(Window.partitionBy("pattern").orderBy("draw"))
    last = inside.withColumn("reached", F.col("before") + reached).where("reached <= rest").groupBy("pattern").agg(
        F.max("draw").alias("last"), F.max("reached").alias("reached"))
    below = F.shiftleft(F.col("bin"), 63 - BIN_BITS) - 1
    cuts = F.broadcast(cut.join(F.broadcast(last), "pattern", "left").select(  # one row for each pattern
        "pattern", F.coalesce("last", below).alias("cut"), F.coalesce("reached", "before").alias("reached")))
    gap = F.col("rest") - F.col("reached")
    beyond = draws.join(cuts, "pattern").where(F.col("draw") > F.col("cut")).withColumn(
        "off", F.abs(F.col("size") - gap)).where(F.col("off") < gap)
    more = beyond.groupBy("pattern").agg(F.min(F.struct("off", "draw")).alias("best"))
    found = cuts.join(F.broadcast(more), "pattern", "left").select(
        "pattern", "cut", F.coalesce("best.draw", F.lit(-1)).alias("more"))
    return {r["pattern"]: (r["cut"], r["more"]) for r in found.collect()}


def _takes(docs: DataFrame, plan: Plan, names: Sequence[str]) -> DataFrame:
    rows = [(key, *take) for key, take in plan.takes.items()]
    key, n, cut, more = names
    return F.broadcast(docs.sparkSession.createDataFrame(  # at most MAX_PATTERNS rows
        rows, f"`{key}` string, `{n}` int, `{cut}` bigint, `{more}` bigint"))


def _times(hash_of: Column, names: Sequence[str]) -> Column:
    _, n, cut, more = names
    return F.col(n) + ((hash_of <= F.col(cut)) | (hash_of == F.col(more))).cast("int")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document with one source."""
    marked = sized(docs, F.array(F.col(source).cast("string")))
    found = plan(marked, weights)
    rows = [(key, found.sizes[s], found.targets[s]) for key in found.takes for s in json.loads(key)]
    goals = F.broadcast(docs.sparkSession.createDataFrame(rows, "pattern string, source_size bigint, target double"))
    names = ("pattern", "whole", "cut", "more")
    return marked.join(goals, "pattern").join(_takes(marked, found, names), "pattern").select(
        "doc_id", "size", "source_size", "target",
        (_times(F.col("draw"), names) * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, sources: Column, weights: Sequence[float] = WEIGHTS,
             total: float | None = None) -> DataFrame:
    """The documents of the mix, each as many times as it is taken."""
    found = plan(sized(docs, sources), weights, total=total)
    names = [fresh(n, docs) for n in ("mix_pattern", "mix_whole", "mix_cut", "mix_more")]
    spread = docs.withColumn(names[0], pattern_key(sources)).join(_takes(docs, found, names), names[0])
    copies = F.explode(F.array_repeat(F.lit(0), _times(draw(), names)))
    return spread.select(*docs.columns, copies.alias(names[0])).select(*docs.columns)
