import random
import re

import pytest
from pyspark.sql import functions as F

from docketmill.llm import mixture as M


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return fixed | share
        fixed |= over


def test_mix_of_the_documents(spark, sf_docs):
    texts = {r["doc_id"]: r for r in sf_docs.collect()}
    rows = M.mixed(sf_docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sizes = {}
    for r in texts.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    goal, taken = brute_targets(sizes), {}
    largest = {}
    for r in rows:
        source = texts[r["doc_id"]]["source"]
        assert r["size"] == size(texts[r["doc_id"]]["text"]) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(goal[source]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        largest[source] = max(largest.get(source, 0), r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
    assert sorted(map(tuple, M.mixed(sf_docs.repartition(7)).collect())) == sorted(map(tuple, rows))


def test_targets_stop_at_three_times_the_size():
    sizes = {"a": 1, "b": 100, None: 10, "c": 0, "d": 500}
    assert M.targets(sizes) == pytest.approx(brute_targets(sizes))
    assert M.targets({}) == {} and M.targets({"a": 0}) == {"a": 0.0}


def brute_cost(patterns, quotas, repeats=3):
    """Greatest flow and its least cost, by successive shortest paths over unit words."""
    flow = {p: {s: 0 for s in p} for p in patterns}
    total = cost = 0
    while True:
        best = {}  # shortest path from the start to each pattern and source
        for p, n in patterns.items():
            used = sum(flow[p].values())
            if used < repeats * n:
                best["p", p] = (used // n, None)
        changed = True
        while changed:
            changed = False
            for p in patterns:
                for s in p:
                    if ("p", p) in best and best["p", p][0] < best.get(("s", s), (1e9,))[0]:
                        best["s", s], changed = (best["p", p][0], ("p", p)), True
                    if ("s", s) in best and flow[p][s] and best["s", s][0] < best.get(("p", p), (1e9,))[0]:
                        best["p", p], changed = (best["s", s][0], ("s", s)), True
        ends = [(best["s", s][0], s) for s in quotas if ("s", s) in best and sum(
            f.get(s, 0) for f in flow.values()) < quotas[s]]
        if not ends:
            return total, cost
        price, s = min(ends)
        node = ("s", s)
        while node is not None:
            before = best[node][1]
            if before and node[0] == "s":
                flow[before[1]][node[1]] += 1
            elif before:
                flow[node[1]][before[1]] -= 1
            node = before
        total, cost = total + 1, cost + price


@pytest.mark.parametrize("seed", range(8))
def test_flow_has_the_least_cost(seed):
    random.seed(seed)
    names = ["a", "b", "c", "d"]
    patterns = {}
    for _ in range(5):
        patterns[tuple(sorted(random.sample(names, random.randint(1, 3))))] = random.randint(1, 6)
    quotas = {s: random.randint(0, 14) for s in names}
    taken = M.route(patterns, quotas)
    assert all(0 <= taken[p] <= 3 * n for p, n in patterns.items())
    cost = sum(sum(min(n, max(0, taken[p] - k * n)) * k for k in range(3)) for p, n in patterns.items())
    assert (sum(taken.values()), cost) == brute_cost(patterns, quotas)


def test_overlapping_sources_share_what_they_hold(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held array<string>")
    plan = M.plan(M.sized(docs, F.col("held")), weights=(1.0, 1.0), total=2000)
    assert plan.sizes == {"a": 2000, "b": 1000} and plan.targets == {"a": 1000.0, "b": 1000.0}
    assert {k: v[0] for k, v in plan.takes.items()} == {'["a"]': 1, '["a","b"]': 1}  # nothing is repeated
    assert M.repeated(docs, F.col("held"), (1.0, 1.0), 2000).count() == 200


def test_odd_rows(odd_docs, no_docs):
    rows = M.mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    again = M.repeated(odd_docs, F.array("source"))
    assert again.columns == odd_docs.columns and again.count() >= 1
    assert M.mixed(no_docs).collect() == [] and M.repeated(no_docs, F.array("source")).collect() == []
