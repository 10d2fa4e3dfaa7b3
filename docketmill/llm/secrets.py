"""Secret scans: patterns, and character Markov models of random strings and identifiers.

Three pattern kinds give base spans.  Beyond them, runs of at least `MIN_RUN` key
characters that hold a letter and touch no base span are scored: the log of how
much likelier a first-order Markov model of random strings makes the run than one
of ordinary identifiers.  Runs at or above `THRESHOLD` are spans of kind `model`.

The models are learned from labelled samples of about `SAMPLE_DOCS` documents:
random strings are what the patterns match there and seeded digests of the ids in
their usual spellings, identifiers are all other runs.  What is collected are
counts of character pairs, at most the square of the alphabet for each model.

Everything is DataFrame functions.  Positions come from the text between matches:
`split` and `regexp_extract_all` cut a text into the same pieces, whose lengths
are summed.

Defined cases: a NULL text is empty and has no spans; rows are scanned one by one,
so repeated rows get equal results and ids may be NULL; without documents there is
nothing to learn, and no run reaches the threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pattern kinds in their order, the group that is measured, and its least length.
KINDS = (
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
MODEL_KIND = "model"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]"
MIN_RUN = 16
#: Shortest run that is learned from.
MIN_LEARNED = 4
#: Log-likelihood ratio of a secret: random strings are about one run in ten thousand.
THRESHOLD = math.log(1e5)
SAMPLE_DOCS = 4_000
SEED = 104_729

_SPAN = "struct<start: int, kind_no: int, stop: int, kind: string, value: string>"


def _matches(text: Column, kind_no: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of all matches of a pattern whose measured group is long enough."""
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    none = F.array().cast(f"array<{_SPAN}>")

    def add(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.char_length(z["piece"])
        stop = start + F.char_length(z["whole"])
        span = F.struct(
            start.alias("start"), F.lit(kind_no).alias("kind_no"), stop.alias("stop"), F.lit(kind).alias("kind"),
            z["value"].alias("value"))
        kept = F.when(F.char_length(z["value"]) >= least, F.array(span)).otherwise(none)
        return F.struct(stop.alias("at"), F.concat(acc["spans"], kept).alias("spans"))

    zipped = F.arrays_zip(
        F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"), whole.alias("whole"), measured.alias("value"))
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    # Most texts have no match: one search tells, and nothing else is done.
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(zipped, start, add)["spans"]).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the pattern kinds, by start and kind."""
    found = [_matches(text, i, *kind) for i, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _place(run: Column, i: Column) -> Column:
    """Place of a character of a run in the alphabet, from 0."""
    return F.position(F.substring(run, i, F.lit(1)), F.lit(ALPHABET)) - 1


def _pairs(run: Column) -> Column:
    """Numbers of the neighbouring character pairs of a run."""
    return F.transform(
        F.sequence(F.lit(2), F.char_length(run)),
        lambda i: _place(run, i - 1) * len(ALPHABET) + _place(run, i))


@dataclass
class Model:
    """Log-likelihood ratio of every pair of characters, by pair number."""

    ratios: list[float]

    def score(self, run: Column) -> Column:
        """Log of how much likelier a run is random than ordinary."""
        table = F.split(F.lit(",".join(repr(r) for r in self.ratios)), ",").cast("array<double>")
        return F.aggregate(_pairs(run), F.lit(0.0), lambda a, p: a + F.get(table, p))


def samples(docs: DataFrame, size: int = SAMPLE_DOCS, seed: int = SEED) -> DataFrame:
    """(run, random): labelled runs of about `size` documents, picked by a hash of the id."""
    n = docs.count()
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(max(1, n // size))) == 0)
    text = F.col("text")
    digest = F.unhex(F.sha2(F.concat_ws(":", F.lit(str(seed)), "doc_id").cast("binary"), 256))
    base64 = F.base64(digest)
    made = F.array(
        base64, F.translate(base64, "+/", "-_"), F.translate(base64, "+/=", ""), F.lower(F.hex(digest)),
        F.hex(digest))
    matched = F.transform(base_spans(text), lambda s: s["value"])
    rest = text
    for _, pattern, _, _ in KINDS:
        rest = F.regexp_replace(rest, F.lit(pattern), F.lit(" "))
    ordinary = F.regexp_extract_all(rest, F.lit(RUN + "{%d,}" % MIN_LEARNED), F.lit(0))
    random = F.filter(F.concat(made, matched), lambda r: F.regexp_like(r, F.lit("^" + RUN + "{%d,}$" % MIN_LEARNED)))
    both = F.concat(
        F.transform(random, lambda r: F.struct(r.alias("run"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda r: F.struct(r.alias("run"), F.lit(False).alias("random"))))
    return picked.select(F.explode(both).alias("s")).select("s.run", "s.random")


def learn(runs: DataFrame) -> Model:
    """Pair models of both labels with one added to every count, as ratios."""
    k = len(ALPHABET)
    counts = {True: [1.0] * (k * k), False: [1.0] * (k * k)}
    found = runs.select("random", F.explode(_pairs(F.col("run"))).alias("pair")).groupBy("random", "pair").count()
    for r in found.collect():  # at most 2 * k * k rows
        counts[r["random"]][r["pair"]] += r["count"]

    def logs(n: list[float]) -> list[float]:
        totals = [sum(n[a * k : (a + 1) * k]) for a in range(k)]
        return [math.log(n[p] / totals[p // k]) for p in range(k * k)]

    return Model([a - b for a, b in zip(logs(counts[True]), logs(counts[False]), strict=True)])


def model_spans(text: Column, base: Column, model: Model) -> Column:
    """Spans of the runs that the model takes for random and that touch no base span."""
    pattern = "(?=[0-9+/_=-]*[A-Za-z])" + RUN + "{%d,}" % MIN_RUN
    runs = _matches(text, len(KINDS), MODEL_KIND, pattern, 0, MIN_RUN)
    return F.filter(runs, lambda r: ~F.exists(
        base, lambda b: (b["start"] < r["stop"]) & (r["start"] < b["stop"])) & (
        model.score(r["value"]) >= THRESHOLD))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, numbers of base spans, their digest, and all spans of every document."""
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = found.withColumn("base", base_spans(F.col("text")))
    found = found.withColumn("all", F.array_sort(F.concat("base", model_spans(F.col("text"), F.col("base"), model))))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind, *_ in KINDS],
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("all")).alias("spans"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """`scan` with models learned from the documents themselves."""
    return scan(docs, learn(samples(docs)))
