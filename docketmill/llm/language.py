"""Language identification by cross-parsing with suffix automata.

Labelled text of each language is a suffix automaton.  A text is parsed against
it from left to right into the longest pieces that occur in it; the language that
needs the fewest pieces, normalised by the length of its text, is the language.

Every language has letter classes of its own, one for each letter of its sample and
one for all others, which have no arc.  An automaton is kept as a table of (state,
letter class) -> next state, in which a step that has no arc ends the piece and
begins the next at the root; of a language with so many letters that the table
would pass its part of `DENSE_CELLS`, only the arcs are kept, in order, and searched.
Both give the same steps, and thousands of stretches of text take them together.  Texts are parsed in stretches of `STRETCH` characters that begin
at the root, each for itself; nothing is left out.

Letters are compared in lower case; anything but letters is one class, and runs
of it one character.  Each language is learned from `SAMPLE_CHARS` characters, or all
it has, taken from its labelled documents in the order of a hash of id and text: a
piece of `PIECE_CHARS` from a hashed place of each, and as many documents as it takes.

Defined cases: a NULL text and a text without letters have language `und` and
score 0; labels that are NULL and ids that are NULL are not learned from; equal
counts go to the language that sorts first; repeated rows get equal results;
without labelled text everything is `und`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketmill.llm.common import crc_of_id

SAMPLE_CHARS = 1 << 16
PIECE_CHARS = 4_096
#: Languages that can be told apart at most; their tables are held by every task.
MAX_LANGUAGES = 64
#: Cells of the tables of all languages together; no result depends on it.
DENSE_CELLS = 1 << 25
STRETCH = 512
#: Characters parsed at once.
BATCH_CHARS = 1 << 20
UNKNOWN = "und"
SEED = 15_485_863

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters of a text, with one space for each run of anything else."""
    return _NO_LETTERS.sub(" ", text).lower()


@dataclass
class Model:
    """Steps of one automaton: state * width + class -> next state, or -1 - state if a piece begins.

    `classes` has the letter class by code point; the last entry, for all beyond, and
    that of other letters is 0.  Without `keys` the steps are the whole table; with
    them those of the arcs in the order of the keys, and `restart` has the others.
    """

    classes: np.ndarray
    width: int
    steps: np.ndarray
    keys: np.ndarray | None = None
    restart: np.ndarray | None = None

    def next(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        if self.keys is None:
            return self.steps[state * self.width + symbols]
        wanted = state.astype(np.int64) * self.width + symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.steps[at], self.restart[symbols])


@dataclass
class Models:
    """The automata of all languages."""

    languages: list[str]
    automata: list[Model]
    bits: np.ndarray  # bits that name a place in the text of a language


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Arcs of every state of the automaton of all substrings; state 0 is the root."""
    arcs: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p >= 0:
            q = arcs[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(arcs)
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and arcs[p].get(c) == q:
                    arcs[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return arcs


def _model(text: str, cells: int) -> Model:
    """The automaton of a text, as a table if it has at most so many cells."""
    known = {c: i for i, c in enumerate(sorted(set(text)), 1)}
    by_code = np.zeros(max(map(ord, known)) + 2, dtype=np.int32)
    for c, i in known.items():
        by_code[ord(c)] = i
    width = len(known) + 1
    arcs = suffix_automaton([known[c] for c in text])
    restart = np.array([-1 - arcs[0].get(c, 0) for c in range(width)], dtype=np.int32)
    if len(arcs) * width <= cells:
        table = np.tile(restart, (len(arcs), 1))
        for state, out in enumerate(arcs):
            if state and out:
                table[state, list(out)] = list(out.values())
        return Model(by_code, width, table.ravel())
    # Steps from the root begin a piece, so its arcs are in `restart` alone.
    found = sorted((state * width + c, to) for state, out in enumerate(arcs) if state for c, to in out.items())
    keys, steps = np.array(found or [(-1, 0)], dtype=np.int64).T
    return Model(by_code, width, steps.astype(np.int32), np.ascontiguousarray(keys), restart)


def build(samples: dict[str, str], cells: int = DENSE_CELLS) -> Models:
    """Models of the sample text of every language."""
    clean = {lang: letters(text) for lang, text in sorted(samples.items())}
    clean = {lang: text for lang, text in clean.items() if text.strip()}
    return Models(
        list(clean), [_model(text, cells // len(clean)) for text in clean.values()],
        np.array([math.log2(len(text) + 1) for text in clean.values()]))


def pieces(texts: list[str], models: Models) -> np.ndarray:
    """Number of pieces of every text (as `letters` gives it) for every language."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lanes = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(texts)), lanes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    starts = np.repeat(np.cumsum(lengths) - lengths, lanes) + place * STRETCH
    sizes = np.minimum(STRETCH, np.repeat(lengths, lanes) - place * STRETCH)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, owner = starts[order], sizes[order], owner[order]
    grid = np.zeros((STRETCH, len(starts)), dtype=np.uint32)
    live = [int(n) for n in np.searchsorted(-sizes, -np.arange(STRETCH), side="left")]
    for step, n in enumerate(live):
        grid[step, :n] = codes[starts[:n] + step]
    found = np.zeros((len(texts), len(models.automata)))
    for k, model in enumerate(models.automata):
        symbols = model.classes[np.minimum(grid, len(model.classes) - 1)]
        state = np.zeros(len(starts), dtype=np.int32)
        begun = np.zeros(len(starts), dtype=np.int32)
        for step, n in enumerate(live):
            if not n:
                break
            to = model.next(state[:n], symbols[step, :n])
            new = to < 0
            begun[:n] += new
            state[:n] = np.where(new, -1 - to, to)
        found[:, k] = np.bincount(owner, weights=begun, minlength=len(texts))
    return found


def predict(texts: list[str | None], models: Models) -> tuple[list[str], np.ndarray]:
    """Language and score of every text.

    The score is the share of the best language if every bit it saves on a
    character, against another, doubles the odds a character.
    """
    clean = [letters(t or "") for t in texts]
    lengths = np.array([len(t) - t.count(" ") for t in clean])
    known = (lengths > 0) & bool(models.languages)
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = np.flatnonzero(known)
    at = 0
    while at < len(rows):
        end, chars = at, 0
        while end < len(rows) and (end == at or chars + len(clean[rows[end]]) <= BATCH_CHARS):
            chars += len(clean[rows[end]])
            end += 1
        part = rows[at:end]
        rate = pieces([clean[i] for i in part], models) * models.bits / lengths[part][:, None]
        best = np.argmin(rate, axis=1)
        scores[part] = 1 / np.exp2((rate.min(axis=1)[:, None] - rate) * 8).sum(axis=1)
        for i, b in zip(part.tolist(), best.tolist(), strict=True):
            names[i] = models.languages[b]
        at = end
    return names, scores


def sample(docs: DataFrame, learn: Column, lang: str = "lang") -> dict[str, str]:
    """Sample text of each language; collected is about twice `SAMPLE_CHARS` of each.

    Documents below a share of the hashes are taken, at first as many as should give
    twice the characters, and twice as many while a language has too few.
    """
    labelled = docs.where(learn & F.col("doc_id").isNotNull() & (F.char_length("text") > 0) & F.col(lang).isNotNull())
    hashes = F.xxhash64(F.lit(SEED), "doc_id", "text")
    room = F.greatest(F.char_length("text") - PIECE_CHARS, F.lit(0)) + 1
    drawn = labelled.select(
        F.col(lang).cast("string").alias("lang"), hashes.alias("h"),
        F.substring("text", F.pmod(F.xxhash64(hashes), room).cast("int") + 1, F.lit(PIECE_CHARS)).alias("piece"))
    totals = labelled.groupBy(F.col(lang).cast("string").alias("lang")).agg(
        F.sum(F.least(F.char_length("text"), F.lit(PIECE_CHARS))).alias("chars")).orderBy("lang")
    names = totals.limit(MAX_LANGUAGES + 1).collect()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = {r["lang"]: 2 * SAMPLE_CHARS / r["chars"] for r in names}
    found: dict[str, str] = {}
    while shares:
        below = F.create_map(*[F.lit(x) for name, share in shares.items() for x in (
            name, int(min(share, 1.0) * (1 << 53)))])[F.col("lang")]
        # The upper 53 bits of the hash; a text that repeats with its id is learned once.
        taken = drawn.where(F.shiftrightunsigned("h", 11) < below).dropDuplicates(["lang", "h"])
        texts: dict[str, list[str]] = {}
        for r in sorted(taken.collect(), key=lambda r: (r["lang"], r["h"])):
            texts.setdefault(r["lang"], []).append(r["piece"])
        for name, share in list(shares.items()):
            parts = texts.get(name, [])
            if share >= 1 or sum(map(len, parts)) >= SAMPLE_CHARS:
                found[name] = "\n".join(parts)[:SAMPLE_CHARS]
                del shares[name]
            else:
                shares[name] = 2 * share
    return found


RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def identified(models: Models, text: str = "text") -> Column:
    """struct(lang_pred, score) of a text column."""
    sent = SparkSession.active().sparkContext.broadcast(models)  # bounded by MAX_LANGUAGES and SAMPLE_CHARS

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for texts in batches:
            names, scores = predict(texts.to_pylist(), known)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], fields=list(RESULT))

    return identify(F.col(text).cast("string"))


def held_out() -> Column:
    return crc_of_id() % 4 == 2


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from those not held out."""
    models = build(sample(docs, ~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), identified(models).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")
