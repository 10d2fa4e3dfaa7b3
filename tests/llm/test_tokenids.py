import heapq
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docketmill.llm import huffman as H
from docketmill.llm import tokenids as K
from docketmill.llm.common import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é '\n\t .1<|endoftext|>    ᠎🙂ß")), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(text):
    found = K.PieceEncoder(PATH, "<u2").encode([text, text + "<|endoftext|> a  b"])
    assert [np.frombuffer(f, "<u2").tolist() for f in found] == [ids_of(text), ids_of(text + "<|endoftext|> a  b")]


def test_long_and_strange_pieces_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(K, "SLOTS", 8)
    monkeypatch.setattr(K, "MEMORY", 3)
    monkeypatch.setattr(K, "POOL_IDS", 50)
    encoder = K.PieceEncoder(PATH, "<u2")
    texts = ["", "a", "zero\0byte and\0 more", "sixteen_bytes_ab sixteen_bytes_abc seventeen_bytes_abcd", "x" * 70000 + " end",
             "naïve\xa0space  two", "same same same", "line\nbreak\n\nand,more!\n", " leads", "trails ", "\t", "word," * 40]
    texts += [f"w{i} Wort{i} x{i}," for i in range(200)]
    for _ in range(2):
        got = [np.frombuffer(f, "<u2").tolist() for f in encoder.encode(texts)]
        assert got == [ids_of(t) for t in texts]


def test_the_table_finds_what_it_holds_and_nothing_else():
    random = np.random.default_rng(2)
    low, high = random.integers(1, 1 << 60, (2, 3000), dtype=np.uint64)
    table = K._Table(1 << 13)
    place = np.arange(1, 3001, dtype=np.uint64)
    for part in np.array_split(np.arange(3000), 7):
        table.add(low[part], high[part], place[part])
    found = table.find(low, high)
    assert ((found == place) | (found == 0)).all() and (found == place).mean() > 0.99
    assert not table.find(low + np.uint64(1), high).any()
    table.add(*random.integers(1, 1 << 60, (2, 20000), dtype=np.uint64), np.full(20000, 7, dtype=np.uint64))
    found = table.find(low, high)
    assert ((found == place) | (found == 0)).all()


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=120), st.integers(0, 5))
def test_codes_are_a_least_prefix_code(counts, seed):
    counts = np.array(counts)
    used = counts[counts > 0]
    lengths = H.code_lengths(counts)
    assert ((lengths > 0) == (counts > 0)).all()
    if len(used) > 1:
        assert sum(2.0 ** -int(n) for n in lengths[lengths > 0]) == 1
        if lengths.max() < H.MAX_BITS:
            assert (lengths * counts).sum() == huffman_cost(used.tolist())
    ids = np.random.default_rng(seed).choice(np.flatnonzero(counts), 700) if len(used) else np.empty(0, np.int64)
    bounds = np.array([0, 0, len(ids) // 3, len(ids)])
    raw, edges, marks = H.encode(ids, bounds, lengths, H.codes(lengths))
    sizes = [n for s, e in zip(bounds, bounds[1:]) for n in [H.MARK_EVERY] * ((e - s) // H.MARK_EVERY) + (
        [(e - s) % H.MARK_EVERY] if (e - s) % H.MARK_EVERY else [])]
    offsets = np.concatenate([m.astype(np.int64) + 8 * s for m, s in zip(marks, edges)])
    assert (H.decode(raw, offsets, np.array(sizes, dtype=np.int64), H.decoding_table(lengths)) == ids).all()


def test_length_limit():
    counts = np.array([1 << i for i in range(40)])
    lengths = H.code_lengths(counts)
    assert lengths.max() == H.MAX_BITS and sum(2.0 ** -int(n) for n in lengths) <= 1
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(9), 3)


def expected(rows):
    found, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = np.array(ids_of(text), dtype="<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_round_trip(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(K, "PART_IDS", 20_000)  # several parts
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    got = K.round_trip(sf_docs, PATH)
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_files_hold_the_ids(spark):
    rows = [(5, "five words are in here"), (1, None), (3, ""), (-2, "x " * 900), (None, "last")]
    path = new_path(spark, "ids") + uuid.uuid4().hex
    K.write_ids(spark.createDataFrame(rows, "doc_id bigint, text string"), path, PATH)
    got = {r["doc_id"]: (r["start"], r["ids"]) for r in K.read_ids(spark, path).collect()}
    assert got == {i: (start, ids_of(dict(rows)[i])) for i, start, _, _ in expected(rows)}


def test_odd_rows(odd_docs, no_docs, odd_rows):
    got = sorted(map(tuple, K.round_trip(odd_docs, PATH).collect()), key=lambda r: r[1])
    named = [r for r in odd_rows if r[0] is not None]
    assert got[: len(named)] == expected(named)
    assert sorted(r[2:] for r in got[len(named) :]) == sorted(
        r[2:] for r in expected([r for r in odd_rows if r[0] is None]))
    assert K.round_trip(no_docs, PATH).collect() == []


def test_ids_are_counted_a_few_rows_at_a_time(spark):
    """A batch of any size is counted by pieces, whose ids alone are widened."""
    rows = [np.full(1 + i % 3, i % 7, dtype="<u2").tobytes() for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])
    pieces = list(K._slices(batch))
    assert [p.num_rows for p in pieces] == [256, 256, 256, 232]
    joined = b"".join(rows)
    found = [K._runs(p.column(0), "<u2") for p in pieces]
    assert np.concatenate([ids for ids, _ in found]).tolist() == np.frombuffer(joined, "<u2").tolist()
    assert np.concatenate([np.diff(bounds) for _, bounds in found]).tolist() == [1 + i % 3 for i in range(1000)]
    counted = K._counts(spark.createDataFrame([(r,) for r in rows], "ids binary"), "<u2")
    assert counted.tolist() == np.bincount(np.frombuffer(joined, "<u2")).tolist()
    empty = spark.createDataFrame([], "ids binary")
    assert K._counts(empty, "<u2").tolist() == [0]


def test_a_worker_gives_back_the_encoder_when_it_counts(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([b"\1\0"], pa.binary())], ["ids"])

    class InThisProcess:
        def select(self, *names):
            return self

        def mapInArrow(self, count, schema):
            assert K._encoders
            assert [b.num_rows for b in count(iter([batch]))] == [1]
            return spark.createDataFrame([(1, 1)], schema)

    K.encoder(PATH, "<u2")
    assert K._counts(InThisProcess(), "<u2").tolist() == [0, 1]
    assert not K._encoders
