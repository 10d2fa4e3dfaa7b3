"""Token ids of documents in Huffman-coded files, and back.

Texts are tokenized once, with an end id after each document; counts of all ids
give one canonical code of at most 16 bits.  The files are a Parquet table
`blocks` and a Parquet table `codebook` (id, length) in one folder.  A block has
whole documents in ascending order of their ids and can be decoded by itself:

    part, block   range of document ids, and place within it
    first         ids before the block in its part
    doc_ids       ids of its documents
    counts        ids of each document, the end id included
    bits          codes, most significant bit first; a document starts at a byte
    starts        byte at which each document starts
    marks         little-endian 32-bit offsets from its document's first bit, of
                  every 256th id of each document

Marks let a reader decode stretches of 256 ids side by side, through a table
that gives the id and the code length for the next 16 bits.

Texts are cut before single spaces, where the tokenizer's own pattern always
ends a piece, and each distinct piece is encoded once in a while; so the ids are
those of the whole text.  The pieces of a block of texts are looked up together, as
numbers made of their bytes, in a table that a worker keeps from task to task.
Only byte-level BPE files are taken.

Defined cases: a NULL or empty text has only the end id; documents without an id
come last; rows that repeat an id keep one another's neighbourhood and come in
the order of a hash of their codes; an empty table gives empty files.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketmill.llm import arrowtext as A
from docketmill.llm import huffman as H
from docketmill.llm.common import materialized, new_path

#: Id after each document.
END = 0
#: Ids of a part of the files on average, and of a block at least.
PART_IDS = 1 << 22
BLOCK_IDS = 1 << 16
#: Pieces of up to 16 bytes whose ids a process remembers at most, and longer ones.
SLOTS = 1 << 21
MEMORY = 50_000
#: Slots of the table that a piece can be in, and ids in the pool behind it before both are emptied.
_WAYS = 8
POOL_IDS = 1 << 23
#: Bits of a place that hold the number of ids; the others hold where they begin.
_COUNT = 32

#: A space after a character that no tokenizer takes for white space.
_CUT = re.compile("(?<=[^\\s\u180e\ufeff\u200b]) ")
#: UTF-8 bytes without which the only white space is a space or a line feed; so no text with a zero is plain.
_RARE = A.byte_class((0x00, 0x00), (0x09, 0x09), (0x0B, 0x1F), (0xC2, 0xC2), (0xE1, 0xE3), (0xEF, 0xEF))
#: Letters that every edition of the tables calls so, and ASCII signs but the apostrophe.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ſ]+").fullmatch
_FEED = "\n"
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")

BLOCK_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("bits", T.BinaryType()), T.StructField("marks", T.BinaryType())])


def _low_bytes() -> np.ndarray:
    """Masks of the lowest 0 to 8 bytes of a number."""
    return np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


class _Table:
    """Places in a pool by pieces of 1 to 16 bytes, none of them zero; a piece is the two numbers its bytes make.

    A piece lies in one of `_WAYS` neighbouring slots.  Where all are taken, the
    newer one takes the first of them; the older is then simply unknown.
    """

    def __init__(self, slots: int):
        self.mask = np.uint64(slots - 1)
        self.low, self.high, self.place = (np.zeros(slots + _WAYS, dtype=np.uint64) for _ in range(3))

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (A.mixed(low ^ A.mixed(high)) & self.mask).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The pieces' places, 0 for those that are not known."""
        found = np.zeros(len(low), dtype=np.uint64)
        at, slot = np.arange(len(low)), self._slots(low, high)
        for _ in range(_WAYS):
            same = (self.low[slot] == low[at]) & (self.high[slot] == high[at])
            found[at[same]] = self.place[slot[same]]
            others = ~same & (self.low[slot] != 0)
            at, slot = at[others], slot[others] + 1
            if not len(at):
                break
        return found

    def add(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> None:
        """Distinct pieces that are not in the table."""
        home = self._slots(low, high)
        at, slot = np.arange(len(low)), home
        for way in range(_WAYS + 1):
            if way == _WAYS:
                slot = home[at]
                free = np.ones(len(at), dtype=bool)
            else:
                free = self.low[slot] == 0
            # Of several pieces that want a slot the last one gets it, as numpy assigns in order.
            some = np.flatnonzero(free)
            for column, values in ((self.low, low), (self.high, high), (self.place, place)):
                column[slot[some]] = values[at[some]]
            left = ~((self.low[slot] == low[at]) & (self.high[slot] == high[at]))
            at, slot = at[left], slot[left] + 1
            if not len(at):
                break


class PieceEncoder:
    """Ids of texts as bytes of `dtype`, through a memory of pieces.

    A piece that is a word of Latin letters and the signs after it is two pieces of
    the tokenizer's pattern, which go to its model one by one; any other piece
    goes through the whole tokenizer.  A line feed between two words is a piece too.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        if not _is_byte_level(self.tokenizer):
            raise ValueError("only byte-level BPE tokenizers cut texts before single spaces")
        self.letters = _byte_letters()
        self.masks = _low_bytes()
        self.dtype = np.dtype(dtype)
        self.signs: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.table = _Table(SLOTS)
        self.long: dict[bytes, int] = {}
        # The pool begins with the end id; a place is where its ids begin, and their number in the low bits.
        self.pool, self.filled = np.full(1 << 16, END, dtype=self.dtype), 1

    def _part(self, part: str) -> list[int]:
        spelled = part.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.tokenize(spelled)]

    def _ids(self, piece: str) -> list[int]:
        line, feed, others = piece.partition("\n")
        if feed and line.strip() and others.strip() == others and line.rstrip() == line and others:
            return self._ids(line) + self._sign(_FEED) + self._ids(others)
        word = piece.rstrip(_SIGNS)
        bare = word.removeprefix(" ")
        if not (bare.isalpha() and (bare.isascii() or _LETTERS(bare))):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        signs = piece[len(word) :]
        return self._part(word) + (self._sign(signs) if signs else [])

    def _sign(self, signs: str) -> list[int]:
        found = self.signs.get(signs)
        if found is None:
            if len(self.signs) >= MEMORY:
                self.signs.clear()
            found = self.signs[signs] = self._part(signs)
        return found

    def _keep(self, piece: bytes) -> int:
        """Encode a piece; its place in the pool."""
        ids = self._ids(piece.decode())
        n = len(ids)
        while self.filled + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.filled : self.filled + n] = ids
        self.filled += n
        return (self.filled - n) << _COUNT | n

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of all pieces of a block, encoding those that are not known."""
        if self.filled >= POOL_IDS or len(self.long) >= MEMORY:
            self._forget()
        raw, sizes = data.tobytes(), ends - starts
        places = np.zeros(len(starts), dtype=np.uint64)
        padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
        windows = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded, strides=(1,))
        zeros = np.flatnonzero(data == 0)
        clean = np.searchsorted(zeros, starts) == np.searchsorted(zeros, ends)
        short = np.flatnonzero((sizes <= 16) & clean)
        low = windows[starts[short]] & self.masks[np.minimum(sizes[short], 8)]
        high = windows[np.minimum(starts[short] + 8, len(data))] & self.masks[np.clip(sizes[short] - 8, 0, 8)]
        found = self.table.find(low, high)
        new = np.flatnonzero(found == 0)
        if len(new):
            order = new[np.lexsort((high[new], low[new]))]
            differs = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
            heads = np.concatenate([[0], np.flatnonzero(differs) + 1])
            first = order[heads]
            kept = np.array([self._keep(raw[s:e]) for s, e in zip(
                starts[short[first]].tolist(), ends[short[first]].tolist(), strict=True)], dtype=np.uint64)
            found[order] = np.repeat(kept, np.diff(np.concatenate([heads, [len(order)]])))
            self.table.add(low[first], high[first], kept)
        places[short] = found
        others = np.ones(len(starts), dtype=bool)
        others[short] = False
        for k in np.flatnonzero(others).tolist():
            piece = raw[starts[k] : ends[k]]
            place = self.long.get(piece)
            if place is None:
                place = self._keep(piece)
                if len(piece) <= 256:
                    self.long[piece] = place
            places[k] = place
        return places

    def block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a block with an end id after each, and the bounds of the texts among them."""
        n = len(bounds) - 1
        starts = cuts(data, bounds)
        ends = np.append(starts[1:], len(data))
        owner = np.searchsorted(bounds, starts, side="right") - 1
        # A text's end id follows its pieces.
        at = np.arange(len(starts)) + owner
        places = np.full(len(starts) + n, 1, dtype=np.uint64)  # the end id: place 0, one id
        places[at] = self._places(data, starts, ends)
        counts = (places & np.uint64((1 << _COUNT) - 1)).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(counts)])
        index = np.repeat((places >> np.uint64(_COUNT)).astype(np.int64) - total[:-1], counts) + np.arange(total[-1])
        last = np.searchsorted(owner, np.arange(n), side="right") + np.arange(n)
        return self.pool[index], np.concatenate([[0], total[last + 1]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text and the end id."""
        found = []
        for block in A.blocks(pa.array(texts, pa.string())):
            ids, edges = self.block(block.data, block.bounds)
            found += [ids[s:e].tobytes() for s, e in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
        return found


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts of a block begin: at each text that is not empty, and at the
    spaces before which a piece of the tokenizer's pattern always ends."""
    space = data == 0x20
    unsure = _RARE[data]
    unsure[1:] |= space[1:] & (space[:-1] | (data[:-1] == 0x0A))
    first = bounds[:-1][np.diff(bounds) > 0]
    unsure[first] |= space[first]
    marked = np.zeros(len(bounds) - 1, dtype=bool)
    marked[np.searchsorted(bounds, np.flatnonzero(unsure), side="right") - 1] = True
    # In the texts that are sure a piece begins at every space, and the space is part of it.
    begins = space
    for k in np.flatnonzero(marked).tolist():
        begins[bounds[k] : bounds[k + 1]] = False
        text = data[bounds[k] : bounds[k + 1]].tobytes().decode()
        sizes = [len(piece.encode()) + (i > 0) for i, piece in enumerate(_CUT.split(text))]
        begins[bounds[k] + np.cumsum(sizes[:-1], dtype=np.int64)] = True
    begins[first] = True
    return np.flatnonzero(begins)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Bytes that print stand for themselves; the others follow from U+0100 on.
    """
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in printed else chr(next(others)) for b in range(256)}


def _is_byte_level(tokenizer) -> bool:
    """Whether pieces are cut by the byte-level pattern, with nothing before or after it."""
    spec = json.loads(tokenizer.to_str())
    cut = spec["pre_tokenizer"] or {}
    return (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and spec["normalizer"] is None and spec["model"]["type"] == "BPE")


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, dtype: str) -> PieceEncoder:
    """The encoder of this process, which keeps its memory from task to task until ids are counted."""
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = PieceEncoder(path, dtype)
    return _encoders[path, dtype]


def _release() -> None:
    """Give back what the encoders of this process hold, once all texts of a run are encoded.

    Workers live on and serve other operators; their memory would stay taken.
    """
    _encoders.clear()


def _dtype(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def tokens(path: str, dtype: str, text: str = "text") -> Column:
    """Ids of a text column and the end id, as bytes of little-endian numbers."""

    @F.arrow_udf(T.BinaryType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = encoder(path, dtype)
        for texts in batches:
            rows: list[bytes] = []
            for block in A.blocks(texts):
                ids, edges = known.block(block.data, block.bounds)
                raw, size = ids.tobytes(), ids.itemsize
                rows += [raw[s:e] for s, e in zip((edges * size).tolist(), (edges[1:] * size).tolist(), strict=False)]
            yield pa.array(rows, pa.binary())

    return encode(F.col(text).cast("string"))


def _bytes_of(column: pa.Array) -> bytes:
    """All values of a binary column one after the other."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return column.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if offsets[-1] > offsets[0] else b""


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, 256 at a time, so that memory follows these rows and not the batch."""
    for at in range(0, batch.num_rows, 256):
        yield batch.slice(at, 256)


def _runs(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the bounds of its rows."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes // np.dtype(dtype).itemsize)])
    return np.frombuffer(_bytes_of(column), dtype=dtype).astype(np.int64), bounds


def _counts(ids: DataFrame, dtype: str) -> np.ndarray:
    """Occurrences of every id; as many numbers as the vocabulary has ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for piece in _slices(batch):
                found = np.bincount(_runs(piece.column(0), dtype)[0], minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    if not found.num_rows:
        return np.zeros(1, dtype=np.int64)
    at = found["id"].to_numpy()
    counts = np.zeros(int(at.max()) + 1, dtype=np.int64)
    counts[at] = found["n"].to_numpy()
    return counts


def _pieces(lengths: np.ndarray, dtype: str, bounds: np.ndarray):
    """Batches of (doc_id, ids) as (part, doc_id, count, bits, marks)."""
    book = H.codes(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch):
                ids, runs = _runs(piece.column(1), dtype)
                raw, edges, marks = H.encode(ids, runs, lengths, book)
                doc = piece.column(0)
                part = np.searchsorted(bounds, doc.fill_null(0).to_numpy(zero_copy_only=False), side="right")
                part[np.asarray(doc.is_null())] = len(bounds)
                bits = [raw[s:e] for s, e in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), doc, pa.array(np.diff(runs)), pa.array(bits, pa.binary()),
                     pa.array([m.tobytes() for m in marks], pa.binary())],
                    ["part", "doc_id", "n", "bits", "marks"])

    return encode


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive documents of a part, in order, as blocks of at least `BLOCK_IDS` ids, the last of a part excepted."""
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("bits", pa.binary()),
        ("marks", pa.binary())])
    part, number, first, held = -1, 0, 0, 0
    pieces: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        nonlocal number, first, held
        docs = pa.Table.from_batches(pieces).combine_chunks()
        doc_id, n, bits, marks = (docs[c].chunk(0) for c in ("doc_id", "n", "bits", "marks"))
        sizes = pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)
        values = [part, number, first, doc_id.to_pylist(), n.to_numpy(), np.cumsum(sizes) - sizes, _bytes_of(bits), _bytes_of(marks)]
        number, first, held = number + 1, first + held, 0
        pieces.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    for batch in batches:
        parts = batch.column("part").to_numpy()
        total = np.concatenate([[0], np.cumsum(batch.column("n").to_numpy())])
        at = 0
        while at < len(parts):
            if parts[at] != part:
                if pieces:
                    yield block()
                part, number, first = int(parts[at]), 0, 0
            same = int(np.searchsorted(parts, part, side="right"))  # parts are in order
            # The document with which the block is large enough is its last one.
            end = min(same, int(np.searchsorted(total, total[at] + BLOCK_IDS - held)))
            end = max(end, at + 1)
            pieces.append(batch.slice(at, end - at))
            held += int(total[end] - total[at])
            at = end
            if held >= BLOCK_IDS:
                yield block()
    if pieces:
        yield block()


def write_ids(docs: DataFrame, path: str, tokenizer: str, text: str = "text") -> None:
    """Write the ids of all documents to the folder `path`."""
    spark = docs.sparkSession
    dtype = _dtype(tokenizer)
    coded = docs.select(F.col("doc_id").cast("bigint"), tokens(tokenizer, dtype, text).alias("ids"))
    ids = materialized(coded.withColumn("n", F.octet_length("ids")), "token-ids")
    counts = _counts(ids, dtype)
    lengths = H.code_lengths(counts)
    n_parts = max(1, math.ceil(int(counts.sum()) / PART_IDS))
    at = [k / n_parts for k in range(1, n_parts)]
    bounds = np.unique(np.array(ids.approxQuantile("doc_id", at, 0.1 / n_parts) if at else [], dtype=np.int64))
    pieces = ids.select("doc_id", "ids").mapInArrow(
        _pieces(lengths, dtype, bounds), "part int, doc_id bigint, n bigint, bits binary, marks binary")
    ordered = pieces.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_last(), F.xxhash64("bits"))
    ordered.mapInArrow(_pack, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    used = np.flatnonzero(lengths)
    book = pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used].astype(np.int32))})
    spark.createDataFrame(book).coalesce(1).write.parquet(f"{path}/codebook")


def _decode_blocks(lengths: np.ndarray, before: dict[int, int], digest: bool):
    """Batches of blocks as (doc_id, start, ids) or (doc_id, start, n_tokens, ids_crc32)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = H.decoding_table(lengths)
        for batch in batches:
            columns_of = {name: batch.column(name) for name in batch.schema.names}
            for at in range(batch.num_rows):
                row = {name: column[at] for name, column in columns_of.items()}
                counts = row["counts"].values.to_numpy()
                lanes = -(-counts // H.MARK_EVERY)
                sizes = np.full(int(lanes.sum()), H.MARK_EVERY, dtype=np.int64)
                sizes[np.cumsum(lanes) - 1] = counts - (lanes - 1) * H.MARK_EVERY
                offsets = np.frombuffer(row["marks"].as_py(), dtype="<u4") + np.repeat(
                    8 * row["starts"].values.to_numpy(), lanes)
                ids = H.decode(row["bits"].as_py(), offsets, sizes, table).astype("<u4")
                edges = np.concatenate([[0], np.cumsum(counts)])
                starts = before[row["part"].as_py()] + row["first"].as_py() + edges[:-1]
                docs = [ids[s:e] for s, e in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
                columns = {"doc_id": row["doc_ids"].values, "start": pa.array(starts)}
                if digest:
                    columns |= {"n_tokens": pa.array(counts),
                                "ids_crc32": pa.array([zlib.crc32(d.tobytes()) for d in docs], pa.int64())}
                else:
                    columns["ids"] = pa.array([d.astype(np.int64) for d in docs], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return decode


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    book = spark.read.parquet(f"{path}/codebook").toArrow()  # at most one row for each id of the vocabulary
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    lengths = np.zeros(max(book["id"].to_pylist(), default=0) + 1, dtype=np.uint8)
    lengths[book["id"].to_numpy()] = book["length"].to_numpy()
    size = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n)
    parts = blocks.groupBy("part").agg(F.sum(size).alias("n")).orderBy("part").collect()  # one row for each part
    before, total = {}, 0
    for p in parts:
        before[p["part"]] = total
        total += p["n"]
    columns = "n_tokens bigint, ids_crc32 bigint" if digest else "ids array<bigint>"
    return blocks.mapInArrow(_decode_blocks(lengths, before, digest), f"doc_id bigint, start bigint, {columns}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; `start` counts the ids before it."""
    return _read(spark, path, digest=False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    return _read(spark, path, digest=True)


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Write the files to a new folder of the shared folder and read their digests back."""
    path = new_path(docs.sparkSession, "token-files")
    write_ids(docs, path, tokenizer, text)
    return read_digests(docs.sparkSession, path)
