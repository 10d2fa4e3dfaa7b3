"""Words of Arrow text batches as numpy arrays: offsets, owners and hashes.

A batch is worked through in blocks of whole texts of about `BLOCK_BYTES`, so
that memory follows the block, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

#: Odd multiplier of the polynomial word hash, and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < n:
        size = max(n, BLOCK_BYTES)
        for name, base in (("p", _P), ("q", _P_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["p"], _powers["q"]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask of the byte values in the given inclusive ranges."""
    mask = np.zeros(256, dtype=bool)
    for low, high in ranges:
        mask[low : high + 1] = True
    return mask


#: Bytes of `[^\x20\x09-\x0D]` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """`h` with its high bits spread over the low ones."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Block:
    """Bytes of consecutive texts; `bounds[i]:bounds[i + 1]` is text i of the block."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Block:
        return Block(self.first, _LOWER[self.data], self.bounds)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts (NULL: empty) in blocks of at most `limit` bytes, or one longer text."""
    filled = texts.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = filled.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    at = 0
    while at < len(filled):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(filled))
        low, high = int(offsets[at]), int(offsets[end])
        yield Block(at, data[low:high], (offsets[at : end + 1] - low))
        at = end


@dataclass
class Words:
    """Words of a block in order: byte ranges, owning texts and 64-bit hashes."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray


def words(block: Block, inside: np.ndarray, hashed: bool = True) -> Words:
    """Maximal runs of the bytes in `inside`; a run ends with its text."""
    mask = inside[block.data]
    n = len(mask)
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = mask[:-1]
    after = np.empty(n, dtype=bool)
    after[-1:] = False
    after[:-1] = mask[1:]
    inner = block.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    owner = np.searchsorted(block.bounds, starts, side="right") - 1
    hashes = np.empty(0, dtype=np.uint64)
    if hashed:
        p, q = _power_tables(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((block.data.astype(np.uint64) + np.uint64(1)) * p[:n], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * q[starts])
    return Words(starts, ends, owner, hashes)
