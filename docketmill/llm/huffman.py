"""Canonical length-limited Huffman codes of integer ids, as numpy arrays.

A code is a vector of lengths by id (0: the id does not occur).  Codes of one
length are consecutive in the order of ids, so the lengths are all a reader needs.
"""

from __future__ import annotations

import numpy as np

#: Longest code, and so the width of the decoding table.
MAX_BITS = 16
#: Ids between two marks of the bit offset.
MARK_EVERY = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of at most `max_bits` with the least total, by package-merge."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(ids)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    if n < 2:
        lengths[ids] = 1
        return lengths
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[ids].astype(np.float64)
    is_id = []  # by level: which of the merged items, lightest first, are single ids
    packages = np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        is_id.append(order < n)
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * n - 2
    for level in reversed(is_id):
        singles = int(level[:taken].sum())
        lengths[ids[:singles]] += 1
        taken = 2 * (taken - singles)
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes by id: ordered by length, then id."""
    found = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    widths = lengths[order].astype(np.int64)
    longest = int(widths[-1]) if len(widths) else 0
    spans = np.left_shift(np.uint64(1), (longest - widths).astype(np.uint64))
    left = np.cumsum(spans) - spans  # codes as fractions in units of 2**-longest
    found[order] = left >> (longest - widths).astype(np.uint64)
    return found


def encode(ids: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, book: np.ndarray):
    """Bits of consecutive runs of ids, each run from a byte boundary on.

    Returns the bytes, the byte bounds of the runs, and for each run the bit
    offsets, from its own start, of every `MARK_EVERY`-th id.
    """
    width = lengths[ids].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(width)])
    run_bytes = (np.diff(total[bounds]) + 7) // 8
    byte_bounds = np.concatenate([[0], np.cumsum(run_bytes)])
    inner = total[:-1] - np.repeat(total[bounds[:-1]], np.diff(bounds))
    at = inner + np.repeat(8 * byte_bounds[:-1], np.diff(bounds))
    words = np.zeros(int(byte_bounds[-1]) // 8 + 2, dtype=np.uint64)
    if len(ids):
        code, slot, shift = book[ids], at >> 6, 64 - (at & 63) - width
        head = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64),
                        code >> np.maximum(-shift, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        words[slot[first]] = np.add.reduceat(head, first)
        over = np.flatnonzero(shift < 0)
        words[slot[over] + 1] += code[over] << (64 + shift[over]).astype(np.uint64)
    raw = words.astype(">u8").tobytes()[: int(byte_bounds[-1])]
    marks = [inner[s:e:MARK_EVERY].astype("<u4") for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    return raw, byte_bounds, marks


def decoding_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length by the next `max_bits` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    spans = np.left_shift(1, max_bits - lengths[order].astype(np.int64))
    ids, widths = np.zeros(1 << max_bits, dtype=np.uint32), np.ones(1 << max_bits, dtype=np.uint8)
    filled = int(spans.sum())
    ids[:filled] = np.repeat(order, spans)
    widths[:filled] = np.repeat(lengths[order], spans)
    return ids, widths


def decode(raw: bytes, offsets: np.ndarray, sizes: np.ndarray, table, max_bits: int = MAX_BITS) -> np.ndarray:
    """Ids of independent lanes: lane i has `sizes[i]` ids from bit `offsets[i]` on, in lane order."""
    symbols, widths = table
    data = np.frombuffer(raw + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at, lane_end = offsets.astype(np.int64), np.cumsum(sizes)
    out = np.empty(int(sizes.sum()), dtype=np.uint32)
    place = lane_end - sizes
    order = np.argsort(-sizes, kind="stable")
    at, place, left = at[order], place[order], sizes[order]
    for step in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(-left, -step, side="left"))
        at, place = at[:live], place[:live]
        peek = (windows[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - max_bits)
        out[place + step] = symbols[peek]
        at = at + widths[peek]
    return out
