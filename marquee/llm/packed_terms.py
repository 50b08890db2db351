"""Terms packed to 64-bit words, radix-sorted and run-counted in numpy.

A term of at most 8 bytes is one number (its bytes, the first highest, zeros
behind), one of at most 16 bytes is two; neither holds a zero byte, so equal
numbers are equal terms and numbers sort as bytes do.  Longer terms are kept
in buckets by length (powers of two) and sorted as bytes there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from marquee.llm.words import TAIL, Block, lanes

#: Widest bucket that is sorted as a matrix of bytes; longer terms are sorted one by one.
WIDEST = 256


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """A stable order by ``keys`` (unsigned, the first counts most): passes
    over 16-bit digits from the last, without those that are all equal."""
    order = None
    for key in reversed(keys):
        key = key.astype(np.uint64, copy=False)
        if not len(key):
            continue
        differ = int(np.bitwise_or.reduce(key) ^ np.bitwise_and.reduce(key))
        for shift in range(0, differ.bit_length(), 16):
            if not differ >> shift & 0xFFFF:
                continue
            digit = ((key if order is None else key[order]) >> np.uint64(shift)).astype(np.uint16)
            step = np.argsort(digit, kind="stable")
            order = step if order is None else order[step]
    return np.arange(len(keys[0])) if order is None else order


def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Places where a run of equal sorted keys begins."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(keys[0]), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def run_sums(begin: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, begin) if len(begin) else values[:0]


def pack(b: Block, pick: np.ndarray, words: int) -> list[np.ndarray]:
    """The numbers of the terms ``pick`` (at most 8 * ``words`` bytes each)."""
    eights = lanes(b.buf)
    length = (b.end - b.start)[pick]
    return [(eights[b.start[pick] + 8 * k] & TAIL[np.clip(length - 8 * k, 0, 8)]).astype(np.uint64)
            for k in range(words)]


def unpack(numbers: list[np.ndarray]) -> list[bytes]:
    flat = np.ascontiguousarray(np.stack(numbers, axis=1)).astype(">u8")
    return flat.view(f"S{8 * len(numbers)}").ravel().tolist()


def sorted_long(terms: list[bytes], tie: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(order, first of each run) of terms of more than 16 bytes by (bytes,
    ``tie``), one length bucket after the other, stable."""
    length = np.array([len(t) for t in terms], dtype=np.int64)
    bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    for k in np.unique(bucket):
        at = np.flatnonzero(bucket == k)
        if 1 << int(k) <= WIDEST:
            key = np.array([terms[i] for i in at], dtype=f"S{1 << int(k)}")
            order = at[np.lexsort((tie[at], key))]
        else:
            order = np.array(sorted(at.tolist(), key=lambda i: (terms[i], tie[i])), dtype=np.int64)
        new = [j for j in range(len(order)) if j == 0 or terms[order[j]] != terms[order[j - 1]]
               or tie[order[j]] != tie[order[j - 1]]]
        yield order, np.array(new, dtype=np.int64)
