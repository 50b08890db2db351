"""Vectorised word hashing for Python workers.

Texts are joined to one byte buffer of bounded size; words are found from a
table of word bytes.  A word's hash takes its bytes eight at a time and mixes
after each eight (words of more than ``LANES`` times eight bytes: BLAKE2b), so
no sum over bytes decides equality.  ``seed`` gives independent hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (a longer document is handled alone).
BLOCK = 1 << 20

_RNG = np.random.RandomState(7)
#: Eights of bytes that are mixed as numbers; a longer word is hashed whole.
LANES = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Word bytes: all but space and tab to carriage return.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes: digits, a-z (texts are lower-cased) and all of non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Masks that keep the first 0 to 8 bytes of eight, the first byte highest.
TAIL = np.array([((1 << 8 * n) - 1) << (64 - 8 * n) for n in range(9)], dtype=np.uint64)


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer as a number, the first
    byte highest; behind the end they are 0."""
    padded = np.concatenate([buf, np.zeros(8 * LANES + 8, dtype=np.uint8)])
    return np.ndarray(len(padded) - 7, dtype=">u8", buffer=padded, strides=(1,))


@dataclass
class Block:
    """Words of some documents: of document d, words first[d]..first[d+1]."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        length = self.end - self.start
        eights = lanes(self.buf)
        h = mix((length + (seed << 32)).astype(np.uint64) + _STEP)
        left = np.flatnonzero(length > 0)
        for k in range(LANES):
            if not len(left):
                return h
            x = eights[self.start[left] + 8 * k] & TAIL[np.minimum(length[left] - 8 * k, 8)]
            h[left] = mix((h[left] ^ x) + _STEP)
            left = left[length[left] > 8 * (k + 1)]
        key = seed.to_bytes(8, "little")
        for i in left:
            digest = hashlib.blake2b(self.word(i), digest_size=8, key=key).digest()
            h[i] = int.from_bytes(digest, "little")
        return h

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


def tokenised(texts: list[bytes], word_byte: np.ndarray) -> Block:
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    inside = word_byte[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return Block(buf, start, end, first)


def blocks(batch: pa.RecordBatch, column: str = "text", lower: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first row, texts as UTF-8) of bounded parts of a batch."""
    part: list[bytes] = []
    size = begin = 0
    for i, t in enumerate(batch.column(column)):
        b = (t.as_py() or "").encode("utf-8", "surrogatepass")
        if part and size + len(b) > BLOCK:
            yield begin, part
            part, size, begin = [], 0, i
        part.append(b.lower() if lower else b)
        size += len(b) + 1
    if part:
        yield begin, part


def sequence_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of every k consecutive words (len(h) - k + 1 of them)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        total += h[j:j + m] * COEFFICIENTS[seed + j]
    return mix(total)


COEFFICIENTS = _RNG.randint(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def whole_hash(h: np.ndarray, seed: int = 0) -> np.uint64:
    """The hash of a whole short sequence; its length counts."""
    with np.errstate(over="ignore"):
        total = (h * COEFFICIENTS[seed:seed + len(h)]).sum(dtype=np.uint64) + np.uint64(len(h) + 1)
    return mix(np.array([total], dtype=np.uint64))[0]
