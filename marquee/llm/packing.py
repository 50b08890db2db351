"""Packing token ids into fixed rows: best fit decreasing.

Documents are encoded, split losslessly into pieces of at most ``length``
tokens, and packed by decreasing length: a piece goes to the row with the
least room that still holds it.  Which rooms exist is kept in a segment tree
over the capacities 0 to ``length``; the search for the least room climbs to
the first subtree on the right that has one and descends into it.

Every task packs its own documents, ``pool`` tokens at a time, so nothing is
shuffled and a task holds one pool.  A packed row has its ids as one
little-endian vector padded to ``length`` (a row of the id matrix) by the first
id above the vocabulary, in 16 bits where that fits and in 32 otherwise; the cumulative segment lengths, the places where positions start again at 0,
and each segment's document and first token in it.

Defined cases: documents without tokens (null or empty text) are in no row;
repeated rows are packed each; a null identifier stays null; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.bpe import codec, default_vocabulary, encode_into
from marquee.llm.common import documents

LENGTH = 2_048
POOL = 2_000_000


class Rooms:
    """Rows by the room left in them, as a segment tree over capacities."""

    def __init__(self, length: int):
        self.half = 1 << (length + 1 - 1).bit_length()
        self.count = [0] * (2 * self.half)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        i = room + self.half
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room >= need."""
        count, i = self.count, need + self.half
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.half:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.half
        row = self.rows[room].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return room, row


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; longer pieces first, ties by number."""
    rooms, rows = Rooms(length), []
    for p in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        found = rooms.take(lengths[p])
        if found is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(p)
        if room > lengths[p]:
            rooms.put(room - lengths[p], row)
    return rows


_SCHEMA = pa.schema([("pool", pa.string()), ("row", pa.int32()), ("n_tokens", pa.int32()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
                     ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
                     ("ids", pa.binary())])
DDL = ("pool string, row int, n_tokens int, doc_ids array<long>, doc_starts array<long>, "
       "cu_seqlens array<int>, position_resets array<int>, ids binary")


def padding(path: str | None = None) -> tuple[int, str]:
    """The id of padding under a vocabulary, and the type of its matrix."""
    pad = len(codec(path or default_vocabulary()).length)
    return pad, "<u2" if pad < 1 << 16 else "<u4"


def _pack(pieces: list[tuple], name: str, length: int, pad: int, kind: str) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    for r, row in enumerate(best_fit([len(p[2]) for p in pieces], length)):
        ids = np.full(length, pad, dtype=kind)
        ends = [0]
        for p in row:
            ids[ends[-1]:ends[-1] + len(pieces[p][2])] = pieces[p][2]
            ends.append(ends[-1] + len(pieces[p][2]))
        out.append({"pool": name, "row": r, "n_tokens": ends[-1], "doc_ids": [pieces[p][0] for p in row],
                    "doc_starts": [pieces[p][1] for p in row], "cu_seqlens": ends,
                    "position_resets": ends[:-1], "ids": ids.tobytes()})
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def packer(length: int, pool: int, label: str):
    def finish(rows, path):
        from pyspark import TaskContext

        pad, kind = padding(path)
        part, n, held, pieces = TaskContext.get().partitionId(), 0, 0, []
        for doc, ids in rows:
            for s in range(0, len(ids), length):
                pieces.append((doc, s, ids[s:s + length].astype(kind)))
            held += len(ids)
            if held >= pool:
                yield from _pack(pieces, f"{label}{part}-{n}", length, pad, kind)
                n, held, pieces = n + 1, 0, []
        if pieces:
            yield from _pack(pieces, f"{label}{part}-{n}", length, pad, kind)
    return finish


def pack(docs: DataFrame, length: int = LENGTH, pool: int = POOL, label: str = "p", **options) -> DataFrame:
    """Packed rows of all documents' token ids."""
    return encode_into(docs, packer(length, pool, label), DDL, **options)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """The packed rows as Parquet files; a file's ``ids`` column is its id matrix."""
    pack(docs, **options).write.parquet(path)


def op7_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))
