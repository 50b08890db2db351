"""Substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  Every window has a
minimiser: the smallest hash of its runs of ``MINIMISER`` words.  Consecutive
windows that share a minimiser travel as one packed string (a super-k-mer)
to the minimiser's bucket; equal windows have equal minimisers, so they meet
there, where sorting brings them together and the smallest document of each
is found.  A word is removed when a window that covers it also starts in a
document with a smaller identifier.

* A first pass sends only (minimiser, document).  Minimisers of one document
  alone cannot hold a repeated window; the others set a bit in a filter of
  fixed size (``FILTER_BITS``), which is broadcast: its size does not grow,
  and a false bit costs a needless row, never a result.  Only super-k-mers
  whose bit is set are packed and sent.
* A minimiser that stands in more than ``HOT`` rows would fill one bucket; its
  super-k-mers are sent window by window, keyed by 128-bit window hashes and
  reduced to the smallest document before the shuffle.  Which are hot is a
  second filter of fixed size.
* Covered places come back as runs of words per document.

In a bucket windows are sorted by two 64-bit hashes over independently seeded
word hashes, and every run of windows found again is compared with the run it
repeats, word bytes by word bytes; where they differ the windows of those
hashes are grouped by their words themselves.  Windows of hot minimisers are
compared by their 128 hash bits.

Defined cases: null text = no words; texts shorter than a window keep all
words; rows with the same identifier are one document's (windows they share
with each other are not removed, and each row is judged on its own words); a
null identifier neither removes nor loses words; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bits import bit_filter, bit_set
from marquee.llm.common import documents, stage, text_or_empty
from marquee.llm.words import SPACED, Block, blocks, sequence_hashes, tokenised

WINDOW, MINIMISER = 50, 10
#: Rows of a minimiser from which its windows travel one by one.
HOT = 2_000


def minimisers(h: np.ndarray, window: int = WINDOW, run: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows) of each super-k-mer of a
    document with word hashes ``h``."""
    n = len(h) - window + 1
    if n <= 0:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(np.uint64), z, z
    grams = sequence_hashes(h, run)
    span = window - run + 1
    # sliding minimum by doubling
    low, width = grams, 1
    while 2 * width <= span:
        low = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:len(low) - rest], low[rest:])
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    return low[starts], starts, np.diff(np.concatenate([starts, [n]]))


def _super_kmers(batch: pa.RecordBatch):
    """(row number, block, document number in it, minimisers, starts, counts)."""
    for begin, texts in blocks(batch):
        b = tokenised(texts, SPACED)
        h = b.hashes()
        for d in range(len(texts)):
            yield begin + d, b, d, *minimisers(h[b.first[d]:b.first[d + 1]])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        m, d = [], []
        for i, _, _, low, _, _ in _super_kmers(batch):
            if len(low) and ids[i] is not None:
                m.append(low)
                d.append(np.full(len(low), ids[i], dtype=np.int64))
        if m:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(m).view(np.int64)), pa.array(np.concatenate(d))],
                                             names=["m", "doc_id"])


_PACKED = pa.schema([("m", pa.int64()), ("m2", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()),
                     ("at", pa.int64()), ("words", pa.binary())])
PACKED_DDL = "m long, m2 long, doc_id long, row long, at long, words binary"


def _window_hashes(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window from two hashes of its words."""
    return sequence_hashes(h, WINDOW, 0), sequence_hashes(g, WINDOW, 100)


def _packed(batches: Iterator[pa.RecordBatch], shared: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of shared minimisers as packed strings; of hot ones,
    their windows (``m``, ``m2``: the window's hashes; no string)."""
    for batch in batches:
        ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        cols: list[list] = [[], [], [], [], [], []]
        size = 0
        for begin, texts in blocks(batch):
            b = tokenised(texts, SPACED)
            h, g = b.hashes(), None
            for d in range(len(texts)):
                doc = ids[begin + d]
                first = int(b.first[d])
                mine = h[first:b.first[d + 1]]
                low, starts, counts = minimisers(mine)
                if doc is None or not len(low):
                    continue
                sent = bit_set(shared, low)
                warm = sent & bit_set(hot, low)
                for i in np.flatnonzero(sent & ~warm):
                    s, n = int(starts[i]), int(counts[i]) + WINDOW - 1
                    a, e = b.start[first + s], b.end[first + s + n - 1]
                    cols[0].append(int(low[i].view(np.int64)))
                    cols[1].append(None)
                    cols[2].append(doc)
                    cols[3].append(rows[begin + d])
                    cols[4].append(s)
                    cols[5].append(b.buf[a:e].tobytes())
                    size += len(cols[5][-1])
                for i in np.flatnonzero(warm):
                    s, n = int(starts[i]), int(counts[i]) + WINDOW - 1
                    g = b.hashes(1) if g is None else g
                    w1, w2 = _window_hashes(mine[s:s + n], g[first + s:first + s + n])
                    cols[0] += w1.view(np.int64).tolist()
                    cols[1] += w2.view(np.int64).tolist()
                    cols[2] += [doc] * len(w1)
                    cols[3] += [rows[begin + d]] * len(w1)
                    cols[4] += range(s, s + len(w1))
                    cols[5] += [None] * len(w1)
            if size > 8_000_000 or len(cols[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PACKED)], schema=_PACKED)
                cols, size = [[], [], [], [], [], []], 0
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PACKED)], schema=_PACKED)


def _same_words(b: Block, one: np.ndarray, other: np.ndarray) -> bool:
    """Whether the windows that start at words ``one`` and ``other`` hold the
    same words; adjoining windows are compared as one stretch of text."""
    pick = np.flatnonzero(one != other)
    pick = pick[np.argsort(one[pick], kind="stable")]
    x, y = one[pick], other[pick]
    if not len(x):
        return True
    length = b.end - b.start
    chars = b.buf[SPACED[b.buf]].tobytes()
    off = np.concatenate([[0], np.cumsum(length)])
    begin = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1] + 1) | (y[1:] != y[:-1] + 1)]))
    for i, j in zip(begin, np.concatenate([begin[1:], [len(x)]])):
        n = j - i + WINDOW - 1
        p, q = x[i], y[i]
        if chars[off[p]:off[p + n]] != chars[off[q]:off[q + n]] or not np.array_equal(length[p:p + n], length[q:q + n]):
            return False
    return True


def _by_words(b: Block, doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows and, for each, the first of its words (smallest document)."""
    least: dict[tuple, int] = {}
    order = np.lexsort((word, doc))
    first = [least.setdefault(tuple(b.word(k) for k in range(word[i], word[i] + WINDOW)), int(i)) for i in order]
    return order, np.array(first, dtype=np.int64)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of a partition sorted by minimiser.

    Whole buckets are taken, about 2 MB of strings at a time (one bucket
    holds fewer than HOT rows): windows are sorted by (minimiser, hashes,
    document) and all but those of the smallest document are marked.
    """
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch | None:
        b = tokenised([r[4] for r in held], SPACED)
        h, g = b.hashes(), b.hashes(1)
        w1, w2, row, at, word = [], [], [], [], []
        for i, r in enumerate(held):
            a, c = _window_hashes(h[b.first[i]:b.first[i + 1]], g[b.first[i]:b.first[i + 1]])
            w1.append(a)
            w2.append(c)
            row.append(np.full(len(a), i))
            at.append(r[3] + np.arange(len(a)))
            word.append(b.first[i] + np.arange(len(a)))
        a, c, row, at, word = (np.concatenate(x) for x in (w1, w2, row, at, word))
        doc = np.array([r[1] for r in held], dtype=np.int64)[row]
        text = np.array([r[2] for r in held], dtype=np.int64)[row]
        order = np.lexsort((doc, c, a))
        new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        if not _same_words(b, word[order], word[first]):
            order, first = _by_words(b, doc, word)
        moved = doc[order] != doc[first]
        again = order[moved]
        if not len(again):
            return None
        order = again[np.lexsort((at[again], text[again], doc[again]))]
        doc, text, at = doc[order], text[order], at[order]
        begin = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
                                               | (at[1:] != at[:-1] + 1)]))
        last = np.concatenate([begin[1:], [len(at)]]) - 1
        return pa.RecordBatch.from_arrays([pa.array(doc[begin]), pa.array(text[begin]), pa.array(at[begin]),
                                           pa.array(at[last] + WINDOW)], names=["doc_id", "row", "a", "b"])

    for batch in batches:
        for m, doc, text, at, words in zip(*(batch.column(c).to_pylist() for c in ("m", "doc_id", "row", "at", "words"))):
            if size > 2_000_000 and m != held[-1][0]:
                out = flush()
                if out is not None:
                    yield out
                held, size = [], 0
            held.append((m, doc, text, at, words))
            size += len(words)
    if held:
        out = flush()
        if out is not None:
            yield out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, row (hash of the text), a, b: words a to b - 1 are covered by repeated windows."""
    spark = docs.sparkSession
    d = _rows(docs, id_col, text_col)
    counted = stage(d.mapInArrow(_keys, "m long, doc_id long").groupBy("m")
                    .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
                    .filter("lo < hi").select("m", "n"), "minimisers")
    shared = spark.sparkContext.broadcast(bit_filter(counted))
    warm = spark.sparkContext.broadcast(bit_filter(counted.filter(F.col("n") > hot)))
    sent = stage(d.mapInArrow(lambda it: _packed(it, shared.value, warm.value), PACKED_DDL), "super-kmers")
    cold = (sent.filter("words IS NOT NULL").select("m", "doc_id", "row", "at", "words")
            .repartition("m").sortWithinPartitions("m").mapInArrow(_repeated, "doc_id long, row long, a long, b long"))
    windows = sent.filter("words IS NULL").select("m", "m2", "doc_id", "row", "at")
    least = windows.groupBy("m", "m2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    again = windows.join(least.drop("most"), ["m", "m2"]).filter("doc_id > least")
    return cold.unionByName(again.select("doc_id", "row", F.col("at").alias("a"), (F.col("at") + WINDOW).alias("b")))


def _merged(runs: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_words(text: str, runs) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space)."""
    words = text.encode("utf-8", "surrogatepass").split()
    keep, at, removed = [], 0, 0
    for a, b in _merged(runs):
        b = min(b, len(words))
        if a >= b:
            continue
        keep += words[at:a]
        removed += b - a
        at = b
    keep += words[at:]
    return len(words), removed, b" ".join(keep)


def with_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, text and its covered runs (array of a, b; null: none)."""
    runs = repeated_runs(docs, id_col, text_col, **options)
    lists = runs.groupBy("doc_id", "row").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    return _rows(docs, id_col, text_col).join(lists, ["doc_id", "row"], "left").drop("row")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """doc_id and the text of the kept words, joined by one space."""
    def run(batches):
        for b in batches:
            out = [kept_words(t, r)[2].decode("utf-8", "surrogatepass")
                   for t, r in zip(b.column("text").to_pylist(), b.column("runs").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])
    return with_runs(docs, **options).mapInArrow(run, "doc_id long, text string")


def removal_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    def run(batches):
        for b in batches:
            got = [kept_words(t.as_py(), r) for t, r in zip(b.column("text"), b.column("runs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return with_runs(docs, **options).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op4_substrings(spark, sf_dir):
    return removal_digests(documents(spark, sf_dir))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 49), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
m AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY win) AS again FROM w),
p AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM d),
c AS (SELECT p.doc_id, p.i, p.word,
             coalesce(bool_or(m.again) OVER (PARTITION BY p.doc_id ORDER BY p.i
                      ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS removed
      FROM p LEFT JOIN m ON p.doc_id = m.doc_id AND p.i = m.i),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
             string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""
