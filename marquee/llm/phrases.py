"""Phrase collocation mining by multikey three-way quicksort.

A suffix is the run of at most ``LONGEST`` words that starts at a word and stays
within its piece of text.  Suffixes are routed by their leading word to buckets
(as many as the corpus has ``BUCKET`` suffixes); in a bucket the pointers to
them are sorted by three-way partitions, word by word: the size of an equal
partition is the count of the phrase its pointers share, and a partition of
fewer than the wanted count is abandoned, which is exact as all suffixes with
a leading word are in one bucket.  Partitions of less than ``SMALL`` pointers
are finished together by one sort.

* A first pass counts words.  Words of more than ``HOT`` occurrences are routed
  by two leading words, and pairs of two such words by all three, so no bucket
  fills up with a common word or pair; only those pairs' counts are added up
  afterwards.  The list of such words is at most ``HOT_WORDS`` long (``HOT``
  rises where it would be longer), so it may be broadcast.
* A task counts equal suffixes of ``PART`` bytes of text before they travel, as
  one compressed string a bucket.

Scores are whole numbers: products are decimals of 38 digits, enough for 10^16
occurrences of a word.  Candidates are joined to the counts of their parts.

Defined cases: null text = empty, null language = ``und``; rows that repeat
count again; texts without words, an empty table: nothing; a very long text is
counted alone; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, stage, text_or_empty
from marquee.llm.packed_terms import radix_order
from marquee.llm.words import Block, mix

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
PART, BUCKET, HOT, HOT_WORDS, SMALL = 4 << 20, 600_000, 150_000, 1_000_000, 4096
#: Shares of a language's candidates that are ranked before all are.
SALTS = 64
_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_INSIDE = ~_CUT
_INSIDE[[0x20, 0x09]] = False

COUNTS_DDL = "lang string, word string, f long"
_SUFFIXES = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("blob", pa.binary())])
SUFFIXES_DDL = "bucket int, lang string, blob binary"
PHRASES_DDL = "lang string, words int, phrase string, f long"


class Words:
    """The words of some lower-cased texts: numbers (into ``names``), the
    document of each, and whether the next word is in the same piece."""

    def __init__(self, texts: list[bytes]) -> None:
        self.buf = buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        inside = np.concatenate([[False], _INSIDE[buf]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[0::2], edge[1::2]
        length = end - start
        chars = pa.py_buffer(buf[inside[1:]].tobytes())
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.tobytes()), chars]) \
            .dictionary_encode()
        self.names = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
        self.doc = np.searchsorted(ends, start, side="right")
        cuts = np.cumsum(_CUT[buf])
        self.joined = np.zeros(len(start), dtype=bool)
        if len(start):
            self.joined[:-1] = cuts[start[1:]] == cuts[end[:-1] - 1]

    def hashes(self) -> np.ndarray:
        """A hash of every name."""
        off = np.frombuffer(self.names.buffers()[1], dtype=np.int64, count=len(self.names) + 1)
        chars = np.frombuffer(self.names.buffers()[2] or b"", dtype=np.uint8)
        return Block(chars, off[:-1], off[1:], off).hashes()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """(languages, lower-cased texts) of about PART bytes."""
    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            x = text.encode("utf-8", "surrogatepass").lower()
            if texts and size + len(x) > PART:
                yield langs, texts
                langs, texts, size = [], [], 0
            langs.append(lang)
            texts.append(x)
            size += len(x) + 1
    if texts:
        yield langs, texts


def _coded(langs: list[str]) -> tuple[list[str], np.ndarray]:
    known: dict[str, int] = {}
    code = np.array([known.setdefault(x, len(known)) for x in langs], dtype=np.int64)
    return list(known), code


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for langs, texts in _parts(batches):
        w = Words(texts)
        known, code = _coded(langs)
        n = np.bincount(w.word * len(known) + code[w.doc], minlength=0)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known, pa.string()).take(pa.array(at % len(known))),
             w.names.take(pa.array(at // len(known))).cast(pa.large_string()).cast(pa.string()), pa.array(n[at])],
            names=["lang", "word", "f"])


def _squeezed(lengths: np.ndarray, counts: np.ndarray, chars: bytes) -> bytes:
    raw = lengths.astype("<u4").tobytes() + counts.astype("<u4").tobytes() + chars
    return len(lengths).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _plain(blob: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    n, size = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
    raw = pa.decompress(blob[16:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u4", n, 4 * n), raw[8 * n:]


def _suffixes(batches: Iterator[pa.RecordBatch], buckets: int, hot: dict[str, set[bytes]]) -> Iterator[pa.RecordBatch]:
    """The counted suffixes of each part of the texts, a row a bucket and language."""
    for langs, texts in _parts(batches):
        w = Words(texts)
        if not len(w.word):
            continue
        known, code = _coded(langs)
        size = len(w.names) + 1
        none = np.zeros(1, dtype=np.int64)
        second = np.where(w.joined, np.concatenate([w.word[1:] + 1, none]), 0)
        third = np.where(w.joined, np.concatenate([second[1:], none]), 0)
        pair, number = np.unique(w.word * size + second, return_inverse=True)
        triple, n = np.unique((number * size + third) * len(known) + code[w.doc], return_counts=True)
        lang, triple = triple % len(known), triple // len(known)
        w3, pair = triple % size, pair[triple // size]
        w1, w2 = pair // size, pair % size
        h = np.concatenate([[0], w.hashes()]).astype(np.uint64)
        # which words are hot, by language; number 0 is the end of a piece
        common = np.zeros((len(known), size), dtype=bool)
        names = w.names.to_pylist()
        for k, x in enumerate(known):
            mine = hot.get(x)
            if mine:
                common[k, 1:] = [name in mine for name in names]
        route = mix(h[w1 + 1] + np.array([len(x) for x in known], dtype=np.uint64)[lang])
        by_two = common[lang, w1 + 1]
        route[by_two] = mix(route[by_two] ^ h[w2[by_two]])
        by_three = by_two & common[lang, w2]
        route[by_three] = mix(route[by_three] ^ h[w3[by_three]])
        bucket = (route % np.uint64(buckets)).astype(np.int64)
        order = radix_order([bucket.astype(np.uint64), lang.astype(np.uint64)])
        bucket, lang, n = bucket[order], lang[order], n[order]
        text = pc.binary_join_element_wise(*[w.names.take(pa.array(x[order] - 1, mask=x[order] == 0)) for x in (w1 + 1, w2, w3)],
                                           pa.scalar(b" ", pa.large_binary()), null_handling="skip")
        off = np.frombuffer(text.buffers()[1], dtype=np.int64, count=len(text) + 1)
        chars = memoryview(text.buffers()[2])
        begin = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (lang[1:] != lang[:-1])]))
        blobs = [_squeezed(np.diff(off[i:j + 1]), n[i:j], bytes(chars[off[i]:off[j]]))
                 for i, j in zip(begin, np.concatenate([begin[1:], [len(order)]]))]
        for i in range(0, len(blobs), 2000):
            at = begin[i:i + 2000]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int32()),
                                              pa.array([known[k] for k in lang[at]], pa.string()),
                                              pa.array(blobs[i:i + 2000], pa.binary())], schema=_SUFFIXES)


def frequent_prefixes(words: np.ndarray, n: np.ndarray, least: int, whole_from: int = 0) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """(rows, length, counts): of each prefix of 2 words or more that occurs
    ``least`` times, one row of ``words`` (numbers, -1 behind the end) that has
    it.  Row i counts ``n[i]`` times.  Partitions below ``least`` are abandoned
    from the depth ``whole_from`` on; prefixes of that many words are all listed."""
    longest = words.shape[1]
    found: list[tuple[np.ndarray, int, np.ndarray]] = []
    small: dict[int, list[np.ndarray]] = {d: [] for d in range(longest)}
    stack = [(np.arange(len(n)), 0)]
    while stack:
        rows, depth = stack.pop()
        if not len(rows) or depth >= whole_from and n[rows].sum() < least:
            continue
        if len(rows) < SMALL:
            small[depth].append(rows)
            continue
        key = words[rows, depth]
        pivot = np.sort(key[[len(key) // 4, len(key) // 2, -1 - len(key) // 4]])[1]
        stack += [(rows[key < pivot], depth), (rows[key > pivot], depth)]
        if pivot < 0:
            continue
        equal = rows[key == pivot]
        count = n[equal].sum()
        if depth and (count >= least or depth + 1 <= whole_from):
            found.append((equal[:1], depth + 1, np.array([count])))
        if depth + 1 < longest:
            stack.append((equal, depth + 1))
    for depth, parts in small.items():
        if not parts:
            continue
        rows = np.concatenate(parts)
        part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort([words[rows, k] for k in range(longest - 1, depth - 1, -1)] + [part])
        rows, part = rows[order], part[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = part[1:] != part[:-1]
        for length in range(depth + 1, longest + 1):
            key = words[rows, length - 1]
            new[1:] |= key[1:] != key[:-1]
            begin = np.flatnonzero(new)
            count = np.add.reduceat(n[rows], begin)
            keep = (key[begin] >= 0) & ((count >= least) | (length <= whole_from))
            if length > 1:
                found.append((rows[begin[keep]], length, count[keep]))
    return found


def _mined(table: pa.Table, least: int, hot: dict[str, set[bytes]]) -> pa.Table:
    """The phrases of a bucket that occur ``least`` times, and the part counts
    of pairs of hot words."""
    out: list[pa.RecordBatch] = []
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
    for lang in pc.unique(table.column("lang")).to_pylist():
        blobs = [_plain(b) for b in table.filter(pc.equal(table.column("lang"), lang)).column("blob").to_pylist()]
        length = np.concatenate([b[0] for b in blobs]).astype(np.int64)
        n = np.concatenate([b[1] for b in blobs]).astype(np.int64)
        chars = np.frombuffer(b"".join(b[2] for b in blobs), dtype=np.uint8)
        space = chars == 0x20
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        inner = np.flatnonzero(space)
        start = np.sort(np.concatenate([first, inner + 1]))
        spaces = np.concatenate([[0], np.cumsum(space)])
        off = np.concatenate([start - spaces[start], [len(chars) - len(inner)]]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(off.tobytes()), pa.py_buffer(chars[~space].tobytes())]).dictionary_encode()
        at = np.searchsorted(start, first)
        many = np.diff(np.concatenate([at, [len(start)]]))
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = np.full((len(n), LONGEST), -1, dtype=np.int64)
        for k in range(LONGEST):
            has = many > k
            words[has, k] = index[at[has] + k]
        mine = hot.get(lang, ())
        common = np.array([x in mine for x in coded.dictionary.to_pylist()] + [False], dtype=bool)
        shared = common[words[:, 0]] & common[words[:, 1]]
        for rows, whole_from in ((np.flatnonzero(~shared), 0), (np.flatnonzero(shared), 2)):
            for r, size, count in frequent_prefixes(words[rows], n[rows], least, whole_from):
                r = rows[r]
                text = pc.binary_join_element_wise(*[coded.dictionary.take(pa.array(words[r, k])) for k in range(size)],
                                                   pa.scalar(b" ", pa.large_binary()))
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(r), pa.string()), pa.array(np.full(len(r), size, dtype=np.int32)),
                     text.cast(pa.large_string()).cast(pa.string()), pa.array(count, pa.int64())], schema=schema))
    return pa.Table.from_batches(out, schema=schema)


def hot_words(counts: DataFrame, above: int = HOT, at_most: int = HOT_WORDS) -> dict[str, set[bytes]]:
    """The words of more than ``above`` occurrences by language, at most
    ``at_most``: a longer list is cut off at a higher count."""
    often = counts.filter(F.col("f") > above)
    while often.limit(at_most + 1).count() > at_most:
        above *= 2
        often = counts.filter(F.col("f") > above)
    out: dict[str, set[bytes]] = {}
    for r in often.toLocalIterator():
        out.setdefault(r["lang"], set()).add(r["word"].encode("utf-8", "surrogatepass"))
    return out


def phrase_counts(docs: DataFrame, least: int = LEAST, hot_above: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f of the phrases of 1 to LONGEST words that occur
    ``least`` times; lang, n).  ``docs``: lang, text."""
    counts = stage(docs.mapInArrow(_counts, COUNTS_DDL).groupBy("lang", "word").agg(F.sum("f").alias("f")), "word-counts")
    n = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    total = counts.agg(F.sum("f")).first()[0] or 0
    buckets = 1 + int(total) // BUCKET
    sc = docs.sparkSession.sparkContext
    hot = sc.broadcast(hot_words(counts, hot_above))
    longer = (docs.mapInArrow(lambda it: _suffixes(it, buckets, hot.value), SUFFIXES_DDL)
              .groupBy("bucket").applyInArrow(lambda t: _mined(t, least, hot.value), PHRASES_DDL)
              .groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))
    single = counts.filter(F.col("f") >= least).select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), "f")
    return stage(single.unionByName(longer), "phrase-counts"), n


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang", hot_above: int = HOT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    f, n = phrase_counts(d, least, hot_above)
    part = f.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    words = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(words, k + 1, F.col("words") - k), " ").alias("right")))
    cut = (f.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c"))
           .select("lang", "phrase", "a", "c.*"))
    sides = (cut.join(part.withColumnsRenamed({"part": "left", "count": "l"}), ["lang", "left"])
             .join(part.withColumnsRenamed({"part": "right", "count": "r"}), ["lang", "right"]))
    score = F.expr("cast((cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * 1000000) "
                   "div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) as bigint)")
    scored = (sides.withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "m.score"))
    inner = F.expr("filter(flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), "
                   "i -> array_join(slice(split(phrase, ' '), i, s), ' ')))), p -> p <> phrase)")
    within = (f.filter("words > 2").select("lang", "f", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(within, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))
    # the best of each of SALTS shares of a language first, so no task sorts a whole language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = (kept.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("rank", "salt"))
    best = Window.partitionBy("lang").orderBy(*order)
    return (some.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).join(n, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir))


OP13_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
      FROM i, (VALUES (1), (2), (3)) AS t(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM i GROUP BY lang),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
x AS (SELECT lang, size, phrase, a, k, array_to_string(words[1:k], ' ') AS lp, array_to_string(words[k + 1:size], ' ') AS rp
      FROM c, (VALUES (1), (2)) AS t(k) WHERE k < size),
s AS (SELECT x.lang, x.phrase, x.a, x.k, l.f AS l, r.f AS r,
             (1000000::HUGEINT * x.a * x.a) // (l.f::HUGEINT * r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.lp JOIN f r ON r.lang = x.lang AND r.phrase = x.rp),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
d AS (SELECT DISTINCT y.lang, y.phrase FROM c z, c y
      WHERE z.size = 3 AND y.size = 2 AND y.lang = z.lang AND 100 * z.a >= 50 * y.a
        AND (y.phrase = array_to_string(z.words[1:2], ' ') OR y.phrase = array_to_string(z.words[2:3], ' '))),
o AS (SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
      FROM m ANTI JOIN d ON d.lang = m.lang AND d.phrase = m.phrase)
SELECT o.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000"""
