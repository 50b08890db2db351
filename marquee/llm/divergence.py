"""Source divergence audit: how differently sources of a language use its terms.

Terms are counted by (language, source) with length-bucketed packing (see
``packed_terms``).  A task sorts and run-counts the terms of a few MB of text
and deals the runs, compressed, to term buckets; the number of buckets grows
with the text, so a bucket's runs fit in a task.  A bucket merges its runs by
the same sorts, knows the document count of each of its terms and sends on
only those that a language keeps.

Pairs of sources are summed in tiles of ``TILE`` x ``TILE`` sources: a block of
terms is a small matrix of p values, absent terms start from p of count 0, and
only each pair's sum leaves the task; terms that no source of a tile has are
added in closed form.  All arithmetic is over whole numbers (p in decimals
where 64 bits could be passed).

Defined cases: null text, language or source = ''; a group without terms is
listed with count 0 throughout; a language without kept terms has V = 0 and
pairs of value 0; rows that repeat count as documents of their own; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, stage, text_or_empty
from marquee.llm.packed_terms import pack, radix_order, run_sums, runs, sorted_long, unpack
from marquee.llm.words import mix, tokenised

MIN_DOCS, TOP_TERMS, PRIOR, SCALE = 30, 50, 5, 1_000_000_000
#: Bytes of text a task counts at once; bytes of text for one term bucket.
PART, BUCKET_BYTES = 4 << 20, 16 << 20
#: Sources a side of a tile; kept rows of one task of a tile.
TILE, TILE_ROWS = 256, 50_000
#: Term bytes once A-Z are lower-cased: a-z and all of non-ASCII.
TERM = np.zeros(256, dtype=bool)
TERM[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: A row holds the runs of a bucket: of each width, terms, groups and counts.
_RUNS = pa.schema([("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())),
                   *[(f"{name}{k}", pa.binary()) for k in range(3) for name in ("terms", "counts")]])
RUNS_DDL = ("bucket int, langs array<string>, sources array<string>, "
            + ", ".join(f"{name}{k} binary" for k in range(3) for name in ("terms", "counts")))
KEPT_DDL = "lang string, source string, term string, n long, total long"


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    part: list[bytes] = []
    size = begin = 0
    for i, t in enumerate(batch.column("text").to_pylist()):
        x = (t or "").encode("utf-8", "surrogatepass").lower()
        if part and size + len(x) > PART:
            yield begin, part
            part, size, begin = [], 0, i
        part.append(x)
        size += len(x) + 1
    if part:
        yield begin, part


def _counted(group: np.ndarray, keys: list[np.ndarray], doc: np.ndarray):
    """(group, keys, occurrences, documents) of each run of equal terms of a group."""
    order = radix_order([group, *keys])
    group, doc, keys = group[order], doc[order], [k[order] for k in keys]
    begin = runs([group, *keys])
    n = np.diff(np.concatenate([begin, [len(group)]]))
    new_doc = np.ones(len(doc), dtype=np.int64)
    new_doc[1:] = doc[1:] != doc[:-1]
    new_doc[begin] = 1
    return group[begin], [k[begin] for k in keys], n, run_sums(begin, new_doc)


def _bucket_of(keys: list[np.ndarray], buckets: int) -> np.ndarray:
    h = np.zeros(len(keys[0]), dtype=np.uint64)
    for k in keys:
        h = mix(h ^ k)
    return (h % np.uint64(buckets)).astype(np.int64)


def _squeezed(a: bytes) -> bytes:
    return pa.compress(a, codec="zstd", asbytes=True) if a else b""


def _with_size(a: bytes) -> bytes:
    return len(a).to_bytes(8, "little") + _squeezed(a)


def _plain(a: bytes) -> bytes:
    size = int.from_bytes(a[:8], "little")
    return pa.decompress(a[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _runs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counted terms of each part of the texts: a row a bucket, group and width."""
    for batch in batches:
        names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        for first, texts in _parts(batch):
            known: dict[tuple, int] = {}
            of_doc = np.array([known.setdefault(names[first + i], len(known)) for i in range(len(texts))], dtype=np.uint64)
            label = list(known)
            b = tokenised(texts, TERM)
            doc = np.repeat(np.arange(len(texts)), np.diff(b.first))
            length = b.end - b.start
            out: dict[int, dict] = {}

            def put(words, bucket, group, n, docs, take) -> None:
                order = radix_order([bucket.astype(np.uint64), group])
                bucket, group = bucket[order], group[order]
                begin = runs([bucket])
                counts = np.stack([group.astype(np.int64), n[order], docs[order]]).astype("<u4")
                for x, y in zip(begin, np.concatenate([begin[1:], [len(order)]])):
                    row = out.setdefault(int(bucket[x]), {"bucket": int(bucket[x]), "groups": []})
                    used, own = np.unique(counts[0, x:y], return_inverse=True)
                    known_here = row["groups"]
                    place = []
                    for g in used:
                        name = label[int(g)]
                        if name not in known_here:
                            known_here.append(name)
                        place.append(known_here.index(name))
                    mine = counts[:, x:y].copy()
                    mine[0] = np.array(place, dtype="<u4")[own]
                    row[f"terms{words}"] = _with_size(take(order[x:y]))
                    row[f"counts{words}"] = _with_size(mine.tobytes())

            for words, low, high in ((1, 1, 8), (2, 9, 16)):
                pick = np.flatnonzero((length >= low) & (length <= high))
                if len(pick):
                    g, keys, n, docs = _counted(of_doc[doc[pick]], pack(b, pick, words), doc[pick])
                    put(words, _bucket_of(keys, buckets), g, n, docs,
                        lambda o, keys=keys: np.concatenate([k[o] for k in keys]).astype("<u8").tobytes())
            pick = np.flatnonzero(length > 16)
            if len(pick):
                terms, group = [b.word(i) for i in pick], of_doc[doc[pick]].astype(np.int64)
                own, groups, n, docs = [], [], [], []
                for order, begin in sorted_long(terms, group):
                    end = np.concatenate([begin[1:], [len(order)]])
                    own += [terms[order[x]] for x in begin]
                    groups.append(group[order[begin]])
                    n.append(end - begin)
                    docs += [len(np.unique(doc[pick[order[x:y]]])) for x, y in zip(begin, end)]
                where = (tokenised(own, TERM).hashes() % np.uint64(buckets)).astype(np.int64)
                put(0, where, np.concatenate(groups).astype(np.uint64), np.concatenate(n), np.array(docs, dtype=np.int64),
                    lambda o: b"\n".join(own[i] for i in o))
            rows = list(out.values())
            for row in rows:
                row["langs"], row["sources"] = [g[0] for g in row["groups"]], [g[1] for g in row["groups"]]
            for i in range(0, len(rows), 500):
                yield pa.RecordBatch.from_pylist(rows[i:i + 500], schema=_RUNS)


def _merged(table: pa.Table, min_docs: int) -> pa.Table:
    """The kept terms of a bucket by (language, source) with their counts."""
    rows = table.to_pylist()
    labels = sorted({g for r in rows for g in zip(r["langs"], r["sources"])})
    langs = {x: i for i, x in enumerate(sorted({x for x, _ in labels}))}
    number = {x: i for i, x in enumerate(labels)}
    lang_of = np.array([langs[x] for x, _ in labels], dtype=np.uint64)
    cols: list[list] = [[], [], [], [], []]
    parts: dict[int, list] = {0: [], 1: [], 2: []}
    for r in rows:
        mine = np.array([number[g] for g in zip(r["langs"], r["sources"])], dtype=np.uint64)
        for words in range(3):
            if r[f"terms{words}"] is not None:
                counts = np.frombuffer(_plain(r[f"counts{words}"]), dtype="<u4").reshape(3, -1).astype(np.int64)
                parts[words].append((_plain(r[f"terms{words}"]), mine[counts[0]], counts[1], counts[2]))

    def kept(lang, group, keys, n, docs, names) -> None:
        """Of rows sorted by (lang, keys, group)."""
        begin = runs([lang, *keys, group])
        own = [lang[begin], group[begin], *[k[begin] for k in keys]]
        n, docs = run_sums(begin, n), run_sums(begin, docs)
        term = runs([own[0], *own[2:]])
        size = np.diff(np.concatenate([term, [len(begin)]]))
        keep = np.repeat(run_sums(term, docs) >= min_docs, size)
        total = np.repeat(run_sums(term, n), size)[keep]
        for i, g in zip(names(begin[keep]), own[1][keep]):
            lang_name, source = labels[int(g)]
            cols[0].append(lang_name)
            cols[1].append(source)
            cols[2].append(i.decode("utf-8", "surrogatepass"))
        cols[3].extend(n[keep].tolist())
        cols[4].extend(total.tolist())

    for words in (1, 2):
        if parts[words]:
            keys = [np.concatenate([np.frombuffer(t, dtype="<u8").reshape(words, -1)[k] for t, *_ in parts[words]]).astype(np.uint64)
                    for k in range(words)]
            group, n, docs = (np.concatenate([p[j] for p in parts[words]]) for j in (1, 2, 3))
            lang = lang_of[group.astype(np.int64)]
            order = radix_order([lang, *keys, group])
            keys = [k[order] for k in keys]
            kept(lang[order], group[order], keys, n[order], docs[order], lambda at, keys=keys: unpack([k[at] for k in keys]))
    if parts[0]:
        terms = [t for p in parts[0] for t in p[0].split(b"\n")]
        group, n, docs = (np.concatenate([p[j] for p in parts[0]]) for j in (1, 2, 3))
        lang = lang_of[group.astype(np.int64)]
        # groups are numbered by (language, source), so a language's are adjacent
        for order, begin in sorted_long(terms, group.astype(np.int64)):
            mark = np.cumsum([i == 0 or terms[order[i]] != terms[order[i - 1]] for i in range(len(order))]).astype(np.uint64)
            kept(lang[order], group[order], [mark], n[order], docs[order],
                 lambda at, order=order: [terms[order[i]] for i in at])
    return pa.Table.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                names=["lang", "source", "term", "n", "total"])


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, total: occurrences of each kept term in each
    source that has it and in the whole language.  ``docs``: lang, source, text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(size) // BUCKET_BYTES
    counted = docs.mapInArrow(lambda it: _runs(it, buckets), RUNS_DDL)
    return counted.groupBy("bucket").applyInArrow(lambda t: _merged(t, min_docs), KEPT_DDL)


def _share(count: str, total: str) -> F.Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * V)), exact."""
    return F.expr(f"1 + ((cast({count} + {PRIOR} as decimal(28,0)) * {SCALE}) div "
                  f"cast({total} + {PRIOR} * v as decimal(28,0)))").cast("long")


def _tile_sums(pdf: pd.DataFrame, tile: int) -> pd.DataFrame:
    """What the terms of one task add to each pair of a tile, over p of count 0."""
    base = pdf[pdf.term.isna()]
    rows = pdf[pdf.term.notna()]
    a, b = int(pdf.a.iloc[0]), int(pdf.b.iloc[0])
    zero = np.zeros(2 * tile, dtype=np.int64)
    # place of a source: its offset in the first tile, or behind it in the second
    def place(idx):
        idx = idx.to_numpy()
        return np.where(idx // tile == a, idx % tile, tile + idx % tile)
    at = place(base.idx)
    zero[at] = base.p.to_numpy()
    left = np.sort(at[at < tile])
    right = left if a == b else np.sort(at[at >= tile])
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    code, terms = pd.factorize(rows.term)
    order = np.argsort(code, kind="stable")
    code, col, p = code[order], place(rows.idx)[order], rows.p.to_numpy()[order]
    for x in range(0, len(terms), 2048):
        lo, hi = np.searchsorted(code, [x, x + 2048])
        m = np.tile(zero, (min(2048, len(terms) - x), 1))
        m[code[lo:hi] - x, col[lo:hi]] = p[lo:hi]
        for i, s in enumerate(left):
            total[i] += np.abs(m[:, right] - m[:, [s]]).sum(axis=0)
    total -= len(terms) * np.abs(zero[left][:, None] - zero[right][None, :])
    i, j = np.nonzero(total)
    return pd.DataFrame({"lang": pdf.lang.iloc[0], "i": a * tile + left[i], "j": b * tile + right[j] % tile, "f": total[i, j]})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source", tile: int = TILE) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                      for c, n in ((lang_col, "lang"), (source_col, "source"))], text_or_empty(text_col).alias("text"))
    groups = d.select("lang", "source").distinct()
    kept = stage(kept_counts(d, min_docs), "kept-terms")
    langs = (kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n")))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    by_name = Window.partitionBy("lang").orderBy("source")
    sides = stage(groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
                  .select("lang", "source", (F.row_number().over(by_name) - 1).cast("long").alias("idx"),
                          F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("v", F.lit(0)).alias("v"),
                          F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
                  .withColumn("none", F.lit(0))
                  .withColumn("p0", F.when(F.col("v") > 0, _share("none", "group_n")).otherwise(F.lit(0))), "sides")
    shares = (kept.join(sides, ["lang", "source"])
              .select("lang", "source", "idx", "term", _share("n", "group_n").alias("p"), _share("total", "lang_n").alias("q")))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    terms = (shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                           (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms))
    # each kept row goes to the tiles of its source's block; each tile has all its sources' p of count 0
    n_rows = kept.count()
    salts = 1 + n_rows // TILE_ROWS
    block = F.floor(F.col("idx") / tile).cast("int")
    tiles = sides.groupBy("lang").agg((F.floor(F.max("idx") / tile) + 1).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")

    def placed(rows: DataFrame, salt) -> DataFrame:
        return (rows.join(tiles, "lang").withColumn("block", block).select("*", other)
                .select("lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
                        salt.alias("salt"), "idx", "term", "p"))

    base = placed(sides.filter("v > 0").select("lang", "idx", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p")),
                  F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))))
    rows = placed(shares.select("lang", "idx", "term", "p"), F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int"))
    sums = (base.unionByName(rows).groupBy("lang", "a", "b", "salt")
            .applyInPandas(lambda pdf: _tile_sums(pdf, tile), "lang string, i long, j long, f long")
            .select("lang", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "f", (F.col("i") > F.col("j")).alias("twice"))
            .filter("i < j AND NOT twice").groupBy("lang", "i", "j").agg(F.sum("f").alias("f")))
    x = sides.select("lang", F.col("source").alias("s"), F.col("idx").alias("x"), F.col("p0").alias("px"), "v")
    y = sides.select("lang", F.col("source").alias("item"), F.col("idx").alias("y"), F.col("p0").alias("py"))
    pairs = (x.join(y, "lang").filter("x <> y")
             .withColumn("i", F.least("x", "y")).withColumn("j", F.greatest("x", "y"))
             .join(sums, ["lang", "i", "j"], "left")
             .select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), "item",
                     (F.col("v") * F.abs(F.col("px") - F.col("py")) + F.coalesce("f", F.lit(0))).cast("long").alias("value"))
             .withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(terms)


def op12_source_divergence(spark, sf_dir):
    return divergence(documents(spark, sf_dir))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term
      GROUP BY t.lang, t.source, t.term),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE cnt > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50"""
