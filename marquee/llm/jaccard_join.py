"""N-gram Jaccard join as a blocked sparse product of documents by shingles.

A document is the set of its distinct word shingles (64-bit hashes).  Equal
sets are one class; the incidence matrix has a row a class.  Two sets that are
similar enough share at least ``min(shared(n), shared(m))`` of the first
``kept(n)`` and ``kept(m)`` shingles in hash order, so only those columns are
multiplied (sets of up to ``SHORT`` shingles have all of them).

* Columns are dealt to tasks by shingle and sorted, a block of columns at a
  time.  A column of at most ``CROWD`` classes adds 1 to the overlap of each of
  its pairs whose sizes allow a link; overlaps are added up over all blocks.
* Of a crowded column only its classes are noted, so no column is multiplied
  out by the square of its length.  A pair whose overlap, with all that its
  crowded columns could add, is below the bound of its sizes is discarded.
* A pair that shares no other column shares as many crowded ones as that bound,
  so only classes with so many need a further look, at each other.  For them all
  shingles are counted; a class too few of whose shingles another one has is
  done, and of the rest only the rarest shingles are columns (prefix filter:
  a linked pair shares one of the first n - least(n) + 1 in order of rarity).
* In such a column each class is first compared with its neighbour by size, as
  every class is with its best partner in the others; once those links are
  joined to components, the pairs whose ends are in different components are
  compared, if the places of the column in both orders leave room for a link and
  the parities of their sets do: a set's shingles are dealt to ``PARITIES`` cells,
  and two sets differ in at least as many shingles as cells whose counts are odd
  in one of them only.  Both bounds are exact; the second gets weak for sets of
  some thousand shingles.
  All links are confirmed on full sets, built anew for the classes concerned.

No link between different texts is lost, and none is found by chance but for
equal 64-bit hashes of different shingles.

Defined cases: null text, texts without words = empty set, linked with nothing
(component: the document itself); fewer words than a shingle = the whole
sequence as one; rows that repeat, also under one identifier with different
texts, are judged by their own text; a null identifier is neither linked nor
links others (component null); an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, stage, text_or_empty
from marquee.llm.near_dedup import components, shingle_sets
from marquee.llm.words import mix

SHINGLE, PERCENT = 5, 80
#: Sets of at most so many shingles have all of them in the product.
SHORT = 64
#: Columns of more classes are crowded.
CROWD = 32
#: Shingles of a set that one more shared column is asked for.
STEP = 20
#: Cells of a set's parities, 64 a word.
PARITIES = 512
_WORDS = [f"p{i}" for i in range(PARITIES // 64)]


def _least(n, percent: int):
    """The fewest shingles of a set of ``n`` that a partner shares."""
    return -(-n * percent // 100)


def shared(n):
    """Columns that a set of ``n`` and one not smaller share at least."""
    return 1 + n // STEP


def kept(n, percent: int):
    return np.where(n <= SHORT, n, n - _least(n, percent) + shared(n))


def _keys(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return (int(mix(s).sum(dtype=np.uint64).view(np.int64)),
                int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))


FEATURES_DDL = "doc_id long, n_shingles long, k1 long, k2 long"
_FEATURES = ["doc_id", "n_shingles", "k1", "k2"]


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, k1, k2 = [], [], []
        for _, s in shingle_sets(batch, k):
            a, b = _keys(s)
            n.append(len(s))
            k1.append(a)
            k2.append(b)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (n, k1, k2)]], names=_FEATURES)


def _own_sets(batches: Iterator[pa.RecordBatch], k: int):
    """(class, set) of the rows whose text is of the class they were joined to."""
    for batch in batches:
        cid, k1, k2 = (batch.column(c).to_pylist() for c in ("cid", "k1", "k2"))
        for i, s in shingle_sets(batch, k):
            if (k1[i], k2[i]) == _keys(s):
                yield cid[i], s


def _incidence(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        h = np.concatenate([s for _, _, s in held]).view(np.int64)
        rows = [len(s) for _, _, s in held]
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.repeat([c for c, _, _ in held], rows)),
                                           pa.array(np.repeat([n for _, n, _ in held], rows))], names=["h", "cid", "n"])

    for cid, s in _own_sets(batches, k):
        head = s[:int(kept(np.int64(len(s)), percent))]
        held.append((cid, len(s), head))
        size += len(head)
        if size > 200_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


PRODUCT_DDL = "crowded boolean, h long, a long, b long, na long, nb long, c long"


def _product(batches: Iterator[pa.RecordBatch], percent: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """Overlap counts of a partition's columns, sorted by (h, n, cid): rows
    (a, b, na, nb, c) of pairs, and (h, a, na) of crowded columns' classes."""
    held = [np.zeros(0, dtype=np.int64)] * 3
    full = None   # a column known to be crowded

    def rows(crowded, h, a, b, na, nb, c) -> pa.RecordBatch:
        m = len(a)
        zero = np.zeros(m, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(m, crowded)), *[pa.array(zero if x is None else x) for x in
                                                                            (h, a, b, na, nb, c)]],
                                          names=["crowded", "h", "a", "b", "na", "nb", "c"])

    def work(h, cid, n, last: bool):
        nonlocal held, full
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.concatenate([begin, [len(h)]]))
        many = size > crowd
        if full is not None and h[0] == full:
            many[0] = True
        # an open last column waits, unless it is crowded already
        wait = not last and not many[-1]
        full = int(h[-1]) if many[-1] else None
        tail = begin[-1] if wait else len(h)
        if wait:
            size, many, begin = size[:-1], many[:-1], begin[:-1]
        held = [x[tail:] for x in (h, cid, n)]
        if many.any():
            at = np.flatnonzero(np.repeat(many, size))
            yield rows(True, h[at], cid[at], None, n[at], None, None)
        pairs: list[np.ndarray] = []
        for k in np.unique(size[~many]):
            if k < 2:
                continue
            i, j = np.triu_indices(int(k), 1)
            first = begin[~many & (size == k)]
            x, y = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
            fits = (100 * n[x] >= percent * n[y]) & (cid[x] != cid[y])   # sorted by size
            pairs.append(np.stack([x[fits], y[fits]]))
        if pairs:
            x, y = np.concatenate(pairs, axis=1)
            swap = cid[x] > cid[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            order = np.lexsort((cid[y], cid[x]))
            x, y = x[order], y[order]
            if len(x):
                new = np.flatnonzero(np.concatenate([[True], (cid[x][1:] != cid[x][:-1]) | (cid[y][1:] != cid[y][:-1])]))
                c = np.diff(np.concatenate([new, [len(x)]]))
                yield rows(False, None, cid[x[new]], cid[y[new]], n[x[new]], n[y[new]], c)

    part: list[list[np.ndarray]] = []
    waiting = 0
    for batch in batches:
        part.append([np.asarray(batch.column(c), dtype=np.int64) for c in ("h", "cid", "n")])
        waiting += len(batch)
        if waiting >= 200_000:
            yield from work(*[np.concatenate([x, *[p[k] for p in part]]) for k, x in enumerate(held)], last=False)
            part, waiting = [], 0
    end = [np.concatenate([x, *[p[k] for p in part]]) for k, x in enumerate(held)]
    if len(end[0]):
        yield from work(*end, last=True)


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of adjacent classes of the columns of a sorted partition."""
    before = None
    for batch in batches:
        h, cid, n = (np.asarray(batch.column(c), dtype=np.int64) for c in ("h", "cid", "n"))
        if not len(h):
            continue
        if before is not None:
            h, cid, n = (np.concatenate([[x], y]) for x, y in zip(before, (h, cid, n)))
        before = h[-1], cid[-1], n[-1]
        near = (h[1:] == h[:-1]) & (100 * n[:-1] >= percent * n[1:]) & (cid[1:] != cid[:-1])
        x, y = cid[:-1][near], cid[1:][near]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, cid, n) of full sets."""
    for batch in batches:
        for cid, items in zip(batch.column("cid").to_pylist(), batch.column("items")):
            h = np.frombuffer(items.as_py(), dtype="<i8")
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), cid)), pa.array(np.full(len(h), len(h)))],
                                             names=["h", "cid", "n"])


def _rare(sets: DataFrame, percent: int) -> DataFrame:
    """h, cid, n, at: the columns of the prefix filter over ``sets`` and their
    places in the order of rarity (columns of one class come first)."""
    full = sets.mapInArrow(_columns, "h long, cid long, n long")
    k = full.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    by_class = Window.partitionBy("cid")
    return (full.join(k, "h").withColumn("s", F.count(F.lit(1)).over(by_class))
            .withColumn("at", F.col("n") - F.col("s") + F.row_number().over(by_class.orderBy("k", "h")))
            .filter(F.col("at") <= F.col("n") - _least_col("n", percent) + 1).select("h", "cid", "n", "at"))


PARITIES_DDL = "cid long, " + ", ".join(f"{w} long" for w in _WORDS)


def parities(s: np.ndarray) -> np.ndarray:
    """The words of a set's parities: one bit a cell, set where its count is odd."""
    odd = np.bincount((s % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [parities(np.frombuffer(x, dtype="<u8")) for x in batch.column("items").to_pylist()]
        words = np.array(rows, dtype=np.int64).reshape(len(rows), len(_WORDS))
        yield pa.RecordBatch.from_arrays([batch.column("cid"), *[pa.array(words[:, i]) for i in range(len(_WORDS))]],
                                         names=["cid", *_WORDS])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    ids, items = [], []
    for cid, s in _own_sets(batches, k):
        ids.append(cid)
        items.append(s.astype("<u8").tobytes())
        if len(ids) >= 500:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(items, pa.binary())], names=["cid", "items"])
            ids, items = [], []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(items, pa.binary())], names=["cid", "items"])


def confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("items").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def _least_col(n: str, percent: int) -> Column:
    return F.ceil(F.col(n) * percent / 100).cast("long")


def _asked(n: str, percent: int) -> Column:
    """Crowded columns of a class without which no pair can be in crowded ones alone."""
    low = _least_col(n, percent)
    # partners of a set this small are short too, so the whole overlap counts
    return F.when(F.floor(F.col(n) * 100 / percent) <= SHORT, low).otherwise(1 + F.floor(low / STEP))


def _bound_col(percent: int) -> Column:
    whole = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    return (F.when((F.col("na") <= SHORT) & (F.col("nb") <= SHORT), whole)
            .otherwise(1 + F.floor(F.least("na", "nb") / STEP)))


def _across(rare: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of a column's classes that are in different components, and whose
    places in the column and parities leave room for a link."""
    placed = (rare.join(roots.withColumnsRenamed({"vertex": "cid", "component": "comp"}), "cid", "left")
              .withColumn("comp", F.coalesce("comp", "cid")))
    parts = placed.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = (parts.groupBy("h").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("parts"))
             .filter("parts > 1").select("h", "main"))
    met = stage(placed.join(mixed, "h").join(sets.mapInArrow(_parities, PARITIES_DDL), "cid"), "join-met")
    x, y = (met.select("h", *[F.col(c).alias(s + c) for c in ("cid", "n", "at", "comp", *_WORDS)], F.col("main").alias(s + "main"))
            for s in ("x_", "y_"))
    x = x.filter("x_comp <> x_main")
    room = 1 + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    both = F.col("x_n") + F.col("y_n")
    differ = sum((F.bit_count(F.col("x_" + w).bitwiseXOR(F.col("y_" + w))) for w in _WORDS), F.lit(0))
    fits = ((F.col("x_comp") != F.col("y_comp")) & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
            & ((100 + percent) * room >= percent * both) & ((100 + percent) * differ <= (100 - percent) * both))
    return (x.join(y, "h").filter(fits)
            .select(F.least("x_cid", "y_cid").alias("a"), F.greatest("x_cid", "y_cid").alias("b")).distinct())


def joined(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
           text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    feats = stage(d.mapInArrow(lambda it: _features(it, shingle), FEATURES_DDL), "join-features")
    classes = stage(feats.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "k1", "k2")
                    .agg(F.min("doc_id").alias("least")).withColumn("cid", F.monotonically_increasing_id()), "join-classes")
    of = d.join(classes.select(F.col("least").alias("doc_id"), "cid", "k1", "k2"), "doc_id")
    entries = of.select("text", "cid", "k1", "k2").mapInArrow(lambda it: _incidence(it, shingle, percent), "h long, cid long, n long")
    product = stage(entries.repartition("h").sortWithinPartitions("h", "n", "cid")
                    .mapInArrow(lambda it: _product(it, percent, crowd), PRODUCT_DDL), "join-product")
    crowds = product.filter("crowded").select("h", F.col("a").alias("cid"), F.col("na").alias("n")).distinct()
    held = crowds.groupBy("cid", "n").agg(F.count(F.lit(1)).alias("v"))
    heavy = held.filter(F.col("v") >= _asked("n", percent)).select("cid")
    more = {s: held.select(F.col("cid").alias(s), F.col("v").alias("v" + s)) for s in ("a", "b")}
    overlaps = product.filter("NOT crowded").groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    could = F.col("c") + F.least(F.coalesce("va", F.lit(0)), F.coalesce("vb", F.lit(0)))
    pairs = stage(overlaps.join(more["a"], "a", "left").join(more["b"], "b", "left")
                  .filter(could >= _bound_col(percent)).select("a", "b", "c"), "join-pairs")
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(heavy).distinct()
    wanted = classes.join(ends, "cid", "left_semi").select(F.col("least").alias("doc_id"), "cid", "k1", "k2")
    sets = stage(d.join(wanted, "doc_id").select("text", "cid", "k1", "k2").mapInArrow(lambda it: _sets(it, shingle), "cid long, items binary")
                 .groupBy("cid").agg(F.first("items").alias("items")), "join-sets")
    crowded = sets.join(heavy, "cid", "left_semi")
    rare = stage(_rare(crowded, percent), "join-rare")
    near = (rare.repartitionByRange("h", "n", "cid").sortWithinPartitions("h", "n", "cid")
            .mapInArrow(lambda it: _neighbours(it, percent), "a long, b long"))
    # each class and its best partner, and neighbours of crowded columns
    best = F.max(F.struct("c", "a", "b"))
    first = stage(pairs.groupBy("a").agg(best.alias("m")).select("m.a", "m.b")
                  .union(pairs.groupBy("b").agg(best.alias("m")).select("m.a", "m.b")).union(near).distinct(), "join-first")
    links = stage(confirmed(sets, first, percent), "join-links")
    roots = components(links)
    at = {s: roots.select(F.col("vertex").alias(s), F.col("component").alias("r" + s)) for s in ("a", "b")}
    apart = (pairs.select("a", "b").join(at["a"], "a", "left").join(at["b"], "b", "left")
             .filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
    rest = stage(apart.union(_across(rare, crowded, roots, percent)).distinct().join(first, ["a", "b"], "left_anti"), "join-rest")
    if rest.limit(1).count():
        # the further links join components, so these are the vertices now
        further = stage(confirmed(sets, rest, percent).join(at["a"], "a", "left").join(at["b"], "b", "left")
                        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
                        .filter("a <> b").distinct(), "join-links")
        if further.limit(1).count():
            above = components(further).select(F.col("vertex").alias("component"), F.col("component").alias("top"))
            single = above.join(roots, "component", "left_anti").select(F.col("component").alias("vertex"), "top")
            roots = (roots.join(above, "component", "left").select("vertex", F.coalesce("top", "component").alias("component"))
                     .unionByName(single.withColumnRenamed("top", "component")))
    named = classes.select("n_shingles", "k1", "k2", "cid", "least").join(roots.withColumnRenamed("vertex", "cid"), "cid", "left")
    group = F.coalesce("component", "cid")
    least = named.groupBy(group.alias("group")).agg(F.min("least").alias("component_id"))
    of_class = named.withColumn("group", group).join(least, "group").select("n_shingles", "k1", "k2", "component_id")
    out = feats.join(of_class, ["n_shingles", "k1", "k2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op11_jaccard_join(spark, sf_dir):
    return joined(documents(spark, sf_dir))


OP11_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)"""
