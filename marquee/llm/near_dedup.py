"""Near-duplicate groups by MinHash and an LSH forest.

A document is the set of its distinct word shingles.  Equal sets are one
class from the start (grouped by size and a 128-bit sum of the set, reduced
before the shuffle), so copies never meet as pairs.  Each class has a
signature of ``HASHES`` minima; a tree of the forest is a choice of ``DEPTH``
of them, in order, and its sorted order of the classes' labels puts similar
classes next to each other.  The minima are dealt to the trees, so no two trees
share one of their first ``BASE`` values.

* Region: the classes whose labels share the first ``BASE`` values.  A region
  of at most ``SMALL`` classes gives all its pairs; a larger one is cut one
  value deeper, and so on, so depth adapts to how crowded a region is.
* In all regions, neighbours in the sorted order (longest common prefix)
  are candidates, at whatever depth they part.
* A candidate pair goes on when its sizes allow a link.  If both sets have
  ``SKETCHED`` shingles or more, their sketches (one bit of each minimum) must
  also agree in no fewer places than ``DEVIATIONS`` standard deviations below
  what a pair at the threshold has: of 200,000 simulated pairs at 0.80 with the
  smallest such sets none was further off than 5.6.  In smaller sets all minima
  come from few shingles, so their bits go together; those pairs have no sketch
  test.
* Regions that were cut may have parted a linked pair.  For them there is a
  second round, over such regions of all trees: after the links
  found so far are joined to components, each region in which several
  components meet is compared on full sets, every class outside the region's
  main component against all of the region.  Classes too few of whose
  shingles occur in another class of those regions cannot be linked and are
  left out first.  The main component's classes and the others are split into
  blocks of ``BLOCK_ITEMS`` shingles; blocks of others meet all blocks, main
  blocks do not meet each other, so a task's memory is bounded and a region
  with few others ships each main class once.  Only links that join two
  components leave a task, never pairs.

The sorted order is cut into ranges, so a region with a large part of all
classes is read by several tasks, each as a stream that holds a few rows.
Regions at the ends of a range go to the second round whatever their size, so
a pair that a cut parts is compared there.

Every candidate pair is confirmed on the full sets with integer arithmetic
(100 * intersection >= percent * union).  Components grow by hooking and
pointer jumping over the confirmed links.

Measured with these trees and hashes on random pairs of sets (unions of 300
shingles): of 400,000 pairs at 0.85 none, at 0.80 one shared no region.

Defined cases: null or blank text has the empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is one shingle;
rows with the same identifier and different texts are judged by their own text
(of a group the rows with its smallest identifier and its smallest set key
stay, so one text stays); rows without identifier are
linked with nothing, have no component and are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bits import bit_filter, bit_set
from marquee.llm.common import documents, stage, text_or_empty
from marquee.llm.words import SPACED, blocks, mix, sequence_hashes, tokenised, whole_hash

HASHES, TREES, DEPTH, BASE, SMALL = 96, 24, 8, 4, 4
DEVIATIONS = 7
#: Shingles that both sets of a pair have at least for their sketches to count.
SKETCHED = 256
#: Shingles of a block of a region.
BLOCK_ITEMS = 1_000_000
_RNG = np.random.RandomState(11)
_MULTIPLIERS = (_RNG.randint(0, 1 << 31, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_OFFSETS = _RNG.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def sketch_agreement(percent: int) -> int:
    """The least number of agreeing sketch bits of a candidate pair."""
    p = (1 + percent / 100) / 2
    return math.floor(HASHES * p - DEVIATIONS * math.sqrt(HASHES * p * (1 - p)))


def tree_choice(tree: int) -> list[int]:
    """The signature values of a tree, in order."""
    first = np.random.RandomState(1000).permutation(HASHES)[BASE * tree:BASE * (tree + 1)].tolist()
    further = np.random.RandomState(1000 + tree).permutation(HASHES).tolist()
    return first + [j for j in further if j not in first][:DEPTH - BASE]


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, sorted distinct shingle hashes) of a batch."""
    for begin, texts in blocks(batch, lower=True):
        b = tokenised(texts, SPACED)
        h = b.hashes()
        for d in range(len(texts)):
            mine = h[b.first[d]:b.first[d + 1]]
            if len(mine) >= k:
                yield begin + d, np.unique(sequence_hashes(mine, k))
            elif len(mine):
                yield begin + d, np.array([whole_hash(mine)], dtype=np.uint64)
            else:
                yield begin + d, np.zeros(0, dtype=np.uint64)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima a set (all sets non-empty)."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    y = np.empty_like(x)
    for j in range(HASHES):
        np.multiply(x, _MULTIPLIERS[j], out=y)
        np.bitwise_xor(y, _OFFSETS[j], out=y)
        out[:, j] = np.minimum.reduceat(y, at)
    return out


FEATURES_DDL = "doc_id long, row long, n_shingles long, k1 long, k2 long, sig binary, b1 long, b2 long"
#: Places of the sketch bits in their two words.
_HALF = HASHES // 2
_PLACES = np.int64(1) << np.arange(_HALF, dtype=np.int64)


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        out: list[list] = [[], [], [], [], [], [], []]
        part: list[tuple[int, np.ndarray]] = []
        held = 0

        def take() -> None:
            full = [p for p in part if len(p[1])]
            sigs = _signatures([s for _, s in full]) if full else np.zeros((0, HASHES), dtype=np.uint32)
            bits = (sigs & 1).astype(np.int64)
            sig = iter(zip(sigs, (bits[:, :_HALF] * _PLACES).sum(1).tolist(), (bits[:, _HALF:] * _PLACES).sum(1).tolist()))
            for i, s in part:
                out[0].append(ids[i])
                out[1].append(len(s))
                out[2].append(int(s.sum(dtype=np.uint64).view(np.int64)))
                out[3].append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                values, b1, b2 = next(sig) if len(s) else (None, None, None)
                out[4].append(values.astype(">u4").tobytes() if len(s) else None)
                out[5].append(b1)
                out[6].append(b2)

        for row in shingle_sets(batch, k):
            part.append(row)
            held += len(row[1])
            if held > 300_000:
                take()
                part, held = [], 0
        take()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), batch.column("row"), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary()), pa.array(out[5], pa.int64()),
             pa.array(out[6], pa.int64())], names=["doc_id", "row", "n_shingles", "k1", "k2", "sig", "b1", "b2"])


CANDIDATES_DDL = "kind int, x long, y long"


def _regions(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidates of a partition sorted by (tree, label), read as a stream.

    Rows (0, a, b): a candidate pair; (1, region, class): a class of a region
    that was cut deeper, or that may go on in another partition.
    """
    out: list[list[int]] = [[], [], []]
    least = sketch_agreement(percent)

    def pair(p, q) -> None:
        a, b, n, m = p[2], q[2], p[3], q[3]
        if (100 * min(n, m) >= percent * max(n, m)
                and (min(n, m) < SKETCHED or HASHES - (p[4] ^ q[4]).bit_count() - (p[5] ^ q[5]).bit_count() >= least)):
            out[0].append(0)
            out[1].append(min(a, b))
            out[2].append(max(a, b))

    def number(row) -> int:
        """The number of a row's region."""
        x = int.from_bytes(row[1][:8]) ^ (int.from_bytes(row[1][8:16]) * 31 % (1 << 64)) ^ row[0] << 7
        return int(mix(np.array([x], dtype=np.uint64))[0].view(np.int64))

    def crowd(region: int, rows: list) -> None:
        out[0].extend([1] * len(rows))
        out[1].extend([region] * len(rows))
        out[2].extend(r[2] for r in rows)

    def common(p, q) -> int:
        """How many first values two rows share."""
        if p[0] != q[0]:
            return 0
        return next((d for d in range(DEPTH) if p[1][4 * d:4 * d + 4] != q[1][4 * d:4 * d + 4]), DEPTH)

    # the open group of each depth, as far as it matters: SMALL + 1 rows
    groups: list[list] = [[] for _ in range(DEPTH + 1)]
    region, at_edge = None, True

    def close(depth: int, last: bool = False) -> None:
        """End the groups that share more than ``depth`` values."""
        nonlocal region, at_edge
        for d in range(max(depth + 1, BASE), DEPTH + 1):
            rows = groups[d]
            if len(rows) <= SMALL:
                # neighbours are pairs already, deeper groups have given theirs
                for i, p in enumerate(rows):
                    for q in rows[i + 2:]:
                        if common(p, q) == d:
                            pair(p, q)
                if d == BASE and rows and (at_edge or last):
                    crowd(number(rows[0]), rows)
            groups[d] = []
        if depth < BASE:
            region, at_edge = None, False

    before = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("tree", "label", "cls", "n", "b1", "b2"))):
            if before is not None:
                shared = common(before, row)
                if shared < DEPTH:
                    close(shared)
                if shared >= BASE:
                    pair(before, row)
            before = row
            for d in range(BASE, DEPTH + 1):
                if len(groups[d]) <= SMALL:
                    groups[d].append(row)
                    if d == BASE and len(groups[d]) > SMALL:
                        region = number(row)
                        crowd(region, groups[d][:-1])
            if region is not None:
                crowd(region, [row])
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.int64())], names=["kind", "x", "y"])
                out[:] = [[], [], []]
    close(-1, last=True)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.int64())], names=["kind", "x", "y"])


def member_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """doc_id (here a class) and the full shingle set (sorted 64-bit numbers) of
    the classes in ``ids`` (column cls), from the text that stands for each."""
    wanted = classes.join(ids.distinct(), "cls", "left_semi").select("cls", F.col("least").alias("doc_id"), "row")

    def sets(batches):
        for batch in batches:
            cls = batch.column("cls")
            held: list[bytes] = []
            begin = 0
            for i, s in shingle_sets(batch, k):
                held.append(s.astype("<u8").tobytes())
                if len(held) >= 1000:
                    yield pa.RecordBatch.from_arrays([cls[begin:i + 1], pa.array(held, pa.binary())], names=["doc_id", "items"])
                    held, begin = [], i + 1
            yield pa.RecordBatch.from_arrays([cls[begin:], pa.array(held, pa.binary())], names=["doc_id", "items"])

    return stage(docs.join(wanted, ["doc_id", "row"]).select("cls", "text").mapInArrow(sets, "doc_id long, items binary")
                 .groupBy("doc_id").agg(F.min("items").alias("items")), "near-sets")


def confirmed(items: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (rows of ``items``) are similar enough."""
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_py(), dtype="<u8"), np.frombuffer(y.as_py(), dtype="<u8")
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(items.select(F.col("doc_id").alias("a"), F.col("items").alias("sa")), "a")
            .join(items.select(F.col("doc_id").alias("b"), F.col("items").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def shared_counts(items: DataFrame) -> DataFrame:
    """vertex, c: how many of its shingles another row of ``items`` has too
    (never too few: a filter of fixed size tells shared shingles)."""
    def each(batches):
        for batch in batches:
            for x in batch.column("items"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), dtype="<i8"))], names=["m"])

    often = items.select("items").mapInArrow(each, "m long").groupBy("m").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = items.sparkSession.sparkContext.broadcast(bit_filter(often))

    def count(batches):
        for batch in batches:
            c = [int(bit_set(shared.value, np.frombuffer(x.as_py(), dtype="<u8")).sum()) for x in batch.column("items")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(c, pa.int64())], names=["vertex", "c"])
    return items.mapInArrow(count, "vertex long, c long")


def components(links: DataFrame) -> DataFrame:
    """vertex, component (its smallest reachable vertex) for the vertices of
    ``links`` (a, b).  Each round hooks vertices and their current roots to
    the smallest neighbouring root, then halves the paths; rounds grow with
    the logarithm of the component size.  Tables are written between rounds."""
    both = stage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                 .union(links.select("b", "a")).distinct(), "near-links")
    label = stage(both.groupBy(F.col("u").alias("vertex")).agg(F.least(F.col("vertex"), F.min("v")).alias("root")),
                  "near-roots")
    while True:
        seen = both.join(label.select(F.col("vertex").alias("v"), F.col("root").alias("rv")), "v")
        near = seen.groupBy("u").agg(F.min("rv").alias("least"))
        own = label.join(near.select(F.col("u").alias("vertex"), "least"), "vertex")
        hooks = (own.select("vertex", F.least("root", "least").alias("to"))
                 .union(own.select(F.col("root").alias("vertex"), "least")))
        hooked = hooks.groupBy("vertex").agg(F.min("to").alias("to"))
        jump = hooked.select(F.col("vertex").alias("to"), F.col("to").alias("far"))
        new = stage(hooked.join(jump, "to", "left").select("vertex", F.least("to", F.coalesce("far", "to")).alias("root")),
                    "near-roots")
        changed = new.join(label.withColumnRenamed("root", "was"), "vertex").filter("root <> was").limit(1).count()
        label = new
        if not changed:
            return label.withColumnRenamed("root", "component")


def _joining_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join different components of a region, from rows
    (region, lo, hi, vertex, component, main, items) sorted by the first three."""
    def close(rows: list[tuple]) -> list[tuple[int, int]]:
        items = [np.frombuffer(r[6], dtype="<u8") for r in rows]
        n = np.array([len(x) for x in items])
        _, number = np.unique(np.concatenate(items), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(n)[:-1]])
        root = {r[4]: r[4] for r in rows}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        mark = np.zeros(number.max() + 1, dtype=np.int32)
        links = []
        for i, r in enumerate(rows):
            if r[4] == r[5]:
                continue
            mine = number[at[i]:at[i] + n[i]]
            mark[mine] = 1
            shared = np.add.reduceat(mark[number], at)
            mark[mine] = 0
            for j in np.flatnonzero(100 * shared >= percent * (n + n[i] - shared)):
                x, y = top(r[4]), top(rows[j][4])
                if x != y:
                    root[x] = y
                    links.append((min(r[3], rows[j][3]), max(r[3], rows[j][3])))
        return links

    group: list[tuple] = []
    names = ("region", "lo", "hi", "vertex", "component", "main", "items")
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if group and row[:3] != group[0][:3]:
                links = close(group)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                                     names=["a", "b"])
                group = []
            group.append(row)
    if group:
        links = close(group)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def meetings(met: DataFrame) -> DataFrame:
    """region, lo, hi, vertex, component, main: which classes of ``met``
    (region, vertex, component, n) meet in which task.

    Main and other classes have blocks of their own.  Each block of others
    meets each block of main classes, and each further block of others.
    """
    parts = met.groupBy("region", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    largest = F.struct("k", "component")
    main_n = F.max_by("n", largest)
    regions = (parts.groupBy("region")
               .agg(F.max_by("component", largest).alias("main"), F.count(F.lit(1)).alias("parts"),
                    F.ceil(main_n / BLOCK_ITEMS).cast("int").alias("mains"),
                    F.ceil((F.sum("n") - main_n) / BLOCK_ITEMS).cast("int").alias("others"))
               .filter("parts > 1").drop("parts"))
    stray = F.col("component") != F.col("main")
    block = F.pmod(F.xxhash64("vertex"), F.when(stray, F.col("others")).otherwise(F.col("mains"))).cast("int")
    place = F.expr("""CASE WHEN component = main THEN transform(sequence(0, others - 1), o -> struct(o AS lo, block AS hi))
        ELSE concat(transform(sequence(0, mains - 1), m -> struct(block AS lo, m AS hi)),
                    transform(filter(sequence(0, others - 1), o -> o <> block),
                              o -> struct(least(block, o) AS lo, mains + greatest(block, o) AS hi))) END""")
    return (met.select("region", "vertex", "component").join(regions, "region").withColumn("block", block)
            .withColumn("place", F.explode(place))
            .select("region", "place.lo", "place.hi", "vertex", "component", "main"))


def links_across(met: DataFrame, classes: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Links between different components of the regions in ``met`` (region,
    vertex, component)."""
    facts = (classes.select(F.col("cls").alias("vertex"), F.col("n_shingles").alias("n"))
             .join(shared_counts(items), "vertex").filter(100 * F.col("c") >= percent * F.col("n")))
    rows = meetings(met.join(facts, "vertex")).join(items.withColumnRenamed("doc_id", "vertex"), "vertex")
    return (rows.repartition("region", "lo", "hi").sortWithinPartitions("region", "lo", "hi", "vertex")
            .select("region", "lo", "hi", "vertex", "component", "main", "items")
            .mapInArrow(lambda it: _joining_links(it, percent), "a long, b long").distinct())


def _row_key(text_col: str):
    """Tells rows of one identifier apart."""
    return F.xxhash64(text_or_empty(text_col))


def _grouped(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, row, n_shingles, component_id, kept."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_key(text_col).alias("row"),
                    text_or_empty(text_col).alias("text"))
    feats = stage(d.mapInArrow(lambda it: _features(it, shingle), FEATURES_DDL), "near-features")
    classes = stage(feats.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "k1", "k2")
                    .agg(F.first("sig").alias("sig"), F.first("b1").alias("b1"), F.first("b2").alias("b2"),
                         F.min(F.struct("doc_id", "row")).alias("rep"))
                    .select("n_shingles", "k1", "k2", "sig", "b1", "b2", F.col("rep.doc_id").alias("least"),
                            F.col("rep.row").alias("row"), F.monotonically_increasing_id().alias("cls")), "near-classes")
    labels = [F.struct(F.lit(t).alias("tree"),
                       F.concat(*[F.substring("sig", 4 * j + 1, 4) for j in tree_choice(t)]).alias("label"))
              for t in range(TREES)]
    forest = (classes.select("cls", F.col("n_shingles").alias("n"), "b1", "b2", F.explode(F.array(*labels)).alias("l"))
              .select("l.tree", "l.label", "cls", "n", "b1", "b2"))
    found = stage(forest.repartitionByRange("tree", "label", "cls")
                  .sortWithinPartitions("tree", "label", "cls")
                  .mapInArrow(lambda it: _regions(it, percent), CANDIDATES_DDL), "near-candidates")
    pairs = stage(found.filter("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "near-pairs")
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
    links = stage(confirmed(member_sets(d, classes, ends, shingle), pairs, percent), "near-confirmed")
    roots = components(links)
    # second round: crowded regions in which several components meet
    crowd = (found.filter("kind = 1").select(F.col("x").alias("region"), F.col("y").alias("vertex"))
             .join(roots, "vertex", "left").select("region", "vertex", F.coalesce("component", "vertex").alias("component")))
    mixed = (crowd.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo < hi").select("region"))
    met = stage(crowd.join(mixed, "region"), "near-crowd")
    if met.limit(1).count():
        items = member_sets(d, classes, met.select(F.col("vertex").alias("cls")), shingle)
        links2 = stage(links_across(met, classes, items, percent), "near-confirmed")
        if links2.limit(1).count():
            roots = components(links.union(links2))
    key = F.struct("least", "n_shingles", "k1", "k2")
    named = (classes.select("n_shingles", "k1", "k2", "cls", "least")
             .join(roots.select(F.col("vertex").alias("cls"), "component"), "cls", "left")
             .withColumn("group", F.coalesce("component", "cls")))
    of_class = (named.join(named.groupBy("group").agg(F.min(key).alias("first")), "group")
                .select("n_shingles", "k1", "k2", F.col("first.least").alias("component"), (key == F.col("first")).alias("is_first")))
    out = feats.select("doc_id", "row", "n_shingles", "k1", "k2").join(of_class, ["n_shingles", "k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "row", "n_shingles", component.alias("component_id"),
                      F.coalesce((F.col("doc_id") == component) & F.coalesce("is_first", F.lit(True)), F.lit(True)).alias("kept"))


def near_groups(docs: DataFrame, shingle: int = 3, percent: int = 85, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _grouped(docs, shingle, percent, id_col, text_col).drop("row")


def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, all columns as they came."""
    gone = (_grouped(docs, shingle, percent, id_col, text_col).filter("NOT kept")
            .select(F.col("doc_id").alias("__gone"), F.col("row").alias("__gone_row")).distinct())
    return docs.join(gone, (docs[id_col] == gone["__gone"]) & (_row_key(text_col) == gone["__gone_row"]), "left_anti")


def op1_near_dedup(spark, sf_dir):
    return near_groups(documents(spark, sf_dir))


OP1_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)"""
