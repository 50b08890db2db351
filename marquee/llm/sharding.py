"""Sharding by Hilbert-curve order (native).

Several metadata dimensions are quantised at their quantiles to a few bits
each, a document's cell on the Hilbert curve through that grid is computed
with SQL higher-order functions, and the documents, sorted by curve index,
are cut into runs of equal row counts (law ``rows``: counts at most one
apart).  Documents near in all dimensions share a shard, so min/max
statistics of the written files prune by any of them.

The global position needs no task that sees all rows: rows are counted per
(cell, hash bucket); cells (at most 2^(bits x dimensions) rows) are summed in
one small window, buckets inside their cell, rows inside their bucket, so a
cell with a third of all rows is numbered in 1/256 parts.

Defined cases: null text has no bytes and the checksum of the empty text;
null dimensions sort first; a null identifier and repeated rows are rows like
any other; with fewer rows than shards some shards are empty; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, stage, text_or_empty

SHARDS = 24
BITS = 4


def hilbert_index(coords: list[Column], bits: int) -> Column:
    """Position on the Hilbert curve of a grid point.

    ``coords`` are integers in [0, 2^bits).  The rotations of each level are
    undone from the coarsest bit to the second finest, the result is Gray
    decoded and its bits are interleaved (the transpose form of the curve).
    """
    n = len(coords)
    x = F.array(*[c.cast("long") for c in coords])
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(a, s):
        low = s["q"] - 1
        first, this = F.element_at(a, 1), F.element_at(a, s["i"] + 1)
        swap = first.bitwiseXOR(this).bitwiseAND(low)
        up = this.bitwiseAND(s["q"]) != 0
        return F.transform(a, lambda v, j: F.when(up, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                           .when(s["i"] == 0, v)
                           .when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v))

    # Each stage hands its result on through ``finish``: a lambda variable is
    # evaluated once, while a column named in a lambda would be evaluated
    # again for every element (thirty times the CPU time of the whole query).
    def interleaved(a: Column, flips: Column) -> Column:
        places = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i + 1).alias("i"))
                           for b in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(places, F.lit(0).cast("long"), lambda t, p: t * 2 + F.when(
            F.element_at(a, p["i"]).bitwiseXOR(flips).bitwiseAND(p["q"]) != 0, 1).otherwise(0))

    def flipped(a: Column) -> Column:
        if bits < 2:
            return interleaved(a, F.lit(0).cast("long"))
        qs = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
        return F.aggregate(qs, F.lit(0).cast("long"), lambda t, q: F.when(
            F.element_at(a, n).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t), lambda t: interleaved(a, t))

    def gray(a: Column) -> Column:
        if n < 2:
            return flipped(a)
        axes = F.array(*[F.lit(i) for i in range(1, n)])
        return F.aggregate(axes, a, lambda g, i: F.transform(
            g, lambda v, j: F.when(j == i, v.bitwiseXOR(F.element_at(g, i))).otherwise(v)), flipped)

    return F.aggregate(steps, x, undo, gray) if bits > 1 else gray(x)


def text_cuts(df: DataFrame, dim: str, bits: int) -> DataFrame:
    """One row: the 2^bits - 1 quantile cuts of a text dimension, whole values.

    Rows are counted per distinct value; the values are sorted in ranges, and
    only the ranges' totals meet in one task.
    """
    counts = df.groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    placed = stage(counts.repartitionByRange(dim).withColumn("part", F.spark_partition_id()), "shard-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.sum("n").alias("part_n"))
    parts = parts.select("part", F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("start"),
                         F.sum("part_n").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(dim).rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.join(parts, "part").withColumn("upto", F.col("start") + F.sum("n").over(inside))
    return upto.agg(F.array(*[F.min(F.when(F.col("upto") * (1 << bits) >= F.col("total") * i, F.col(dim)))
                              for i in range(1, 1 << bits)]).alias(f"cuts_{dim}"))


def quantised(df: DataFrame, texts: list[str], numbers: list[str], bits: int) -> DataFrame:
    """``df`` with an integer column q_<i> in [0, 2^bits) for each dimension,
    text ones first: how many of its 2^bits - 1 quantile cuts lie below the
    value.  The cuts are one row of at most dims x 2^bits values (a bounded
    broadcast)."""
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    wide = df.crossJoin(F.broadcast(df.agg(*[F.percentile_approx(d, cuts, 10_000).alias(f"cuts_{d}") for d in numbers])))
    for dim in texts:
        wide = wide.crossJoin(F.broadcast(text_cuts(df, dim, bits)))

    def cuts_below(dim: str) -> Column:
        return F.coalesce(F.size(F.filter(f"cuts_{dim}", lambda c: c < F.col(dim))), F.lit(0))

    q = [cuts_below(d) for d in [*texts, *numbers]]
    return wide.select(*[F.col(c) for c in df.columns],
                       *[F.greatest(c, F.lit(0)).alias(f"q_{i}") for i, c in enumerate(q)])


def curve_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, curve (index), shard, slot; the dimensions
    are source, language and size."""
    text = text_or_empty(text_col)
    narrow = stage(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_or_empty(source_col).cast("binary").alias("d_source"), text_or_empty(lang_col).cast("binary").alias("d_lang")),
        "shard-keys")
    cells = quantised(narrow, ["d_source", "d_lang"], ["size"], bits)
    cells = (cells.withColumn("curve", hilbert_index([F.col(f"q_{i}") for i in range(3)], bits))
             .withColumn("hb", F.pmod(F.xxhash64("text_crc32", "doc_id"), F.lit(256)).cast("int"))
             .select("doc_id", "size", "text_crc32", "curve", "hb"))
    cells = stage(cells, "shard-cells")
    buckets = cells.groupBy("curve", "hb").agg(F.count(F.lit(1)).alias("n"))
    per_cell = cells.groupBy("curve").agg(F.count(F.lit(1)).alias("cell_n"))
    upto = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.select("curve", F.coalesce(F.sum("cell_n").over(upto), F.lit(0)).alias("cell_start"),
                               F.sum("cell_n").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("curve").orderBy("hb").rowsBetween(Window.unboundedPreceding, -1)
    starts = (buckets.withColumn("b_start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(per_cell, "curve")
              .select("curve", "hb", (F.col("cell_start") + F.col("b_start")).alias("start"), "total"))
    place = Window.partitionBy("curve", "hb").orderBy("size", "text_crc32", "doc_id")
    ranked = (cells.join(starts, ["curve", "hb"])
              .withColumn("rank", F.col("start") + F.row_number().over(place) - 1))
    ranked = ranked.withColumn("shard", F.expr(f"rank * {shards} div total"))
    return ranked.select("doc_id", "size", "text_crc32", "curve", F.col("shard").cast("int").alias("shard"),
                         (F.col("rank") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).alias("slot"))


def op6_sharding(spark, sf_dir):
    return curve_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")
