"""Mixing sources to target weights by systematic sampling (native).

Every document of a source has the same expected number of copies, the
source's rate (target words / source words).  The expected copies are
prefix-summed along an order of the source's documents, one random offset is
added, and a document is emitted once for each integer boundary its interval
crosses.  The order is by size class, so neighbours have near sizes and the
words taken stay within about one long document of the target.  A source's
offset is, of ``DRAWS`` seeded random draws, the one whose words come nearest
its target: small sources with a few long documents need that.

The prefix sum needs no task that sees a whole source: documents are counted
per (source, size class, hash bucket), those counts are summed along the
source (at most size classes x buckets rows a source, whatever the number of
documents), and only positions inside one bucket are numbered by a window.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; documents of size 0 get copies like any other and take no
words; a source without words has target 0; repeated rows are documents of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import documents, stage, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20


#: Random offsets of which each source uses one.
DRAWS = 32


def offsets(seed: int = SEED) -> list[float]:
    """The random offsets in (0, 1) that a mix draws."""
    rng = random.Random(seed)
    return [round(rng.uniform(0.01, 0.99), 6) for _ in range(DRAWS)]


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """skey, source, source_size, target, rate from rows (skey, source, size).

    Weights repeat along the sources by code point, null last.  Targets share
    all words by weight; a source whose share passes ``cap`` times its size
    stops there.  Sorted by cap / weight, a source is capped exactly if its
    cap is within its share of what the sources before it leave, so no
    iteration is needed.  One row a source: the windows here order sources,
    not documents.
    """
    per = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.select("*", w.alias("w"), F.row_number().over(by_name).alias("pos"),
                     (F.col("source_size") * F.lit(float(cap))).alias("most"))
    order = Window.orderBy(F.col("most") / F.col("w"), "pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(every).cast("double"))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
           .withColumn("capped", F.col("most") * F.sum("w").over(after) <= F.col("w") * F.col("left")))
    per = (per.withColumn("free", F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(every), F.lit(0.0)))
           .withColumn("free_w", F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)))
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("w") * F.col("free") / F.col("free_w"))
    return per.select("skey", "source", "source_size", target.alias("target"),
                      F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def _size_class(size: Column) -> Column:
    """Sixteen classes to a doubling, in the order of the sizes."""
    bits = F.length(F.bin(size))
    shift = F.greatest(bits - 5, F.lit(0))
    return (bits * 32 + F.call_function("shiftright", size, shift)).cast("long")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, cap: float = CAP, seed: int = SEED, with_rows: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and, with rows, the document's ``row``."""
    src = F.col(source_col).cast("string")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    cols = [F.col(id_col).alias("doc_id"), src.alias("source"),
            F.coalesce(F.concat(F.lit("1"), src), F.lit("0")).alias("skey"),
            word_count(text_or_empty(text_col)).alias("size"), key.alias("key")]

    def classed(df: DataFrame) -> DataFrame:
        return df.withColumn("cls", _size_class(F.col("size"))).withColumn("hb", F.substring("key", 1, 2))

    narrow = classed(stage(docs.select(*cols), "mix-sizes"))
    chunks = (narrow.groupBy("skey", "cls", "hb")
              .agg(F.first("source").alias("source"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    along = Window.partitionBy("skey").orderBy("cls", "hb").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select("skey", "cls", "hb", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start"))
    targets = source_targets(chunks, weights, cap).drop("source")
    starts = starts.join(targets, "skey")
    inside = Window.partitionBy("skey", "cls", "hb").orderBy("size", "key")

    def numbered(df: DataFrame) -> DataFrame:
        return (df.join(starts, ["skey", "cls", "hb"])
                .withColumn("k", (F.col("start") + F.row_number().over(inside)).cast("double")))

    def crossed(u: Column) -> Column:
        return (F.floor(F.col("k") * F.col("rate") + u) - F.floor((F.col("k") - 1.0) * F.col("rate") + u)).cast("long")

    draws = offsets(seed)
    tried = (numbered(narrow).groupBy("skey")
             .agg(F.first("target").alias("target"),
                  *[F.sum(F.col("size") * crossed(F.lit(u))).alias(f"t{i}") for i, u in enumerate(draws)]))
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{i}") - F.col("target")), F.lit(i), F.lit(u).alias("u"))
                                    for i, u in enumerate(draws)]))
    chosen = tried.select("skey", nearest["u"].alias("u"))
    d = narrow
    if with_rows:
        d = classed(docs.select(*cols, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    out = numbered(d).join(chosen, "skey")
    return out.select("doc_id", "source", "size", "source_size", "target", crossed(F.col("u")).alias("copies"),
                      *(["row"] if with_rows else []))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it."""
    rows = copies(docs, with_rows=True, **options).filter("copies > 0")
    return rows.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "row").select("row.*")


def op2_mixing(spark, sf_dir):
    return copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS pos FROM s),
w AS (SELECT *, CAST(CASE (pos - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w,
             source_size * CAST(3 AS DOUBLE) AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM r),
c AS (SELECT *, most * sum(w) OVER (ORDER BY most / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
             <= w * (total - coalesce(sum(most) OVER (ORDER BY most / w, pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped FROM w),
f AS (SELECT *, total - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0) AS free,
             sum(CASE WHEN NOT capped THEN w END) OVER () AS free_w FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN most ELSE w * free / free_w END AS target FROM f),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY
               length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)),
               substr(key, 1, 2), size, key) AS DOUBLE) AS k FROM d),
j AS (SELECT k.doc_id, k.source, k.size, k.k, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
u AS (SELECT unnest(range({DRAWS})) AS i, unnest({offsets()!r}) AS u),
a AS (SELECT source, i, u.u, sum(size * (floor(k * rate + u.u) - floor((k - 1.0) * rate + u.u))) AS words,
             first(target) AS target FROM j, u GROUP BY source, i, u.u),
b AS (SELECT source, u FROM a
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(words - target), i) = 1)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(k * rate + u) - floor((k - 1.0) * rate + u)) AS BIGINT) AS taken
FROM j JOIN b ON j.source IS NOT DISTINCT FROM b.source"""
