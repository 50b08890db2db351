"""Statistics that must stay exact and distributed.

``aggregated_with_median`` takes two passes with the help of quantile sketches
and is what the reports use; ``exact_median`` needs none and is its fallback.

``exact_median`` returns the interpolated median (mean of the two middle
values for an even count, as pandas and DuckDB do) per group without ever
holding a whole large group in one task.  Spark's own ``median`` /
``percentile`` keep a value->count map of the whole group in the final
aggregation task, which fails for a group holding a large share of a
100 TB table.  Instead:

1. count per group; a group with at most ``threshold`` values is finished by
   ranking just those values;
2. otherwise ``percentile_approx`` gives cut points inside the interval.
   Every cut point has a bucket of its own for the values equal to it, and
   the values between two cut points are a bucket.  One aggregate counts
   them, and a cumulative sum over the (small) bucket table finds the bucket
   of the middle rank(s).  If the two middle ranks fall in different buckets,
   they are the max of one and the min of the next; if the bucket is one of
   equal values, that is the answer; else the interval narrows to the bucket.

A value that is repeated often becomes a cut point and so leaves the interval
at once; what remains shrinks to about ``1/pivots`` a round, so the rounds
grow with the logarithm of the group, whatever the ties.  The per-group state
is checkpointed in the session's shared folder between rounds.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.plans.storage import ensure_checkpoint_dir


#: Size of the quantile sketches, and the rank error taken for it (several
#: times what such a sketch has; a median outside is found by ``exact_median``).
SKETCH_SIZE, RANK_MARGIN, CUTS = 4096, 0.005, 64


def aggregated_with_median(df: DataFrame, value: str, group_cols, aggs, out_col: str = "median") -> DataFrame:
    """``df.groupBy(group_cols).agg(aggs)`` with the exact interpolated median of
    ``value`` added, in two passes over ``df`` whatever the ties.

    The first pass also builds a quantile sketch of each group.  It bounds the
    middle ranks; the second pass counts the values below the bounds and, by
    value, those within.  Their cumulative counts, first over ``CUTS``
    sections of the bounds and then within the section that holds the middle,
    give the median, so no task sees more than a small share of a group."""
    ensure_checkpoint_dir(df.sparkSession)
    gcols = list(group_cols)
    fields = [F.col(c) for c in gcols] if gcols else [F.lit(0).alias("_all")]
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    base = df.withColumns({"_g": F.struct(*fields), "_v": v})
    sketch = F.call_function("kll_sketch_agg_double", F.col("_v"), F.lit(SKETCH_SIZE))
    groups = base.groupBy("_g").agg(*aggs, F.count("_v").alias("_n"), sketch.alias("_s")).checkpoint(eager=True)
    out = groups.join(_sketched_median(base.select("_g", "_v"), groups, out_col), "_g", "left")
    names = [c for c in groups.columns if c not in ("_g", "_n", "_s")]
    return out.select(*[F.col("_g").getField(c).alias(c) for c in gcols], *names, out_col)


def _sketched_median(base: DataFrame, groups: DataFrame, out_col: str) -> DataFrame:
    """_g and the median of ``_v`` from the groups' sketches ``_s`` of ``_n`` values."""
    ranks = F.array(*[F.lit(0.5 - RANK_MARGIN + 2 * RANK_MARGIN * i / CUTS) for i in range(CUTS + 1)])
    bounds = (groups.filter("_n > 0")
              .select("_g", F.floor((F.col("_n") - 1) / 2).alias("_r1"), F.floor(F.col("_n") / 2).alias("_r2"),
                      F.call_function("kll_sketch_get_quantile_double", F.col("_s"), ranks).alias("_cuts")))
    v, lo, hi = F.col("_v"), F.col("_cuts")[0], F.col("_cuts")[CUTS]
    section = F.when(v < lo, F.lit(-1)).otherwise(F.size(F.filter("_cuts", lambda c: c < v)))
    counts = (base.filter(v.isNotNull()).join(bounds.select("_g", "_cuts"), "_g").filter(v <= hi)
              .select("_g", section.alias("_b"), F.when(v >= lo, v).alias("_v"))
              .groupBy("_g", "_b", "_v").agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sections = (counts.groupBy("_g", "_b").agg(F.sum("_c").alias("_k"))
                .withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0)))
                .join(bounds.select("_g", "_r1", "_r2"), "_g"))

    def within(r, start, k):
        return (F.col(start) <= F.col(r)) & (F.col(r) < F.col(start) + F.col(k))

    held = sections.filter((F.col("_b") >= 0) & (within("_r1", "_before", "_k") | within("_r2", "_before", "_k")))
    inside = Window.partitionBy("_g", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    fine = (counts.join(held.select("_g", "_b", "_before", "_r1", "_r2"), ["_g", "_b"])
            .withColumn("_at", F.col("_before") + F.coalesce(F.sum("_c").over(inside), F.lit(0))))

    def found(r):
        return F.max(F.when(within(r, "_at", "_c"), F.col("_v")))

    middle = (fine.groupBy("_g").agg(found("_r1").alias("_x"), found("_r2").alias("_y"))
              .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
              .select("_g", ((F.col("_x") + F.col("_y")) / 2).alias(out_col)).checkpoint(eager=True))
    missed = bounds.select("_g").join(middle, "_g", "left_anti")
    if missed.limit(1).count():
        rest = exact_median(base.join(missed, "_g", "left_semi"), "_v", ["_g"], out_col=out_col)
        middle = middle.unionByName(rest)
    return middle


def _interval(base: DataFrame, state: DataFrame) -> DataFrame:
    """The values of each group in ``state`` that lie in its interval."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    return base.join(state, "_g").filter((lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi)))


def exact_median(df: DataFrame, value: str, group_cols=(), threshold: int = 200_000,
                 pivots: int = 64, accuracy: int = 10_000, out_col: str = "median",
                 on_round=None) -> DataFrame:
    """Exact median of ``value`` per ``group_cols`` (nulls and NaN ignored).

    Runs a few small jobs eagerly and returns a small frame
    ``(*group_cols, out_col)``; groups without values are absent.
    ``on_round`` is called with the number of each narrowing round.
    """
    ensure_checkpoint_dir(df.sparkSession)
    gcols = list(group_cols)
    # The group travels as one struct key: it is never null itself and struct
    # equality treats null fields as equal, so a null group is joined back to
    # its state like any other instead of dropping out of the equi-joins.
    fields = [F.col(c) for c in gcols] if gcols else [F.lit(0).alias("_all")]
    base = (df.select(F.struct(*fields).alias("_g"), F.col(value).cast("double").alias("_v"))
            .filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    state = (base.groupBy("_g").agg(F.count(F.lit(1)).cast("long").alias("_cnt"))
             .select("_g", F.floor((F.col("_cnt") - 1) / 2).cast("long").alias("_r1"),
                     F.floor(F.col("_cnt") / 2).cast("long").alias("_r2"),
                     F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"),
                     F.lit(0).cast("long").alias("_below"), "_cnt")
             .checkpoint(eager=True))
    done, rounds = [], 0
    small = state.filter(F.col("_cnt") <= threshold)
    large = state.filter(F.col("_cnt") > threshold)
    while large.limit(1).count():
        rounds += 1
        if on_round is not None:
            on_round(rounds)
        picked = _middle_buckets(base, large, pivots, accuracy).checkpoint(eager=True)
        split = F.col("_x1._b") != F.col("_x2._b")
        constant = F.col("_x1._mn") == F.col("_x1._mx")
        done.append(picked.filter(split | constant).select(
            "_g", F.when(split, (F.col("_x1._mx") + F.col("_x2._mn")) / 2)
            .otherwise(F.col("_x1._mn")).alias(out_col)))
        left = picked.filter(~split & ~constant).select(
            "_g", "_r1", "_r2", F.col("_x1._mn").alias("_lo"), F.col("_x1._mx").alias("_hi"),
            (F.col("_below") + F.col("_x1._before")).alias("_below"), F.col("_x1._c").alias("_cnt"))
        small = small.unionByName(left.filter(F.col("_cnt") <= threshold))
        large = left.filter(F.col("_cnt") > threshold)
    done.append(_ranked_middle(base, small, out_col))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if gcols:
        return out.select(*[F.col("_g").getField(c).alias(c) for c in gcols], out_col)
    return out.select(out_col)


def _middle_buckets(base: DataFrame, large: DataFrame, pivots: int, accuracy: int) -> DataFrame:
    """For each large group the buckets that hold its middle ranks."""
    sub = _interval(base, large)
    cuts = [i / pivots for i in range(1, pivots)]
    piv = sub.groupBy("_g").agg(F.array_distinct(F.percentile_approx("_v", cuts, accuracy)).alias("_piv"))
    below = F.size(F.filter("_piv", lambda p: p < F.col("_v")))
    bucket = below * 2 + F.array_contains("_piv", F.col("_v")).cast("int")
    buckets = (sub.select("_g", "_v").join(piv, "_g").select("_g", "_v", bucket.alias("_b"))
               .groupBy("_g", "_b")
               .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
    wb = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    located = (buckets.withColumn("_before", F.coalesce(F.sum("_c").over(wb), F.lit(0)))
               .join(large.select("_g", "_r1", "_r2", "_below"), "_g")
               .withColumn("_t1", F.col("_r1") - F.col("_below"))
               .withColumn("_t2", F.col("_r2") - F.col("_below")))

    def holds(t):
        return (F.col("_before") <= F.col(t)) & (F.col(t) < F.col("_before") + F.col("_c"))

    return located.groupBy("_g").agg(
        F.max(F.when(holds("_t1"), F.struct("_b", "_c", "_mn", "_mx", "_before"))).alias("_x1"),
        F.max(F.when(holds("_t2"), F.struct("_b", "_mn"))).alias("_x2"),
        F.first("_r1").alias("_r1"), F.first("_r2").alias("_r2"), F.first("_below").alias("_below"))


def _ranked_middle(base: DataFrame, small: DataFrame, out_col: str) -> DataFrame:
    """The median of groups whose interval holds at most the threshold."""
    w = Window.partitionBy("_g").orderBy("_v")
    ranked = _interval(base, small).withColumn("_rank", F.col("_below") + F.row_number().over(w) - 1)

    def at(r):
        return F.max(F.when(F.col("_rank") == F.col(r), F.col("_v")))

    return (ranked.filter((F.col("_rank") == F.col("_r1")) | (F.col("_rank") == F.col("_r2")))
            .groupBy("_g").agg(((at("_r1") + at("_r2")) / 2).alias(out_col)))


def correlations(df: DataFrame, columns, decimals: int = 6) -> DataFrame:
    """Pairwise Pearson correlation over rows where both values are present:
    one aggregate for all pairs, then one row per pair
    (metric_a, metric_b, pairs, correlation).

    Computed as ``covar_pop / sqrt(var_pop_a * var_pop_b)`` over the pair's
    rows (Spark's stable moment aggregates) with ``try_divide``: an
    undefined correlation (fewer than two pairs, or a constant column) is
    null instead of failing the job, which Spark's ``corr`` does under ANSI.
    """
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        xa = F.when(both, F.col(a).cast("double"))
        xb = F.when(both, F.col(b).cast("double"))
        aggs += [F.covar_pop(xa, xb).alias(f"cov{i}"), F.var_pop(xa).alias(f"va{i}"),
                 F.var_pop(xb).alias(f"vb{i}"), F.count_if(both).alias(f"n{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"n{i}").alias("pairs"),
        F.round(F.try_divide(F.col(f"cov{i}"), F.sqrt(F.col(f"va{i}") * F.col(f"vb{i}"))),
                decimals).alias("correlation"))
        for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")
