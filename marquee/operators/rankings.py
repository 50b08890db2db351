"""Top-N rankings.

``rank_by_metric`` plans as ``TakeOrderedAndProject``: each task keeps its
own top n and one merge follows, so no full sort and no large shuffle.
``rankings_long`` computes all ten rankings together.  A first aggregate takes
the best key of each ranking in each of ``CUT_BUCKETS`` buckets of ids; n rows at
least reach the n-th best of those, so it is a safe cut.  The rows that reach it
(about n a ranking, and those equal to the cut) are ranked, where
``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit`` before
the exchange; the winners are then joined back to their titles.  A ranking with
values in fewer than n buckets has no cut and is ranked whole.

Ties are broken by ``id`` ascending, which always yields one of the answers
an arbitrary tie cut could give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import DEFAULTS, RANKING_TABLE, Settings, resolve_top_n
from marquee.operators.metrics import with_metrics

RANKING_PROJECTION = ("title", "release_date", "genres")


RANKING_NAMES = tuple(r[0] for r in RANKING_TABLE)


def _extra_filter(kind, settings: Settings):
    if kind == "min_budget":
        return F.col("budget_musd") >= settings.min_budget_for_roi
    if kind == "min_votes":
        return F.col("vote_count") >= settings.min_votes_for_rating
    return None


def ranking_specs(settings: Settings = DEFAULTS):
    """(name, metric, ascending, extra filter Column or None)."""
    return [(n, m, a, _extra_filter(k, settings)) for n, m, a, k in RANKING_TABLE]


def _implied(metric: str, columns):
    """Predicates on stored columns implied by ``metric IS NOT NULL`` for the
    derived metrics; unlike the derived expression they reach the Parquet
    scan as pushed filters."""
    if metric == "roi" and {"revenue_musd", "budget_musd"} <= set(columns):
        return F.col("revenue_musd").isNotNull() & (F.col("budget_musd") > 0)
    if metric == "profit" and {"revenue_musd", "budget_musd"} <= set(columns):
        return F.col("revenue_musd").isNotNull() & F.col("budget_musd").isNotNull()
    return None


def rank_by_metric(df: DataFrame, metric: str, ascending: bool = False, filter_expr=None,
                   top_n=None, tiebreak: str = "id", settings: Settings = DEFAULTS) -> DataFrame:
    n = resolve_top_n(top_n, settings)
    out = df
    implied = _implied(metric, df.columns)
    if implied is not None:
        out = out.filter(implied)
    out = out.filter(F.col(metric).isNotNull())
    if filter_expr is not None:
        out = out.filter(filter_expr)
    order = [F.col(metric).asc() if ascending else F.col(metric).desc()]
    if tiebreak and tiebreak in df.columns:
        order.append(F.col(tiebreak).asc())
    return out.orderBy(*order).limit(n).select("title", metric, "release_date", "genres")


def ranking(df: DataFrame, name: str, top_n=None, settings: Settings = DEFAULTS) -> DataFrame:
    """One named ranking over the clean table."""
    for nm, metric, asc, flt in ranking_specs(settings):
        if nm == name:
            return rank_by_metric(with_metrics(df), metric, asc, flt, top_n, settings=settings)
    raise KeyError(name)


#: Buckets of ids whose best keys give the cuts of the rankings.
CUT_BUCKETS = 4096


def _entries(settings: Settings):
    """(ranking, value where the ranking takes the row else null, key ascending)."""
    for name, metric, asc, flt in ranking_specs(settings):
        value = F.col(metric).cast("double")
        value = value if flt is None else F.when(flt, value)
        yield name, value, value if asc else -value


def ranking_cuts(df: DataFrame, n: int, settings: Settings = DEFAULTS) -> DataFrame:
    """ranking, cut: a key that at least n rows of the ranking reach, or null."""
    entries = list(_entries(settings))
    best = (with_metrics(df).groupBy(F.pmod(F.xxhash64("id"), F.lit(CUT_BUCKETS)).alias("_bucket"))
            .agg(*[F.min(key).alias(name) for name, _, key in entries]))
    long = best.select(F.explode(F.array(*[F.struct(F.lit(name).alias("ranking"), F.col(name).alias("key"))
                                           for name, _, _ in entries])).alias("_r")).select("_r.*")
    return long.groupBy("ranking").agg(F.get(F.sort_array(F.collect_list("key")), n - 1).alias("cut"))


def ranking_candidates(df: DataFrame, n: int, settings: Settings = DEFAULTS) -> DataFrame:
    """id, ranking, value, key of the rows that reach the cuts; all n best are among them."""
    pairs = F.filter(F.array(*[F.when(value.isNotNull(), F.struct(F.lit(name).alias("ranking"), value.alias("value"), key.alias("key")))
                               for name, value, key in _entries(settings)]), lambda e: e.isNotNull())
    narrow = with_metrics(df).select("id", F.explode(pairs).alias("_r")).select("id", "_r.ranking", "_r.value", "_r.key")
    # one row a ranking
    cuts = F.broadcast(ranking_cuts(df, n, settings))
    return narrow.join(cuts, "ranking", "left").filter(F.col("cut").isNull() | (F.col("key") <= F.col("cut"))).drop("cut")


def rankings_long(df: DataFrame, top_n=None, settings: Settings = DEFAULTS) -> DataFrame:
    """All ten rankings, long form:
    ranking, rank, title, value, release_date, genres.

    Candidates (ranking, key, id) are ranked; the winners, n a ranking and
    so a proven bound for the broadcast, then fetch their titles."""
    n = resolve_top_n(top_n, settings)
    w = Window.partitionBy("ranking").orderBy(F.col("key").asc(), F.col("id").asc())
    winners = (ranking_candidates(df, n, settings).withColumn("rank", F.row_number().over(w))
               .filter(F.col("rank") <= n).select("ranking", "rank", "id", "value"))
    return (df.select("id", *RANKING_PROJECTION).join(F.broadcast(winners), "id")
            .select("ranking", "rank", "title", "value", "release_date", "genres"))
