"""Multi-criteria search over the joined-string columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import SEARCH_CAST, SEARCH_GENRES, SEARCH_PAIR_CAST, SEARCH_PAIR_DIRECTOR
from marquee.operators.numbering import running_number


def _matches(column: str, needle: str, match: str, sep: str):
    c = F.col(column)
    if match == "substring":
        return c.contains(needle)
    if match == "token":
        return F.array_contains(F.split(c, re.escape(sep)), needle)
    raise ValueError(f"match must be 'substring' or 'token', got {match!r}")


def search(df: DataFrame, all_of: dict, order_by=None, ascending: bool = True, select=None,
           match: str = "substring", sep: str = "|", tiebreak: str = "id",
           position: bool = False) -> DataFrame:
    """Rows where every needle occurs in its column.

    ``match='substring'`` is case-sensitive containment in the joined string
    (so ``Action`` also hits ``Live Action``); ``match='token'`` needs an
    exact element of the ``sep``-separated list.  A null column never
    matches.  Ordering uses Spark's default null placement (first when
    ascending, last when descending).  ``position=True`` adds each row's place
    in that order (from 1), numbered by partitions.
    """
    cond = F.lit(True)
    for column, needles in all_of.items():
        if isinstance(needles, str):
            needles = [needles]
        cond = cond & F.col(column).isNotNull()
        for n in needles:
            cond = cond & _matches(column, n, match, sep)
    out = df.filter(cond)
    if order_by is not None:
        order = [F.col(order_by).asc() if ascending else F.col(order_by).desc()]
        if tiebreak and tiebreak in df.columns and tiebreak != order_by:
            # a unique tiebreak lets the range partitioner split a run of equal
            # sort values across tasks instead of sending it to one
            order.append(F.col(tiebreak).asc())
        if position:
            out = running_number(out, order, "position")
            order = [F.col("position")]
            select = [*select, "position"] if select is not None else None
        out = out.orderBy(*order)
    if select is not None:
        out = out.select(*select)
    return out


def search_genres_cast(df: DataFrame, genres=SEARCH_GENRES, cast=SEARCH_CAST,
                       match: str = "substring", position: bool = False) -> DataFrame:
    """Titles with all ``genres`` and all ``cast``, best rated first."""
    return search(df, {"genres": list(genres), "cast": list(cast)}, order_by="vote_average",
                  ascending=False, select=["title", "vote_average", "genres", "cast"], match=match,
                  position=position)


def search_cast_director(df: DataFrame, cast=SEARCH_PAIR_CAST, director=SEARCH_PAIR_DIRECTOR,
                         match: str = "substring", position: bool = False) -> DataFrame:
    """Titles with all ``cast`` directed by ``director``, shortest first."""
    return search(df, {"cast": list(cast), "director": list(director)}, order_by="runtime",
                  ascending=True, select=["title", "runtime", "director", "cast"], match=match,
                  position=position)
