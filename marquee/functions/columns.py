"""Column-level building blocks.

Everything here returns a ``Column`` made of Spark built-ins, so the
optimizer sees through it and codegen keeps it in one stage.  Expressions
are written to be safe under ANSI mode: no plain cast of text, no division
that can see a zero, ``size`` of null handled explicitly.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined_names(c, field: str = "name", sep: str = "|") -> Column:
    """Names of an array of structs joined by ``sep``.

    Null or empty array -> null; null names are skipped by ``concat_ws``;
    order and duplicates are kept.
    """
    arr = _c(c)
    return F.when(F.size(arr) > 0, F.concat_ws(sep, F.transform(arr, lambda x: x[field])))


def joined_strings(c, sep: str = "|") -> Column:
    """An array of strings joined by ``sep``; null or empty -> null."""
    arr = _c(c)
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def role_names(crew, role: str = "Director", sep: str = "|") -> Column:
    """Names of crew members whose ``job`` equals ``role``.

    A non-empty crew without that role gives ``''`` (turned into null by the
    empty-string rule later); a null or empty crew gives null.
    """
    arr = _c(crew)
    picked = F.filter(arr, lambda x: x["job"] == F.lit(role))
    return F.when(F.size(arr) > 0, F.concat_ws(sep, F.transform(picked, lambda x: x["name"])))


def size_or_zero(c) -> Column:
    """Array length with null counted as 0.  (``size(null)`` is null under
    ANSI mode but -1 otherwise, so null is tested explicitly.)"""
    arr = _c(c)
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))


def size_or_null(c) -> Column:
    """Array length, null for a null array, in either ANSI mode."""
    arr = _c(c)
    return F.when(arr.isNotNull(), F.size(arr))


def nonzero(c) -> Column:
    """``c`` with 0 replaced by null."""
    col = _c(c)
    return F.when(col != 0, col)


def placeholder_to_null(c, placeholders: Iterable[str]) -> Column:
    """Exact, case-sensitive, untrimmed membership test."""
    col = _c(c)
    return F.when(~col.isin(list(placeholders)), col)


def empty_to_null(c) -> Column:
    col = _c(c)
    return F.when(col != F.lit(""), col)


def profit(revenue="revenue_musd", budget="budget_musd") -> Column:
    """Revenue minus budget; null when either is null."""
    return _c(revenue) - _c(budget)


def roi(revenue="revenue_musd", budget="budget_musd") -> Column:
    """Revenue / budget when both are present and budget > 0, else null."""
    b = _c(budget)
    r = _c(revenue)
    return F.when(r.isNotNull() & (b > 0), r / b)


def category(collection="belongs_to_collection") -> Column:
    return F.when(_c(collection).isNotNull(), F.lit("Franchise")).otherwise(F.lit("Standalone"))


def non_null_count(columns: Iterable[str]) -> Column:
    """Number of non-null values among ``columns`` in the row."""
    parts = [F.col(c).isNotNull().cast("int") for c in columns]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def to_whole(c, dtype=None) -> Column:
    """A 64-bit integer from a number or its text; fractions are cut off.
    Text goes through a decimal, so no digit of a large number is lost."""
    col = _c(c)
    if dtype is not None and dtype.typeName() in ("long", "integer", "short", "byte"):
        return col.cast("bigint")
    return F.coalesce(col.try_cast("bigint"), col.try_cast("decimal(38,6)").try_cast("bigint"),
                      col.try_cast("double").try_cast("bigint"))


def to_id(c, dtype=None) -> Column:
    """As ``to_whole``, but null where a fraction would be cut off: 4.7 is not
    title 4."""
    whole = to_whole(c, dtype)
    if dtype is not None and dtype.typeName() in ("long", "integer", "short", "byte"):
        return whole
    exact = _c(c).try_cast("decimal(38,6)")
    return F.when(exact.isNull() | (exact == whole.cast("decimal(38,6)")), whole)


def to_finite(c, dtype=None) -> Column:
    """A double from a number or its text; NaN and infinities are null."""
    d = _c(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


# Sums and means of reported KPIs are taken over exact decimals: a double sum
# depends on the order rows arrive in (and so on the partitioning), which
# can flip the rounded value when the true mean sits on a .xx5 boundary.
EXACT_DECIMAL = "decimal(38,10)"


def exact_avg(c, decimals: int = 2) -> Column:
    """Mean over exact decimals, rounded half-up, as a double; a value that
    no such decimal holds (NaN, 1e300) is left out, and a mean whose sum no
    decimal holds is null, instead of failing the job."""
    return F.round(F.try_avg(_c(c).try_cast(EXACT_DECIMAL)), decimals).cast("double")


def exact_sum(c, decimals: int = 2) -> Column:
    """Sum over exact decimals, rounded half-up, as a double; values left out
    as in ``exact_avg``."""
    return F.round(F.try_sum(_c(c).try_cast(EXACT_DECIMAL)), decimals).cast("double")
