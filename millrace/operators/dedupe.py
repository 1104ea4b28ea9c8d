"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "__rank"


def _best(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    # The filter on row_number() = 1 lets Spark keep only the best row per key and map task before
    # the shuffle (WindowGroupLimit), so a key that holds a third of all rows sends one row per task.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    sort: str | None = None,
    keep: str = "last",
    null_keys: str = "drop",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key.

    With ``sort`` the highest (``keep="last"``) or lowest value wins and missing values rank lowest;
    without it the first row wins whatever ``keep`` says. Rows that tie are taken in ``tie_break``
    order, lowest first; Spark rows have no order of their own, so name an ordinal there.
    ``null_keys`` drops rows with a NULL key or collapses them to one row.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if null_keys not in ("drop", "collapse"):
        raise ValueError(f"null_keys must be 'drop' or 'collapse', not {null_keys!r}")
    if sort is None and not tie_break:
        raise ValueError("without a sort column, tie_break must name the input order")
    if null_keys == "drop":
        df = df.dropna(how="any", subset=list(keys))
    order = []
    if sort is not None:
        value = F.col(sort)
        if isinstance(df.schema[sort].dataType, T.StringType):
            value = F.coalesce(value, F.lit(""))
        order.append(value.desc_nulls_last() if keep == "last" else value.asc_nulls_first())
    order += [F.col(t).asc_nulls_last() for t in tie_break]
    return _best(df, [F.col(k) for k in keys], order)


def latest_per_key(
    df: DataFrame, key: str = "id", version: str = "updated_at", tie_break: Sequence[str] = (), null_keys: str = "collapse"
) -> DataFrame:
    """The newest version of every key; NULL versions rank last and NULL keys count as one key."""
    return dedupe(df, [key], sort=version, null_keys=null_keys, tie_break=tie_break)
