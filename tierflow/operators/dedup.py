"""One row per key, chosen by order and not by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(ref: str | Column) -> Column:
    return ref if isinstance(ref, Column) else F.col(ref).desc_nulls_last()


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    tie_break: Sequence[str | Column] | None = None,
    filter_first: Column | None = None,
) -> DataFrame:
    """Keep the first row of every key under ``order_by``; a bare name there means newest first.

    Ties go to ``tie_break``, by default every other column, so the result depends on the rows alone
    and not on their order or partitioning. Rows with a NULL key form one group. ``filter_first``
    removes rows before they can win; without it the newest version decides even if it is bad.

    Catalyst turns the rank filter into a group limit on both sides of the exchange: a map task sends
    at most one row per key, so a key holding most of the rows costs one row per task.
    """
    if filter_first is not None:
        df = df.filter(filter_first)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (*keys, *(o for o in order_by if isinstance(o, str)))]
    order = [_newest_first(c) for c in (*order_by, *tie_break)]
    best = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    op_col: str = "op",
    delete_value: str = "D",
    full_load: DataFrame | None = None,
) -> DataFrame:
    """Current state of a table from its change log: newest change per key, deleted keys left out.

    ``full_load`` rows are older than every change. They need neither the sequence nor the kind of
    change, which are then NULL and lose to any change.
    """
    if full_load is not None:
        changes = changes.unionByName(full_load, allowMissingColumns=True)
    newest = dedup_latest(changes, keys, [sequence])
    return newest.filter(~F.col(op_col).eqNullSafe(F.lit(delete_value)))


def latest_snapshot(exports: DataFrame, keys: Sequence[str], taken_on: str) -> DataFrame:
    """Per key the row of the newest export that contains it."""
    return dedup_latest(exports, keys, [taken_on])
