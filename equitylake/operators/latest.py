"""Latest-wins by key (AGG1): one whole row per key, the last in an explicit order.

Spark rows have no order of their own, so "last" always names its order
columns. ``row_number() == 1`` over the key, newest first, keeps whole rows
(nulls included) and plans a *partial* WindowGroupLimit before the exchange:
each map task ships at most one row per key, so a key holding a third of all
rows costs one row per task in the shuffle, not a third of the data.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitylake.operators.joins import MAX_BROADCAST_KEYS

_RN = "__rn"


def _desc(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def latest_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep, per ``key``, the row that sorts last by ``order`` (ascending).

    Rows whose order value is null sort first, i.e. they lose to any non-null.
    The order columns stay in the output; callers project them away.
    """
    if not order:
        raise ValueError("latest_wins needs an explicit order; Spark rows have none")
    window = Window.partitionBy(*key).orderBy(*[_desc(c) for c in order])
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


_PRIO = "__prio"
_ORDER = "__order"


def merge_latest(stored: DataFrame | None, fresh: DataFrame, key: Sequence[str],
                 order: Sequence[str] | None = None) -> DataFrame:
    """Overlay ``fresh`` on ``stored`` by ``key``: fresh rows win whole.

    The output has ``stored``'s columns (``fresh`` must carry them all), or,
    with nothing stored yet (``stored`` is ``None``), ``fresh``'s columns
    except the order columns. Among fresh duplicates the row that sorts last
    by ``order`` (columns of ``fresh``; they may also be data columns) wins;
    without ``order``, the last in scan order. Stored duplicates of a key
    fresh does not touch are de-duplicated too, in no particular order, so
    callers pass only the stored rows they mean to merge.
    """
    order = list(order or [])
    columns = stored.columns if stored is not None else [c for c in fresh.columns if c not in order]
    if order:
        ordered = fresh.withColumn(_ORDER, F.struct(*[F.col(f"`{c}`") for c in order]))
    else:
        ordered = fresh.withColumn(_ORDER, F.struct(F.monotonically_increasing_id().alias("scan")))
    ordered = ordered.select(*[F.col(f"`{c}`") for c in columns], _ORDER).withColumn(_PRIO, F.lit(1))
    if stored is None:
        both = ordered
    else:
        order_type = ordered.schema[_ORDER].dataType
        both = (stored.select(*[F.col(f"`{c}`") for c in columns])
                      .withColumn(_ORDER, F.lit(None).cast(order_type))
                      .withColumn(_PRIO, F.lit(0))).unionByName(ordered)
    return latest_wins(both, key, [_PRIO, _ORDER]).drop(_PRIO, _ORDER)


def overlay(stored: DataFrame, fresh: DataFrame, key: Sequence[str], fresh_rows: int,
            max_broadcast_rows: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """``stored`` with ``fresh`` over it, both with one row for a key (nulls are equal): no window, no shuffle of ``stored``.

    Stored rows are kept by an anti join with the fresh keys, broadcast while
    ``fresh_rows`` is within bounds. Column order is ``stored``'s.
    """
    theirs = [f"__fresh_{i}" for i in range(len(key))]
    keys = fresh.select(*[F.col(f"`{k}`").alias(t) for k, t in zip(key, theirs)])
    same = functools.reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(t)) for k, t in zip(key, theirs)])
    kept = stored.join(F.broadcast(keys) if fresh_rows <= max_broadcast_rows else keys, same, "left_anti")
    return kept.unionByName(fresh.select(*[F.col(f"`{c}`") for c in stored.columns]))
