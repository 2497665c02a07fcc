"""Prefix aggregates per key, in one lazy plan.

``Window.partitionBy(key)`` puts a key into one task.  With a *bucket* - an
expression that never falls along the key's order, such as the day of its
time - the key is cut into (key, bucket) groups: a window inside each group, one
total per group, a window over a key's few totals for what went before, and a
join that adds it.  A task then holds one bucket of one key, whatever the key's
size.  Nothing runs while the plan is built, and no data decide its shape.

Supported aggregates are associative with an identity on NULL: ``max``,
``min``, ``sum``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FN = {"max": F.max, "min": F.min, "sum": F.sum}


def combine(kind: str, a: Column, b: Column) -> Column:
    """Fold two partial results; NULL is the identity."""
    if kind == "max":
        return F.greatest(a, b)
    if kind == "min":
        return F.least(a, b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running(df: DataFrame, key: str, order: Sequence[str], aggs: Mapping[str, tuple[str, Column]], *,
            inclusive: bool = False, bucket: Column | None = None) -> DataFrame:
    """Add, per row, ``aggs[name] = (kind, expr)`` aggregated over the earlier
    rows of the same ``key`` in ``order`` (also the row itself when
    ``inclusive``).  ``order`` must be a total order within a key; ``bucket``
    must not fall along it."""
    last = 0 if inclusive else -1
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
        return df.select("*", *[_FN[kind](expr).over(w).alias(name) for name, (kind, expr) in aggs.items()])
    base = df.select("*", bucket.alias("_bucket"), *[expr.alias(f"_v_{name}") for name, (_, expr) in aggs.items()])
    w = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    local = base.select(*df.columns, "_bucket", *[_FN[kind](F.col(f"_v_{name}")).over(w).alias(f"_l_{name}") for name, (kind, _) in aggs.items()])
    totals = base.groupBy(key, "_bucket").agg(*[_FN[kind](F.col(f"_v_{name}")).alias(f"_t_{name}") for name, (kind, _) in aggs.items()])
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(key).alias("_ck"), F.col("_bucket").alias("_cb"),
                          *[_FN[kind](F.col(f"_t_{name}")).over(earlier).alias(f"_c_{name}") for name, (kind, _) in aggs.items()])
    joined = local.join(carry, F.col(key).eqNullSafe(F.col("_ck")) & F.col("_bucket").eqNullSafe(F.col("_cb")))
    return joined.select(*df.columns, *[combine(kind, F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name) for name, (kind, _) in aggs.items()])
