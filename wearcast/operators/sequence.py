"""Skew-safe row numbers and running sums inside groups, as one lazy plan.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends a whole group to one
task. Here the order key is cut into nested buckets by its value alone (high bits of
integers, months and hours of timestamps, exponent and mantissa bits of doubles), so
nothing has to be sampled or measured first:

1. rows are counted (or summed) per (group, finest bucket), a partial aggregate;
2. each bucket's offset is the sum of the buckets of its group before it (without a
   group: level by level, a window over the siblings of one parent plus its offset);
3. the offsets join the rows as one marker row per bucket, and a window over
   (group, bucket) numbers the rows behind their marker.

No task holds more than one finest bucket of a group, whatever the group's size, and
null group keys form a group like any other. Ties in the order must be interchangeable
rows (``total_order=True`` appends every other sortable column as a tie breaker).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SORTABLE = (T.NumericType, T.StringType, T.TimestampType, T.TimestampNTZType,
             T.DateType, T.BooleanType)
_LOWEST = -(1 << 62)   # level of a null, which sorts first


def _tie_breakers(df: DataFrame, used: list[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in used and isinstance(f.dataType, _SORTABLE)]


def _double_code(x: Column) -> Column:
    """Order-keeping integer of a double: sign, exponent and 20 mantissa bits (NaN last)."""
    size = F.abs(x)
    exp = F.greatest(F.floor(F.log2(size)), F.lit(-1000))
    part = F.floor((size / F.pow(F.lit(2.0), exp.cast("double")) - 1.0) * F.lit(float(1 << 20)))
    part = F.least(F.greatest(part, F.lit(-1)), F.lit(1 << 20))
    code = (exp + 1100) * F.lit(1 << 21) + part + 1
    return (F.when(F.isnan(x), F.lit(1 << 50))
            .when(size == float("inf"), F.when(x > 0, F.lit(1 << 49)).otherwise(F.lit(-(1 << 49))))
            .when(x == 0, F.lit(0)).when(x > 0, code).otherwise(-code).cast("long"))


def bucket_levels(df: DataFrame, order: list[str], depth: int) -> list[Column]:
    """Nested bucket numbers, coarse to fine, of the first ``depth`` order columns."""
    out: list[Column] = []
    for name in order[:depth]:
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            v, shifts = F.unix_micros(c.cast("timestamp")), (42, 32)     # about 50 days, 70 minutes
        elif isinstance(kind, T.DateType):
            v, shifts = F.unix_date(c).cast("long"), (7, 0)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            v, shifts = c.cast("long"), (24, 12)
        elif isinstance(kind, T.NumericType):
            v, shifts = _double_code(c.cast("double")), (12, 0)
        elif isinstance(kind, T.StringType):
            v = sum((F.coalesce(F.ascii(F.substring(c, i, 1)), F.lit(0)).cast("long") * F.lit(1 << (63 - 21 * i)) for i in (1, 2)), F.lit(0))
            shifts = (42, 21)
        else:
            raise TypeError(f"cannot number rows by {kind.simpleString()} column {name!r}")
        last = name == order[:depth][-1]
        out += [F.coalesce(F.shiftright(v, s), F.lit(_LOWEST)) for s in shifts]
        if not last:
            out.append(F.coalesce(v, F.lit(_LOWEST)))   # the next column only orders rows of equal values
    return out


def _fresh(*names: str) -> list[str]:
    """Helper column names that no input has."""
    tag = uuid.uuid4().hex
    return [f"{n}_{tag}" for n in names]


def _offsets(buckets: DataFrame, by: list[str], levels: list[str], sums: list[str]) -> DataFrame:
    """Sum of ``sums`` over all earlier buckets of the group, for every bucket.

    A group's buckets are thousands of times fewer than its rows and take one window;
    without a group the levels are added up one by one, so no task sees all buckets.
    """
    if by:
        before = Window.partitionBy(*by).orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
        return buckets.select(*by, *levels, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums])
    parents = levels[:-1]
    before = Window.partitionBy(*parents).orderBy(levels[-1]).rowsBetween(Window.unboundedPreceding, -1)
    here = buckets.select(*parents, levels[-1], *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums])
    if len(levels) == 1:
        return here
    above = _offsets(buckets.groupBy(*parents).agg(*[F.sum(c).alias(c) for c in sums]), by, parents, sums)
    keys, ups = _fresh(*[f"p{i}" for i in range(len(parents))]), _fresh(*[f"up{i}" for i in range(len(sums))])
    above = above.select(*[F.col(k).alias(n) for k, n in zip(parents, keys)], *[F.col(c).alias(n) for c, n in zip(sums, ups)])
    same = reduce(Column.__and__, [here[k].eqNullSafe(above[n]) for k, n in zip(parents, keys)])
    return here.join(above, same).select(*parents, levels[-1], *[(F.col(c) + F.col(n)).alias(c) for c, n in zip(sums, ups)])


def _with_markers(df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column]) -> tuple[DataFrame, list[str], str]:
    """Rows and one marker row per bucket that carries the bucket's offsets; names of the levels and of the row flag."""
    cuts = bucket_levels(df, order, 1 if by else 2)   # without a group, the second column cuts equal values of the first
    names = _fresh(*[f"l{i}" for i in range(len(cuts))])
    (row,) = _fresh("row")
    rows = df.select("*", *[c.alias(n) for c, n in zip(cuts, names)])
    buckets = rows.groupBy(*by, *names).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    marks = _offsets(buckets, by, names, list(sums)).withColumn(row, F.lit(0))
    return rows.withColumn(row, F.lit(1)).unionByName(marks, allowMissingColumns=True), names, row


def number_rows(df: DataFrame, by: list[str], order: list[str], out: str = "_idx",
                total_order: bool = False) -> DataFrame:
    """Add ``out`` = 1, 2, ... per group of ``by`` in ``order``; input columns may have any names but ``out``."""
    order = list(order) + (_tie_breakers(df, list(by) + list(order)) if total_order else [])
    many, place, ahead = _fresh("n", "rank", "before")
    both, levels, row = _with_markers(df, list(by), order, {many: F.lit(1).cast("long")})
    w = Window.partitionBy(*by, *levels)
    rank = F.row_number().over(w.orderBy(row, *order)).cast("long") - 1
    return (both.withColumn(place, rank).withColumn(ahead, F.max(many).over(w))
            .where(F.col(row) == 1).select(*df.columns, (F.col(ahead) + F.col(place)).cast("long").alias(out)))


def cumulative_sum(df: DataFrame, by: list[str], order: list[str], cols: list[str],
                   suffix: str = "_cum") -> DataFrame:
    """Running sums of ``cols`` per group of ``by`` in ``order`` (inclusive).

    ``order`` must be unique within a group (aggregate first).
    """
    total, within, base = (dict(zip(cols, _fresh(*[f"{kind}{i}" for i in range(len(cols))]))) for kind in ("s", "in", "to"))
    both, levels, row = _with_markers(df, list(by), list(order), {total[c]: F.col(c) for c in cols})
    w = Window.partitionBy(*by, *levels)
    inside = w.orderBy(row, *order).rowsBetween(Window.unboundedPreceding, 0)
    sums = both.select("*", *[F.sum(F.when(F.col(row) == 1, F.col(c))).over(inside).alias(within[c]) for c in cols],
                       *[F.max(total[c]).over(w).alias(base[c]) for c in cols])
    return sums.where(F.col(row) == 1).select(
        *df.columns, *[(F.col(base[c]) + F.coalesce(F.col(within[c]), F.lit(0))).alias(c + suffix) for c in cols])
