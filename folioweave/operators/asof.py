"""As-of joins (J11): the last row at or before a time, or the first at or after it.

Spark SQL has no ASOF join and a window per key would sort a hot key in one task. Here time is cut
into periods: within (key, period) a window finds the match, and what a period inherits from the
earlier ones comes from a window over one row per key and period. So a key's rows spread over its
periods, however many it has.

Defined results: rows without a key or time match nothing and keep a null; of several right rows
at one time the largest value counts; left columns keep their names, the value column is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, period: Column | None = None, forward: bool = False) -> DataFrame:
    """``left`` with the ``value`` of the nearest row of ``right`` (keys, at, value) in the given direction.

    ``period`` is an expression over ``at`` that does not fall as ``at`` rises; by default the month of a timestamp.
    """
    period = F.date_trunc("month", at) if period is None else period
    r = right.dropna(subset=[*keys, at, value]).groupBy(*keys, at).agg(F.max(value).alias("__v")).withColumn("__p", period)
    lt = left.withColumn("__p", period).withColumn("__left", F.lit(True))
    pick = F.min_by if forward else F.max_by
    edge = r.groupBy(*keys, "__p").agg(pick("__v", at).alias("__edge"))
    periods = lt.select(*keys, "__p").dropDuplicates().join(edge, [*keys, "__p"], "full")
    order = F.col("__p").desc() if forward else F.col("__p").asc()
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = periods.withColumn("__carry", F.last("__edge", ignorenulls=True).over(before)).select(*keys, "__p", "__carry")
    both = lt.unionByName(r.withColumn("__left", F.lit(False)), allowMissingColumns=True)
    time = F.col(at).desc() if forward else F.col(at).asc()
    near = Window.partitionBy(*keys, "__p").orderBy(time, "__left").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__near", F.last("__v", ignorenulls=True).over(near)).where("__left")
    out = found.join(carried, [*keys, "__p"], "left").withColumn(value, F.when(F.col(at).isNotNull(), F.coalesce("__near", "__carry")))
    return out.select(*left.columns, value)
