"""Consecutive numbers in a global order without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import written


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``name`` counting from 1 in ``order`` (nulls first), which must tell rows apart.

    Rows are dealt into ranges of the order and written, so that a range is the same for all that
    follows; ranges are numbered on their own and shifted by the sizes of those before. The driver
    sees one size per range.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)), initial=0))
    shift = F.element_at(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_range") + 1)
    inside = Window.partitionBy("_range").orderBy(*order)
    return ranged.withColumn(name, F.row_number().over(inside) + shift).drop("_range")
