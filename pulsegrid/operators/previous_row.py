"""Value of the preceding row in an order, without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str],
                  values: Sequence[str], name: str = "prev", finer: Column | None = None) -> DataFrame:
    """Add ``name``, a struct of ``values`` in the row before within ``keys``, ordered by ``order``.

    Plain LAG puts every row of a key into one task. Here a key is cut into buckets, a rising
    function of ``order`` such as a date or an hour, and buckets into parts by ``finer``, which rises
    with ``order`` inside a bucket. Rows look back inside their part; then only the first and last
    row of each part look back across the parts of a bucket, and only those of each bucket across
    the buckets of a key. The input is read once, and what meets in a task is the rows of a part,
    two per part of a bucket or two per bucket of a key. The result equals LAG for any width.

    ``order`` must tell all rows of a key apart that differ in ``values``. Null keys form a key of
    their own, as in a window.
    """
    part = F.lit(None).cast("long") if finer is None else finer.cast("long")
    looked = rows.withColumn("_bucket", bucket).withColumn("_part", part)
    sequence = ("_bucket", "_part", *order)
    within = Window.partitionBy(*keys, "_bucket", "_part").orderBy(*sequence)
    looked = looked.withColumns({
        "_prev": F.lag(F.struct(*values)).over(within),
        "_first": F.row_number().over(within) == 1,
        "_last": F.lead(F.lit(1)).over(within).isNull(),
    })
    for wider in ([*keys, "_bucket"], [*keys]) if finer is not None else ([*keys],):
        edge = F.col("_first") | F.col("_last")
        # rows that are no edge stay in partitions of their own
        looked = looked.withColumn("_apart", F.when(~edge, F.struct("_bucket", "_part")))
        across = Window.partitionBy(*wider, "_apart").orderBy(*sequence)
        looked = looked.withColumns({
            "_carried": F.lag(F.struct(*values)).over(across),
            "_starts": F.row_number().over(across) == 1,
            "_ends": F.lead(F.lit(1)).over(across).isNull(),
        }).withColumns({
            "_prev": F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev")),
            "_first": F.col("_first") & F.col("_starts"),
            "_last": F.col("_last") & F.col("_ends"),
        })
    return looked.select(*[F.col(c) for c in rows.columns], F.col("_prev").alias(name))
