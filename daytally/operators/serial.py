"""Serial ids: ascending, without gaps, in key order, and without a global window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = "row_position"

# Fixed value: monotonically_increasing_id keeps the row's place within its partition in the low 33 bits.
_PLACE_BITS = 33


def with_positions(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partitions and sorts by ``order`` and notes each row's partition and place.

    Write the result before using it: counts and ids must come from one and the same partitioning.
    """
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(POSITION, F.monotonically_increasing_id())
    )


def _partition() -> Column:
    return F.shiftright(POSITION, _PLACE_BITS)


def _place() -> Column:
    return F.col(POSITION).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def partition_sizes(written: DataFrame, *by: str) -> DataFrame:
    """Rows per partition of the write (part, n), and per value of further columns."""
    return written.groupBy(*by, _partition().alias("part")).agg(F.count(F.lit(1)).alias("n"))


def assign_ids(
    written: DataFrame, start_after: int = 0, id_column: str = "id", sizes: DataFrame | None = None
) -> DataFrame:
    """Numbers written rows from ``start_after + 1`` on. In every partition the rows must be the first ones.

    What is broadcast, and what the unpartitioned window sees, is one row per partition of the write, so their size
    follows the partition count and not the data. ``sizes`` (``partition_sizes``) saves counting again.
    """
    if sizes is None:
        sizes = partition_sizes(written)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (
        written.withColumn("part", _partition())
        .join(F.broadcast(offsets), "part")
        .withColumn(id_column, F.lit(start_after) + F.col("offset") + _place() + 1)
        .drop("part", "offset", POSITION)
    )
