"""Replaying a table as an endless, optionally reversed sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.ordered import with_global_index


def replay(
    df: DataFrame,
    order: Sequence[str],
    reverse: bool = False,
    loops: int = 0,
    date_col: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """The rows in order, then ``loops`` more passes; adds ``loop`` (0 = the first pass) and
    ``seq`` (position over all passes).

    In the further passes the date column advances by one day with every event, starting
    from the date of the last row sent in order (of the first row, when reversed).
    ``order`` must end in a unique column.
    """
    keys = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    rows = with_global_index(df, keys, "_i", slices)
    size = rows.count()
    out = rows.withColumn("loop", F.explode(F.sequence(F.lit(0), F.lit(loops))))
    out = out.withColumn("seq", F.col("loop") * F.lit(size) + F.col("_i"))
    if date_col is not None and loops:
        # reversed: the newest row comes first and its date is the one to go on from
        at = 0 if reverse else size - 1
        last = rows.filter(F.col("_i") == at).select(F.col(date_col).cast("date")).first()  # one row
        days = ((F.col("loop") - 1) * F.lit(size) + F.col("_i") + 1).cast("int")
        moved = F.date_add(F.lit(last[0] if last else None).cast("date"), days).cast(df.schema[date_col].dataType)
        out = out.withColumn(date_col, F.when(F.col("loop") > 0, moved).otherwise(F.col(date_col)))
    return out.drop("_i")
