"""Operators on CSV text inside records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.errors import any_of, with_errors
from tidemill.functions.numbers import leading_int, let

# --- fixed values: the stock record -----------------------------------------------------
STOCK_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Last", T.StringType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("Open", T.StringType()),
        T.StructField("High", T.StringType()),
        T.StructField("Low", T.StringType()),
    ]
)
# ----------------------------------------------------------------------------------------


def csv_lines_to_json(
    df: DataFrame, column: str = "value", on_error: str = "reject", whole_record: bool = False
) -> DataFrame:
    """One ``{"item", "quantity"}`` record per ``item,quantity`` line; other columns are kept.

    A line without exactly two fields or without a leading integer is an error.  With
    ``whole_record`` one bad line rejects all lines of its record.
    """
    lines = F.split(F.col(column).cast("string"), "\n", -1)
    rows = df.withColumn("_lines", lines)
    if whole_record:

        def is_bad(line: Column) -> Column:
            return let(F.split(line, ",", -1), lambda c: (F.size(c) != 2) | leading_int(F.get(c, F.lit(1))).isNull())

        rows = rows.withColumn("_bad", F.get(F.filter("_lines", is_bad), F.lit(0)))
    # one row per line, then plain columns: they are compiled with the scan
    rows = rows.withColumn("_line", F.explode("_lines")).drop("_lines")
    rows = rows.withColumn("_cells", F.split("_line", ",", -1))
    rows = rows.withColumn("_quantity", leading_int(F.get("_cells", F.lit(1))))
    wrong = F.when(F.size("_cells") != 2, "unexpected number of columns")
    error = wrong.when(F.col("_quantity").isNull(), "invalid quantity")
    if whole_record:
        first = F.when(F.size(F.split("_bad", ",", -1)) != 2, "unexpected number of columns")
        error = F.when(F.col("_bad").isNotNull(), first.otherwise("invalid quantity"))
    body = F.to_json(F.struct(F.get("_cells", F.lit(0)).alias("item"), F.col("_quantity").alias("quantity")))
    tagged = with_errors(rows, error, "reject")
    out = tagged.withColumn(column, F.when(F.col("_error").isNull(), body))
    return with_errors(out.drop("_bad", "_line", "_cells", "_quantity"), F.lit(None).cast("string"), on_error)


def csv_to_record(
    df: DataFrame,
    schema: T.StructType = STOCK_SCHEMA,
    column: str = "value",
    out: str = "record",
    sep: str = ",",
    on_bad: str = "reject",
) -> DataFrame:
    """A line as a typed struct, by position.

    A line of another length, or with an unreadable number, is bad: ``null`` gives an empty
    record, else it is an error with the named policy.
    """
    rows = df.withColumn("_cells", F.split(F.col(column).cast("string"), f"\\Q{sep}\\E", -1))
    text_at = [F.get("_cells", F.lit(i)) for i in range(len(schema.fields))]
    typed = [t.try_cast(f.dataType).alias(f.name) for t, f in zip(text_at, schema.fields)]
    rows = rows.withColumn(out, F.when(F.size("_cells") == len(schema.fields), F.struct(*typed)))
    unread = any_of(
        [
            t.isNotNull() & F.col(out)[f.name].isNull()
            for t, f in zip(text_at, schema.fields)
            if not isinstance(f.dataType, T.StringType)
        ]
    )
    error = (
        F.when(F.col(column).isNull(), "missing value")
        .when(F.size("_cells") != len(schema.fields), "unexpected number of columns")
        .when(unread, "malformed field")
    )
    tagged = with_errors(rows, error, "reject").drop("_cells")
    built = tagged.withColumn(out, F.when(F.col("_error").isNull(), F.col(out)))
    return built.drop("_error") if on_bad == "null" else with_errors(built, F.lit(None).cast("string"), on_bad, costly=True)


def rows_to_json(df: DataFrame, out: str = "value") -> DataFrame:
    """Every row as one JSON object; null fields are written."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def us_date(col: Column) -> Column:
    """``MM/dd/yyyy`` text as a date, null when it is none."""
    return F.try_to_timestamp(col, F.lit("MM/dd/yyyy")).cast("date")
