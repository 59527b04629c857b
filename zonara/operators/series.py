"""Wide tables to series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot(wide: DataFrame, label: str, periods: list[str]) -> DataFrame:
    """label, pos, index, valor: a row for each label and period, in the table's order of periods."""
    place = F.create_map(*(x for k, p in enumerate(periods) for x in (F.lit(p), F.lit(k))))
    long = wide.select(label, *(F.col(f"`{p}`").cast("double").alias(p) for p in periods)).unpivot([label], periods, "index", "valor")
    return long.select(label, place[F.col("index")].alias("pos"), "index", "valor")


def log(v: Column) -> Column:
    """Natural log with -inf at 0 and NaN below."""
    return F.when(v == 0, F.lit(float("-inf"))).when(v < 0, F.lit(float("nan"))).otherwise(F.ln(v))


def only(wide: DataFrame, label: str, value: str) -> DataFrame:
    """The one row with that label; none or several are an error when the plan runs."""
    found = wide.filter(F.col(label) == F.lit(value)).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*wide.columns)).alias("row"))
    error = F.concat(F.col("n").cast("string"), F.lit(f" rows with {label} = {value}, not one"))
    row = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(error))
    return found.select(row.alias("row")).select("row.*")


def log_series(wide: DataFrame, label: str, value: str, periods: list[str]) -> DataFrame:
    return unpivot(only(wide, label, value), label, periods).withColumn("log", log(F.col("valor")))
