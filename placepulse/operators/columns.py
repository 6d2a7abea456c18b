"""Projections and schema operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placepulse.session import durable

# Where review text may be found, in order of preference.
TEXT_COLUMNS = ("cleaned_text", "review_text", "text", "content")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns; a missing one raises."""
    require_columns(df, columns)
    return df.select(*columns)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present are {df.columns}")


def with_source(df: DataFrame, name: str) -> DataFrame:
    """Tag every row with the name of its source."""
    return df.withColumn("source", F.lit(name))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Without these columns; absent ones are ignored."""
    return df.drop(*columns)


def keep_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only those of ``columns`` that are present, in table order."""
    return df.select(*[name for name in df.columns if name in columns])


def rename_label(df: DataFrame) -> DataFrame:
    """``labels_id`` to ``label``; a table without it is returned as it is."""
    return df.withColumnRenamed("labels_id", "label")


def resolve_text_column(df: DataFrame, candidates: Sequence[str] = TEXT_COLUMNS) -> str:
    """Name of the first candidate the table has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of the text columns {list(candidates)} is present")


def cast_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Cast one column; null stays null."""
    return df.withColumn(name, F.col(name).cast(dtype))


def preview(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and column names of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def row_identity(*columns: Column | str) -> Column:
    """A 256-bit identity of a row: equal for equal rows only. Null equals null.

    Every value is written with its length in front, so neighbouring values cannot run together.
    """
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def fingerprint(*columns: str) -> list[Column]:
    """A 128-bit identity of values as two numbers; null equals null and nothing else."""
    values = [F.col(name) for name in columns]
    nulls = [value.isNull() for value in values]
    return [F.xxhash64(*nulls, *values), F.xxhash64(F.lit("second"), *values, *nulls)]


def with_row_id(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Dense ids 0, 1, ... in the given order, without bringing the rows together.

    A range-partitioned sort, one count per partition and a running sum over those counts. Rows
    equal in ``order`` are told apart by their whole content; exact copies by where they came
    from, which only decides how a large group of copies is cut into partitions.
    """
    partitions = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    shuffle = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    keys = [*order, "_content", "_came"]
    ranged = (
        df.withColumn("_content", F.xxhash64(*df.columns))
        .withColumn("_came", F.monotonically_increasing_id())
        .repartitionByRange(max(partitions, int(shuffle)), *keys)
        .sortWithinPartitions(*keys)
        .drop("_content", "_came")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return _numbered(durable(ranged), F.col("_at"), df.columns, name)


_PER_PARTITION = 2**33  # monotonically_increasing_id keeps the partition above bit 33


def _numbered(df: DataFrame, at: Column, columns: Sequence[str], name: str) -> DataFrame:
    """Dense ids from places: the row's number in its partition plus the rows of the partitions before."""
    part = F.floor(at / _PER_PARTITION)
    sizes = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the window and the broadcast are bounded by the partition count.
    offsets = durable(sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    # The row travels as one struct, so its own names can't meet those used here.
    placed = df.select(F.struct(*columns).alias("_row"), at.alias("_at"))
    numbered = placed.withColumn("_part", F.floor(F.col("_at") / _PER_PARTITION)).join(F.broadcast(offsets), "_part")
    row_id = (F.col("_offset") + F.col("_at") % _PER_PARTITION).cast("bigint")
    return numbered.select("_row.*", row_id.alias(name))


def with_place_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Dense ids 0, 1, ... by where a row lies in the files it is read from, without a shuffle.

    One pass counts the rows of every split, the second numbers them. The same files give the same ids. ``df``
    must be read from files through projections, filters, unions and broadcast joins only: behind a
    shuffle a row's place may differ from run to run, which raises.
    """
    plan = df._jdf.queryExecution().sparkPlan().toString()
    moved = [word for word in ("Exchange", "SortMergeJoin", "ShuffledHashJoin", "Aggregate", "Window", "Limit") if word in plan]
    if moved:
        raise ValueError(f"rows have no fixed place behind {', '.join(moved)}; use with_row_id")
    return _numbered(df, F.monotonically_increasing_id(), df.columns, name)
