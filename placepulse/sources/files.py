"""CSV at the edges, Parquet and JSON inside."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.operators.columns import require_columns
from placepulse.operators.profiling import value_counts
from placepulse.schema import LABEL_MAP, RAW_REVIEWS, SCORED_REVIEWS, label_vocab

# Cells read as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
HEADERS_AT_ONCE = 16


def read_reviews_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_REVIEWS,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV with a header; columns are picked by name and cast to the schema.

    Every cell is read as text first, because a schema given to the reader would bind by
    position. Spark binds all files of a scan to the header of one of them, so each file's header
    is read first and files with the same header are scanned together; a file that lacks a column
    raises, a file without any line has no rows. Quoted line breaks need ``multi_line``, which
    makes a file one task: split large deliveries into several files, or convert them with
    ``write_parquet`` once.
    """

    groups = _by_header(spark, path, encoding, multi_line)
    tables = [_typed(_scan(spark, group, encoding, multi_line), schema) for group in groups.values()]
    return reduce(DataFrame.unionByName, tables) if tables else _typed(_scan(spark, path, encoding, multi_line), schema)


def account_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", multi_line: bool = True
) -> DataFrame:
    """``file, rows, cells, misshapen`` per CSV file that has rows: ``cells`` are those not null, rows with more or fewer cells than the header are misshapen.

    ``read_reviews_csv`` reads such rows without the cells too many, and with null for those that lack. Every
    file is parsed once, its cells are not moved.
    """
    parts = []
    for header, group in _by_header(spark, path, encoding, multi_line).items():
        names = [f"c{i}" for i in range(len(header))]
        fields = [T.StructField(name, T.StringType()) for name in [*names, "_misshapen"]]
        reader = _reader(spark, encoding, multi_line).option("columnNameOfCorruptRecord", "_misshapen")
        # Null cells too are parsed, since every column takes part in the sum.
        rows = reader.schema(T.StructType(fields)).csv(group)
        cells = reduce(lambda a, b: a + b, [F.col(name).isNotNull().cast("long") for name in names])
        parts.append(rows.select(F.col("_metadata.file_path").alias("file"), "_misshapen", cells.alias("cells")))
    if not parts:
        return spark.createDataFrame([], "file STRING, rows BIGINT, cells BIGINT, misshapen BIGINT")
    counts = [F.count(F.lit(1)).alias("rows"), F.sum("cells").alias("cells"), F.count("_misshapen").alias("misshapen")]
    return reduce(DataFrame.unionByName, parts).groupBy("file").agg(*counts)


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return reader.option("encoding", encoding).option("mode", "PERMISSIVE")


def _scan(spark: SparkSession, paths: str | list[str], encoding: str, multi_line: bool) -> DataFrame:
    return _reader(spark, encoding, multi_line).csv(paths)


def _by_header(
    spark: SparkSession, path: str | list[str], encoding: str, multi_line: bool
) -> dict[tuple[str, ...], list[str]]:
    """The files below a path by their header; those without any line are left out."""
    # Lists the files; their content is pruned.
    listed = spark.read.format("binaryFile").load(path).select("path").collect()
    files = [re.sub(r"([\\{}\[\]*?])", r"\\\1", row["path"]) for row in listed]
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: tuple(_scan(spark, file, encoding, multi_line).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header:
            groups.setdefault(header, []).append(file)
    return groups


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema, from text."""
    require_columns(raw, schema.fieldNames())

    def cell(field: T.StructField):
        value = F.col(f"`{field.name}`")
        present = F.when(~value.isin(*NULL_TOKENS), value)
        if isinstance(field.dataType, T.StringType):
            return present.alias(field.name)
        # A whole number may be written as "4.0".
        number = present.try_cast("double") if isinstance(field.dataType, T.IntegralType) else present
        return number.cast(field.dataType).alias(field.name)

    return raw.select(*[cell(field) for field in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header, every cell quoted so that line breaks and spaces survive."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_distribution(df: DataFrame, column: str, path: str) -> DataFrame:
    """Write the counts of a column's values, most frequent first, and return them."""
    counts = value_counts(df, column)
    write_csv(counts, path)
    return counts


def write_scored(df: DataFrame, path: str) -> None:
    """Write scored reviews; an empty batch still leaves a table with a header."""
    scored = df.select(*SCORED_REVIEWS.fieldNames())
    if scored.isEmpty():
        scored = scored.sparkSession.createDataFrame([], SCORED_REVIEWS).repartition(1)
    write_csv(scored, path)


def read_scored_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_reviews_csv(spark, path, SCORED_REVIEWS)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_label_map(spark: SparkSession, path: str) -> None:
    """Write the label vocabulary as JSON lines."""
    label_vocab(spark).coalesce(1).write.mode("overwrite").json(path)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """Read the label vocabulary back, ids as integers."""
    return spark.read.schema(LABEL_MAP).json(path)
