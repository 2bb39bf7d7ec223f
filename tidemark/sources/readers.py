"""Readers for the five input shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import words
from tidemark.operators.skew import number_rows
from tidemark.session import materialise

# Positions of country, salary and salary period in the survey file.
SURVEY_COLUMNS = {"country_raw": 3, "salary_raw": 52, "period_raw": 53}


def read_survey(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """[country_raw, salary_raw, period_raw] from a quoted CSV with a header.

    Files stay splittable unless `multi_line` is set for quoted line breaks.
    """
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    names = raw.columns
    return raw.select(*[F.col(f"`{names[at]}`").alias(name) for name, at in SURVEY_COLUMNS.items()])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """[user, item, rating] from a plain CSV with a header; further columns are ignored."""
    schema = "user string, item string, rating double"
    return spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(path)


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """[key, item] from headerless comma text; further columns are ignored."""
    return spark.read.schema("key string, item string").csv(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """[doc_id, words] from text with one document per line.

    Lines are numbered 0, 1, 2, ... in the order of the files, of the blocks in a file and of the
    lines in a block, so equal lines stay separate documents.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    # Inside a block the ids follow the lines; written once, they stay as they are.
    lines = materialise(lines.withColumn("at", F.monotonically_increasing_id()), "lines")
    numbered = number_rows(lines, "file", "block", "at", name="n")
    return numbered.select((F.col("n") - 1).alias("doc_id"), words(F.col("value")).alias("words"))


def documents_from_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[doc_id, words] from a table that already carries document ids."""
    return df.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words"))


def read_messages_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files: int = 1,
    pattern: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Message files as a stream: `max_files` new files per micro-batch, or as many as `max_bytes` hold.

    Files come in the order in which they were written. With `max_bytes` the end of a micro-batch may lie
    anywhere between two files, so messages whose order matters shouldn't be written in parallel.
    """
    bound = ("maxFilesPerTrigger", max_files) if max_bytes is None else ("maxBytesPerTrigger", max_bytes)
    reader = spark.readStream.schema(schema).option(*bound)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def drop_header(lines: DataFrame) -> DataFrame:
    """Remove every line of a text DataFrame that equals its first line."""
    first = lines.first()
    return lines if first is None else lines.where(F.col("value") != F.lit(first[0]))
