"""Writers and text formats of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import number_rows
from tidemark.session import materialise


def write_csv_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Headerless CSV in the given order: range-sorted part files that follow one another.

    Adaptive execution makes one file of a small result.
    """
    df.orderBy(*order).write.mode("overwrite").csv(path)


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """`user,item,prediction` lines."""
    return predictions.select(F.concat_ws(",", "user", "item", "prediction").alias("value"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Lines sorted by user and item; the part files follow one another in that order."""
    prediction_lines(predictions.orderBy("user", "item")).write.mode("overwrite").text(path)


def format_itemsets(itemsets: DataFrame) -> DataFrame:
    """[size, n, line]: each itemset as `(a, b)` with its number in the sorted list of its size.

    Joined by ", " the lines of a size give the whole list. No row grows with the input.
    """
    sets = itemsets.select("size", F.array_sort("items").alias("items"))
    numbered = number_rows(sets, "items", name="n", within=("size",))
    return numbered.select("size", "n", F.concat(F.lit("("), F.array_join("items", ", "), F.lit(")")).alias("line"))


def write_itemsets(itemsets: DataFrame, path: str) -> None:
    """One itemset to a line, by size and then by items."""
    format_itemsets(itemsets).orderBy("size", "n").select("line").write.mode("overwrite").text(path)


def write_cluster_report(report: DataFrame, path: str) -> None:
    """One JSON object per algorithm: algorithm, wsse and the list of clusters."""
    report.write.mode("overwrite").json(path)


# Least number of micro-batches of written arrivals, and the bytes of a batch and of a file.
LEAST_BATCHES = 4
BATCH_BYTES = 16 << 30
FILE_BYTES = 128 << 20


def write_arrivals(
    df: DataFrame,
    path: str,
    *order: str,
    least: int = LEAST_BATCHES,
    batch_bytes: int = BATCH_BYTES,
    file_bytes: int = FILE_BYTES,
) -> int:
    """Write rows to one folder as they would arrive, one range of the order after the other.

    The number of ranges follows the size of the rows. Each range is written in parallel, as the same number of
    files, which is returned: with it as `max_files` every micro-batch of `read_messages_stream` is one
    range. The last range may have fewer files.
    """
    numbered = materialise(number_rows(df, *order, name="_arrival"), "arrivals")
    sizes = numbered.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size"))
    total, size = numbered.agg(F.max("_arrival")).first()[0] or 0, sizes.first()[0] or 0
    batches = max(least, -(-size // batch_bytes))
    width = max(1, -(-total // batches))
    # At least two files where there are two rows; numbers without gaps fill each of them.
    files = min(width, max(2, -(-size // batches // file_bytes)))
    at = ((F.col("_arrival") - 1) % width % files).cast("int")
    for first in range(1, max(total, 1) + 1, width):
        part = numbered.where(F.col("_arrival").between(first, first + width - 1))
        part.repartitionById(files, at).drop("_arrival").write.mode("append").parquet(path)
    return files
