"""Survey salaries: counts, statistics and sums per country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    INT_MAX,
    annualise,
    clean_country,
    clean_salary,
    saturating_int,
    two_decimals,
    valid_salary,
)


def reported_salaries(survey: DataFrame) -> DataFrame:
    """[country, salary, period_raw]: reported salaries only; salary is null when malformed."""
    return survey.where(valid_salary(F.col("salary_raw"))).select(
        clean_country(F.col("country_raw")).alias("country"),
        clean_salary(F.col("salary_raw")).alias("salary"),
        "period_raw",
    )


def annual_salaries(survey: DataFrame) -> DataFrame:
    """[country, annual]: rows with a malformed salary or an unknown period are dropped."""
    yearly = annualise(F.col("salary"), F.col("period_raw")).alias("annual")
    return reported_salaries(survey).select("country", yearly).where(F.col("annual").isNotNull())


def salary_rejects(survey: DataFrame) -> DataFrame:
    """[reason, n]: how many reported rows the cleaning drops, and why."""
    yearly = annualise(F.col("salary"), F.col("period_raw"))
    reason = F.when(F.col("salary").isNull(), "malformed salary").when(yearly.isNull(), "unknown period")
    return (
        reported_salaries(survey)
        .select(reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def count_by_group(df: DataFrame, key: str, total: str = "Total") -> DataFrame:
    """[key, n] with a leading total row.

    The total is rolled up from the group counts, so the input is aggregated once.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    rolled = counts.rollup(key).agg(F.sum("n").alias("n"), F.grouping(key).alias("_total"))
    label = F.when(F.col("_total") == 1, F.lit(total)).otherwise(F.col(key))
    return rolled.select(label.alias(key), "n", "_total").orderBy(F.desc("_total"), key).drop("_total")


def saturating_sum(value: Column, cap: int = INT_MAX) -> Column:
    """Sum that stops at `cap`; a single row is kept as it is. For non-negative values."""
    total = F.sum(value)
    return F.when(F.count(value) > 1, F.least(total, F.lit(float(cap)))).otherwise(total)


def salary_stats(df: DataFrame, mode: str = "plain") -> DataFrame:
    """[country, n, min, max, avg] from [country, annual], in one aggregation.

    min and max are 32-bit ints that hold at their bounds. mode "saturating" takes the
    average from the capped sum.
    """
    if mode not in ("plain", "saturating"):
        raise ValueError(f"unknown mode: {mode}")
    value = F.col("annual")
    average = F.avg(value) if mode == "plain" else saturating_sum(value) / F.count(value)
    return (
        df.groupBy("country")
        .agg(
            F.count("*").alias("n"),
            saturating_int(F.min(value)).alias("min"),
            saturating_int(F.max(value)).alias("max"),
            average.alias("avg"),
        )
        .orderBy("country")
    )


def salary_report(stats: DataFrame) -> DataFrame:
    """The statistics with the average as text of two decimals."""
    return stats.withColumn("avg", two_decimals(F.col("avg")))


def assemble_by_join(
    largest: DataFrame, smallest: DataFrame, counts: DataFrame, averages: DataFrame, on: str
) -> DataFrame:
    """Four separately aggregated metrics joined on their group; `salary_stats` is the cheaper form."""
    return largest.join(smallest, on).join(counts.join(averages, on), on)


def sum_by_group(df: DataFrame, key: str, value: str, partitions: int | None = None) -> DataFrame:
    """[key, total]; with `partitions`, the group sums are placed by key in that many partitions.

    Rows are summed before they move, so a heavy group never travels as rows.
    """
    sums = df.groupBy(key).agg(F.sum(value).alias("total"))
    return sums if partitions is None else sums.repartition(partitions, key)
