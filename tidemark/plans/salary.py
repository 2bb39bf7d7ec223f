"""Registered queries over the survey."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import saturating_int
from tidemark.operators import salary as ops
from tidemark.operators.relational import union_all
from tidemark.plans.oracle_views import SURVEY
from tidemark.session import scratch_dir
from tidemark.sources import adapters
from tidemark.sources.readers import SURVEY_COLUMNS, read_survey
from tidemark.sources.sinks import write_csv_sorted


def survey_csv_roundtrip(spark, sf_dir):
    """Write the survey as a wide quoted CSV and read it back by position."""
    survey = adapters.survey(spark, sf_dir)
    at = {SURVEY_COLUMNS["country_raw"]: "country_raw", SURVEY_COLUMNS["salary_raw"]: "salary_raw",
          SURVEY_COLUMNS["period_raw"]: "period_raw"}
    wide = [F.col(at[i]).alias(f"c{i}") if i in at else F.lit("x").alias(f"c{i}") for i in range(54)]
    path = scratch_dir(spark, "survey")
    survey.select(*wide).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_survey(spark, path)


def survey_file_stats(spark, sf_dir):
    """From a survey file to the statistics."""
    return _rounded(ops.salary_stats(ops.annual_salaries(survey_csv_roundtrip(spark, sf_dir))))


def valid_salary(spark, sf_dir):
    return ops.reported_salaries(adapters.survey(spark, sf_dir)).select(
        "country", F.round("salary", 2).alias("salary"), "period_raw"
    )


def salary_clean_annual(spark, sf_dir):
    return ops.annual_salaries(adapters.survey(spark, sf_dir)).select(
        "country", F.round("annual", 2).alias("annual")
    )


def salary_rejects(spark, sf_dir):
    return ops.salary_rejects(adapters.survey(spark, sf_dir))


def salary_count_total(spark, sf_dir):
    return ops.count_by_group(ops.reported_salaries(adapters.survey(spark, sf_dir)), "country")


def _rounded(stats):
    return stats.select("country", "n", "min", "max", F.round("avg", 1).alias("avg"))


def salary_stats(spark, sf_dir):
    return _rounded(ops.salary_stats(ops.annual_salaries(adapters.survey(spark, sf_dir))))


def salary_stats_saturating(spark, sf_dir):
    return _rounded(ops.salary_stats(ops.annual_salaries(adapters.survey(spark, sf_dir)), "saturating"))


def salary_stats_by_join(spark, sf_dir):
    annual = ops.annual_salaries(adapters.survey(spark, sf_dir))
    by = annual.groupBy("country")
    joined = ops.assemble_by_join(
        by.agg(saturating_int(F.max("annual")).alias("max")),
        by.agg(saturating_int(F.min("annual")).alias("min")),
        by.agg(F.count("*").alias("n")),
        by.agg(F.avg("annual").alias("avg")),
        "country",
    )
    return _rounded(joined)


def _exact(survey):
    """Salaries as decimals, whose sums don't depend on the order of the rows."""
    return ops.reported_salaries(survey).where(F.col("salary").isNotNull()).select(
        "country", F.col("salary").cast("decimal(18,2)").alias("salary")
    )


def salary_sum(spark, sf_dir):
    sums = ops.sum_by_group(_exact(adapters.survey(spark, sf_dir)), "country", "salary")
    return sums.select("country", F.col("total").cast("double").alias("total"))


def salary_sum_partitioned(spark, sf_dir):
    sums = ops.sum_by_group(_exact(adapters.survey(spark, sf_dir)), "country", "salary", partitions=2)
    return sums.select("country", F.col("total").cast("double").alias("total"))


def salary_union_periods(spark, sf_dir):
    """The three period branches as a union; the same rows as one conditional factor."""
    reported = ops.reported_salaries(adapters.survey(spark, sf_dir))
    branches = [
        reported.where(F.col("period_raw").isin(names)).select(
            "country", (F.col("salary") * factor).alias("annual")
        )
        for names, factor in ((["Weekly"], 52), (["Monthly"], 12), (["Yearly", "NA"], 1))
    ]
    every = union_all(*branches).where(F.col("annual").isNotNull())
    return every.groupBy("country").agg(F.count("*").alias("n"))


def salary_csv_single(spark, sf_dir):
    """The counts through the single-file CSV writer and back."""
    counts = ops.count_by_group(ops.reported_salaries(adapters.survey(spark, sf_dir)), "country")
    path = scratch_dir(spark, "counts")
    write_csv_sorted(counts, path, "country")
    return spark.read.schema("country string, n bigint").csv(path)



def salary_report(spark, sf_dir):
    """The saturating statistics as the single CSV file of the report, read back."""
    annual = ops.annual_salaries(adapters.survey(spark, sf_dir))
    path = scratch_dir(spark, "salaries")
    write_csv_sorted(ops.salary_report(ops.salary_stats(annual, "saturating")), path, "country")
    return spark.read.schema("country string, n bigint, min int, max int, avg string").csv(path)


QUERIES = {
    f.__name__: f
    for f in (
        survey_csv_roundtrip, survey_file_stats, valid_salary, salary_clean_annual, salary_rejects, salary_count_total,
        salary_stats, salary_stats_saturating, salary_stats_by_join, salary_sum,
        salary_sum_partitioned, salary_union_periods,
        salary_csv_single, salary_report,
    )
}

_TRUNC_MIN = "CAST(trunc(greatest(least(min(annual), 2147483647), -2147483648)) AS INTEGER)"
_TRUNC_MAX = "CAST(trunc(greatest(least(max(annual), 2147483647), -2147483648)) AS INTEGER)"
_STATS = f"""WITH {SURVEY}
SELECT country, count(*) AS n, {_TRUNC_MIN} AS min, {_TRUNC_MAX} AS max, round(avg(annual), 1) AS avg
FROM annual WHERE annual IS NOT NULL GROUP BY country"""
_COUNTS = f"""WITH {SURVEY}
SELECT 'Total' AS country, count(*) AS n FROM reported
UNION ALL SELECT country, count(*) AS n FROM reported GROUP BY country"""
_SUM = f"""WITH {SURVEY}
SELECT country, CAST(sum(CAST(salary AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM reported WHERE salary IS NOT NULL GROUP BY country"""
ORACLE = {
    "survey_csv_roundtrip": f"WITH {SURVEY} SELECT country_raw, salary_raw, period_raw FROM survey",
    "survey_file_stats": _STATS,
    "valid_salary": f"WITH {SURVEY} SELECT country, round(salary, 2) AS salary, period AS period_raw FROM reported",
    "salary_clean_annual": f"""WITH {SURVEY}
SELECT country, round(annual, 2) AS annual FROM annual WHERE annual IS NOT NULL""",
    "salary_rejects": f"""WITH {SURVEY}
SELECT CASE WHEN r.salary IS NULL THEN 'malformed salary' ELSE 'unknown period' END AS reason, count(*) AS n
FROM reported r JOIN annual a ON a.respondent = r.respondent WHERE a.annual IS NULL GROUP BY 1""",
    "salary_count_total": _COUNTS,
    "salary_stats": _STATS,
    "salary_stats_saturating": f"""WITH {SURVEY}
SELECT country, count(*) AS n, {_TRUNC_MIN} AS min, {_TRUNC_MAX} AS max,
       round(CASE WHEN count(*) > 1 THEN least(sum(annual), 2147483647) ELSE sum(annual) END / count(*), 1) AS avg
FROM annual WHERE annual IS NOT NULL GROUP BY country""",
    "salary_stats_by_join": _STATS,
    "salary_sum": _SUM,
    "salary_sum_partitioned": _SUM,
    "salary_union_periods": f"""WITH {SURVEY}
SELECT country, count(*) AS n FROM annual WHERE annual IS NOT NULL GROUP BY country""",
    "salary_csv_single": _COUNTS,
    "salary_report": f"""WITH {SURVEY}
SELECT country, count(*) AS n, {_TRUNC_MIN} AS min, {_TRUNC_MAX} AS max,
       regexp_replace(printf('%.2f', CASE WHEN count(*) > 1 THEN least(sum(annual), 2147483647)
         ELSE sum(annual) END / count(*)), '^0[.]', '.') AS avg
FROM annual WHERE annual IS NOT NULL GROUP BY country""",
}
