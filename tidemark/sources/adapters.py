"""The supplied tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import words


# Lines of orders that a task of ratings is meant to hold.
TASK_RATINGS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[respondent, country_raw, salary_raw, period_raw] with every kind of dirt."""
    orders = table(spark, sf_dir, "orders").alias("o")
    customer = table(spark, sf_dir, "customer").alias("c")
    nation = table(spark, sf_dir, "nation").alias("n")
    key, name = F.col("o_orderkey"), F.col("n_name")
    salary = (
        F.when(key % 11 == 0, "NA")
        .when(key % 13 == 0, "0")
        .when(key % 17 == 0, " ")
        .when(key % 19 == 0, "0.00")
        .when(key % 7 == 0, F.concat(F.lit("1,"), (key % 900 + 100).cast("string")))
        .when(key % 997 == 1, "99999999999.5")
        .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    )
    period = (
        F.when(key % 23 == 0, "Hourly")
        .when(F.col("o_orderstatus") == "F", "Weekly")
        .when(F.col("o_orderstatus") == "O", "Monthly")
        .when(key % 2 == 0, "NA")
        .otherwise("Yearly")
    )
    quoted = F.concat(F.lit(' "'), name, F.lit('"'))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("respondent"),
            F.when(key % 29 == 0, quoted).otherwise(name).alias("country_raw"),
            salary.alias("salary_raw"),
            period.alias("period_raw"),
        )
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[user, item, rating, is_test], one row per customer and part.

    Lines are dealt out by user and item, about TASK_RATINGS to a task, as what follows holds those of a task several times.
    """
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lineitem.count() // TASK_RATINGS))
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), "l_quantity")
        .repartition(tasks, "user", "item")
        .groupBy("user", "item")
        .agg(F.max(F.col("l_quantity").cast("bigint") % 5 + 1).cast("double").alias("rating"))
        .withColumn(
            "is_test",
            (F.col("user") % 97 == 0)
            | (F.col("item") % 101 == 0)
            | ((F.col("user") * 31 + F.col("item")) % 10 == 0),
        )
    )


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): the train file holds every rating, so the test pairs must be subtracted."""
    every = ratings(spark, sf_dir)
    return every.drop("is_test"), every.where("is_test").drop("is_test")


def basket_rows(spark: SparkSession, sf_dir: str, item: str = "p_brand") -> DataFrame:
    """[key, item] with duplicates: orders and the brands (or types) bought in them."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", item)
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("key"), F.col(item).alias("item")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[doc_id, words]"""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", words(F.col("text")).alias("words"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[id, vec array<double>]"""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )


def tags_of(events: DataFrame, *keep: str) -> DataFrame:
    """Events with their tags: the user, and for every third event its type as well."""
    user_tag = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    tags = F.when(
        F.col("event_id") % 3 == 0, F.array(user_tag, F.col("event_type"))
    ).otherwise(F.array(user_tag))
    return events.select((F.col("event_id") + 1).alias("seq"), "ts", "event_id", *keep, tags.alias("tags"))


def with_text(tagged: DataFrame, documents: DataFrame, text: Column, name: str) -> DataFrame:
    """[seq, ts, tags, name]: the text of a message is a document, taken round robin.

    `text` is worked out before the join, so a length doesn't carry the texts along.
    """
    n_docs = documents.agg(F.count("*")).scalar()
    lookup = documents.select(F.col("doc_id").alias("_doc"), text.alias(name))
    joined = tagged.withColumn("_doc", F.col("event_id") % n_docs).join(lookup, "_doc")
    return joined.select("seq", "ts", "tags", name)


def text_length() -> Column:
    return F.length("text").cast("bigint")


def message_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[seq, ts, tags, len]"""
    tagged = tags_of(table(spark, sf_dir, "events"))
    return with_text(tagged, table(spark, sf_dir, "documents"), text_length(), "len")


def message_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[seq, tag]"""
    tagged = tags_of(table(spark, sf_dir, "events"))
    return tagged.select("seq", F.explode("tags").alias("tag"))
