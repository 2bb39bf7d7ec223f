"""Registered queries over order baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import contains_all
from tidemark.operators import itemsets as ops
from tidemark.operators import relational as rel
from tidemark.plans.oracle_views import BASKETS
from tidemark.session import scratch_dir
from tidemark.sources import adapters
from tidemark.sources.readers import read_baskets
from tidemark.sources.sinks import format_itemsets

CHUNKS = 8
# A set is frequent in at least one of this many baskets.
ONE_IN = 245


def _baskets(spark, sf_dir):
    """(rows, support), the support being a share of the baskets."""
    rows = adapters.basket_rows(spark, sf_dir)
    return rows, rows.select("key").distinct().count() // ONE_IN


def _text(df):
    return df.withColumn("items", F.array_join("items", ","))


def baskets_csv_roundtrip(spark, sf_dir):
    """Headerless basket lines with a further column, written and read back."""
    path = scratch_dir(spark, "baskets")
    adapters.basket_rows(spark, sf_dir).withColumn("extra", F.lit("x")).write.csv(path)
    return read_baskets(spark, path)


def baskets(spark, sf_dir):
    return _text(ops.build_baskets(adapters.basket_rows(spark, sf_dir)))


def son_local_items(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    return _text(ops.local_frequent_items(rows, support, CHUNKS, F.col("key") % CHUNKS))


def _frequent(rows, support, size):
    found = ops.son_frequent_itemsets(rows, support, CHUNKS, max_size=size)
    return found.where(F.col("size") == size)


def son_local_pairs(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    pairs = _frequent(rows, support, 2).select("items")
    return _text(ops.local_frequent_sets(rows, pairs, support, CHUNKS, F.col("key") % CHUNKS))


def apriori_candidates(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    return _text(ops.apriori_candidates(_frequent(rows, 3 * support, 2)))


def global_support(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    triples = ops.apriori_candidates(_frequent(rows, support, 2))
    return _text(ops.global_support(rows, triples, support))


def son_itemsets(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    return _text(ops.son_frequent_itemsets(rows, support, CHUNKS))


def son_itemsets_wide(spark, sf_dir):
    """The same itemsets with the largest baskets counted apart."""
    rows, support = _baskets(spark, sf_dir)
    return _text(ops.son_frequent_itemsets(rows, support, CHUNKS, wide=9))


def fpgrowth_itemsets(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    return _text(ops.fpgrowth_itemsets(rows, support))


def itemset_lines(spark, sf_dir):
    rows, support = _baskets(spark, sf_dir)
    return format_itemsets(ops.son_frequent_itemsets(rows, support, CHUNKS))


def baskets_with_itemset(spark, sf_dir):
    """Baskets that hold two given brands, from the long form."""
    return ops.baskets_with(adapters.basket_rows(spark, sf_dir), "Brand#11", "Brand#12")


def baskets_with_itemset_array(spark, sf_dir):
    """The same baskets by the array predicate."""
    arrays = ops.build_baskets(adapters.basket_rows(spark, sf_dir))
    wanted = F.array(F.lit("Brand#11"), F.lit("Brand#12"))
    return arrays.where(contains_all(F.col("items"), wanted)).select("key")


def candidate_union(spark, sf_dir):
    """Items that are locally frequent among urgent or among other orders, and in both."""
    rows, support = _baskets(spark, sf_dir)
    orders = adapters.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    marked = rows.join(orders, "key")
    a = ops.local_frequent_items(marked.where("urgent"), 8 * support, 1)
    b = ops.local_frequent_items(marked.where("not urgent"), 31 * support, 1)
    both = rel.candidate_intersect(a, b).select("items", F.lit("both").alias("side"))
    return _text(rel.candidate_union(a, b).select("items", F.lit("any").alias("side")).unionByName(both))


QUERIES = {
    f.__name__: f
    for f in (
        baskets_csv_roundtrip, baskets, son_local_items, son_local_pairs, apriori_candidates, global_support, son_itemsets,
        son_itemsets_wide, fpgrowth_itemsets, itemset_lines, baskets_with_itemset,
        baskets_with_itemset_array, candidate_union,
    )
}

_S = f"(SELECT count(DISTINCT key) // {ONE_IN} FROM rows_)"
_LOCAL = f"greatest(1, {_S} // {CHUNKS})"
_LEVELS = f"""WITH {BASKETS},
l1 AS (SELECT item AS a, count(*) AS support FROM rows_ GROUP BY item HAVING count(*) >= {_S}),
l2 AS (SELECT x.item AS a, y.item AS b, count(*) AS support
       FROM rows_ x JOIN rows_ y ON x.key = y.key AND x.item < y.item
       GROUP BY 1, 2 HAVING count(*) >= {_S}),
l3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS support
       FROM rows_ x JOIN rows_ y ON x.key = y.key AND x.item < y.item
            JOIN rows_ z ON x.key = z.key AND y.item < z.item
       GROUP BY 1, 2, 3 HAVING count(*) >= {_S}),
l4 AS (SELECT x.item AS a, y.item AS b, z.item AS c, t.item AS d, count(*) AS support
       FROM rows_ x JOIN rows_ y ON x.key = y.key AND x.item < y.item
            JOIN rows_ z ON x.key = z.key AND y.item < z.item
            JOIN rows_ t ON x.key = t.key AND z.item < t.item
       GROUP BY 1, 2, 3, 4 HAVING count(*) >= {_S}),
found AS (SELECT a AS items, CAST(1 AS INTEGER) AS size, support FROM l1
          UNION ALL SELECT a || ',' || b, CAST(2 AS INTEGER), support FROM l2
          UNION ALL SELECT a || ',' || b || ',' || c, CAST(3 AS INTEGER), support FROM l3
          UNION ALL SELECT a || ',' || b || ',' || c || ',' || d, CAST(4 AS INTEGER), support FROM l4)"""
_FOUND = f"{_LEVELS} SELECT items, size, support FROM found"
_PAIRS3 = f"""pairs AS (SELECT x.item AS a, y.item AS b
       FROM rows_ x JOIN rows_ y ON x.key = y.key AND x.item < y.item
       GROUP BY 1, 2 HAVING count(*) >= 3 * {_S})"""

ORACLE = {
    "baskets_csv_roundtrip": """SELECT CAST(l.l_orderkey AS VARCHAR) AS key, p.p_brand AS item
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "baskets": f"""WITH {BASKETS}
SELECT key, string_agg(item, ',' ORDER BY item) AS items FROM rows_ GROUP BY key""",
    "son_local_items": f"""WITH {BASKETS}
SELECT DISTINCT item AS items FROM rows_ GROUP BY key % {CHUNKS}, item HAVING count(*) >= {_LOCAL}""",
    "son_local_pairs": f"""{_LEVELS}
SELECT DISTINCT x.item || ',' || y.item AS items
FROM rows_ x JOIN rows_ y ON x.key = y.key JOIN l2 ON l2.a = x.item AND l2.b = y.item
GROUP BY x.key % {CHUNKS}, x.item, y.item HAVING count(*) >= {_LOCAL}""",
    "apriori_candidates": f"""WITH {BASKETS}, {_PAIRS3}
SELECT p.a || ',' || p.b || ',' || q.b AS items
FROM pairs p JOIN pairs q ON p.a = q.a AND p.b < q.b JOIN pairs r ON r.a = p.b AND r.b = q.b""",
    "global_support": f"""{_LEVELS}
SELECT a || ',' || b || ',' || c AS items, CAST(3 AS INTEGER) AS size, support FROM l3""",
    "son_itemsets": _FOUND,
    "son_itemsets_wide": _FOUND,
    "fpgrowth_itemsets": _FOUND,
    "itemset_lines": f"""{_LEVELS},
numbered AS (SELECT size, items, row_number() OVER (PARTITION BY size ORDER BY items) AS n FROM found)
SELECT size, n, '(' || replace(items, ',', ', ') || ')' AS line FROM numbered""",
    "baskets_with_itemset": f"""WITH {BASKETS}
SELECT key FROM rows_ WHERE item IN ('Brand#11', 'Brand#12') GROUP BY key HAVING count(*) = 2""",
    "baskets_with_itemset_array": f"""WITH {BASKETS}
SELECT key FROM rows_ WHERE item IN ('Brand#11', 'Brand#12') GROUP BY key HAVING count(*) = 2""",
    "candidate_union": f"""WITH {BASKETS},
marked AS (SELECT DISTINCT r.key, r.item, o.o_orderpriority = '1-URGENT' AS urgent
           FROM rows_ r JOIN orders o ON o.o_orderkey = r.key),
a AS (SELECT item FROM marked WHERE urgent GROUP BY item HAVING count(*) >= 8 * {_S}),
b AS (SELECT item FROM marked WHERE NOT urgent GROUP BY item HAVING count(*) >= 31 * {_S})
SELECT item AS items, 'any' AS side FROM (SELECT item FROM a UNION SELECT item FROM b)
UNION ALL SELECT item AS items, 'both' AS side FROM (SELECT item FROM a INTERSECT SELECT item FROM b)""",
}
