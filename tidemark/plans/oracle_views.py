"""SQL of the adapted inputs, shared by the oracle statements."""

SURVEY = """
survey AS (
  SELECT o.o_orderkey AS respondent,
         CASE WHEN o.o_orderkey % 29 = 0 THEN CONCAT(' "', n.n_name, '"') ELSE n.n_name END AS country_raw,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 'NA'
              WHEN o.o_orderkey % 13 = 0 THEN '0'
              WHEN o.o_orderkey % 17 = 0 THEN ' '
              WHEN o.o_orderkey % 19 = 0 THEN '0.00'
              WHEN o.o_orderkey % 7 = 0 THEN CONCAT('1,', CAST(100 + o.o_orderkey % 900 AS VARCHAR))
              WHEN o.o_orderkey % 997 = 1 THEN '99999999999.5'
              ELSE CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS salary_raw,
         CASE WHEN o.o_orderkey % 23 = 0 THEN 'Hourly'
              WHEN o.o_orderstatus = 'F' THEN 'Weekly'
              WHEN o.o_orderstatus = 'O' THEN 'Monthly'
              WHEN o.o_orderkey % 2 = 0 THEN 'NA' ELSE 'Yearly' END AS period_raw
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
),
reported AS (
  SELECT respondent, replace(trim(country_raw), '"', '') AS country,
         TRY_CAST(replace(replace(trim(salary_raw), '"', ''), ',', '') AS DOUBLE) AS salary,
         trim(period_raw) AS period
  FROM survey WHERE salary_raw NOT IN ('NA', ' ', '0')
),
annual AS (
  SELECT respondent, country, salary * CASE replace(period, 'NA', 'Yearly')
           WHEN 'Weekly' THEN 52 WHEN 'Monthly' THEN 12 WHEN 'Yearly' THEN 1 END AS annual
  FROM reported
)"""

RATINGS = """
ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item,
         CAST(MAX(CAST(l.l_quantity AS BIGINT) % 5 + 1) AS DOUBLE) AS rating,
         o.o_custkey % 97 = 0 OR l.l_partkey % 101 = 0
           OR (o.o_custkey * 31 + l.l_partkey) % 10 = 0 AS is_test
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey
),
train AS (SELECT "user", item, rating FROM ratings WHERE NOT is_test),
test AS (SELECT "user", item, rating FROM ratings WHERE is_test)"""

BASKETS = """
rows_ AS (SELECT DISTINCT l.l_orderkey AS key, p.p_brand AS item
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

WORDS = """
words AS (SELECT doc_id, w AS term
          FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> ''),
terms AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term)"""

POINTS = """
points AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"""

MESSAGES = """
messages AS (
  SELECT m.event_id + 1 AS seq, m.ts, length(d.text) AS body_len
  FROM (SELECT event_id, ts, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events) m
       JOIN documents d ON m.doc_id = d.doc_id
)"""

TAGS = """
tags AS (
  SELECT event_id + 1 AS seq, CONCAT('u', CAST(user_id AS VARCHAR)) AS tag FROM events
  UNION ALL
  SELECT event_id + 1 AS seq, event_type AS tag FROM events WHERE event_id % 3 = 0
)"""


def java_hash_sql(column: str) -> str:
    """`String.hashCode` of a BMP text as bigint."""
    units = f"list_prepend(0::BIGINT, list_transform(string_split({column}, ''), lambda c: unicode(c)::BIGINT))"
    folded = f"list_reduce({units}, lambda a, x: (a * 31 + x) % 4294967296)"
    return f"(CASE WHEN {folded} >= 2147483648 THEN {folded} - 4294967296 ELSE {folded} END)"
