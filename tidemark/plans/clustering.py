"""Registered queries over documents and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clustering as ops
from tidemark.operators import sparse_kmeans, text
from tidemark.plans.oracle_views import POINTS, WORDS
from tidemark.session import materialise, scratch_dir
from tidemark.sources import adapters
from tidemark.sources.readers import documents_from_table, read_documents
from tidemark.sources.sinks import write_cluster_report

K = 5
ROUNDS = 3
# Clusters and rounds of the splits that SQL repeats.
SPLITS = 4
SPLIT_ROUNDS = 2


def documents_words(spark, sf_dir):
    docs = documents_from_table(adapters.table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n"), F.get("words", F.lit(0)).alias("first"))


def documents_text(spark, sf_dir):
    """The documents as text files, one to a line in the order of their ids, written and read back."""
    path = scratch_dir(spark, "documents")
    docs = adapters.table(spark, sf_dir, "documents").orderBy("doc_id")
    docs.select(F.translate("text", "\r\n", "  ").alias("value")).write.text(path)
    docs = read_documents(spark, path)
    return docs.select(
        "doc_id", F.size("words").cast("bigint").alias("n"), F.get("words", F.lit(0)).alias("first")
    )


def term_counts(spark, sf_dir):
    return text.term_counts(adapters.documents(spark, sf_dir))


def idf(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir)
    weights = text.idf(text.term_counts(docs), text.document_count(docs))
    return weights.withColumn("idf", F.round("idf", 6))


def tfidf(spark, sf_dir):
    return text.tfidf_long(adapters.documents(spark, sf_dir)).withColumn("tfidf", F.round("tfidf", 6))


def bag_of_words(spark, sf_dir):
    return text.bag_of_words(adapters.documents(spark, sf_dir))


def hashing_tfidf(spark, sf_dir):
    vectors = text.tfidf(adapters.documents(spark, sf_dir))
    raw = F.unwrap_udt("features")
    return vectors.select("doc_id", F.size(raw["indices"]).alias("terms"))


def hashed_counts(spark, sf_dir):
    """Words of each document from its hashed vector: a collision adds counts, it loses none."""
    vectors = text.hashing_tf(adapters.documents(spark, sf_dir))
    counts = F.aggregate(F.unwrap_udt("tf")["values"], F.lit(0.0), lambda a, x: a + x)
    return vectors.select("doc_id", counts.alias("tokens"))


def _lloyd(spark, sf_dir, rounds=ROUNDS):
    points = adapters.points(spark, sf_dir)
    return ops.lloyd_kmeans(points, ops.smallest_id_centres(points, K), rounds)


def assign_nearest(spark, sf_dir):
    points = adapters.points(spark, sf_dir)
    nearest = ops.assign_nearest(points, ops.smallest_id_centres(points, K))
    return nearest.select("id", "cluster", F.round("d2", 6).alias("d2"))


def lloyd_kmeans(spark, sf_dir):
    assigned, _ = _lloyd(spark, sf_dir)
    return assigned.select("id", "cluster", F.round("d2", 6).alias("d2"))


def lloyd_centres(spark, sf_dir):
    _, centres = _lloyd(spark, sf_dir)
    at = centres.select("cluster", F.posexplode("vec").alias("pos", "x"))
    return at.withColumn("x", F.round("x", 6))


def cluster_sse(spark, sf_dir):
    assigned, _ = _lloyd(spark, sf_dir)
    return ops.cluster_sse(assigned).withColumn("sse", F.round("sse", 5))


def _sparse(spark, sf_dir, x="tfidf"):
    """(documents by their own terms, weighted by `x`, [doc_id, term, tf] with terms as numbers, vocabulary)."""
    docs = adapters.documents(spark, sf_dir)
    rows, vocabulary = text.weighted_terms(docs)
    return sparse_kmeans.documents_rows(docs, rows, x_col=x), rows.withColumnRenamed("term_id", "term"), vocabulary


def _clustered(spark, sf_dir, x="tfidf"):
    """(assigned, term counts by cluster with terms as numbers, vocabulary) of all documents."""
    docs, terms, vocabulary = _sparse(spark, sf_dir, x)
    assigned, _ = sparse_kmeans.kmeans(docs, K, ROUNDS)
    assigned = materialise(assigned.select("doc_id", "cluster", "d2"), "assigned")
    return assigned, ops.cluster_terms(assigned, terms), vocabulary


def cluster_documents(spark, sf_dir):
    assigned, _, _ = _clustered(spark, sf_dir)
    return assigned.select("doc_id", "cluster", F.round("d2", 2).alias("d2"))


def cluster_terms(spark, sf_dir):
    _, terms, vocabulary = _clustered(spark, sf_dir)
    words = vocabulary.select(F.col("term_id").alias("term"), F.col("term").alias("word"))
    return terms.join(words, "term").select("cluster", "doc_id", F.col("word").alias("term"), "tf")


def _top_terms(spark, sf_dir, mode):
    _, terms, vocabulary = _clustered(spark, sf_dir)
    return ops.named_terms(ops.top_terms(terms, mode=mode), vocabulary)


def cluster_top_terms(spark, sf_dir):
    return _top_terms(spark, sf_dir, "summed")


def cluster_top_terms_literal(spark, sf_dir):
    return _top_terms(spark, sf_dir, "literal")


def _flat(report):
    """[algorithm, wsse, id, size, error, terms]"""
    one = report.select("algorithm", "wsse", F.explode("clusters").alias("c"))
    return one.select(
        "algorithm",
        F.round("wsse", 2).alias("wsse"),
        "c.id",
        "c.size",
        F.round("c.error", 2).alias("error"),
        F.array_join("c.terms", " ").alias("terms"),
    )


def cluster_report(spark, sf_dir):
    """The report, written as JSON and read back."""
    assigned, terms, vocabulary = _clustered(spark, sf_dir)
    report = ops.cluster_report(assigned, terms, "K-Means", vocabulary=vocabulary)
    path = scratch_dir(spark, "report")
    write_cluster_report(report, path)
    return _flat(spark.read.schema(report.schema).json(path))


def _lloyd_report(spark, sf_dir, x, algorithm):
    assigned, terms, vocabulary = _clustered(spark, sf_dir, x)
    return _flat(ops.cluster_report(assigned, terms, algorithm, vocabulary=vocabulary))


def lloyd_report_tfidf(spark, sf_dir):
    return _lloyd_report(spark, sf_dir, "tfidf", "K-Means T")


def lloyd_report_words(spark, sf_dir):
    return _lloyd_report(spark, sf_dir, "tf", "K-Means W")


def _bisected(spark, sf_dir):
    docs, terms, vocabulary = _sparse(spark, sf_dir)
    assigned, _ = sparse_kmeans.bisecting(docs, SPLITS, SPLIT_ROUNDS)
    return materialise(assigned.select("doc_id", "cluster", "d2"), "assigned"), terms, vocabulary


def bisecting_documents(spark, sf_dir):
    """Repeated two-way splits of all documents by their own terms."""
    assigned, _, _ = _bisected(spark, sf_dir)
    return assigned.select("doc_id", "cluster", F.round("d2", 2).alias("d2"))


def bisecting_report_terms(spark, sf_dir):
    assigned, terms, vocabulary = _bisected(spark, sf_dir)
    report = ops.cluster_report(assigned, ops.cluster_terms(assigned, terms), "Bisecting K-Means T", vocabulary=vocabulary)
    return _flat(report)


def _hashed(spark, sf_dir):
    """(documents with words, sparse documents) by hashed TF-IDF."""
    # Words are hashed once; the weights are worked out where the vectors are read.
    features = text.idf_vectors(materialise(text.hashing_tf(adapters.documents(spark, sf_dir)), "hashed"))
    return features.select("doc_id", "words"), ops.sparse_features(features)


def _ml_report(spark, sf_dir, cluster, k, algorithm):
    words, docs = _hashed(spark, sf_dir)
    assigned = materialise(cluster(docs, k)[0].select("doc_id", "cluster", "d2"), "assigned")
    return _flat(ops.cluster_report(assigned, ops.words_by_cluster(words.join(assigned, "doc_id")), algorithm))


def kmeans_report_8(spark, sf_dir):
    return _ml_report(spark, sf_dir, ops.kmeans, 8, "K-Means")


def kmeans_report_16(spark, sf_dir):
    return _ml_report(spark, sf_dir, ops.kmeans, 16, "K-Means")


def bisecting_report_8(spark, sf_dir):
    return _ml_report(spark, sf_dir, ops.bisecting_kmeans, 8, "Bisecting K-Means")


def bisecting_report_16(spark, sf_dir):
    return _ml_report(spark, sf_dir, ops.bisecting_kmeans, 16, "Bisecting K-Means")


def kmeans_checks(spark, sf_dir):
    """Distances of the fits on hashed features, worked out again from the documents and the centres.

    Documents with a recorded distance that isn't the one to their centre, documents for which k-means has
    a nearer centre, and whether the error is below that of one cluster less.
    """
    _, docs = _hashed(spark, sf_dir)
    found = []
    for name, cluster in (("K-Means", ops.kmeans), ("Bisecting K-Means", ops.bisecting_kmeans)):
        assigned, centres = cluster(docs, 8)
        assigned = materialise(assigned.select("doc_id", "cluster", "d2"), "assigned")
        one = cluster(docs, 1)[0].agg(F.sum("d2")).first()[0]
        nearer = F.col("own") - F.col("least") > 1e-3 if name == "K-Means" else F.lit(False)
        found.append(
            ops.recomputed(docs, assigned, centres).agg(
                F.lit(name).alias("algorithm"),
                F.count("*").alias("documents"),
                F.count_if(F.abs(F.greatest("own", F.lit(0.0)) - F.col("d2")) > 1e-3).alias("wrong_distances"),
                F.count_if(nearer).alias("not_nearest"),
                (F.sum("own") < one).alias("better_than_one"),
            )
        )
    return found[0].unionByName(found[1])


QUERIES = {
    f.__name__: f
    for f in (
        documents_words, documents_text, term_counts, idf, tfidf, bag_of_words, hashing_tfidf, cluster_documents,
        assign_nearest, lloyd_kmeans, lloyd_centres, cluster_sse, cluster_terms, cluster_top_terms,
        cluster_top_terms_literal, cluster_report, lloyd_report_tfidf, lloyd_report_words,
        kmeans_report_8, kmeans_report_16, bisecting_report_8, bisecting_report_16, hashed_counts, kmeans_checks,
        bisecting_documents, bisecting_report_terms,
    )
}


def _lloyd_sql(rounds: int) -> str:
    """Long-form k-means, one pair of statements per round."""
    sql = f"""WITH {POINTS},
dims AS (SELECT id, CAST(pos - 1 AS INTEGER) AS pos, vec[pos] AS x
         FROM (SELECT id, vec, unnest(range(1, len(vec) + 1)) AS pos FROM points)),
c0 AS (SELECT CAST(id AS INTEGER) AS cluster, pos, x FROM dims WHERE id < {K})"""
    for i in range(rounds + 1):
        sql += f""",
d{i} AS (SELECT p.id, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS d2
         FROM dims p JOIN c{i} c ON c.pos = p.pos GROUP BY 1, 2),
a{i} AS (SELECT id, cluster, d2 FROM
         (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, cluster) AS r FROM d{i}) WHERE r = 1)"""
        if i < rounds:
            sql += f""",
c{i + 1} AS (SELECT cluster, pos, avg(x) AS x FROM dims JOIN a{i} USING (id) GROUP BY 1, 2)"""
    return sql


_LLOYD = _lloyd_sql(ROUNDS)


def _lloyd_terms_sql(x: str) -> str:
    """Long-form k-means on the terms of all documents, weighted by the expression `x`."""
    sql = f"""WITH {WORDS},
weights AS MATERIALIZED (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM terms GROUP BY term),
w AS MATERIALIZED (SELECT doc_id, term, {x} AS x FROM terms JOIN weights USING (term)),
norms AS MATERIALIZED (SELECT d.doc_id, coalesce(sum(x * x), 0) AS p2 FROM documents d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id),
s AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER) AS cluster FROM documents QUALIFY cluster < {K}),
c0 AS MATERIALIZED (SELECT cluster, term, x FROM w JOIN s USING (doc_id))"""
    for i in range(ROUNDS + 1):
        sql += f""",
n{i} AS (SELECT s.cluster, coalesce(sum(c.x * c.x), 0) AS c2 FROM s LEFT JOIN c{i} c USING (cluster) GROUP BY s.cluster),
t{i} AS (SELECT w.doc_id, c.cluster, sum(w.x * c.x) AS dot FROM w JOIN c{i} c USING (term) GROUP BY 1, 2),
d{i} AS (SELECT p.doc_id, n.cluster, greatest(round(p2 + c2 - 2 * coalesce(dot, 0), 6), 0) AS d2
         FROM norms p CROSS JOIN n{i} n LEFT JOIN t{i} t ON t.doc_id = p.doc_id AND t.cluster = n.cluster),
a{i} AS MATERIALIZED (SELECT doc_id, cluster, d2 FROM
         (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d2, cluster) AS r FROM d{i}) WHERE r = 1)"""
        if i < ROUNDS:
            sql += f""",
g{i} AS (SELECT cluster, count(*) AS members FROM a{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT a.cluster, w.term, sum(w.x) / any_value(g.members) AS x
  FROM a{i} a JOIN w USING (doc_id) JOIN g{i} g ON g.cluster = a.cluster GROUP BY 1, 2
  UNION ALL SELECT cluster, term, x FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM g{i}))"""
    return f"""{sql},
members AS (SELECT a.cluster, t.doc_id, t.term, t.tf FROM a{ROUNDS} a JOIN terms t USING (doc_id)),
summed AS (SELECT cluster, term, sum(tf) AS n FROM members GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS INTEGER) AS rank FROM summed),
best AS (SELECT cluster, string_agg(term, ' ' ORDER BY rank) AS terms FROM ranked WHERE rank <= 10 GROUP BY cluster)"""


_MEMBERS = _lloyd_terms_sql("tf * idf")


def _split_sql() -> str:
    """Two levels of two-way splits, from one cluster to four."""
    sql = f"""WITH {WORDS},
weights AS MATERIALIZED (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM terms GROUP BY term),
w AS MATERIALIZED (SELECT doc_id, term, tf * idf AS x FROM terms JOIN weights USING (term)),
norms AS MATERIALIZED (SELECT d.doc_id, coalesce(sum(x * x), 0) AS p2 FROM documents d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id),
g0 AS (SELECT doc_id, 0 AS grp FROM documents)"""
    for level, leaves in enumerate((1, 2)):
        sql += f""",
chosen{level} AS MATERIALIZED (SELECT grp, row_number() OVER (ORDER BY count(*) DESC, grp) - 1 AS i FROM g{level} GROUP BY grp),
sides{level} AS (SELECT grp, side FROM chosen{level} CROSS JOIN (VALUES (0), (1)) s(side)),
c{level}_0 AS MATERIALIZED (
  SELECT s.grp, s.side, w.term, w.x FROM w JOIN
    (SELECT doc_id, grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS side FROM g{level} QUALIFY side < 2) s USING (doc_id))"""
        for i in range(SPLIT_ROUNDS + 1):
            sql += f""",
n{level}_{i} AS (SELECT s.grp, s.side, coalesce(sum(c.x * c.x), 0) AS c2
  FROM sides{level} s LEFT JOIN c{level}_{i} c ON c.grp = s.grp AND c.side = s.side GROUP BY 1, 2),
t{level}_{i} AS (SELECT g.doc_id, c.side, sum(w.x * c.x) AS dot
  FROM g{level} g JOIN w USING (doc_id) JOIN c{level}_{i} c ON c.term = w.term AND c.grp = g.grp GROUP BY 1, 2),
d{level}_{i} AS (SELECT g.doc_id, g.grp, n.side, greatest(round(p2 + c2 - 2 * coalesce(dot, 0), 6), 0) AS d2
  FROM g{level} g JOIN norms USING (doc_id) JOIN n{level}_{i} n ON n.grp = g.grp
       LEFT JOIN t{level}_{i} t ON t.doc_id = g.doc_id AND t.side = n.side),
a{level}_{i} AS MATERIALIZED (SELECT doc_id, grp, arg_min(side, (d2, side)) AS side, min(d2) AS d2 FROM d{level}_{i} GROUP BY 1, 2)"""
            if i < SPLIT_ROUNDS:
                sql += f""",
m{level}_{i} AS (SELECT grp, side, count(*) AS n FROM a{level}_{i} GROUP BY 1, 2),
c{level}_{i + 1} AS MATERIALIZED (
  SELECT a.grp, a.side, w.term, sum(w.x) / any_value(m.n) AS x
  FROM a{level}_{i} a JOIN w USING (doc_id) JOIN m{level}_{i} m ON m.grp = a.grp AND m.side = a.side GROUP BY 1, 2, 3
  UNION ALL SELECT grp, side, term, x FROM c{level}_{i} WHERE (grp, side) NOT IN (SELECT (grp, side) FROM m{level}_{i}))"""
        sql += f""",
g{level + 1} AS MATERIALIZED (SELECT doc_id, CASE WHEN side = 0 THEN grp ELSE {leaves} + i END AS grp, d2
  FROM a{level}_{SPLIT_ROUNDS} JOIN chosen{level} USING (grp))"""
    return sql


_SPLIT = _split_sql()


def _report_sql(sql: str, algorithm: str) -> str:
    return f"""{sql}
SELECT '{algorithm}' AS algorithm, (SELECT round(sum(d2), 2) FROM a{ROUNDS}) AS wsse,
       CAST(a.cluster + 1 AS INTEGER) AS id, count(*) AS size, round(sum(a.d2), 2) AS error,
       coalesce(any_value(best.terms), '') AS terms
FROM a{ROUNDS} a LEFT JOIN best ON best.cluster = a.cluster GROUP BY a.cluster"""


ORACLE = {
    "documents_words": f"""WITH {WORDS}
SELECT d.doc_id, count(w.term) AS n, list_filter(string_split(d.text, ' '), lambda x: x <> '')[1] AS first
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id GROUP BY d.doc_id, d.text""",
    "documents_text": """WITH split AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id,
         list_filter(string_split(replace(replace(text, chr(10), ' '), chr(13), ' '), ' '), lambda x: x <> '') AS w
  FROM documents)
SELECT doc_id, len(w) AS n, w[1] AS first FROM split""",
    "term_counts": f"WITH {WORDS} SELECT doc_id, term, tf FROM terms",
    "idf": f"""WITH {WORDS}
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)), 6) AS idf
FROM terms GROUP BY term""",
    "tfidf": f"""WITH {WORDS},
weights AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM terms GROUP BY term)
SELECT doc_id, term, round(tf * idf, 6) AS tfidf FROM terms JOIN weights USING (term)""",
    "bag_of_words": f"""WITH {WORDS},
vocabulary AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS position FROM (SELECT DISTINCT term FROM terms))
SELECT doc_id, term, position, tf FROM terms JOIN vocabulary USING (term)""",
    "hashed_counts": f"""WITH {WORDS}
SELECT d.doc_id, CAST(coalesce(sum(tf), 0) AS DOUBLE) AS tokens
FROM documents d LEFT JOIN terms t ON t.doc_id = d.doc_id GROUP BY d.doc_id""",
    "kmeans_checks": """SELECT algorithm, count(*) AS documents, CAST(0 AS BIGINT) AS wrong_distances,
       CAST(0 AS BIGINT) AS not_nearest, true AS better_than_one
FROM documents CROSS JOIN (VALUES ('K-Means'), ('Bisecting K-Means')) t(algorithm) GROUP BY algorithm""",
    "bisecting_documents": f"{_SPLIT} SELECT doc_id, CAST(grp AS INTEGER) AS cluster, round(d2, 2) AS d2 FROM g2",
    "bisecting_report_terms": f"""{_SPLIT},
members AS (SELECT g.grp AS cluster, t.term, t.tf FROM g2 g JOIN terms t USING (doc_id)),
summed AS (SELECT cluster, term, sum(tf) AS n FROM members GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS rank FROM summed),
best AS (SELECT cluster, string_agg(term, ' ' ORDER BY rank) AS terms FROM ranked WHERE rank <= 10 GROUP BY cluster)
SELECT 'Bisecting K-Means T' AS algorithm, (SELECT round(sum(d2), 2) FROM g2) AS wsse,
       CAST(g.grp + 1 AS INTEGER) AS id, count(*) AS size, round(sum(g.d2), 2) AS error,
       coalesce(any_value(best.terms), '') AS terms
FROM g2 g LEFT JOIN best ON best.cluster = g.grp GROUP BY g.grp""",
    "assign_nearest": f"{_lloyd_sql(0)} SELECT id, cluster, round(d2, 6) AS d2 FROM a0",
    "lloyd_kmeans": f"{_LLOYD} SELECT id, cluster, round(d2, 6) AS d2 FROM a{ROUNDS}",
    "lloyd_centres": f"{_LLOYD} SELECT cluster, pos, round(x, 6) AS x FROM c{ROUNDS}",
    "cluster_sse": f"""{_LLOYD}
SELECT cluster, count(*) AS size, round(sum(d2), 5) AS sse FROM a{ROUNDS} GROUP BY cluster
UNION ALL SELECT -1 AS cluster, count(*) AS size, round(sum(d2), 5) AS sse FROM a{ROUNDS}""",
    "cluster_terms": f"{_MEMBERS} SELECT cluster, doc_id, term, tf FROM members",
    "cluster_top_terms": f"{_MEMBERS} SELECT cluster, rank, term, CAST(n AS BIGINT) AS n FROM ranked WHERE rank <= 10",
    "cluster_top_terms_literal": f"""{_MEMBERS}
SELECT cluster, rank, term, n FROM
  (SELECT cluster, term, tf AS n,
          CAST(row_number() OVER (PARTITION BY cluster ORDER BY tf DESC, term, doc_id) AS INTEGER) AS rank
   FROM members) WHERE rank <= 10""",
    "cluster_report": _report_sql(_MEMBERS, "K-Means"),
    "lloyd_report_tfidf": _report_sql(_MEMBERS, "K-Means T"),
    "lloyd_report_words": _report_sql(_lloyd_terms_sql("CAST(tf AS DOUBLE)"), "K-Means W"),
    "cluster_documents": f"{_MEMBERS} SELECT doc_id, cluster, round(d2, 2) AS d2 FROM a{ROUNDS}",
}
