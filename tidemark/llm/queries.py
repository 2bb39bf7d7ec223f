"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    hadamard_clusters,
    html_content,
    language_bayes,
    latent_decontam,
    partenum,
    pii,
    quality_cnn,
    secret_scan,
    sentencepiece_codec,
    sharding,
    token_files,
    vector_neardup,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return token_files.read_token_files(manifest).withColumnRenamed("id", "doc_id")


def op2_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_content.extract_text(_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return texts.select(
        F.col("k0").alias("page_id"), F.col("k1").alias("url"), "text", F.length("text").cast("long").alias("n_chars")
    )


def op3_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = partenum.join_sets(_table(spark, sf_dir, "documents"))
    return joined.withColumnsRenamed({"id": "doc_id", "component": "component_id"})


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_cnn.train(docs, _table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, model).select(
        F.col("id").alias("doc_id"),
        quality_cnn.is_held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _vocabulary("piece_bpe_32k.model")
    found = sentencepiece_codec.round_trips(_table(spark, sf_dir, "documents"), model)
    return found.withColumnRenamed("id", "doc_id")


def op6_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_neardup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def _span_counts(kinds: tuple[str, ...]) -> list[Column]:
    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(kinds)]


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    # The first three kinds are those of the base patterns.
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(
        F.col("id").alias("doc_id"),
        *_span_counts(secret_scan.KINDS),
        F.sha2(secret_scan.digest(base), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    # The first four kinds are those of the base patterns.
    base = F.filter("spans", lambda s: s["rank"] < 4)
    return found.select(
        F.col("id").alias("doc_id"),
        *_span_counts(pii.KINDS),
        F.sha2(pii.digest(base), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op10_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = latent_decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op11_hashed_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_bayes.train(docs.where(~language_bayes.is_held_out(F.col("doc_id"))))
    found = language_bayes.predict(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", language_bayes.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_hadamard_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hadamard_clusters.cluster_vectors(_table(spark, sf_dir, "embeddings"))
    return found.drop("centroid").withColumnRenamed("id", "vec_id")


def op13_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    # Null where the exact sum has more digits than a long.
    return found.withColumn("deviation", F.col("deviation").try_cast("long")).withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_html_content": op2_html_content,
    "op3_partenum": op3_partenum,
    "op4_byte_cnn": op4_byte_cnn,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_rotation_codes": op6_rotation_codes,
    "op7_secret_scan": op7_secret_scan,
    "op8_disclosure": op8_disclosure,
    "op9_vector_packing": op9_vector_packing,
    "op10_latent_retrieval": op10_latent_retrieval,
    "op11_hashed_bayes": op11_hashed_bayes,
    "op12_hadamard_search": op12_hadamard_search,
    "op13_refined_whitening": op13_refined_whitening,
}

# Shingles as strings, links by brute force over the sets that share one.
_OP3_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
    FROM w
),
grams AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets WHERE doc_id IS NOT NULL),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (
    SELECT doc_id AS id, doc_id AS met FROM sets
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON reach.met = links.a
),
least AS (SELECT id, min(met) AS component_id FROM reach GROUP BY id)
SELECT sets.doc_id, len(shingles)::BIGINT AS n_shingles, component_id
FROM sets LEFT JOIN least ON least.id = sets.doc_id
"""

# Vectors and links by brute force over all pairs.
_OP6_SQL = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS row_id, vec_id, embedding::DOUBLE[] AS e,
           len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND vec_id IS NOT NULL AS sound
    FROM embeddings
),
links AS (
    SELECT a.row_id, a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.sound AND b.sound AND a.row_id <> b.row_id AND len(a.e) = len(b.e)
    WHERE CASE WHEN a.sound AND b.sound AND len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 END
),
reach AS (
    SELECT vec_id AS id, vec_id AS met FROM v
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON reach.met = links.a
),
least AS (SELECT id, min(met) AS component_id FROM reach GROUP BY id),
counts AS (SELECT row_id, count(*) AS n FROM links GROUP BY row_id)
SELECT v.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, least.component_id,
       v.vec_id = least.component_id AS kept
FROM v LEFT JOIN counts USING (row_id) LEFT JOIN least ON least.id = v.vec_id
"""

# Counts and whole-step logarithms per language and bucket, summed over the n-grams of each text.
_OP11_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, lang,
           coalesce(regexp_matches(text, '\\p{L}'), false) AS known,
           coalesce(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda crc, e: CASE WHEN e >= 0 THEN xor(crc, e)
                   ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 0) AS crc,
           ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}]+', ' ', 'g'), ' ') || ' ' AS plain
    FROM documents
),
marked AS (SELECT *, xor(crc, 4294967295) % 4 = 2 AS held_out, NOT (xor(crc, 4294967295) % 4 = 2) AND known AND lang IS NOT NULL AS learn FROM docs),
codes AS (
    SELECT row_id, unnest(list_transform(string_split(plain, ''), lambda c: ord(c)::BIGINT)) AS c,
           generate_subscripts(string_split(plain, ''), 1) AS place
    FROM marked WHERE known
),
near AS (
    SELECT row_id, c, lead(c, 1) OVER w AS c2, lead(c, 2) OVER w AS c3
    FROM codes WINDOW w AS (PARTITION BY row_id ORDER BY place)
),
grams AS (
    SELECT row_id, (((k & 4294967295) * 1540483477) & 4294967295) >> 16 AS bucket
    FROM (
        SELECT row_id, c + 1 AS k FROM near
        UNION ALL
        SELECT row_id, c * 1000003 + c2 + 2 FROM near WHERE c2 IS NOT NULL
        UNION ALL
        SELECT row_id, ((c * 1000003 + c2) & 4294967295) * 1000003 + c3 + 3 FROM near WHERE c3 IS NOT NULL
    )
),
bags AS (SELECT row_id, bucket, count(*) AS n FROM grams GROUP BY row_id, bucket),
counts AS (
    SELECT lang, bucket, sum(n) AS n FROM bags JOIN marked USING (row_id) WHERE learn GROUP BY lang, bucket
),
langs AS (
    SELECT lang, floor(ln(count(*) / sum(count(*)) OVER ()) * 65536 + 0.5)::BIGINT AS prior
    FROM marked WHERE learn GROUP BY lang
),
totals AS (SELECT lang, sum(n) + 65536 AS total FROM counts GROUP BY lang),
shares AS (
    SELECT lang, bucket, floor(ln((n + 1) / total) * 65536 + 0.5)::BIGINT
        - floor(ln(1 / total) * 65536 + 0.5)::BIGINT AS gain
    FROM counts JOIN totals USING (lang)
),
sizes AS (SELECT row_id, sum(n) AS n FROM bags GROUP BY row_id),
gains AS (
    SELECT row_id, lang, sum(n * gain) AS gain FROM bags JOIN shares USING (bucket) GROUP BY row_id, lang
),
sums AS (
    SELECT sizes.row_id, lang,
        (prior + sizes.n * floor(ln(1 / total) * 65536 + 0.5)::BIGINT + coalesce(gain, 0))::BIGINT AS s
    FROM sizes CROSS JOIN langs JOIN totals USING (lang) LEFT JOIN gains USING (row_id, lang)
),
best AS (
    SELECT row_id, arg_min(lang, (-s, lang)) AS lang_pred, max(s) AS top FROM sums GROUP BY row_id
),
masses AS (
    SELECT row_id, sum(exp((s - top) / 65536)) AS mass FROM sums JOIN best USING (row_id) GROUP BY row_id
)
SELECT doc_id, held_out, coalesce(lang_pred, 'und') AS lang_pred, coalesce(round(1 / mass, 6), 0.0) AS score
FROM marked LEFT JOIN best USING (row_id) LEFT JOIN masses USING (row_id)
"""



def _op12_sql() -> str:
    """Every distance in every round."""
    distance = "list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        """kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, vec_id,
           list_transform(embedding, lambda x: CASE WHEN isfinite(x) THEN floor(256 * x::DOUBLE)::BIGINT END) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        """centres0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, v) - 1 AS c, v AS m
    FROM kept WHERE vec_id IS NOT NULL QUALIFY c < 40
)""",
    ]
    for i in range(6):
        parts.append(f"""placed{i} AS MATERIALIZED (
    SELECT row_id, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
    FROM (SELECT row_id, vec_id, v, c, {distance} AS d FROM kept CROSS JOIN centres{i})
    GROUP BY row_id, vec_id, v
)""")
        parts.append(f"""centres{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(moved.m, centres{i}.m) AS m
    FROM centres{i} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS m
        FROM (
            SELECT c, place, sum(x) AS s, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM placed{i}) GROUP BY c, place
        ) GROUP BY c
    ) moved USING (c)
)""")
    return "WITH " + ",\n".join(parts[:-1]) + """
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM placed5 JOIN centres5 USING (c)
"""


ORACLE: dict[str, str] = {
    "op12_hadamard_search": _op12_sql(),
    "op11_hashed_bayes": _OP11_SQL,
    "op3_partenum": _OP3_SQL,
    "op6_rotation_codes": _OP6_SQL,
}
