"""The queries of this package on the given tables, with SQL where it can tell the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    centroids,
    chat,
    decontamination,
    exact_dedup,
    exact_topk,
    hard_negatives,
    licenses,
    near_dedup,
    quality,
    sharding,
    token_counts,
    toxicity,
)
from millrace.llm.common import documents, few_at_once

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            few_at_once(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = configured
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


@query()
def op4_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_sharding(spark, sf_dir):
    placed = sharding.sharded(documents(spark, sf_dir), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok'
        FROM (VALUES (0, 'user'), (1, 'assistant')) AS added(turn, role)
    ), sized AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS escaped,
            replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS named
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(length(named) + length(escaped) + 15)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
""")
def op3_chat_formatting(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.read_back(chat.formatted(chat.with_control_strings(conversations)))


@query()
def op2_license_scan(spark, sf_dir):
    best = F.get("found", F.lit(0))
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id",
        F.array_join(F.array_sort("found.license"), ",").alias("licenses"),
        best["license"].alias("best_license"),
        F.coalesce(best["dice"], F.lit(0.0)).alias("best_dice"),
        F.aggregate("found.segments", F.lit(0).cast("long"), lambda a, b: a + b).alias("n_segments"),
    )


@query()
def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.scored(docs, toxicity.fit(docs, labels))


@query()
def op9_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.judged(documents(spark, sf_dir), benchmark).withColumn(
        "items", F.array_join(F.col("items").cast("array<string>"), ",")
    )


@query()
def op10_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query()
def op5_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.judged(documents(spark, sf_dir), labels)


def _embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _whole_vectors(scale: int, extra: str = "", where: str = "TRUE") -> str:
    """SQL for the usable vectors with whole components."""
    return f"""
        SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS q{extra} FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND {where}
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    """


@query(f"""
    WITH v AS ({_whole_vectors(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", "label IS NOT NULL")}),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, (row_number() OVER own)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW own AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER own <= 5
""")
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_embeddings(spark, sf_dir).withColumn("label", label), F.col("vec_id") % 100 == 0)


def _clusters_sql() -> str:
    steps = []
    for step in range(4):
        steps.append(f"""a{step} AS (
            SELECT vec_id, n, d FROM (
                SELECT vec_id, n, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{step} c USING (i) GROUP BY vec_id, n
            ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, n) = 1
        )""")
        if step < 3:
            steps.append(f"""c{step + 1} AS (
                SELECT c.n, c.i, coalesce(m.x, c.x) AS x FROM c{step} c LEFT JOIN (
                    SELECT n, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
                    FROM v JOIN a{step} USING (vec_id) GROUP BY n, i
                ) m USING (n, i)
            )""")
    return f"""
        WITH w AS ({_whole_vectors(64, where="len(embedding) = 64")}),
        v AS (SELECT vec_id, unnest(range(64)) AS i, unnest(q)::BIGINT AS x FROM w),
        starts AS (
            SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS n FROM w
            QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16
        ),
        c0 AS (SELECT n, i, x FROM v JOIN starts USING (vec_id)),
        {", ".join(steps)},
        digests AS (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY n)
        SELECT vec_id, n::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY n))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a3 JOIN digests USING (n)
    """


@query(_clusters_sql())
def op12_centroid_clustering(spark, sf_dir):
    return centroids.clustered(_embeddings(spark, sf_dir))


@query(f"""
    WITH v AS ({_whole_vectors(64)})
    SELECT a.vec_id AS query_id, (row_number() OVER own)::INTEGER AS rank, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
    WINDOW own AS (PARTITION BY a.vec_id ORDER BY list_dot_product(a.q, b.q) DESC, b.vec_id)
    QUALIFY row_number() OVER own <= 20
""")
def op13_exact_topk(spark, sf_dir):
    return exact_topk.top_k(_embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0)
