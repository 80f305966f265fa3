"""The registered opN_<name> queries: each reads its whole table and applies its operator with production parameters."""

from __future__ import annotations

import public_tokenizers

from .bpe import bpe_round_trip
from .exact_dedup import exact_dedup
from .extraction import extract_main_text
from .jaccard import jaccard_components
from .langid import identify
from .learned_partitions import approximate_neighbours
from .licenses import oracle, scan_licenses
from .packing import pack_documents
from .pitman_yor import score_documents
from .rotated_kmeans import rotated_clusters
from .secrets import find_secrets
from .topk import exact_top_k
from .value_codes import vector_codes

VOCAB = "byte_bpe_50k.json"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark, sf_dir):
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op2_pack(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCAB))


def op3_extract(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_langid(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op5_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, public_tokenizers.path(VOCAB)).drop("text")


def op6_bpe(spark, sf_dir):
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCAB))


def op7_hpy(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op8_jaccard(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_clusters(spark, sf_dir):
    return rotated_clusters(table(spark, sf_dir, "embeddings")).drop("n_verified")


def op12_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark, sf_dir):
    return approximate_neighbours(table(spark, sf_dir, "embeddings"))


def clusters_sql(rounds: int = 5) -> str:
    """Five rounds written out; sums are of whole numbers, so floor(sum / count) is exact."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT n, any_value(vec_id) AS vec_id, any_value(e.x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(e.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c := c.cluster)) AS m
               FROM e CROSS JOIN c{i} c GROUP BY n)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT cluster, list(v ORDER BY j) AS x FROM (SELECT m.c AS cluster, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS v FROM a{i} CROSS JOIN range(1, 65) t(j) GROUP BY ALL) GROUP BY cluster),
        c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster)""")
    listed = ",\n        ".join(steps)
    return f"""
        WITH e AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x FROM (SELECT sha256('2:' || vec_id) AS h, x FROM e WHERE vec_id IS NOT NULL) ORDER BY h, x LIMIT 40),
        {listed}
        SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} c ON m.c = c.cluster"""


def codes_sql(rounds: int = 6) -> str:
    """Six rounds written out, for vectors of 64 components."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT n, q.part, any_value(q.x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c := c.entry)) AS m
               FROM q JOIN c{i} c ON q.part = c.part GROUP BY n, q.part)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT part, entry, list(v ORDER BY j) AS x FROM (SELECT part, m.c AS entry, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS v FROM a{i} CROSS JOIN range(1, 9) t(j) GROUP BY ALL) GROUP BY part, entry),
        c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.entry = m.entry)""")
    listed = ",\n        ".join(steps)
    return f"""
        WITH e AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda v: CAST(floor(4096 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
        q AS MATERIALIZED (SELECT n, part, x[8 * part + 1 : 8 * part + 8] AS x FROM e CROSS JOIN range(8) t(part)),
        f AS (SELECT row_number() OVER (ORDER BY vec_id, x) - 1 AS entry, n FROM e WHERE vec_id IS NOT NULL ORDER BY vec_id, x LIMIT 16),
        c0 AS MATERIALIZED (SELECT part, entry, x FROM f JOIN q USING (n)),
        {listed},
        s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM c{rounds}),
        r AS (SELECT n, string_agg(format('{{:02x}}', m.c), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY n)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM r JOIN e USING (n) CROSS JOIN s"""


QUERIES = {f.__name__: f for f in (op1_topk, op2_pack, op3_extract, op4_langid, op5_secrets, op6_bpe, op7_hpy, op8_jaccard, op9_exact_dedup, op10_licenses, op11_clusters, op12_codes, op13_neighbours)}

# Queries whose rows SQL can express.
ORACLE_SQL = {
    "op1_topk": """
        WITH e AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
        s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.n <> c.n AND len(q.x) = len(c.x))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op10_licenses": oracle(),
    "op11_clusters": clusters_sql(),
    "op12_codes": codes_sql(),
    "op9_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY x)""",
}
