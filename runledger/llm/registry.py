"""The subpackage's queries and their SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from runledger.llm.ann import search as nearest
from runledger.llm.bpe import digests
from runledger.llm.codes import encode
from runledger.llm.fingerprint import compare_with_next
from runledger.llm.kd_shards import shard_by_bytes
from runledger.llm.language import predict
from runledger.llm.lexical import search
from runledger.llm.licenses import find_licenses
from runledger.llm.lm import score
from runledger.llm.neardup import near_duplicates
from runledger.llm.packing import pack
from runledger.llm.quality import classify
from runledger.llm.shared import documents
from runledger.llm.topk import top_k


def op2_topk(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(~bad).withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("double")))
    return top_k(whole, F.col("vec_id") % 50 == 0)


def op7_shards(spark, sf_dir):
    return shard_by_bytes(documents(spark, sf_dir))


def op4_bpe(spark, sf_dir):
    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_language(spark, sf_dir):
    return predict(documents(spark, sf_dir))


def op3_quality(spark, sf_dir):
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op1_neardup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op5_fingerprints(spark, sf_dir):
    return compare_with_next(documents(spark, sf_dir))


def op8_licenses(spark, sf_dir):
    return find_licenses(documents(spark, sf_dir))


def op9_lm(spark, sf_dir):
    return score(documents(spark, sf_dir))


def op11_lexical(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_neighbours(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("v"))
    return nearest(rows, F.col("vec_id") % 20 == 0)


def op13_codes(spark, sf_dir):
    return encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("v"), "label"))


QUERIES = {"op11_lexical": op11_lexical, "op12_neighbours": op12_neighbours, "op13_codes": op13_codes, "op8_licenses": op8_licenses, "op5_fingerprints": op5_fingerprints, "op9_lm": op9_lm, "op1_neardup": op1_neardup, "op3_quality": op3_quality, "op6_packing": op6_packing, "op10_language": op10_language, "op4_bpe": op4_bpe, "op2_topk": op2_topk, "op7_shards": op7_shards}
ROUND = """b{k} AS MATERIALIZED (SELECT b.part, b.entry, CASE WHEN any_value(m.c) IS NULL THEN any_value(b.c) ELSE any_value(m.c) END AS c FROM b{j} b
 LEFT JOIN (SELECT part, entry, list(f ORDER BY position) AS c FROM (SELECT a.part, a.entry, u.position, CAST(floor(sum(a.c[u.position]) / count(*)) AS BIGINT) AS f
  FROM (SELECT p.vec_id, p.part, arg_min(b.entry, list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + b.entry) AS entry, any_value(p.c) AS c
   FROM parts p JOIN b{j} b ON p.part = b.part GROUP BY p.vec_id, p.part) a, (SELECT unnest(range(1, 17)) AS position) u GROUP BY a.part, a.entry, u.position) GROUP BY part, entry) m
 ON b.part = m.part AND b.entry = m.entry GROUP BY b.part, b.entry)"""
SQL = {
    "op11_lexical": r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
r AS (SELECT q.item_id, p.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + (90 * p.n * s.n) // s.l)))) AS BIGINT) AS score
 FROM q JOIN p ON q.term = p.term JOIN w ON q.term = w.term, s GROUP BY q.item_id, p.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10""",
    "op13_codes": f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, part, c[part * 16 + 1 : part * 16 + 16] AS c FROM k, (SELECT unnest(range(0, 4)) AS part)),
b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, c FROM parts QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256),
{", ".join(ROUND.format(k=k, j=k - 1) for k in range(1, 5))},
f AS (SELECT p.vec_id, any_value(p.label) AS label, p.part, min(list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + b.entry) AS x FROM parts p JOIN b4 b ON p.part = b.part GROUP BY p.vec_id, p.part),
o AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', CAST(x % 256 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(x // 256) AS BIGINT) AS error FROM f GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b4) AS codebooks_sha256 FROM o""",
    "op2_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
}
