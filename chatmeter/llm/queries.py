"""The registered queries of this package, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.llm import alignment, covertree, lexical, licenses, mixing, packing, secrets, sharding, shards, simhash, tokens, topk, toxicity, wrappers
from chatmeter.llm.tables import documents
from chatmeter.session import scratch_dir

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), tokens.vocabulary_path(), capacity=4096)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scanned(docs, secrets.learn(docs), ["doc_id"])

    def number(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["kind"] != "format")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        number("format").alias("n_format"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


@query
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(documents(spark, sf_dir), ["doc_id"])
    span = F.transform("spans", lambda x: F.concat_ws(":", x["label"], x["start"], x["end"], x["edits"]))
    return found.select(
        *["doc_id", "n_words", "n_base", "first_word", "last_word"],
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join(span, ",").alias("spans"),
    )


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(documents(spark, sf_dir), number=8)
    return found.select(
        *["doc_id", "size", "text_crc32"], F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    total = docs.agg(F.sum(mixing.tokens_by_bytes(F.col("text")))).first()[0]
    return mixing.counted(docs, mixing.Target(entropy=0.97, budget=total or 0))


SQL["op2_source_mixing"] = """
WITH docs AS (
  SELECT doc_id, source, (strlen(text) + 3) // 4 AS tokens,
    CAST('0x' || substr(md5('mix:' || doc_id), 1, 8) AS BIGINT) % 1024 AS block FROM documents),
blocks AS (SELECT source, block, sum(tokens) AS n FROM docs GROUP BY ALL),
sources AS (SELECT source, sum(n) AS s, sum(n) / sum(sum(n)) OVER () AS p, sum(sum(n)) OVER () AS total FROM blocks GROUP BY source),
sums AS (
  SELECT k, sum(pow(p, k / 65536)) AS z, sum(pow(p, k / 65536) * ln(p)) AS zl, count(*) AS number
  FROM sources, range(65537) AS g(k) GROUP BY k),
chosen AS (SELECT max_by(z, k) AS z, max(k) AS k FROM sums WHERE ln(z) - k / 65536 * zl / z >= 0.97 * ln(number)),
wanted AS (
  SELECT source, s, round(pow(p, k / 65536) / z * total / s, 9) AS passes FROM sources, chosen),
turns AS (
  SELECT source, block, n, s, passes, epoch, sum(n) OVER (PARTITION BY source, epoch
    ORDER BY CAST('0x' || substr(md5('mix:' || epoch || ':=' || source || ':' || block), 1, 8) AS BIGINT), block) - n AS before
  FROM (SELECT *, unnest(range(CAST(floor(passes) AS BIGINT) + 1)) AS epoch FROM blocks JOIN wanted USING (source))),
kept AS (
  SELECT source, block, count(*) AS copies FROM turns
  WHERE epoch < floor(passes) OR (floor((passes - floor(passes)) * s) > 0 AND 2 * before + n <= 2 * floor((passes - floor(passes)) * s))
  GROUP BY ALL)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS tokens, block, coalesce(copies, 0) AS copies
FROM docs LEFT JOIN kept USING (source, block)
"""


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


SQL["op6_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL),
usable AS (SELECT vec_id, v FROM vectors WHERE isfinite(list_sum(list_transform(v, lambda x: x * x))) AND list_sum(list_transform(v, lambda x: x * x)) > 0
  AND len(list_filter(v, lambda x: x IS NULL)) = 0),
links AS (SELECT a.vec_id AS one, b.vec_id AS other FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT vec_id AS one, vec_id AS other FROM vectors UNION SELECT r.one, l.other FROM reached r JOIN links l ON l.one = r.other),
numbers AS (SELECT one, count(*) AS n FROM links GROUP BY one),
roots AS (SELECT one, min(other) AS root FROM reached GROUP BY one)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, root AS component_id, vec_id = root AS kept
FROM vectors JOIN roots ON vec_id = roots.one LEFT JOIN numbers ON vec_id = numbers.one
"""


@query
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


SQL["op9_exact_topk"] = """
WITH pairs AS (
  SELECT q.vec_id, r.vec_id AS neighbor_id, CAST(list_sum(list_transform(range(1, 65),
    lambda i: CASE WHEN (q.embedding[i] > 0) <> (r.embedding[i] > 0) THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM embeddings q, embeddings r WHERE q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id)
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance
FROM pairs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) <= 10
"""


@query
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-shards")
    if not shards.write(documents(spark, sf_dir), path, tokens.vocabulary_path(), length=1024, seed=42):
        return spark.createDataFrame([], "slot long, shard long, byte_offset long, n_ids int, ids_crc32 long")
    return shards.digests(shards.read(spark, path, length=1024))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = tokens.vocabulary_path("byte_bpe_50k.json"), tokens.vocabulary_path("piece_bpe_32k.model")
    return alignment.cross_aligned(documents(spark, sf_dir), path_a, path_b)


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


_FOLDED = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL["op12_lexical_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, {_FOLDED} AS terms FROM documents),
items AS (SELECT DISTINCT item_id, text, unnest({_FOLDED}) AS term FROM benchmark),
sizes AS (SELECT place, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS number, CAST(sum(n) AS BIGINT) AS length FROM sizes),
counts AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(number) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, total GROUP BY term),
scores AS (
  SELECT item_id, text, doc_id, place,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * number) // length)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (place), total GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM places WHERE rank <= 50
"""


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
