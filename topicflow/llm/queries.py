"""The registered queries of the numbered operators, with their contracts' digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from topicflow.llm import decontaminate as decon
from topicflow.llm import (
    embedding_dedup, license_scan, line_dedup, packing, periodic_runs, quality_rules, secret_scan, sharding, simhash,
    token_store, toxicity, vector_codes,
)
from topicflow.llm.common import table
from topicflow.session import scratch_dir


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to shards of at most 16 MiB of text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    found = sharding.assign_shards(docs, "doc_id", F.col("size"), sharding.LIMIT)
    return found.select("doc_id", "shard", "n_bytes", "shard_bytes")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints of 3-word shingles differ in at most 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of at least 0.93."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents, by diagonal voting."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.phrase)
    starts = F.transform(base, lambda s: s.first)

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in a window of ten benchmark words, by suffix arrays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decon.find_matches(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.array_compact("found.items"))
    hits = F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, h: n + h.end - h.first)
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), hits.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents; a document is a repository, its source the owner."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    def judged(verdict: str):
        return F.size(F.filter("spans", lambda s: (s.kind < 3) & (s.verdict == verdict))).cast("long")

    base = F.filter("spans", lambda s: s.kind < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
        count(3).alias("n_owned"), count(4).alias("n_spread"), "n_examples",
        *[judged(v).alias(f"base_{v}") for v in (secret_scan.OWNED, secret_scan.SPREAD, secret_scan.EXAMPLE)])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of repeated three-line windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=("n_lines", "n_removed"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written as Huffman blocks and read back."""
    path = scratch_dir(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2,
                      special_tokens=True)
    return token_store.read(spark, path, with_ids=False).withColumnRenamed("doc", "doc_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of all documents, by rules learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_rules.score(docs, model)
    return scored.select("doc_id", quality_rules.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= quality_rules.THRESHOLD).cast("int").alias("predicted"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2048, best fit decreasing."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), special_tokens=True))


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Documents of which each tenth (by a checksum of its id) repeats some of its words to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumns({"checksum": checksum, "words": F.when(
        checksum % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))})
    docs = docs.withColumns({"n": F.expr("nullif(size(words), 0)"), "g": F.expr("checksum div 10")})
    docs = docs.withColumn("a", F.expr("cast(g % n as int)")).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("flatten(array_repeat(slice(words, a + 1, p), cast((n - a) div p + 1 as int)))")
    rest = F.slice(again, F.lit(1), F.expr("n - a"))
    new = F.array_join(F.concat(F.expr("slice(words, 1, a)"), rest), " ")
    return docs.select("doc_id", F.coalesce(F.when(F.col("n").isNotNull(), new), "text").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least four periods in all documents, and the texts without what they repeat."""
    docs = _with_repeated_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs.select("doc_id", "text"))

    def stronger(x, y):
        left, right = x.length * y.period, y.length * x.period
        return F.when(left != right, F.sign(right - left)).when(x.start != y.start, F.sign(x.start - y.start)) \
            .otherwise(F.sign(x.period - y.period)).cast("int")

    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of all documents, by a network learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as four bytes each, with what the codebooks lose."""
    coded, book = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.sha2(F.lit(vector_codes.listed(book)), 256).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_line_dedup": op2_line_dedup,
        "op3_token_store": op3_token_store,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_sharding": op6_sharding,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_benchmark_decontamination": op10_benchmark_decontamination,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_toxicity": op12_toxicity,
        "op13_vector_codes": op13_vector_codes,
    }
