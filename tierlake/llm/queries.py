"""The registered queries of the text operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import crosstok, decontam, fim, fingerprints, licenses, linededup, mixing, pieces, pii, quality, simhash, toxicity, warc
from tierlake.llm.base import scratch

#: Vocabulary files of public tokenizers; not part of the repository.
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = pieces.encode(docs, PIECE_MODEL, n_best=4)
    return found.select("doc_id", "n_pieces", "score", "ids", "alternatives", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write(_read(spark, sf_dir, "pages"), folder, shard_bytes=16 << 20, roll_bytes=4 << 20)
    found = warc.read(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    weight, noise, least = quality.resample(docs, _read(spark, sf_dir, "labels"))
    return docs.select("doc_id", weight.alias("log_weight"), noise.alias("noise")) \
        .withColumn("selected", F.col("log_weight") + F.col("noise") >= F.lit(least))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), threshold=0.7)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(_read(spark, sf_dir, "documents"), words=5, k=128, shard_bytes=16 << 20)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no paths; source, language and id make one
    path = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return licenses.scan(_read(spark, sf_dir, "documents"), path)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.report(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii.replaced(docs.select("doc_id", "text"), secret="surrogates-1", number_col="n_replaced")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "overlap")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transform(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fim.restored("output", "form"), 256).alias("restored_sha256"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2)
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align(_read(spark, sf_dir, "documents"), BYTE_MODEL, PIECE_MODEL)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprints": op5_fingerprints,
    "op6_licenses": op6_licenses,
    "op7_line_dedup": op7_line_dedup,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_fim": op11_fim,
    "op12_mixing": op12_mixing,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op6_licenses": licenses.ORACLE,
    "op11_fim": fim.ORACLE,
    "op7_line_dedup": f"SELECT doc_id, n_lines, len(removed_lines)::INT AS n_removed, array_to_string(removed_lines, ',') AS removed_lines FROM ({linededup.ORACLE})",
}
