"""The operators on the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, decontamination, digest, divergence, extraction, language, licenses, minhash, packing, quality, secrets, simhash, urls
from millrace.llm.statements import SECRET_SPANS, SOURCE_DIVERGENCE, URL_VERDICTS
from millrace.session import scratch_path


#: The rules of host, path and verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Hosts that are blocked where no rule says otherwise.
URL_BLOCK_LIST = [("cheap-pills.example.com", "", "block"), ("spam-farm.example.org", "", "block")]
VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_urls(spark: SparkSession, sf: str) -> DataFrame:
    rules, listed = (
        spark.createDataFrame(rows, "host string, path string, verdict string") for rows in (URL_RULES, URL_BLOCK_LIST)
    )
    return urls.judge(table(spark, sf, "pages"), rules, listed)


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op5_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.main_text(table(spark, sf, "pages"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY))


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # The base rules first; then the ledger leaves only the added ones to scan, and last nothing.
    ledger = scratch_path(spark)
    secrets.extend_ledger(docs, ledger, secrets.BASE)
    secrets.extend_ledger(docs, ledger)
    found, _ = secrets.paths_with_findings(docs, secrets.read_ledger(spark, ledger))

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op8_digest(spark: SparkSession, sf: str) -> DataFrame:
    return digest.fingerprints(table(spark, sf, "documents"))


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op12_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in (VOCABULARY, PIECE_MODEL))
    return alignment.align(table(spark, sf, "documents"), *paths)


QUERIES = {q.__name__: q for q in (op1_quality, op2_urls, op3_language, op4_licenses, op5_extraction, op6_packing, op7_secrets, op8_digest, op9_decontamination, op10_simhash, op11_divergence, op12_minhash, op13_alignment)}

ORACLE_SQL: dict[str, str] = {"op2_urls": URL_VERDICTS, "op7_secrets": SECRET_SPANS, "op11_divergence": SOURCE_DIVERGENCE}
