"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    bpe, byte_bpe, langid, license_digest, line_runs, partenum, periodic_runs, pitman_yor, ranked_search, rule_ledger,
    secret_scan, spaced_seed, url_rules,
)
from stratum.llm.common import reach_workers, table
from stratum.session import scratch

#: Given url rules of the page filter: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return table(spark, sf_dir, "documents")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return secret_scan.scan_secrets(
        documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out("doc_id", 5))
    scored = pitman_yor.score(docs, "held_out")
    return scored.withColumn("held_out", langid.held_out("doc_id", 5))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a url's path ends in the number of the document that the page shows."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(url_rules.path_of(F.col("url")), r"/([0-9]{1,18})[^/]*/?$", 1)
    shown = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("block"))
    labelled = shown.join(labels, "doc_id").select("url", F.coalesce("block", F.lit(False)).alias("block"))
    return url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES), labelled)


def op5_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similar_groups(documents(spark, sf_dir), n=3, num=90, den=100)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = langid.held_out("doc_id", 3)
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model).withColumn("held_out", held)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan_licenses(table(spark, sf_dir, "documents"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_repeated(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule evaluated once, written, and read back for the policies."""
    path = scratch(spark, "rule-ledger")
    rule_ledger.write_ledger(rule_ledger.ledger(rule_ledger.measure(documents(spark, sf_dir))), path)
    return rule_ledger.read_ledger(spark, path)


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("fail_bits").bitwiseAND(F.lit(rule_ledger.POLICIES[1].mask)) != 0
    return rule_ledger.apply_policy(stored_ledger(spark, sf_dir), rule_ledger.POLICIES[2]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "fail_bits",
    )


def rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule fails, and what it alone rejects, under every policy."""
    book = stored_ledger(spark, sf_dir)
    parts = [
        rule_ledger.ablation(book, p).select(F.lit(p.version).alias("version"), "rule", "n_fail", "n_only")
        for p in rule_ledger.POLICIES.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def op10_spaced_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seed.find_overlaps(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.top_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=20)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The given variation of the documents: in one of ten, by the id's CRC-32, the
    words from some place on repeat with one period. A null id is in none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(documents(spark, sf_dir), prepare=planted)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_bpe, op2_secrets, op3_pitman_yor, op4_url_rules, op5_partenum, op6_langid, op7_licenses, op8_line_runs,
        op9_rule_ledger, rule_ablation, op10_spaced_seed, op11_block_max, op12_byte_bpe, op13_periodic_runs,
    )
    return {f.__name__: f for f in found}
