"""URL filter: given rules first, then rules mined by FP-growth (DataFrame and
MLlib operations only).

Given rules are (host, path, verdict). A rule fits its host and all subdomains
where the url's path starts with the rule's; the longest rule wins (of one rule
given with both verdicts, block). Host suffixes of each distinct address are joined to
the rules' hosts, so any number of rules costs one equi-join.

Addresses that no rule fits are judged by association rules. Spark's FP-growth
mines combinations of url tokens (host labels, path segments without numbers)
among labelled urls, with the label as one more item. Tokens that occur in exactly the
same labelled urls (the levels of one directory, say) are mined as one item, which loses
nothing: a combination with one of them holds wherever one with another does. An address
holds the item if it has any of its tokens. Combinations that imply
"block" with enough confidence and support are kept, unless a part of the
combination is a rule already. Each kept rule is filed under its rarest token
only (an inverted index), so a token that all urls share doesn't meet all rules;
an address that holds a filed token is compared with the whole combination.

Each distinct (host, path) is judged once and joined back to the rows, so a url
that a third of the rows repeat costs what any other does.

Defined results: a null url or one without ``://`` has an empty host and path, and
no token: allowed unless a rule with an empty host fits (none does by default);
rows that repeat an id get a row each; null ids stay; extra columns are ignored;
without labelled urls nothing is mined; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"
#: Of the labelled urls, and of those that hold the combination.
MIN_SUPPORT, MIN_CONFIDENCE = 0.001, 0.8


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rule, rule_host, rule_path, given`` from (host, path, verdict)."""
    return spark.createDataFrame([(h + p, h, p, v) for h, p, v in rules], "rule string, rule_host string, rule_path string, given string")


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, given`` of the addresses that a rule fits."""
    order = F.struct(F.length("rule").alias("n"), (-F.length("rule_host")).alias("h"), "given")
    return (
        addresses.withColumn("rule_host", F.explode(F.array_distinct(host_suffixes(F.col("host")))))
        .join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path").agg(F.max_by(F.struct("rule", "given"), order).alias("r"))
        .select("host", "path", "r.rule", "r.given")
    )


def tokens(host: Column, path: Column) -> Column:
    """Host labels and path segments of an address; numbers and file endings aside."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host="), x))
    parts = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(F.lower(x), r"\.[a-z0-9]+$", ""))
    words = F.transform(F.filter(parts, lambda x: (x != "") & ~x.rlike(r"^[0-9]+$")), lambda x: F.concat(F.lit("path="), x))
    return F.array_distinct(F.concat(labels, words))


def items_of(labelled: DataFrame) -> DataFrame:
    """``token, item``: the least of the tokens that occur in exactly the same rows.

    Rows with equal tokens are equal here; a token's rows are known by their number and
    two sums of 64-bit hashes.
    """
    hashes = [F.xxhash64(F.lit(seed), "tokens").cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)]
    each = labelled.select(F.explode("tokens").alias("token"), *hashes)
    places = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    least = places.groupBy("n", "s1", "s2").agg(F.min("token").alias("item"))
    return places.join(least, ["n", "s1", "s2"]).select("token", "item")


def in_items(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (distinct ``keys``, ``tokens``) with their ``items``; tokens in no item go."""
    return rows.withColumn("token", F.explode("tokens")).join(known, "token").groupBy(*keys).agg(F.collect_set("item").alias("items"))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """``items, confidence, support`` of the combinations that imply block, and the
    ``token, item`` table that they are spelled in.

    ``labelled`` holds ``tokens`` (an array without repeats) and ``block``, a row per url.
    """
    spark = labelled.sparkSession
    labelled = labelled.where(F.size("tokens") > 0).select(F.array_sort("tokens").alias("tokens"), "block").checkpoint()
    known = items_of(labelled).checkpoint()
    if known.isEmpty():
        return spark.createDataFrame([], "items array<string>, confidence double, support double"), known
    # urls with the same tokens and label are one row with a number until they are baskets
    alike = labelled.groupBy("tokens", "block").agg(F.count(F.lit(1)).alias("n"))
    alike = alike.withColumn("h1", F.xxhash64(F.lit(1), "tokens")).withColumn("h2", F.xxhash64(F.lit(2), "tokens"))
    baskets = in_items(alike, known, ["h1", "h2", "block", "n"]).select(
        F.when(F.col("block"), F.array_append("items", F.lit(BLOCK))).otherwise(F.col("items")).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("turn"),
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets.select("items"))
    found = (
        model.associationRules.where(F.array_contains("consequent", BLOCK))
        .select(F.array_sort("antecedent").alias("items"), "confidence", "support").checkpoint()
    )
    # a rule is redundant where a proper part of it is a rule: look its parts up by one item fewer, then fewer still
    general = found.select(F.col("items").alias("part"), F.explode("items").alias("item"))
    redundant = (
        found.select(F.col("items").alias("whole"), F.explode("items").alias("item"))
        .join(general, "item").where((F.size("part") < F.size("whole")) & (F.size(F.array_except("part", "whole")) == 0))
        .select(F.col("whole").alias("items")).distinct()
    )
    return found.join(redundant, "items", "left_anti"), known


def index(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """``item, rule, confidence``: each rule under its rarest item among the addresses."""
    df = addresses.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rare = F.min_by(F.col("item"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("item").alias("t")))
    return (
        rules.select(F.col("items").alias("rule"), F.explode("items").alias("item"), "confidence").join(df, "item", "left")
        .groupBy("rule").agg(rare.alias("item"), F.max("confidence").alias("confidence"))
    )


def matched(addresses: DataFrame, filed: DataFrame) -> DataFrame:
    """``host, path, mined, confidence``: the most confident rule each address holds."""
    best = F.struct("confidence", (-F.size("rule")).alias("n"), F.array_join("rule", " ").alias("mined"))
    return (
        addresses.withColumn("item", F.explode("items")).join(filed, "item")
        .where(F.size(F.array_except("rule", "items")) == 0)
        .groupBy("host", "path").agg(F.max(best).alias("m")).select("host", "path", "m.mined", "m.confidence")
    )


def judge(pages: DataFrame, rules: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` of every row.

    ``labels`` holds ``url`` and ``block`` (boolean): what FP-growth learns from.
    """
    rows = pages.select(pages[id_col].alias("page_id"), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"))
    addresses = rows.select("host", "path").distinct().withColumn("tokens", tokens(F.col("host"), F.col("path"))).checkpoint()
    given = ruled(addresses.select("host", "path"), rules)
    mined, known = mine(labels.select(tokens(host_of(F.col("url")), path_of(F.col("url"))).alias("tokens"), "block"))
    held = in_items(addresses, known, ["host", "path"])
    verdicts = (
        addresses.select("host", "path")
        .join(given, ["host", "path"], "left").join(matched(held, index(mined, held)), ["host", "path"], "left")
        .withColumn("verdict", F.coalesce("given", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")))
    )
    return rows.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", "verdict", F.when(F.col("rule").isNull(), F.col("mined")).alias("mined")
    )
