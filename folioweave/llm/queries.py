"""Queries of the text and matching problems and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioweave.llm import matching, mixing, quality, tokens
from folioweave.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(table(spark, sf_dir, "cited_refs"), table(spark, sf_dir, "paper_catalog")).select("cat_no", "ref_no")


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match with its rule, the evidence, the rule's labels and its confidence."""
    sides = table(spark, sf_dir, "cited_refs"), table(spark, sf_dir, "paper_catalog")
    return matching.with_confidence(*matching.cascade(*sides, trace=True), *sides)


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_table(table(spark, sf_dir, "documents"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of every mix with their number of copies."""
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_goals"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share that each source reaches in every mix, beside its target."""
    return mixing.shares(*mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_goals")))


def p7_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of the mixes whose token shares are exponentiated to the entropy of their targets."""
    return mixing.shares(*mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_goals"), rule="temperature"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(*(table(spark, sf_dir, t) for t in ("documents", "common_words", "form_labels")))


def p8_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its statistics, their percentiles and robust z-scores, and the tails it lies in."""
    stats = quality.document_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))
    return quality.flagged(quality.scored(stats, table(spark, sf_dir, "form_labels")))


def p8_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the labelled documents that were held out of the fit."""
    stats = quality.document_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))
    return quality.held_out(stats, table(spark, sf_dir, "form_labels"))


QUERIES = {
    "p3_found": p3_found,
    "p3_matches": p3_matches,
    "p6_ids": p6_ids,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_temperature": p7_temperature,
    "p8_found": p8_found,
    "p8_held_out": p8_held_out,
    "p8_stats": p8_stats,
}

ORACLE: dict[str, str] = {}
