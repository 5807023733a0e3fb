"""Samples, comparisons of runs and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions.scalar import title_prefixes

HEAD_CHARS = 3_000


def faithfulness(title: Column, text: Column) -> Column:
    """The share of the title's word prefixes found in the first line or in the beginning of the text."""
    want = title_prefixes(title)
    cover = lambda part: F.size(F.array_intersect(want, title_prefixes(part))) / F.size(want)
    head = F.regexp_extract(text, r"\A([^\n]*)", 1)
    return F.when(F.size(want) > 0, F.greatest(cover(head), cover(F.left(text, F.lit(HEAD_CHARS))))).otherwise(F.lit(0.0))


def coherent(text: Column) -> Column:
    """A heading for abstract or introduction and one for references."""
    opening = text.rlike(r"(?im)^(?:#{1,6} *|\*\*)?[0-9. ]*(?:abstract|introduction)\b")
    return F.coalesce(opening & text.rlike(r"(?im)^(?:#{1,6} *|\*\*)?[0-9. ]*(?:references|bibliography)\b"), F.lit(False))


def usable(docs: DataFrame, min_chars: int = 6_000, denied: str = r"(?i)\b(?:erratum|retract|poster)\b") -> DataFrame:
    """Long enough texts whose name shows no artefact."""
    return docs.where((F.length("text") >= min_chars) & ~F.coalesce(F.col("title").rlike(denied), F.lit(False)))


def stratified(papers: DataFrame, quota: int, tail_quota: int, tail_before: int, seed: int = 20260618, key: str = "paper_id", total: int | None = None) -> DataFrame:
    """Up to ``quota`` papers per venue, at most ``tail_quota`` of them older, in the order of a seeded hash; where these are
    fewer than ``total``, the next papers of any venue in that order are taken, newer ones first.

    Deterministic for a seed, whatever the partitions. Picks differ from other generators'. The draw is a top-k per
    venue, taken in two steps so that no venue is sorted in one task: first per hash bin, then over what is left.
    """
    p = papers.withColumn("tail", F.coalesce(F.col("year") < tail_before, F.lit(True))).withColumn("h", F.xxhash64(F.lit(seed), key))
    limit = F.when(F.col("tail"), F.least(F.lit(tail_quota), F.lit(quota))).otherwise(quota)
    order = [F.col("h"), F.col(key)]
    binned = p.withColumn("bin", F.pmod("h", F.lit(64)))
    first = binned.withColumn("rn", F.row_number().over(Window.partitionBy("venue", "tail", "bin").orderBy(*order))).where(F.col("rn") <= limit)
    part = first.withColumn("rn", F.row_number().over(Window.partitionBy("venue", "tail").orderBy(*order))).where(F.col("rn") <= limit)
    picked = part.withColumn("rn", F.row_number().over(Window.partitionBy("venue").orderBy("tail", *order))).where(F.col("rn") <= quota)
    if total is not None and (short := total - picked.count()) > 0:
        rest = p.join(picked.select(key), key, "left_anti").orderBy("tail", *order).limit(short)
        return picked.select(*papers.columns, "tail").unionByName(rest.select(*papers.columns, "tail"))
    return picked.drop("rn", "bin", "h")


def sample_report(sample: DataFrame) -> DataFrame:
    """Papers and older papers per venue."""
    return sample.groupBy("venue").agg(F.count(F.lit(1)).alias("n"), F.count_if("tail").alias("n_tail"), F.min("year").alias("first_year"))


def year_histogram(sample: DataFrame) -> DataFrame:
    """Papers by year; null is its own bar."""
    return sample.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def fuzzy_tagged(ids: DataFrame, keys: DataFrame, least: int = 3) -> DataFrame:
    """Ids that equal a key or hold it, or that a key holds, either at least ``least`` characters long. ``keys`` is a baseline
    of at most 10,000 names, checked, so that every id is compared with all of them where it lies."""
    known = [r[0] for r in keys.where("key is not null").select("key").distinct().limit(10_001).collect()]
    if len(known) > 10_000:
        raise ValueError("more than 10,000 keys")
    listed = F.array(*map(F.lit, sorted(known))).cast("array<string>")
    hit = lambda k: (F.col("id") == k) | ((F.length(k) >= least) & F.col("id").contains(k)) | ((F.length("id") >= least) & k.contains(F.col("id")))
    return ids.withColumn("tagged", F.coalesce(F.exists(listed, hit), F.lit(False)))


def run_difference(before: DataFrame, after: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Differences of metrics of the papers in both runs."""
    b = before.select(*keys, *(F.col(m).alias(f"b_{m}") for m in metrics))
    return after.join(b, keys).select(*keys, *((F.col(m) - F.col(f"b_{m}")).alias(f"d_{m}") for m in metrics))


def validity_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Papers that became valid or invalid, (paper_id, change)."""
    j = before.select("paper_id", F.col("valid").alias("b")).join(after.select("paper_id", F.col("valid").alias("a")), "paper_id")
    return j.where("a <> b").select("paper_id", F.when(F.col("a"), "newly_valid").otherwise("newly_invalid").alias("change"))


def kept_defects(claims: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Claims that no verdict refutes, with the corrected attribution where there is one."""
    j = claims.join(verdicts, ["paper_id", "idx"], "left")
    attribution = F.coalesce(F.nullif(F.col("corrected"), F.lit("")), F.col("attribution"))
    return j.where(F.coalesce("verdict", F.lit("confirmed")) != "refuted").select(*claims.columns[:-1], attribution.alias("attribution"))


def tally(defects: DataFrame, dims: list[str]) -> DataFrame:
    """Counts by every combination of the dimensions, by CUBE; null is 'all'."""
    g = defects.cube(*dims).agg(F.count(F.lit(1)).alias("n"), *(F.grouping(d).alias(f"g_{d}") for d in dims))
    return g.select(*(F.when(F.col(f"g_{d}") == 1, "all").otherwise(F.coalesce(d, F.lit("none"))).alias(d) for d in dims), "n")


def outcome_tally(checks: DataFrame, outcomes: tuple[str, ...] = ("fixed", "partial", "still", "n-a", "regression")) -> DataFrame:
    """Checks by outcome, one column each."""
    return checks.agg(*(F.count_if(F.col("outcome") == o).alias(o.replace("-", "_")) for o in outcomes))


def match_prefix(ids: DataFrame, names: DataFrame, width: int) -> DataFrame:
    """Truncated ids to full names: exact first, else the first name with that prefix.

    ``ids`` holds ids of at least ``width`` characters; names are keyed by their first ``width`` characters, so the
    prefix match is an equi-join with a check instead of a nested loop.
    """
    n = names.select("name", F.left("name", F.lit(width)).alias("k"))
    j = ids.select("id", F.left("id", F.lit(width)).alias("k")).join(n, "k").where(F.col("name").startswith(F.col("id")))
    return j.groupBy("id").agg(F.min_by("name", F.struct(F.col("name") != F.col("id"), "name")).alias("name"))
