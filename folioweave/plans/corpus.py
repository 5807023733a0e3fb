"""The corpus tables: catalog, cards, result rows and cited works, and their counts (K, A1, A4, A12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions import scalar as S
from folioweave.functions import vocab


def ordered_names(units: DataFrame, condition: Column, name: str) -> DataFrame:
    """A1: the distinct names of some units of a paper in order of first appearance, as an array column ``name``."""
    first = units.where(condition & S.truthy(F.col("name"))).groupBy("paper_id", F.col("name").alias("x")).agg(F.min("ord").alias("o"))
    return first.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "x"))), lambda s: s["x"]).alias(name))


def catalog(papers: DataFrame, units: DataFrame, edges: DataFrame) -> DataFrame:
    """K1: one row per paper: its own columns, names by kind, the problem, counts and aliases."""
    is_data = (F.col("type") == "ExperimentSetup") & F.col("kind").isin("dataset", "benchmark")
    out = papers
    for name, condition in (("datasets", is_data), ("metrics", F.col("type") == "Measure"), ("contribution_names", F.col("type") == "Contribution")):
        out = out.join(ordered_names(units, condition, name), "paper_id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    problem = units.where("type = 'Problem'").groupBy("paper_id").agg(F.min_by("description", "ord").alias("problem_description"))
    n_units, n_edges = units.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_units")), edges.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_relations"))
    for extra in (problem, n_units, n_edges):
        out = out.join(extra, "paper_id", "left")
    aliases = F.array_sort(F.array_distinct(F.flatten(F.transform("contribution_names", S.derive_aliases))))
    return out.fillna(0, ["n_units", "n_relations"]).withColumn("contribution_aliases", aliases)


def cards(units: DataFrame, nodes: DataFrame, papers: DataFrame) -> DataFrame:
    """K2: one row per unit with the text that is searched; name and kind fall back to the planned node."""
    n = nodes.groupBy("paper_id", "id").agg(F.max_by(F.struct("name", "kind", "description", "cite_keys"), "ord").alias("n"))
    u = units.join(n, ["paper_id", "id"], "left").join(papers.select("paper_id", F.col("title").alias("paper_title")), "paper_id", "left")
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("n.name"), F.lit("")), F.col("id"))
    kind = F.coalesce(F.nullif(F.col("kind"), F.lit("")), F.col("n.kind"))
    none = F.lit(None).cast("string")
    text = S.card_text(F.col("type"), F.col("description"), F.col("description"), none, F.col("description"), none, F.col("n.description"))
    u = u.withColumns({"__name": name, "__kind": kind}).withColumn("text", text)
    return u.select(
        "paper_id", "paper_title", F.col("id").alias("unit_id"), "section", "type", F.col("__kind").alias("kind"), F.col("__name").alias("name"), "text",
        F.col("n.description").alias("description"), S.derive_aliases(F.col("__name")).alias("aliases"),
        F.when(S.truthy(F.col("cite_keys"), "array"), F.col("cite_keys")).otherwise(F.coalesce("n.cite_keys", F.array().cast("array<string>"))).alias("cite_keys"),
        S.embed_text(F.col("paper_title"), F.col("paper_id"), F.col("type"), F.col("__kind"), F.col("__name"), F.col("text")).alias("embed_text"),
    )


def result_rows(scores: DataFrame, units: DataFrame) -> DataFrame:
    """Every score with the names of its system and setup; a dataset only where the setup is one."""
    u = units.groupBy("paper_id", "id").agg(F.max_by(F.struct("type", "kind", "name"), "ord").alias("u"))
    sys_ = u.select("paper_id", F.col("id").alias("system_id"), F.col("u").alias("sys"))
    set_ = u.select("paper_id", F.col("id").alias("setup_id"), F.col("u").alias("stp"))
    j = scores.join(sys_, ["paper_id", "system_id"], "left").join(set_, ["paper_id", "setup_id"], "left")
    dataset = F.when(F.col("stp.kind").isin("dataset", "benchmark"), F.col("stp.name"))
    return j.select(
        "paper_id", "measure_id", "metric", S.normalize_name(F.col("metric")).alias("metric_norm"), dataset.alias("dataset"),
        F.when(S.truthy(dataset), S.normalize_name(dataset)).alias("dataset_norm"), F.col("stp.name").alias("setup"), F.nullif(F.col("setup_id"), F.lit("")).alias("setup_id"),
        F.coalesce(F.nullif(F.col("sys.name"), F.lit("")), F.col("variant")).alias("system"), F.nullif(F.col("system_id"), F.lit("")).alias("system_id"),
        F.col("sys.type").alias("system_role"), F.coalesce(F.col("sys.type") == "Contribution", F.lit(False)).alias("is_paper_contribution"),
        "variant", F.col("value").alias("value_raw"), S.parse_value_num(F.col("value")).alias("value_num"), "ord",
    )


def entities(references: DataFrame) -> DataFrame:
    """Cited works clustered by normalised title; references: paper_id, ref_id, title, year, venue, ord.

    A work may be cited by a third of all papers: titles and counts are aggregated, the papers stay rows of the
    reference table (``members``) and are never gathered in one array.
    """
    r = references.withColumn("canonical_key", S.normalize_name(F.col("title"))).where("canonical_key <> ''")
    return r.groupBy("canonical_key").agg(
        F.min_by("title", "ord").alias("title"), F.min_by("year", "ord").alias("year"), F.min_by("venue", "ord").alias("venue"),
        F.count(F.lit(1)).alias("n_references"), F.countDistinct("paper_id").alias("n_papers"), F.countDistinct("title").alias("n_titles"),
    )


def members(references: DataFrame) -> DataFrame:
    """The reference rows of the works of ``entities``."""
    return references.withColumn("canonical_key", S.normalize_name(F.col("title"))).where("canonical_key <> ''")


def skipped_references(references: DataFrame) -> DataFrame:
    """K3: how many references have no title to cluster by."""
    return references.agg(F.count_if(S.normalize_name(F.col("title")) == "").alias("n_skipped"), F.count(F.lit(1)).alias("n"))


def type_counts(units: DataFrame) -> DataFrame:
    """A4: units of every type per paper, one column each."""
    return units.groupBy("paper_id").pivot("type", sorted(vocab.ID_PREFIX)).count().fillna(0)


def relation_means(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """A4: edges of every relation and their mean per paper."""
    n_papers = papers.select(F.countDistinct("paper_id")).head()[0]
    g = edges.groupBy("relation").agg(F.count(F.lit(1)).alias("n_edges"))
    return g.select("relation", "n_edges", (F.col("n_edges") / n_papers).alias("per_paper"))


def version_census(versions: DataFrame) -> DataFrame:
    """Documents per version; the corpus is uniform, mixed or unknown."""
    g = versions.groupBy(F.coalesce("ir_version", F.lit("unknown")).alias("version")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(1))  # one row per version
    alone = F.count(F.lit(1)).over(everything) == 1
    state = F.when(alone & (F.col("version") == "unknown"), "unknown").when(alone, "uniform").otherwise("mixed")
    return g.withColumn("state", state)
