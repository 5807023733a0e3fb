"""Citations, bibliography metadata and their links to units.

Tables: citations(paper_id, cite_key, role, signal, ord), metadata(paper_id, cite_key, title,
authors, venue, year, ord), units(paper_id, id, type, name, cite_keys, ord).

Defined results: blank cite keys never merge (each row is a work of its own); roles outside the
vocabulary given are dropped and works without any role left out; null signals count as blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.functions.scalar import (
    CODE_HOSTS, DATA_HOSTS, dirname_venue, dirname_year, is_release_host, normalize_cite_key, normalize_name, strip, truthy, url_host,
)

ROLE_PRECEDENCE = ("builds_on", "uses", "compares_to")


def merged_citations(citations: DataFrame, roles: tuple[str, ...]) -> DataFrame:
    """A2: one row per work: its roles in order of first appearance and the last filled signal of each role."""
    c = citations.where(F.col("role").isin(*roles)).withColumn("key", strip(F.coalesce("cite_key", F.lit(""))))
    c = c.withColumn("work", F.when(F.col("key") != "", F.concat(F.lit("key:"), "key")).otherwise(F.concat(F.lit("row:"), F.col("ord").cast("string"))))
    signal = F.max_by("signal", F.when(truthy(strip(F.col("signal"))), F.col("ord")))
    per_role = c.groupBy("paper_id", "work", "key", "role").agg(F.min("ord").alias("first"), F.coalesce(signal, F.lit("")).alias("signal"))
    ordered = F.array_sort(F.collect_list(F.struct("first", "role", "signal")))
    g = per_role.groupBy("paper_id", "work", "key").agg(ordered.alias("r"))
    return g.select(
        "paper_id", "work", F.col("key").alias("cite_key"), F.transform("r", lambda x: x["role"]).alias("roles"),
        F.map_from_arrays(F.transform("r", lambda x: x["role"]), F.transform("r", lambda x: x["signal"])).alias("signals"),
    )


def cite_keys(citations: DataFrame) -> DataFrame:
    """A3: the distinct filled cite keys of a paper with the order of their first appearance."""
    return citations.withColumn("cite_key", strip(F.col("cite_key"))).where("cite_key <> ''").groupBy("paper_id", "cite_key").agg(F.min("ord").alias("first"))


def join_metadata(works: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each work with its metadata: by the exact key, else by the normalised one; the first entry of a key counts.

    Two equi-joins and a coalesce, not one join with OR, which could only be a nested loop.
    """
    info = F.struct("title", "authors", "venue", "year")
    raw = strip(F.col("cite_key"))
    exact = metadata.where(truthy(raw)).groupBy("paper_id", raw.alias("cite_key")).agg(F.min_by(info, "ord").alias("exact"))
    norm = normalize_cite_key(F.col("cite_key"))
    loose = metadata.where(norm != "").groupBy("paper_id", norm.alias("norm")).agg(F.min_by(info, "ord").alias("loose"))
    w = works.withColumn("norm", norm).join(exact, ["paper_id", "cite_key"], "left").join(loose, ["paper_id", "norm"], "left")
    m = F.when(F.col("cite_key") != "", F.coalesce("exact", "loose"))
    return w.select(*works.columns, m["title"].alias("title"), m["authors"].alias("authors"), m["venue"].alias("venue"), m["year"].alias("year"))


def link_units(references: DataFrame, units: DataFrame) -> DataFrame:
    """(paper_id, ref_id, unit_id): by normalised cite key, else by a normalised name that one unit of the paper has."""
    by_key = units.select("paper_id", "id", F.explode("cite_keys").alias("k")).select("paper_id", "id", normalize_cite_key(F.col("k")).alias("norm")).where("norm <> ''").dropDuplicates()
    r = references.select("paper_id", "ref_id", normalize_cite_key(F.col("cite_key")).alias("norm"), normalize_name(F.col("title")).alias("name"))
    hit = r.where("norm <> ''").join(by_key, ["paper_id", "norm"]).select("paper_id", "ref_id", F.col("id").alias("unit_id")).dropDuplicates()
    names = units.select("paper_id", "id", normalize_name(F.col("name")).alias("name")).where("name <> ''").dropDuplicates()
    unique = names.groupBy("paper_id", "name").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("unit_id")).where("n = 1").drop("n")
    rest = r.join(hit.select("paper_id", "ref_id").dropDuplicates(), ["paper_id", "ref_id"], "left_anti").where("name <> ''")
    return hit.unionByName(rest.join(unique, ["paper_id", "name"]).select("paper_id", "ref_id", "unit_id")).dropDuplicates()


def unit_references(links: DataFrame) -> DataFrame:
    """The references of every unit."""
    return links.groupBy("paper_id", "unit_id").agg(F.array_sort(F.collect_set("ref_id")).alias("ref_ids"))


def reference_edges(references: DataFrame, links: DataFrame, units: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges from a paper's first Contribution to the units its references link to, for legacy versions.

    ``references``: (paper_id, ref_id, roles). The strongest role of a pair counts; a pair of the same type family
    is not compared, a unit that is a part is no target, and a pair with a dependency edge gets no second one.
    """
    root = units.where("type = 'Contribution'").groupBy("paper_id").agg(F.min_by("id", "ord").alias("source_id"))
    rank = F.array_position(F.array(*map(F.lit, ROLE_PRECEDENCE)), F.col("role"))
    r = references.select("paper_id", "ref_id", F.explode("roles").alias("role")).where(F.col("role").isin(*ROLE_PRECEDENCE))
    pairs = r.join(links, ["paper_id", "ref_id"]).join(root, "paper_id").where("unit_id <> source_id")
    best = pairs.groupBy("paper_id", "source_id", F.col("unit_id").alias("target_id")).agg(F.min_by("role", rank).alias("relation"))
    types = units.select("paper_id", F.col("id").alias("target_id"), F.col("type").alias("target_type")).dropDuplicates(["paper_id", "target_id"])
    best = best.join(types, ["paper_id", "target_id"]).where(F.col("target_type").isin("Contribution", "Component", "ExperimentSetup"))
    parts = edges.where("relation = 'part_of'").select("paper_id", F.col("source_id").alias("target_id")).dropDuplicates()
    best = best.join(parts, ["paper_id", "target_id"], "left_anti").where("not (relation = 'compares_to' and target_type = 'Contribution')")
    native = edges.where(F.col("relation").isin(*ROLE_PRECEDENCE)).select("paper_id", "source_id", "target_id").dropDuplicates()
    return best.join(native, ["paper_id", "source_id", "target_id"], "left_anti").select("paper_id", "source_id", "relation", "target_id", F.lit("reference").alias("origin"))


def enrich_metadata(papers: DataFrame, default_venue: str | None = None) -> DataFrame:
    """M2: venue and year from the paper id where missing, each with its source, and true-or-null release flags.

    ``papers``: paper_id, venue, year, resources array<struct<type, url>>; idempotent.
    """
    venue = F.nullif(F.col("venue"), F.lit(""))
    year = F.nullif(F.col("year"), F.lit(0))
    by_dir, dir_year = dirname_venue(F.col("paper_id")), dirname_year(F.col("paper_id"))
    host = lambda r: url_host(r["url"])
    any_of = lambda kinds, hosts: F.when(F.exists("resources", lambda r: r["type"].isin(*kinds) | is_release_host(host(r), hosts)), True)
    return papers.select(
        "paper_id",
        F.coalesce(venue, by_dir, F.lit(default_venue)).alias("venue"),
        F.coalesce(year, dir_year).alias("year"),
        F.when(venue.isNull() & by_dir.isNotNull(), "dirname").when(venue.isNull() & F.lit(default_venue is not None), "corpus_default").alias("venue_source"),
        F.when(year.isNull() & dir_year.isNotNull(), "dirname").alias("year_source"),
        any_of(("code",), CODE_HOSTS).alias("has_code"),
        any_of(("data", "dataset"), DATA_HOSTS).alias("has_data"),
        F.transform("resources", lambda r: F.when(truthy(strip(r["url"])) & ~r["url"].contains("://"), F.concat(F.lit("https://"), strip(r["url"]))).otherwise(r["url"])).alias("urls"),
    )
