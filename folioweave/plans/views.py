"""The normalised tables of the graph layer, read from the change log, the relations and the result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.functions import ids
from folioweave.session import table

UNIT_COLUMNS = ("section", "type", "kind", "name", "description", "cite_keys")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "graph_units").withColumn("id", ids.canonical(F.col("unit_id")))


def first_loaded(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, the one loaded first; of several at one time the least by its columns in order."""
    rest = [c for c in rows.columns if c not in (key, "loaded_at")]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("loaded_at", *rest)).alias("r")).select(key, *(f"r.{c}" for c in rest))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units that exist after the last change; ``ord`` is (changed_at, id)."""
    last = F.max_by(F.struct("op", "changed_at", *UNIT_COLUMNS), F.struct("changed_at", (F.col("op") == "delete"))).alias("u")
    u = _changes(spark, sf_dir).groupBy("paper_id", "id").agg(last).where("u.op <> 'delete'")
    return u.select("paper_id", "id", *(f"u.{c}" for c in UNIT_COLUMNS), F.struct("u.changed_at", "id").alias("ord"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planned nodes: each id as its first change wrote it; Findings are never planned."""
    first = F.min_by(F.struct("changed_at", *UNIT_COLUMNS), "changed_at").alias("u")
    n = _changes(spark, sf_dir).where("op <> 'delete' and type <> 'Finding'").groupBy("paper_id", "id").agg(first)
    return n.select("paper_id", "id", *(f"u.{c}" for c in UNIT_COLUMNS), F.struct("u.changed_at", "id").alias("ord"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations with canonical endpoints, each relation_no once; ``ord`` is relation_no."""
    r = table(spark, sf_dir, "relations").select("relation_no", "paper_id", "source_id", "relation", "target_id", "provenance", "origin", "stance", "loaded_at")
    r = first_loaded(r, "relation_no")
    return r.select(
        "paper_id", ids.canonical(F.col("source_id")).alias("source_id"), "relation", ids.canonical(F.col("target_id")).alias("target_id"),
        "provenance", "origin", "stance", F.col("relation_no").alias("ord"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcribed result rows, each row_no once, with canonical ids; ``ord`` is row_no."""
    r = table(spark, sf_dir, "result_rows").where("source = 'transcribed'")
    used = ("paper_id", "measure_id", "system_id", "setup_id", "variant", "value_raw", "metric", "unit", "table_marker")
    r = first_loaded(r.select("row_no", *used, "loaded_at"), "row_no")
    c = lambda x: ids.canonical(F.col(x)).alias(x)
    return r.select(
        "paper_id", c("measure_id"), c("system_id"), c("setup_id"), "variant", F.col("value_raw").alias("value"), "metric", "unit",
        F.col("table_marker").alias("marker"), F.col("row_no").alias("ord"),
    )


def paper_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioweave.operators import text as T

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "paper_id")
    return T.blocks(docs).join(docs.select("doc_id", "paper_id").dropDuplicates(["doc_id"]), "doc_id")
