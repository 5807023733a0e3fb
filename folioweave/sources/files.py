"""Files in and out (S1-S18): papers, records, paper trees, JSON lines, resumable and idempotent writes."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions import vocab
from folioweave.operators.blocks import explode_records, to_markdown

STAGE_FILES = ("01_census", "02_metadata", "03_citations", "03_reference_metadata", "03_references", "04_relations", "06_extraction", "07_validation", "status")


def _stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)


def scan_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(paper_id, content) of the ``*.md`` files of one folder, not of its subfolders."""
    return spark.read.text(f"{folder}/*.md", wholetext=True).select(_stem().alias("paper_id"), F.col("value").alias("content"))


def scan_json(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(doc, payload) of JSON files, one record each."""
    r = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", str(recursive).lower())
    return r.text(path, wholetext=True).select(_stem().alias("doc"), F.col("value").alias("payload"))


def scan_jsonl(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(doc, line_no, payload) of JSON-lines files; a bad line fails the job, or is dropped if not ``strict``.

    Files are read line by line and split, however large. A line's number is its place in its block of the file and the
    number of lines in the blocks before it: rows get ids that rise within a block, and one row per block tells where it begins.
    """
    r = spark.read.option("pathGlobFilter", "*.{jsonl,ndjson}").option("lineSep", "\n").text(path)
    place = ["path", "block"]
    rows = r.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), _stem().alias("file"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("payload"))
    sizes = rows.groupBy(*place).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(sizes.select(*place, "first", before.alias("before")), place).where("trim(payload) <> ''")
    rows = rows.withColumn("line_no", (F.col("before") + F.col("id") - F.col("first") + 1).cast("int"))
    lines = rows.select(F.concat_ws(":", "file", "line_no").alias("doc"), "line_no", F.regexp_replace("payload", r"\r$", "").alias("payload"))
    if not strict:
        return lines.where(F.try_parse_json("payload").isNotNull())
    bad = F.raise_error(F.concat(F.lit("not JSON: "), F.col("doc"))).cast("string")
    return lines.withColumn("payload", F.when(F.try_parse_json("payload").isNull(), bad).otherwise(F.col("payload")))


def has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether a folder of any file system that Spark reads holds such files; nothing of them is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return not found.select("path").limit(1).isEmpty()


def scan_papers(spark: SparkSession, path: str, kind: str = "auto") -> DataFrame:
    """Papers of a folder: Markdown as it is, JSON and JSON lines converted; ``auto`` prefers Markdown."""
    if kind == "auto":
        kinds = {"md": "*.md", "json": "*.json", "jsonl": "*.{jsonl,ndjson}"}
        kind = next((k for k, pattern in kinds.items() if has_files(spark, path, pattern)), "none")
    if kind == "md":
        return scan_markdown(spark, path)
    if kind not in ("json", "jsonl"):
        raise ValueError(f"no papers in {path}")
    records = scan_json(spark, path) if kind == "json" else scan_jsonl(spark, path)
    return to_markdown(explode_records(records)).select(F.col("doc").alias("paper_id"), F.col("markdown").alias("content"))


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """(paper_id, stage, payload) of the stage files below a run's folder; unreadable JSON is a null payload."""
    r = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True)
    parent = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    rows = r.select(parent.alias("paper_id"), _stem().alias("stage"), F.col("value").alias("payload")).where(F.col("stage").isin(*STAGE_FILES))
    return rows.withColumn("payload", F.when(F.try_parse_json("payload").isNotNull(), F.col("payload")))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record per line, null fields written, non-ASCII kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_json(value: object, path: str) -> None:
    """One file, written beside its place and moved there."""
    target = Path(path)
    fd, temp = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}")
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=1)
    os.replace(temp, target)


def changed_rows(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose content differs from the row of that key in ``old``, or that have none."""
    digest = lambda df: F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in keys))), 256)
    return new.withColumn("__d", digest(new)).join(old.select(*keys, digest(old).alias("__d")), [*keys, "__d"], "left_anti").drop("__d")


def unfinished(papers: DataFrame, status: DataFrame, limit: int | None = None, force: bool = False) -> DataFrame:
    """Papers without a completed status; the limit is the batch size asked for, taken before the filter."""
    p = papers if limit is None else papers.orderBy("paper_id").limit(limit)
    return p if force else p.join(status.where("status = 'completed'").select("paper_id").dropDuplicates(), "paper_id", "left_anti")


def manifest(tables: dict[str, DataFrame], version: str, descriptions: dict[str, str] | None = None) -> dict:
    """The data dictionary of a run: its tables with their columns, types and descriptions, the files of a paper, and the
    closed vocabularies of sections, unit types, kinds and relations."""
    said = descriptions or {}
    made = {name: {"description": said.get(name, ""), "columns": [{"name": c, "type": t, "description": said.get(f"{name}.{c}", "")} for c, t in df.dtypes]} for name, df in tables.items()}
    return {
        "ir_version": version,
        "accepted_versions": list(vocab.ACCEPTED_VERSIONS),
        "tables": made,
        "stage_files": list(STAGE_FILES),
        "sections": {k: {"unit_types": list(v), "preferred_anchor": vocab.PREFERRED_ANCHOR[k]} for k, v in vocab.SECTION_UNIT_TYPES.items()},
        "units": {t: {"id_prefix": vocab.ID_PREFIX.get(t, "doc"), "fields": list(keys), "kinds": list(vocab.KINDS_BY_TYPE.get(t, ()))} for t, keys in vocab.UNIT_KEYS.items()},
        "relations": {r: {"sources": list(a), "targets": list(b)} for r, (a, b) in vocab.RELATION_MATRIX.items()},
    }


def progress(papers: DataFrame, status: DataFrame, seconds: float) -> DataFrame:
    """Total, completed and failed papers, papers a minute and the minutes left at that pace (null before the first)."""
    j = papers.select("paper_id").dropDuplicates().join(status.groupBy("paper_id").agg(F.max("status").alias("status")), "paper_id", "left")
    g = j.agg(F.count(F.lit(1)).alias("n_papers"), F.count_if(F.col("status") == "completed").alias("n_completed"), F.count_if(F.col("status") == "failed").alias("n_failed"))
    done = F.col("n_completed") + F.col("n_failed")
    pace = done * 60.0 / seconds
    return g.select("*", pace.alias("papers_per_minute"), F.when(done > 0, (F.col("n_papers") - done) / pace).alias("minutes_left"))


def run_summary(status: DataFrame) -> DataFrame:
    """Papers by status."""
    return status.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n_papers"))
