"""The questions a reader asks the corpus tables (Q1-Q8): facet, lookup, sweep, leaderboard, compare and join.

A question is a dict of settings; its answer is a DataFrame, and ``answers`` reports the hits of a
whole set. Needles of lookup and leaderboard are used as given, those of sweep and join are normalised.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions.scalar import normalize_name, truthy


def _has(haystack: Column, needle: str) -> Column:
    return F.coalesce(normalize_name(haystack).contains(needle), F.lit(False)) & truthy(haystack)


def _norm(text: str) -> str:
    import re

    return " ".join(re.findall(r"[a-z0-9]+", text.lower()))


def facet(catalog: DataFrame, venue: str | None = None, year_min: int | None = None, year_max: int | None = None, has_code: bool = False) -> DataFrame:
    """Q1: papers of a venue, a range of years, with code; a null year is in no range."""
    c = catalog
    if venue:
        c = c.where(normalize_name(F.col("venue")) == _norm(venue))
    if year_min:
        c = c.where(F.col("year") >= year_min)
    if year_max:
        c = c.where(F.col("year") <= year_max)
    return c.where("has_code") if has_code else c


def lookup(catalog: DataFrame, paper_substr: str) -> DataFrame:
    """Q2: papers with a central contribution whose title or id contains the needle."""
    return catalog.where((_has(F.col("title"), paper_substr) | _has(F.col("paper_id"), paper_substr)) & truthy(F.col("central_contribution")))


def sweep(cards: DataFrame, catalog: DataFrame, keywords: list[str]) -> DataFrame:
    """Q3: papers with the number of their cards that contain a keyword, and those whose surface does, with 0."""
    # One pattern of all keywords, so that a text is normalised once.
    words = "|".join(re.escape(_norm(k)) for k in keywords)
    any_of = lambda c: F.coalesce(normalize_name(c).rlike(words), F.lit(False)) if keywords else F.lit(False)
    hits = cards.where(any_of(F.col("embed_text"))).select("paper_id", F.lit(1).alias("k"))
    surface = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("title", "problem_description", "central_contribution")))
    also = catalog.where(any_of(surface)).select("paper_id", F.lit(0).alias("k"))
    return hits.unionByName(also).groupBy("paper_id").agg(F.sum("k").alias("n_cards"))


def leaderboard_rows(rows: DataFrame, dataset: str, metric: str = "") -> DataFrame:
    """Q4: numeric rows on a dataset (of lifted rows also by caption or metric) and a metric; '' is any metric."""
    blob = F.col("source") == "table_blob"
    on = _has(F.col("dataset"), dataset) | blob & (_has(F.col("table_caption"), dataset) | _has(F.col("metric"), dataset))
    r = rows.where(F.col("value_num").isNotNull() & on)
    return r.where(_has(F.col("metric"), metric) | _has(F.col("unit"), metric)) if metric else r


def leaderboard(rows: DataFrame, dataset: str, metric: str = "", direction: str = "max", tie: str = "row_no") -> DataFrame:
    """Q4: numbers of rows, systems and papers and the best row; ties go to the lowest ``tie``."""
    r = leaderboard_rows(rows, dataset, metric)
    sign = 1 if direction == "min" else -1
    best = F.min_by(F.struct("system", "value_raw", "paper_id", tie), F.struct(sign * F.col("value_num"), tie)).alias("b")
    g = r.agg(F.count(F.lit(1)).alias("n_hits"), F.countDistinct(F.nullif(F.col("system"), F.lit(""))).alias("n_systems"), F.countDistinct("paper_id").alias("n_papers"), best)
    return g.select("n_hits", "n_systems", "n_papers", "b.system", "b.value_raw", "b.paper_id")


def leaderboards(rows: DataFrame, tie: str = "row_no") -> DataFrame:
    """Q4 for every dataset and metric at once: the best row by the metric's direction."""
    r = rows.where("value_num is not null and dataset_norm <> '' and metric_norm <> ''")
    key = F.struct(F.when(F.col("direction") == "lower_is_better", F.col("value_num")).otherwise(-F.col("value_num")), tie)
    best = F.min_by(F.struct("system", "value_raw", "paper_id"), key).alias("b")
    g = r.groupBy("dataset_norm", "metric_norm").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("system").alias("n_systems"), F.countDistinct("paper_id").alias("n_papers"), best)
    return g.select("dataset_norm", "metric_norm", "n_rows", "n_systems", "n_papers", F.col("b.system").alias("best_system"), F.col("b.value_raw").alias("best_value"), F.col("b.paper_id").alias("best_paper"))


def compare(rows: DataFrame, top: int | None = 5) -> DataFrame:
    """Q5: (dataset, metric) cells that several papers report; ``top`` is the length of the report."""
    r = rows.where("value_num is not null and source = 'transcribed' and dataset_norm <> '' and metric_norm <> ''")
    g = r.groupBy("dataset_norm", "metric_norm").agg(F.countDistinct("paper_id").alias("n_papers")).where("n_papers > 1")
    return g if top is None else g.orderBy(F.desc("n_papers"), "dataset_norm", "metric_norm").limit(top)


def cited(entities: DataFrame, entity_substr: str, min_papers: int = 1) -> DataFrame:
    """Q6: works whose key contains the needle and that enough papers cite."""
    return entities.where(F.col("canonical_key").contains(_norm(entity_substr)) & (F.col("n_papers") >= min_papers))


TASKS = ("facet", "lookup", "sweep", "leaderboard", "compare", "join")


def hits(question: dict[str, Any], catalog: DataFrame, cards: DataFrame, rows: DataFrame, entities: DataFrame) -> DataFrame:
    """The rows that answer one question."""
    q = {k: v for k, v in question.items() if k not in ("id", "task", "desc", "min_hits", "min_pairs", "direction")}
    task = question["task"]
    if task == "facet":
        return facet(catalog, **q)
    if task == "lookup":
        return lookup(catalog, **q)
    if task == "sweep":
        return sweep(cards, catalog, **q)
    if task == "leaderboard":
        return leaderboard_rows(rows, **q)
    return compare(rows, None) if task == "compare" else cited(entities, **q)


def answers(questions: list[dict[str, Any]], catalog: DataFrame, cards: DataFrame, rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Q7: per question its task, hits and whether they reach its threshold; a question set is a handful of settings."""
    parts = []
    for q in questions:
        n = hits(q, catalog, cards, rows, entities).agg(F.count(F.lit(1)).alias("n_hits"))
        enough = F.col("n_hits") >= q.get("min_hits", q.get("min_pairs", 1))
        parts.append(n.select(F.lit(q["id"]).alias("id"), F.lit(q["task"]).alias("task"), "n_hits", enough.alias("answered")))
    return reduce(DataFrame.unionByName, parts)


def by_task(answered: DataFrame) -> DataFrame:
    return answered.groupBy("task").agg(F.count_if("answered").alias("n_answered"), F.count(F.lit(1)).alias("n_questions"))


def load_questions(text: str) -> list[dict[str, Any]]:
    """Q8: a question set from JSON text: a list of objects with an id and a known task, each with the settings of that task."""
    questions = json.loads(text)
    for q in questions if isinstance(questions, list) else [None]:
        if not isinstance(q, dict) or not q.get("id") or q.get("task") not in TASKS:
            raise ValueError(f"no question: {q}")
    return questions
