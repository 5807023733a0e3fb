"""Token counts, costs and cache use by stage and paper (A7-A10, N26, T).

usage(paper_id, stage, prompt, cached, completion, truncated) has one row per call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.functions.scalar import dollars, effective_cost


def stage_totals(usage: DataFrame) -> DataFrame:
    """A7."""
    return usage.groupBy("stage").agg(F.count(F.lit(1)).alias("calls"), *(F.sum(c).alias(c) for c in ("prompt", "cached", "completion")))


def cost_report(usage: DataFrame) -> DataFrame:
    """Totals, hit rate of the cache, effective cost with its share, and dollars by stage, with a TOTAL row by ROLLUP."""
    g = usage.rollup("stage").agg(F.count(F.lit(1)).alias("calls"), *(F.sum(c).alias(c) for c in ("prompt", "cached", "completion")), F.grouping("stage").alias("g"))
    p, c, o = F.col("prompt"), F.col("cached"), F.col("completion")
    g = g.withColumn("effective", effective_cost(p, c, o))
    whole = F.max(F.when(F.col("g") == 1, F.col("effective"))).over(Window.partitionBy(F.lit(1)))  # a row per stage
    return g.select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("stage")).alias("stage"), "calls", (p - c).alias("uncached"), "effective",
        F.when(p > 0, c / p).alias("hit_rate"), F.when(whole > 0, F.col("effective") / whole).alias("share"), dollars(p, c, o).alias("usd"),
    )


def load_usage(tree: DataFrame) -> DataFrame:
    """Usage rows from the status files of a run (paper_id, stage, payload): ``token_usage`` with an object
    ``by_stage`` of counts, or the counts of each stage themselves; counts that are missing are 0."""
    v = F.try_parse_json("payload")
    per = F.coalesce(F.try_variant_get(v, "$.token_usage.by_stage", "map<string,variant>"), F.try_variant_get(v, "$.token_usage", "map<string,variant>"))
    rows = tree.where("stage = 'status'").select("paper_id", F.explode(per).alias("stage", "u"))
    n = lambda *ks: F.coalesce(*(F.try_variant_get("u", f"$.{k}", "bigint") for k in ks), F.lit(0).cast("bigint"))
    return rows.select(
        "paper_id", "stage", n("prompt_tokens", "prompt").alias("prompt"), n("cached_tokens", "cached").alias("cached"), n("completion_tokens", "completion").alias("completion"),
        F.coalesce(F.try_variant_get("u", "$.truncated", "boolean"), F.lit(False)).alias("truncated"),
    )


def paper_usage(usage: DataFrame) -> DataFrame:
    """Sums of a paper and whether any of its calls was cut short."""
    return usage.groupBy("paper_id").agg(F.sum(F.col("prompt") + F.col("completion")).alias("tokens"), F.bool_or("truncated").alias("truncated"))


def run_totals(usage: DataFrame) -> DataFrame:
    """Token sums of a run and the number of papers with a call cut short."""
    p = paper_usage(usage)
    return p.agg(F.sum("tokens").alias("tokens"), F.count_if("truncated").alias("n_truncated"), F.count(F.lit(1)).alias("n_papers"))


def cache_diagnosis(usage: DataFrame, content_stages: tuple[str, ...]) -> DataFrame:
    """Per paper with two content stages or more: whether its stages hit the same cached prefix, the uncached tokens
    of all stages but the one with the largest completion, and what of it a warm prefix would save (less the spread)."""
    s = usage.where(F.col("stage").isin(*content_stages)).groupBy("paper_id", "stage").agg(*(F.sum(c).alias(c) for c in ("prompt", "cached", "completion")))
    s = s.withColumn("uncached", F.col("prompt") - F.col("cached"))
    per = Window.partitionBy("paper_id")  # at most one row per content stage
    s = s.withColumn("rn", F.row_number().over(per.orderBy(F.desc("completion"), "stage"))).withColumn("spread", F.max("uncached").over(per) - F.min("uncached").over(per))
    later = F.col("rn") > 1
    g = s.groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("n_stages"), (F.countDistinct("cached") == 1).alias("same_prefix"), F.min("cached").alias("prefix"),
        F.sum(F.when(later, F.col("uncached"))).alias("redundant"), F.sum(F.when(later, F.greatest(F.lit(0), F.col("uncached") - F.col("spread")))).alias("saving"),
    )
    return g.where("n_stages >= 2")


def cache_summary(diagnosis: DataFrame) -> DataFrame:
    """A9 over the run; the median is the upper one of the sorted prefixes."""
    upper = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY prefix DESC)")
    return diagnosis.agg(F.count(F.lit(1)).alias("n_papers"), F.count_if("same_prefix").alias("n_same"), upper.alias("median_prefix"), F.sum("redundant").alias("redundant"), F.sum("saving").alias("saving"))
