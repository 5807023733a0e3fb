"""Mixing sources to target weights (problem 7).

Each mix has a budget (``size_ratio`` of all corpus tokens) and each of its sources a capacity
(``max_repeats`` times its tokens). Two rules give the weights:

* ``temperature_weights`` exponentiates the token shares, ``w_s ~ share_s ** a``, bisects the exponent to
  the entropy of the target shares and, where a source would pass its repetition limit, from there
  towards 1 until it does not. What a source cannot take even then goes to the others in proportion
  to their weights, so that a budget within the capacities is always filled.
* ``target_weights`` keeps the targets: ``w_s = min(capacity_s / budget, scale * target_s)``, with the
  scale bisected until the weights fill the budget. One exponent for all sources gives the entropy of the
  targets but not the targets; the mixes of the goal table are made by this rule, since each source must
  hold its target share (the README has the errors of both rules).

A budget beyond all capacities is cut to them.

The weights are realised as budgeted block permutations: a source's budget is a number of whole
passes over its documents and a rest. A pass is a block in which the documents are permuted by
a hash of mix, block and document; the rest takes the beginning of one more block. Where the
rest ends is searched by prefix sums over 2 ** BITS ranges of the hash, again within the range that
holds the end, and so on until a range has few documents; only these are ordered. So no source, however
large, is ordered or summed in one task, and no task sums more than 2 ** BITS rows of a source.

Defined results: null and empty texts have no tokens and are in no mix; documents without a
source are in no mix but count for the corpus; a source of a mix without documents or with a
target of 0, a null or negative target has weight 0; repeated documents (same id) count as
separate documents of the caller's table; the last document of the rest is taken when at least
half of it fits; an empty corpus or goal table gives empty results; extra columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.llm.tokens import VOCABULARY, count_tokens
from folioweave.session import cut

#: Documents that are ordered at once, on average, where a rest ends, and the ranges of a search step (as bits).
BIN_DOCUMENTS, BITS, CODE_BITS = 2_000, 10, 60
BISECTIONS = 60
#: Beyond this exponent all tokens come from the largest source.
MAX_EXPONENT = 64.0
GOAL_BOUND = 100_000


def _bisect(low: float, high: float, below) -> float:
    """The largest point up to which ``below`` holds, for a test that holds at ``low``."""
    for _ in range(BISECTIONS):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) else (low, mid)
    return low


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(sizes: list[float], exponent: float) -> list[float]:
    """``sizes ** exponent``, normalised; sizes of 0 stay 0."""
    logs = [exponent * math.log(x) if x > 0 else -math.inf for x in sizes]
    top = max(logs, default=-math.inf)
    w = [math.exp(x - top) if x > -math.inf else 0.0 for x in logs]
    return [x / sum(w) for x in w] if any(w) else w


def temperature_weights(sizes: list[float], capacity: list[float], budget: float, goal: float) -> tuple[float, list[float]]:
    """The exponent and the weights whose entropy comes nearest to ``goal`` within the repetition limits.

    A falling exponent evens the weights out: entropy and the repetitions of small sources rise.
    """
    usable = [x if c > 0 else 0.0 for x, c in zip(sizes, capacity)]
    budget = min(budget, sum(c for c, x in zip(capacity, usable) if x > 0))
    if not budget > 0:
        return 1.0, [0.0] * len(sizes)

    def fits(a: float) -> bool:
        return all(x * budget <= c * (1 + 1e-12) for x, c in zip(tempered(usable, a), capacity))

    exponent = _bisect(0.0, MAX_EXPONENT, lambda a: entropy(tempered(usable, a)) >= goal) if entropy(tempered(usable, 0.0)) >= goal else 0.0
    if not fits(exponent):
        start = exponent
        exponent = 1.0 + (start - 1.0) * _bisect(0.0, 1.0, lambda t: fits(1.0 + (start - 1.0) * t)) if fits(1.0) else 1.0
    return exponent, target_weights(tempered(usable, exponent), capacity, budget)[1]


def target_weights(target: list[float], capacity: list[float], budget: float) -> tuple[float, list[float]]:
    """The scale and the weights of the sources (see above); unusable sources get weight 0."""
    aim = [t if t > 0 and c > 0 else 0.0 for t, c in zip(target, capacity)]
    total = sum(c for c, t in zip(capacity, aim) if t)
    budget = min(budget, total)
    if not budget > 0:
        return 1.0, [0.0] * len(target)
    aim = [t / sum(aim) for t in aim]
    filled = lambda scale: [min(c, scale * t * budget) for t, c in zip(aim, capacity)]
    top = max(c / (t * budget) for t, c in zip(aim, capacity) if t) + 1
    scale = 1.0 if sum(filled(1.0)) >= budget * (1 - 1e-12) else math.exp(_bisect(0.0, math.log(top), lambda x: sum(filled(math.exp(x))) <= budget))
    w = filled(scale)
    return scale, [min(x / sum(w), c / budget) for x, c in zip(w, capacity)]


def plan(goals: pd.DataFrame, sizes: dict[str, int], corpus_tokens: int, rule: str = "target") -> pd.DataFrame:
    """The budget, whole passes and rest of every source of every mix; goals are a small table of settings.

    ``factor`` is the scale of the rule "target" or the exponent of the rule "temperature".
    """
    rows = []
    for mix, g in goals.groupby("mix_name", sort=True):
        g = g.groupby("source", sort=True).agg(target_share=("target_share", "max"), max_repeats=("max_repeats", "min"), size_ratio=("size_ratio", "max")).reset_index()
        target = [t if t == t and t is not None else 0.0 for t in g["target_share"]]
        tokens = [sizes.get(s, 0) for s in g["source"]]
        capacity = [float(max(0, r)) * t for r, t in zip(g["max_repeats"].fillna(0), tokens)]
        wanted = float(g["size_ratio"].max()) * corpus_tokens
        capacity = [c if t > 0 else 0.0 for c, t in zip(capacity, target)]
        budget = min(wanted, sum(capacity))
        whole = sum(t for t in target if t > 0)
        if rule == "temperature":
            goal = entropy([max(t, 0.0) / whole for t in target]) if whole else 0.0
            exponent, w = temperature_weights([float(t) for t in tokens], capacity, budget, goal)
        else:
            exponent, w = target_weights(target, capacity, budget)
        for source, t, n, c, x in zip(g["source"], target, tokens, capacity, w):
            b = min(int(round(x * budget)), int(c))
            passes = b // n if n else 0
            rows.append((mix, source, max(t, 0.0) / whole if whole else 0.0, x, exponent, n, b, passes, b - passes * n if n else 0))
    return pd.DataFrame(rows, columns=["mix_name", "source", "target_share", "weight", "factor", "source_tokens", "budget", "passes", "rest"])


PLAN_SCHEMA = "mix_name string, source string, target_share double, weight double, factor double, source_tokens bigint, budget bigint, passes bigint, rest bigint"


def _sized(documents: DataFrame, path: str) -> DataFrame:
    return cut(count_tokens(documents, ["doc_id", "source"], "text", path).where("n_tokens > 0"))


def _plan_table(sized: DataFrame, goals: DataFrame, rule: str) -> tuple[DataFrame, int]:
    """The plan and the number of documents. Sources come from the goal table, which is bounded."""
    spark = sized.sparkSession
    wanted = goals.where("mix_name is not null and source is not null").select("mix_name", "source", "target_share", "max_repeats", "size_ratio").limit(GOAL_BOUND + 1).toPandas()
    if len(wanted) > GOAL_BOUND:
        raise ValueError(f"mix_goals has more than {GOAL_BOUND} rows")
    named = sized.join(F.broadcast(goals.select("source").dropDuplicates()), "source", "left_semi")
    total = sized.agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).head()
    sizes = {r["source"]: r["t"] for r in named.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    made = plan(wanted, sizes, total["t"] or 0, rule)
    return spark.createDataFrame(made, PLAN_SCHEMA) if len(made) else spark.createDataFrame([], PLAN_SCHEMA), total["n"]


def mixture(documents: DataFrame, goals: DataFrame, path: str = VOCABULARY, rule: str = "target") -> tuple[DataFrame, DataFrame]:
    """(rows, plan): mix_name, source, doc_id, n_tokens, copies; and the plan table."""
    sized = _sized(documents, path)
    planned, n_documents = _plan_table(sized, goals, rule)
    docs = sized.join(F.broadcast(planned), "source")
    # The block after the last whole pass: its permutation is the order of (code, doc_id).
    docs = docs.withColumn("code", F.pmod(F.xxhash64("mix_name", "passes", "doc_id"), F.lit(1 << CODE_BITS)))
    ends = _ends(docs, n_documents)
    if ends is None:
        return docs.where("passes > 0").select("mix_name", "source", "doc_id", "n_tokens", F.col("passes").cast("int").alias("copies")), planned
    low, high, ends = ends
    placed = docs.join(F.broadcast(ends), ["mix_name", "source"], "left")
    inside = F.coalesce(F.col("code").between(low, high), F.lit(False))
    w = Window.partitionBy("mix_name", "source").orderBy("code", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.where(inside).withColumn("at", F.col("before") + F.sum("n_tokens").over(w))
    edge = edge.withColumn("more", (F.col("at") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int"))
    whole = placed.where(~inside).withColumn("more", F.coalesce((F.col("code") < low).cast("int"), F.lit(0)))
    cols = ["mix_name", "source", "doc_id", "n_tokens", (F.col("passes") + F.col("more")).cast("int").alias("copies")]
    return edge.select(*cols).unionByName(whole.select(*cols)).where("copies > 0"), planned


def _ends(docs: DataFrame, n_documents: int) -> tuple[Column, Column, DataFrame] | None:
    """The lowest and highest code of the range where the rest of a source ends, as columns of the returned table (a row
    per mix and source with a rest: mix_name, source, prefix, before); None where there is no rest."""
    steps, left = 1, n_documents / BIN_DOCUMENTS
    while left > 1 << BITS and (steps + 1) * BITS <= CODE_BITS:
        steps, left = steps + 1, left / (1 << BITS)
    found = None
    for step in range(1, steps + 1):
        shift = CODE_BITS - step * BITS
        part = docs.where("rest > 0")
        if found is None:
            part = part.withColumn("before", F.lit(0).cast("bigint"))
        else:
            part = part.join(F.broadcast(found), ["mix_name", "source"]).where(F.shiftright("code", shift + BITS) == F.col("prefix")).drop("prefix")
        sums = part.groupBy("mix_name", "source", "rest", "before", F.shiftright("code", shift).alias("prefix")).agg(F.sum("n_tokens").alias("t"))
        until = F.col("before") + F.sum("t").over(Window.partitionBy("mix_name", "source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        sums = sums.withColumn("until", until).where("until > rest")
        found = cut(sums.groupBy("mix_name", "source").agg(F.min(F.struct("prefix", (F.col("until") - F.col("t")).alias("before"))).alias("f")).select("mix_name", "source", "f.*"))
    if found.isEmpty():
        return None
    low = F.shiftleft("prefix", shift)
    return low, low + F.lit((1 << shift) - 1), found


def shares(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Target, weight and reached share, tokens, documents and most copies of every source of every mix."""
    got = rows.groupBy("mix_name", "source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("copies").alias("most_copies")
    )
    out = planned.join(got, ["mix_name", "source"], "left").fillna(0, ["tokens", "n_documents", "most_copies"])
    # A plan has a few rows per mix.
    total = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return out.select(
        "mix_name", "source", "target_share", "weight", "factor", "budget",
        (F.col("tokens") / F.when(total > 0, total)).alias("reached_share"), "tokens", "n_documents", "most_copies",
    )
