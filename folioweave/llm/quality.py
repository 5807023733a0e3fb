"""Per-document text statistics and the documents that are not natural prose (problem 8).

One pass over the texts gives the statistics of each document. Quantile sketches (KLL) of every
statistic are kept per language over all documents and merged over all languages; with them each
value becomes a percentile (in steps of GRID) and a robust z-score. Location and scale of a z-score
are the median and the interquartile range of the prose part of the distribution: raters' labels tell
which share of a language is no prose, and that share is left out on the side of the statistic's tail
(``TAIL_SIDE``) before the quartiles are read from the sketch. So the scores stay the same whether a
tenth or two thirds of a corpus are lists and tables.

The tails are weighed into one score; the weights and the bound of the score are fitted on labelled
documents (at most ``LABEL_BOUND``, those with the lowest hash; a fifth of them is held out). Found are
the documents whose score lies beyond the bound. Quantiles of a language are blended with those of the
corpus by its number of documents (``BLEND``), its share by its number of labels (``SHARE_BLEND``).

One of the statistics is the share of characters in sentences of natural prose: common words hold
together their words, most of them do not start with a capital (titles of works do) and they consist
of letters in the main. Lines broken in the middle of a sentence are joined first.

Defined results: a null, empty or blank text has statistics of 0 and a null prose share and is never
flagged; texts are used whole, at any length; a repeated row gives its result twice in the statistics
and once in the found documents; ``lang`` is not used, the language is taken from the words; labels of
null form are ignored, a document whose raters disagree evenly as well; without labels of both kinds the
default weights and bound hold; without common words no sentence is prose and no document stands out by
it; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.session import cut

STATISTICS = (
    "n_words",
    "mean_word_length",
    "symbol_ratio",
    "digit_ratio",
    "line_end_ratio",
    "common_ratio",
    "capital_ratio",
    "prose_share",
)
SKETCH_K = 400
#: Ranks of the percentiles; a percentile is the highest of them that a value reaches.
GRID = (0.01, *(k / 20 for k in range(1, 20)), 0.99)
#: Ranks read from the sketches; quartiles of the prose part lie between two of them.
RANKS = tuple(k / 200 for k in range(201))
#: Where no prose lies: above (1), below (-1) or on both sides (0).
TAIL_SIDE = {
    "n_words": -1, "mean_word_length": 0, "symbol_ratio": 1, "digit_ratio": 1, "line_end_ratio": -1,
    "common_ratio": -1, "capital_ratio": 1, "prose_share": -1,
}
#: A z-score beyond this on its side is a tail, beyond Z_LIMIT it counts no more; SCALE_FLOOR keeps a statistic that hardly varies from small deviations.
TAIL_Z, Z_LIMIT = 2.0, 8.0
SCALE_FLOOR = {
    "n_words": 50.0, "mean_word_length": 0.3, "symbol_ratio": 0.02, "digit_ratio": 0.02, "line_end_ratio": 0.1,
    "common_ratio": 0.03, "capital_ratio": 0.05, "prose_share": 0.08,
}
#: Documents after which a language's own quantiles weigh as much as those of the corpus; labels for its share.
BLEND, SHARE_BLEND = 100, 10
#: Labelled documents that are fitted on at most; every HOLD_OUT-th is kept for the evaluation.
LABEL_BOUND, HOLD_OUT = 20_000, 5
#: Weights and bound of the score without labels, and the penalty of a fitted weight.
DEFAULT_WEIGHTS = {s: 4.0 if s == "prose_share" else 0.0 for s in STATISTICS}
DEFAULT_BOUND, PENALTY = 2.5, 1.0
#: A text with fewer common words than this share has no language of its own and is held against the whole corpus.
LANGUAGE_SHARE = 0.05
LANGUAGE_BOUND = 1_000

_BREAK = re.compile(r"\r\n|[\n\r\x0b\x0c\x85  ]")
_WORD = re.compile(r"[^\W\d_]+(?:['’\-‑][^\W\d_]+)*")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])")
_HAN = re.compile(r"[㐀-鿿]")
_MARK = re.compile(r"^\s*(?:>\s*)*(?:\[§[^\]]{0,12}\]\s*)?")
#: List marks, numbers, headings, rows of tables and markup that begin a line of their own.
_ITEM = re.compile(r"^\s*(?:[-–—*•·▪◦‣+]\s|\(?\d{1,3}[.)]\s|\[\d+\]\s+[A-Z]|\[[ xX]\]|#{1,6}\s|[|<\\{}=]|\d+(?:\.\d+)+\s)")
_MOJIBAKE = re.compile(r"Ã[\x80-\xbf¡-¿ƒ‚„…†‡ˆ‰Š‹ŒŽ''""•–—˜™š›œžŸ€]|â€.|Â[\x80-\xbf¡-¿]")
_NOISE = re.compile(r"[~^`|;\\<>{}=_]")
_DECORATION = re.compile(r"\$[^$\n]{0,200}\$|\\\([^\n]{0,200}?\\\)")
_ENDS = ".!?…。！？:;"


class Lexicon:
    """Common words by language; Han characters count one by one."""

    def __init__(self, common: dict[str, list[str]]) -> None:
        languages = {k: {w.lower() for w in v} for k, v in common.items()}
        self.languages = {k: frozenset(w for w in v if not _HAN.search(w)) for k, v in languages.items()}
        self.han = frozenset(c for v in languages.values() for w in v if _HAN.search(w) for c in w)
        self.any = frozenset().union(*self.languages.values())

    def language(self, words: list[str], n_han: int) -> str:
        if not words and not n_han:
            return "und"
        if n_han > 0.3 * sum(map(len, words)):
            return "zh"
        held = [w for w in words if w in self.any]
        counts = {k: sum(map(v.__contains__, held)) for k, v in self.languages.items()}
        best = max(sorted(counts), key=counts.__getitem__, default="und")
        return best if counts.get(best, 0) > LANGUAGE_SHARE * len(words) else "und"

    def is_prose(self, sentence: str, item: bool) -> bool | None:
        """Whether a sentence is natural prose; None: too short to tell."""
        bare = _DECORATION.sub(" x ", sentence)
        words = _WORD.findall(bare)
        n = len(words)
        size = len(bare.strip())
        if not size:
            return None
        han = _HAN.findall(bare)
        if len(han) >= 5 and 2 * len(han) > sum(map(len, words)) - len(han):
            return sum(map(self.han.__contains__, han)) >= 0.08 * len(han)
        letters = sum(map(len, words))
        if n < 4:
            return None if letters >= 0.6 * size and not item else False
        if 2 * len(bare.split()) < n or letters < 0.55 * size or letters < 2.8 * n or len(_NOISE.findall(bare)) > 0.04 * size:
            return False
        held = sum(w.lower() in self.any for w in words)
        if sum(map(str.isupper, words)) > 0.8 * n:  # written in capitals throughout
            return held >= 0.2 * n and not item
        capitals = sum(w[0].isupper() for w in words[1:])
        if len(_MOJIBAKE.findall(bare)) > 0.1 * n:
            return False
        if held < 0.1 * n or held < 1 + (n > 14):
            return None if n < 6 and not item and capitals < n - 1 else False
        return capitals <= 0.55 * (n - 1)


def _logical_lines(text: str) -> Iterator[tuple[str, bool, bool, int]]:
    """(line, is an item, begins a paragraph, characters) with the lines of a broken sentence joined."""
    held, size, item, first, open_end, blank = "", 0, False, True, False, True
    for raw in _BREAK.split(text):
        n = len(raw) + 1
        line = _MARK.sub("", raw).strip()
        if not line:
            if held:
                yield held, item, first, size + n
                held, size = "", 0
            blank, open_end = True, False
            continue
        starts_item = bool(_ITEM.match(raw)) or bool(_ITEM.match(line))
        joins = held and open_end and not starts_item and "\t" not in raw and (line[0].islower() or line[0] in "([$\"'“„«" or len(held) >= 30 and not line[0].isupper() or _flows(held))
        if joins:
            held, size = f"{held} {line}", size + n
        else:
            if held:
                yield held, item, first, size
            held, size, item, first = line, n, starts_item, blank
        blank = False
        open_end = line[-1] not in _ENDS and "|" not in line and "\t" not in raw
    if held:
        yield held, item, first, size


def _flows(line: str) -> bool:
    """A line that breaks off within a sentence: it ends in a comma or a lower-case word after others."""
    last = line.rsplit(None, 1)
    return len(last) > 1 and len(line) >= 30 and (line[-1] == "," or last[-1][0].islower() or bool(_HAN.match(line[-1])))


def statistics_of(text: str, lex: Lexicon) -> tuple:
    """language, then STATISTICS, of one text that is not blank."""
    written = _WORD.findall(text)
    words = [w.lower() for w in written]
    n_han = len(_HAN.findall(text)) if not text.isascii() else 0
    n_words = len(words) + n_han
    length = len(text)
    letters = sum(map(len, words))
    digits = sum(map(text.count, "0123456789"))
    spaces = length - len("".join(text.split()))
    prose = total = 0
    lines = ended = 0
    label: bool | None = None
    for line, item, first, size in _logical_lines(text):
        lines += 1
        ended += line[-1] in _ENDS
        if first:
            label = None
        parts = _SENTENCE.split(line)
        at = 0
        for k, part in enumerate(parts):
            share = size - at if k == len(parts) - 1 else len(part) + 1
            at += share
            total += share
            got = lex.is_prose(part, item and k == 0)
            if got is None and label and not item:
                got = True  # the short rest of a sentence or a short one beside others
            label = got
            if got:
                prose += share
    capitals = sum(w[0].isupper() for w in written)
    held = sum(map(lex.any.__contains__, words))
    return (
        lex.language(words, n_han),
        float(n_words),
        letters / max(1, len(words)),
        max(0, length - letters - digits - spaces) / length,
        digits / length,
        ended / max(1, lines),
        (held + (sum(map(lex.han.__contains__, _HAN.findall(text))) if n_han else 0)) / max(1, n_words),
        capitals / max(1, len(words)),
        prose / max(1, total),
    )


def lexicon(common_words: DataFrame | None) -> Lexicon:
    """From the fixed table of common words (a few hundred rows, checked)."""
    rows = common_words.where("lang is not null and word is not null").limit(100_001).collect() if common_words is not None else []
    if len(rows) > 100_000:
        raise ValueError("common_words is no fixed table")
    common: dict[str, list[str]] = {}
    for r in rows:
        common.setdefault(r["lang"], []).append(r["word"])
    return Lexicon(common)


def document_statistics(df: DataFrame, common_words: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, language and STATISTICS of every row."""
    lex = lexicon(common_words)
    names = ["language", *STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics_of(t, lex) if t and not t.isspace() else ("und", *[0.0] * (len(STATISTICS) - 1), None) for t in batch.column(text).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            kinds = [pa.string()] + [pa.float64()] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[key, *names])

    schema = f"{key} {dict(df.dtypes)[key]}, language string, " + ", ".join(f"{s} double" for s in STATISTICS)
    return df.select(key, text).mapInArrow(run, schema)


def _sketches(stats: DataFrame) -> DataFrame:
    """One row per language, and one with the language '*' merged from them, with a sketch of each statistic."""
    full = stats.where("prose_share is not null")
    per = full.groupBy("language").agg(*(F.kll_sketch_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in STATISTICS))
    merged = per.agg(*(F.kll_merge_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in STATISTICS)).select(F.lit("*").alias("language"), *STATISTICS)
    return per.unionByName(merged)


def quantiles(stats: DataFrame) -> DataFrame:
    """language, n and, for each statistic, its quantiles at RANKS."""
    ranks = F.array(*map(F.lit, RANKS))
    return _sketches(stats).select(
        "language",
        F.kll_sketch_get_n_double(STATISTICS[0]).alias("n"),
        *(F.when(F.kll_sketch_get_n_double(s) > 0, F.kll_sketch_get_quantile_double(F.col(s), ranks)).alias(s) for s in STATISTICS),
    )


def labelled(stats: DataFrame, labels: DataFrame | None, key: str = "doc_id") -> pd.DataFrame:
    """Language, STATISTICS, ``other`` (1: no prose) and ``held_out`` of at most LABEL_BOUND labelled documents."""
    if labels is None:
        return pd.DataFrame(columns=["language", *STATISTICS, "other", "held_out"])
    said = labels.where(F.col("form").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.avg((F.col("form") != "prose").cast("int")).alias("other"))
    said = said.where("other <> 0.5").withColumn("at", F.xxhash64(key)).orderBy("at").limit(LABEL_BOUND)
    rows = stats.where("prose_share is not null").join(F.broadcast(said), key).dropDuplicates([key])
    held_out = F.pmod(F.xxhash64("at"), F.lit(HOLD_OUT)) == 0
    return rows.select("language", *STATISTICS, F.round("other").cast("int").alias("other"), held_out.alias("held_out")).orderBy("at").toPandas()


def references(q: dict, known: pd.DataFrame) -> dict[str, dict[str, tuple[float, float]]]:
    """Median and scale of the prose part of every statistic, per language and for '*'."""
    whole = q["*"]
    at = lambda row, s, rank: float(np.interp(rank, RANKS, row[s]))
    general = (known["other"].sum() + 1) / (len(known) + 4)
    out: dict[str, dict[str, tuple[float, float]]] = {}
    for lang, row in q.items():
        if lang == "und":
            continue
        mine = known[known["language"] == lang]["other"]
        share = general if lang == "*" else (mine.sum() + SHARE_BLEND * general) / (len(mine) + SHARE_BLEND)
        own = 0.0 if lang == "*" else row["n"] / (row["n"] + BLEND)
        out[lang] = {}
        for s in STATISTICS:
            quartiles = []
            for p in (0.25, 0.5, 0.75):
                value = 0.0
                for weight, r, away in ((own, row, share), (1 - own, whole, general)):
                    low = {-1: away, 0: away / 2, 1: 0.0}[TAIL_SIDE[s]]
                    value += weight * at(r, s, low + (1 - away) * p)
                quartiles.append(value)
            out[lang][s] = (quartiles[1], max((quartiles[2] - quartiles[0]) / 1.349, SCALE_FLOOR[s]))
    return out


def _evidence(z: np.ndarray) -> np.ndarray:
    """Deviations towards the tails, from 0 to 1 at Z_LIMIT."""
    side = np.array([TAIL_SIDE[s] for s in STATISTICS])
    return np.where(side == 0, np.abs(z), z * side).clip(0, Z_LIMIT) / Z_LIMIT


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of a penalised logistic regression and the bound with the fewest errors, in the middle of the widest gap."""
    if min(y.sum(), len(y) - y.sum()) < 2:
        return np.array([DEFAULT_WEIGHTS[s] for s in STATISTICS]), DEFAULT_BOUND
    a = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([PENALTY] * x.shape[1] + [1e-3])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ w)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    order = np.argsort(x @ w[:-1], kind="stable")
    score, other = (x @ w[:-1])[order], y[order]
    errors = np.concatenate(([0], np.cumsum(other))) + np.concatenate((np.cumsum((1 - other)[::-1])[::-1], [0]))
    edges = np.concatenate(([score[0] - 1], score, [score[-1] + 1]))
    gap = np.diff(edges)
    errors = np.where(gap > 0, errors, len(y) + 1)  # no bound between equal scores
    k = np.argmax(np.where(errors == errors.min(), gap, 0))
    return w[:-1], float((edges[k] + edges[k + 1]) / 2)


def scored(stats: DataFrame, labels: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """``stats`` with z_<statistic> and p_<statistic> against the language, or the corpus where a text has none, and
    ``excess``, the weighed evidence less the bound."""
    stats = cut(stats)
    # A row of quantiles per language of the lexicon, '*' and 'und': a dozen rows whatever the corpus.
    q = {r["language"]: r for r in quantiles(stats).limit(LANGUAGE_BOUND + 1).collect()}
    if len(q) > LANGUAGE_BOUND:
        raise ValueError(f"more than {LANGUAGE_BOUND} languages")
    empty = q["*"][STATISTICS[0]] is None
    known = labelled(stats, labels, key)
    known = known[~known["held_out"].astype(bool)]
    refs = {} if empty else references(q, known)
    weights, bound = np.array([DEFAULT_WEIGHTS[s] for s in STATISTICS]), DEFAULT_BOUND
    if len(known):
        of = [refs.get(lang, refs["*"]) for lang in known["language"]]
        z = np.array([[(v - r[s][0]) / r[s][1] for v, s in zip(row, STATISTICS)] for row, r in zip(known[list(STATISTICS)].to_numpy(), of)])
        weights, bound = fit(_evidence(z), known["other"].to_numpy(dtype=float))
    use = {k: (refs[k if k in refs else "*"], q[k if k in refs else "*"]) for k in q if k != "*"}
    grid = lambda row, s: [float(np.interp(g, RANKS, row[s])) for g in GRID]
    schema = "language string, " + ", ".join(f"__m_{s} double, __s_{s} double, __q_{s} array<double>" for s in STATISTICS)
    rows = [(k, *(x for s in STATISTICS for x in (*r[s], grid(row, s)))) for k, (r, row) in use.items()]
    joined = stats.join(F.broadcast(stats.sparkSession.createDataFrame(rows, schema)), "language", "left")

    def z_of(s: str) -> Column:
        return ((F.col(s) - F.col(f"__m_{s}")) / F.col(f"__s_{s}")).alias(f"z_{s}")

    def rank(s: str) -> Column:
        reached = F.size(F.filter(f"__q_{s}", lambda g: g <= F.col(s)))
        return F.when(F.col(s).isNotNull(), F.get(F.array(F.lit(0.0), *map(F.lit, GRID)), reached)).alias(f"p_{s}")

    out = joined.select(*stats.columns, *map(z_of, STATISTICS), *map(rank, STATISTICS))
    score = F.lit(-bound)
    for s, w in zip(STATISTICS, weights):
        score = score + F.greatest(F.lit(0.0), F.least(F.lit(Z_LIMIT), _towards(s))) * float(w / Z_LIMIT)
    return out.withColumn("excess", F.when(F.col("prose_share").isNotNull(), score))


def _towards(s: str) -> Column:
    """The z-score of a statistic towards its tail."""
    z = F.col(f"z_{s}")
    return F.abs(z) if TAIL_SIDE[s] == 0 else z * TAIL_SIDE[s]


def flagged(scores: DataFrame) -> DataFrame:
    """Adds ``tails``, the statistics in whose tail a document lies, and ``is_prose``."""
    tail = F.array_compact(F.array(*(F.when(_towards(s) > TAIL_Z, F.lit(s)) for s in STATISTICS)))
    blank = F.col("prose_share").isNull()
    return scores.withColumn("tails", F.when(blank, F.array().cast("array<string>")).otherwise(tail)).withColumn("is_prose", F.col("excess") <= 0)


def not_prose(df: DataFrame, common_words: DataFrame | None = None, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose tails weigh more than the fitted bound."""
    got = scored(document_statistics(df, common_words, key, text), labels, key)
    return got.where("excess > 0").select(key).dropDuplicates()


def held_out(stats: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labelled documents that the fit did not see, counted by their label and the verdict."""
    said = labels.where(F.col("form").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.avg((F.col("form") != "prose").cast("int")).alias("other"))
    said = said.where((F.col("other") != 0.5) & (F.pmod(F.xxhash64(F.xxhash64(key)), F.lit(HOLD_OUT)) == 0))
    got = flagged(scored(stats, labels, key)).where("is_prose is not null").dropDuplicates([key]).join(said, key)
    return got.groupBy((F.col("other") < 0.5).alias("labelled_prose"), "is_prose").agg(F.count(F.lit(1)).alias("n"))
