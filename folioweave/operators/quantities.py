r"""Quantities recorded in different units, converted to common units (problem 2).

Pure SQL expressions: the number and the unit words are cut out with regexp_extract, the
words are normalised by a join with an alias table, the nearest statement wins (value text,
metric, caption, unit field, then the default), and factor and offset are applied.

Defined results: a null, blank or text value has no number and gives no row; words that are no
alias of the metric's quantity state nothing; a metric that names no quantity gives no row; a
repeated row gives one row; null metric, caption and unit state nothing; an empty table
gives an empty table; columns of other names are ignored.

The alias, unit and metric tables are fixed tables (TABLE_BOUND rows are checked), so they
are broadcast; the data is neither shuffled for the conversion nor collected.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_BOUND = 10_000

# The written forms of each unit code, by quantity.
UNIT_ALIASES = {
    "share": {
        "pct": "%|pct|percent|per cent|per-cent|percentage",
        "frac": "frac|fraction|ratio|proportion|0-1 scale|0..1|[0,1]",
        "permille": "‰|permille|per mille|per-mille|per 1000|per thousand",
        "bp": "bp|bps|basis points|basis point",
    },
    "duration": {
        "s": "s|sec|secs|second|seconds",
        "ms": "ms|msec|msecs|millisec|millisecs|millisecond|milliseconds",
        "us": "us|µs|μs|usec|usecs|microsec|microsecs|microsecond|microseconds",
        "min": "min|mins|minute|minutes",
        "h": "h|hr|hrs|hour|hours",
        "d": "d|day|days",
    },
    "memory": {
        "GB": "gb|gbyte|gbytes|gigabyte|gigabytes",
        "MB": "mb|mbyte|mbytes|megabyte|megabytes",
        "GiB": "gib|gibibyte|gibibytes",
        "MiB": "mib|mebibyte|mebibytes",
        "TB": "tb|tbyte|tbytes|terabyte|terabytes",
    },
    "params": {
        "M": "m|mln|million|millions|m params|m parameters|million params",
        "K": "k|thousand|thousands|k params|k parameters|thousand params",
        "B": "b|bn|billion|billions|b params|b parameters|billion params",
    },
    "compute": {
        "GFLOP": "gflop|gflops|gigaflop|gigaflops",
        "MFLOP": "mflop|mflops|megaflop|megaflops",
        "TFLOP": "tflop|tflops|teraflop|teraflops",
        "PFLOP": "pflop|pflops|petaflop|petaflops",
    },
    "energy": {
        "kWh": "kwh|kilowatt-hour|kilowatt-hours|kilowatt hours",
        "Wh": "wh|watt-hour|watt-hours|watt hours",
        "MJ": "mj|megajoule|megajoules",
        "kJ": "kj|kilojoule|kilojoules",
    },
    "temperature": {
        "degC": "degc|°c|celsius|deg c|degrees c|degrees celsius",
        "K": "k|kelvin|kelvins",
        "degF": "degf|°f|fahrenheit|deg f|degrees f|degrees fahrenheit",
    },
    "throughput": {
        "tok_s": "tok_s|tok/s|tokens/s|tokens/sec|tokens per second",
        "tok_min": "tok_min|tok/min|tokens/min|tokens per minute",
        "ktok_s": "ktok_s|ktok/s|k tokens per second|k tokens/s|thousand tokens/s|thousand tokens per second",
    },
    "length": {
        "mm": "mm|millimeter|millimeters|millimetre|millimetres",
        "cm": "cm|centimeter|centimeters|centimetre|centimetres",
        "m": "m|meter|meters|metre|metres",
        "um": "um|µm|μm|micron|microns|micrometer|micrometers|micrometre|micrometres",
        "inch": "inch|inches|in.",
    },
}
# The words that name a quantity in a caption.
CAPTION_TOPICS = {
    "share": "scores?|rates?",
    "duration": "timings?|times?|durations?|latency|latencies",
    "memory": "memory|footprints?",
    "params": "parameter counts?|parameters|model sizes?|weights",
    "compute": "compute|operation counts?|operations|flops",
    "energy": "energy|power draw",
    "temperature": "temperatures?|sensor readings?",
    "throughput": "throughput|decoding speed|speed",
    "length": "distances?|errors?|lengths?",
}

_DIGITS = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)"
_MANTISSA = rf"[-−–]?{_DIGITS}"
_POWER = r"\s*[x×]\s*10\^?\(?([-−–+]?[0-9]+)\)?"
_EXP = r"[eE]([-−–+]?[0-9]+)"
#: The first number of a text; 1: mantissa, 2: power of ten, 3: E exponent.
NUMBER = rf"({_MANTISSA})(?:{_POWER}|{_EXP})?"
_ERROR = rf"(?:\s*(?:±|\+/-)\s*{_DIGITS}(?:{_POWER}|{_EXP})?)?"
#: Text after the first number and its error, group 6: the statement nearest to the number.
_AFTER = rf"^[^0-9]*?{NUMBER}{_ERROR}(.*)$"
_METRIC_TAIL = r"(?i)^.*?(?:\s+in\s+|\s*[,(\[/]\s*)(.+?)\s*[)\]]?\s*$"


def alias_rows() -> list[tuple[str, str, str]]:
    """(quantity, alias in lower case, unit_code)."""
    return [(q, name, code) for q, units in UNIT_ALIASES.items() for code, names in units.items() for name in names.split("|")]


def alias_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(alias_rows(), "quantity string, alias string, unit_code string")


def _alias_pattern(quantity: str) -> str:
    names = sorted({a for q, a, _ in alias_rows() if q == quantity}, key=len, reverse=True)
    return "|".join(re.escape(n).replace(r"\ ", r"\s+") for n in names)


#: A value that is a number and nothing else, by far the most frequent form.
_PLAIN = r"^[0-9]+(?:\.[0-9]+)?\z"


def number(text: Column) -> Column:
    """The first number of a text as a double: signs, thousands commas, E and x10^ notation."""
    plain = lambda g: F.regexp_replace(F.regexp_extract(text, NUMBER, g), "[−–]", "-")
    mantissa = F.regexp_replace(plain(1), ",", "")
    exponent = F.coalesce(F.nullif(plain(2), F.lit("")), F.nullif(plain(3), F.lit("")), F.lit("0"))
    return F.when(text.rlike(_PLAIN), text.try_cast("double")).otherwise(F.concat(mantissa, F.lit("e"), exponent).try_cast("double"))


def _cleaned(words: Column) -> Column:
    """Unit words in lower case without decoration, to be looked up as an alias."""
    bare = F.lower(words)
    x = F.regexp_replace(bare, r"[*†‡]+", " ")
    x = F.regexp_replace(x, r"^\s*(?:unit\s*:)?[\s(\[-]*(?:(?:on|as|in)\s+(?:an?\s+)?)?", "")
    x = F.regexp_replace(x, r"\s*\(0\s*(?:\.\.|-)\s*1\)\s*$", "")
    cleaned = F.regexp_replace(F.regexp_replace(x, r"[\s)\]]+$", ""), r"\s+", " ")
    # A word of letters or a percent sign has nothing to be cleaned.
    return F.when((bare == "") | bare.rlike(r"^(?:%|(?!in\z)[a-z]+)\z"), bare).otherwise(cleaned)


def _caption_words(caption: Column, quantity: Column) -> Column:
    """The words of the caption on that quantity that are a unit of it."""
    out = F.lit(None).cast("string")
    low = F.lower(caption)
    for q, topic in CAPTION_TOPICS.items():
        units = _alias_pattern(q)
        after = rf"(?:^|[^\p{{L}}0-9])(?:{topic})(?![\p{{L}}0-9])[^;,]*?[\s(\[]({units})(?![\p{{L}}0-9/])"
        found = F.nullif(F.regexp_extract(low, after, 1), F.lit(""))
        if q == "share":
            throughout = rf"(?:^|[\s(\[])({units})\s+throughout\b"
            found = F.coalesce(F.nullif(F.regexp_extract(low, throughout, 1), F.lit("")), found)
        out = F.when(quantity == q, F.regexp_replace(found, r"\s+", " ")).otherwise(out)
    return out


def _names(metric_refs: DataFrame) -> list[str]:
    rows = metric_refs.select("metric_norm").where("metric_norm is not null").distinct().limit(TABLE_BOUND + 1).collect()
    if len(rows) > TABLE_BOUND:
        raise ValueError(f"metric_refs has more than {TABLE_BOUND} names")
    return sorted((r[0] for r in rows), key=len, reverse=True)


def convert(
    rows: DataFrame,
    unit_refs: DataFrame,
    metric_refs: DataFrame,
    key: list[str],
    value: str = "value_raw",
    metric: str = "metric",
    metric_norm: str | None = "metric_norm",
    caption: str | None = "table_caption",
    unit: str | None = "unit",
) -> DataFrame:
    """``key``, quantity, value, unit_code, stated_by, common_unit, common_value of each number."""
    spark = rows.sparkSession
    if unit_refs.limit(TABLE_BOUND + 1).count() > TABLE_BOUND:
        raise ValueError(f"unit_refs has more than {TABLE_BOUND} rows")
    text = lambda c: F.col(c) if c else F.lit(None).cast("string")
    norm = F.trim(F.regexp_replace(F.lower(F.coalesce(text(metric_norm), text(metric))), "[^a-z0-9]+", " "))
    names = _names(metric_refs)
    within = F.regexp_extract(norm, r"(?<![a-z0-9])(" + "|".join(map(re.escape, names)) + r")(?![a-z0-9])", 1) if names else F.lit("")
    name = F.when(norm.isin(names), norm).otherwise(within)
    base = rows.select(*key, text(value).alias("__value"), text(metric).alias("__metric"), text(caption).alias("__caption"), text(unit).alias("__unit"), name.alias("__name"))
    known = metric_refs.where("quantity is not null").select(F.col("metric_norm").alias("__name"), "quantity").dropDuplicates(["__name"])
    base = base.withColumn("value", number(F.col("__value"))).where("value is not null").join(F.broadcast(known), "__name")
    # The nearest statement first; the next is only read where those before it state nothing.
    words = {
        "value": _cleaned(F.when(F.col("__value").rlike(_PLAIN), "").otherwise(F.regexp_extract("__value", _AFTER, 6))),
        "metric": _cleaned(F.when(F.col("__metric").rlike(r"[,(\[/]|\s[iI][nN]\s"), F.regexp_extract("__metric", _METRIC_TAIL, 1)).otherwise("")),
        "caption": _caption_words(F.col("__caption"), F.col("quantity")),
        "unit": _cleaned(F.col("__unit")),
    }
    aliases = alias_table(spark)
    said, before = base, F.lit(True)
    for source, w in words.items():
        a = aliases.select("quantity", F.col("alias").alias(f"w_{source}"), F.col("unit_code").alias(f"u_{source}"))
        said = said.withColumn(f"w_{source}", F.when(before, w)).join(F.broadcast(a), ["quantity", f"w_{source}"], "left")
        before = before & F.col(f"u_{source}").isNull()
    units = unit_refs.select("quantity", "unit_code", "factor", "shift", "is_common").dropDuplicates(["quantity", "unit_code"])
    common = units.where("is_common").select("quantity", F.col("unit_code").alias("common_unit")).dropDuplicates(["quantity"])
    said = said.join(F.broadcast(common), "quantity")
    stated = [F.col(f"u_{s}") for s in ("value", "metric", "caption", "unit")]
    default = F.when((F.col("quantity") == "share") & (F.col("value") <= 1), "frac").otherwise(F.col("common_unit"))
    by = F.coalesce(*(F.when(F.col(f"u_{s}").isNotNull(), s) for s in ("value", "metric", "caption", "unit")), F.lit("default"))
    said = said.select(*key, "quantity", "value", F.coalesce(*stated, default).alias("unit_code"), by.alias("stated_by"), "common_unit")
    out = said.join(F.broadcast(units.drop("is_common")), ["quantity", "unit_code"])
    return out.select(*key, "quantity", "value", "unit_code", "stated_by", "common_unit", (F.col("value") * F.col("factor") + F.col("shift")).alias("common_value"))


def other_units(rows: DataFrame, unit_refs: DataFrame, metric_refs: DataFrame, key: str = "row_no") -> DataFrame:
    """(key, unit_code) of the rows whose number is in another than the common unit."""
    got = convert(rows, unit_refs, metric_refs, [key])
    return got.where(F.col("unit_code") != F.col("common_unit")).select(key, "unit_code").dropDuplicates()
