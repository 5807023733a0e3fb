r"""Row-level functions as Column expressions; N-numbers are those of the operator inventory.

Python-side regular expressions know Unicode white space, so ``(?U)`` is used wherever that can
matter. Null handling: a null (or wrong-typed, read as null) input gives '' for normalisers, null
for parsers and an empty array for splitters.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
CITE_STOPWORDS = ("et", "al", "and", "the")
CODE_HOSTS = ("github.com", "gitlab.com", "bitbucket.org", "4open.science", "codeberg.org")
DATA_HOSTS = ("zenodo.org", "figshare.com", "kaggle.com")
RATES_PER_MILLION = {"uncached": 1.0, "cached": 0.1, "completion": 4.0}


def truthy(c: Column, kind: str = "string") -> Column:
    """Python truthiness: null, '' , [] and 0 are false."""
    empty = {"string": c == "", "array": F.size(c) == 0, "number": c == 0, "boolean": ~c}[kind]
    return c.isNotNull() & ~empty


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_name(c: Column) -> Column:
    """Lower case, runs of [a-z0-9] joined by one blank; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def normalize_cite_key(c: Column) -> Column:
    """Digits of a bracketed number; first author, year and letter; else the bare key."""
    s = strip(c)
    bare = F.lower(F.regexp_replace(s, r"(?U)[\[\]\s]+", ""))
    year = r"(1[89][0-9][0-9]|20[0-9][0-9])([a-z])?"
    before = F.regexp_extract(s, rf"(?s)^(.*?){year}", 1)
    author = F.get(F.filter(F.regexp_extract_all(before, F.lit(r"([A-Za-z][A-Za-z\-]*)"), F.lit(1)), lambda t: ~F.lower(t).isin(*CITE_STOPWORDS)), F.lit(0))
    first = F.regexp_replace(F.lower(author), "[^a-z0-9]", "")
    dated = F.concat(first, F.regexp_extract(s, year, 1), F.regexp_extract(s, year, 2))
    out = F.when(s.rlike(r"(?U)^\[?\s*[0-9]+\s*\]?$"), bare).when(s.rlike(year) & (F.length(first) > 0), dated).otherwise(bare)
    return F.coalesce(out, F.lit(""))


def canon_marker(c: Column) -> Column:
    """``§N`` from ``N``, ``[§N]``, ``§N``; blank gives ''."""
    m = strip(c)
    m = F.when(m.rlike(r"(?s)^\[.*\]$"), strip(F.regexp_replace(m, r"(?s)^\[(.*)\]$", "$1"))).otherwise(m)
    m = strip(F.regexp_replace(m, "^§+", ""))
    return F.when(F.length(m) > 0, F.concat(F.lit("§"), m)).otherwise(F.lit(""))


# A number in a score text: a sign, digits that commas may group, a fraction, an exponent in either notation.
_SIGN, _COUNT, _FRACTION = "[+-]?", "[0-9][0-9,]*", r"\.[0-9]+"
_TIMES_TEN = r"\s*[x×*]\s*10\s*(?:\^|\*\*)?\s*"
_LEAD = rf"^({_SIGN}(?:{_COUNT}(?:{_FRACTION})?|{_FRACTION})(?:[eE]{_SIGN}[0-9]+)?)"
_SCI = rf"^({_SIGN}[0-9]+(?:{_FRACTION})?){_TIMES_TEN}\(?({_SIGN}[0-9]+)\)?"


def parse_value_num(c: Column) -> Column:
    """The number a score text starts with, or null where prose comes first."""
    t = F.regexp_replace(F.regexp_replace(strip(c), "[−–]", "-"), r"^[≈~<>≤≥±$ \t]+", "")
    sci = F.concat(F.regexp_extract(t, _SCI, 1), F.lit("e"), F.regexp_extract(t, _SCI, 2))
    lead = F.regexp_replace(F.regexp_extract(t, _LEAD, 1), ",", "")
    return F.when(t.rlike(_SCI), sci.try_cast("double")).otherwise(F.nullif(lead, F.lit("")).try_cast("double"))


def numeric_values(c: Column) -> Column:
    """N7 as doubles: every number token of a text, in order."""
    t = F.regexp_replace(c, "[−–—]", "-")
    tokens = F.regexp_extract_all(t, F.lit(r"([-+]?(?:[0-9][0-9,]*\.?[0-9]*|\.[0-9]+))"), F.lit(1))
    clean = F.transform(tokens, lambda x: F.regexp_replace(F.regexp_replace(x, ",", ""), r"\.+$", "").try_cast("double"))
    return F.coalesce(F.array_compact(clean), F.array().cast("array<double>"))


def number_key(x: float) -> str:
    """The canonical key of a number."""
    return f"{x:.10g}"


def coerce_year(c: Column) -> Column:
    """The first year 1800-2099 in a text."""
    return F.regexp_extract(c, "(1[89][0-9][0-9]|20[0-9][0-9])", 1).try_cast("int")


# The parts of a paper id: a running number, a venue, a year, each followed by "_".
_RUNNING, _VENUE, _YEAR_PART = "[0-9]+_", "([A-Za-z][A-Za-z0-9-]*)_", "((?:19|20)[0-9]{2})"
_DIRNAME = rf"^(?:{_RUNNING})?(?:{_VENUE})?{_YEAR_PART}(?=[_-]|$)"


def dirname_venue(c: Column) -> Column:
    """The venue token of a paper id, or null."""
    return F.nullif(F.regexp_extract(c, _DIRNAME, 1), F.lit(""))


def dirname_year(c: Column) -> Column:
    return F.regexp_extract(c, _DIRNAME, 2).try_cast("int")


def url_host(c: Column) -> Column:
    """Lower-case authority (port and user kept) without a leading www."""
    u = strip(c)
    full = F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))
    host = F.lower(F.regexp_extract(full, r"^[^:/?#]+://([^/?#]*)", 1))
    return F.coalesce(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def is_release_host(host: Column, hosts: tuple[str, ...]) -> Column:
    """Equal to a known host or below it."""
    return F.coalesce(reduce(lambda a, b: a | b, ((host == h) | host.endswith(f".{h}") for h in hosts)), F.lit(False))


def derive_aliases(c: Column) -> Column:
    """[long, short] of 'Long Form (SHORT)', else an empty array."""
    rx = r"(?s)^(.+?)\s*\(([^()]{1,40})\)\s*$"
    s = strip(c)
    long_, short = strip(F.regexp_extract(s, rx, 1)), strip(F.regexp_extract(s, rx, 2))
    ok = (F.length(long_) > 0) & (F.length(short) > 0) & (F.size(F.split(short, r"(?U)\s+")) <= 3) & short.rlike("[A-Z0-9]")
    return F.when(ok, F.array(long_, short)).otherwise(F.array().cast("array<string>"))


def sanitize_text(c: Column) -> Column:
    """Control characters to blanks, runs of blanks and tabs collapsed, outer white space cut."""
    x = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    return strip(F.regexp_replace(x, r"[ \t]{2,}", " "))


def formula_key(c: Column) -> Column:
    """An expression without white space."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def cache_key(model: Column, content: Column) -> Column:
    """Sanitised model name and 16 hex digits of the content digest."""
    return F.concat(F.regexp_replace(model, "[^A-Za-z0-9]+", "-"), F.lit(":"), F.substring(F.sha2(content, 256), 1, 16))


def long_tokens(c: Column) -> Column:
    """The distinct words of more than three characters, lower case."""
    return F.array_distinct(F.filter(F.split(normalize_name(c), " "), lambda w: F.length(w) > 3))


def headline_overlap(a: Column, b: Column) -> Column:
    """Number of long words that two texts share."""
    return F.size(F.array_intersect(long_tokens(a), long_tokens(b)))


def card_text(type_: Column, description: Column, statement: Column, effect: Column, headline: Column, unit: Column, fallback: Column) -> Column:
    """The text of a card by unit type."""
    filled = lambda *cs: F.coalesce(*(F.nullif(c, F.lit("")) for c in cs), F.lit(""))
    finding = F.when(truthy(effect), F.concat(filled(statement), F.lit(" (effect: "), effect, F.lit(")"))).otherwise(filled(statement))
    measure = filled(headline, fallback)
    measure = F.when(truthy(unit) & (unit != "unitless"), F.concat(measure, F.lit(" [unit: "), unit, F.lit("]"))).otherwise(measure)
    return F.when(type_ == "Finding", finding).when(type_ == "Measure", measure).otherwise(filled(description, fallback))


def embed_text(title: Column, paper_id: Column, type_: Column, kind: Column, name: Column, text: Column) -> Column:
    head = F.when(truthy(kind), F.concat_ws("/", type_, kind)).otherwise(type_)
    base = F.concat(F.coalesce(F.nullif(title, F.lit("")), paper_id), F.lit(" | "), head, F.lit(": "), name)
    return F.when(truthy(text), F.concat(base, F.lit(" — "), text)).otherwise(base)


def unit_label(name: Column, statement: Column, description: Column, id_: Column, width: int = 70) -> Column:
    """The first filled of four fields, cut to ``width`` characters with an ellipsis."""
    x = F.coalesce(*(F.nullif(c, F.lit("")) for c in (name, statement, description)), id_)
    return F.when(F.length(x) > width, F.concat(F.left(x, F.lit(width)), F.lit("…"))).otherwise(x)


def alnum_only(c: Column) -> Column:
    """Unicode letters and digits, lower case."""
    return F.coalesce(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", "")), F.lit(""))


# The words that name a float or statement of a paper.
FLOAT_WORDS = (
    "Table", "Figure", "Fig", "Algorithm", "Alg", "Equation", "Eq", "Listing", "Theorem", "Lemma", "Corollary",
    "Proposition", "Definition", "Assumption", "Claim", "Remark", "Observation", "Proof",
)
FLOAT_MARKER = rf"(?:{'|'.join(FLOAT_WORDS)})\.?\s+[A-Za-z0-9][\w.()-]*(?:\s*\([^)]*\))?"
MARKER_GRAMMAR = rf"(?i)^(?:§(?:[0-9]+|[A-Za-z]+)|{FLOAT_MARKER})$"


def is_marker(c: Column) -> Column:
    """Whether a provenance marker follows the grammar."""
    return F.coalesce(c.rlike(MARKER_GRAMMAR), F.lit(False))


def feedback_suffix(c: Column) -> Column:
    """An error text on one line, at most 200 characters."""
    return F.left(F.regexp_replace(strip(c), r"(?U)\s+", " "), F.lit(200))


def paper_key(path: Column) -> Column:
    """The logical paper of a file: its stem, or its folder where the stem is a number or a fixed stage name."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(stem.rlike(r"^[0-9]+(_[a-z]+)?$") & (F.length(parent) > 0), parent).otherwise(stem)


TITLE_STOPWORDS = ("with", "from", "that", "this", "using", "based", "towards", "learning")


def title_prefixes(c: Column) -> Column:
    """Distinct five-character prefixes of the words of four characters or more."""
    w = F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda x: (F.length(x) >= 4) & ~x.isin(*TITLE_STOPWORDS))
    return F.array_distinct(F.transform(w, lambda x: F.left(x, F.lit(5))))


def effective_cost(prompt: Column, cached: Column, completion: Column) -> Column:
    """Uncached prompt tokens and four times the completion tokens."""
    return prompt - cached + 4 * completion


def dollars(prompt: Column, cached: Column, completion: Column, rates: dict[str, float] = RATES_PER_MILLION) -> Column:
    return ((prompt - cached) * rates["uncached"] + cached * rates["cached"] + completion * rates["completion"]) / 1e6


def compact_number(c: Column) -> Column:
    """Thousands as K with one decimal."""
    return F.when(c >= 1000, F.concat(F.format_number(c / 1000, 1), F.lit("K"))).otherwise(c.cast("string"))


def marker_order(c: Column) -> Column:
    """The sort key of a §-marker: its first number, else a large one."""
    return F.coalesce(F.regexp_extract(c, "([0-9]+)", 1).try_cast("bigint"), F.lit(1_000_000_000))


def mapped(c: Column, values: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items()))), c)
