"""Paper-local unit ids: alias prefixes and slugs as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioweave.functions.vocab import ID_ALIASES


def slug(part: Column) -> Column:
    """Lower case, runs outside ``[a-z0-9_]`` to one ``_``, outer ``_`` removed."""
    return F.regexp_replace(F.regexp_replace(F.lower(part), "[^a-z0-9_]+", "_"), "^_+|_+$", "")


def _present_prefix(head: Column) -> Column:
    """The present form of a retired prefix, any other prefix as it is."""
    out = F.when(F.lit(False), head)
    for retired, present in ID_ALIASES.items():
        out = out.when(head == retired, F.lit(present))
    return out.otherwise(head)


def alias_prefix(id_: Column) -> Column:
    """A retired prefix before the first colon becomes its present form."""
    head = F.substring_index(id_, ":", 1)
    return F.when(id_.contains(":"), F.concat(_present_prefix(head), F.substr(id_, F.length(head) + 1))).otherwise(id_)


#: Ids that are canonical as they stand, by far the most.
_CANONICAL = rf"^(?!(?:{'|'.join(map(re.escape, ID_ALIASES))}):)[^:]*:[a-z0-9](?:[a-z0-9_]*[a-z0-9])?\z"


def canonical(id_: Column) -> Column:
    """N4, then N3 on what follows the first colon; an id without a colon stays as it is.

    Where nothing of the part after the colon can be kept, it stays as written.
    """
    head = F.substring_index(id_, ":", 1)
    rest = F.substr(id_, F.length(head) + 2)
    written = F.concat(_present_prefix(head), F.lit(":"), F.coalesce(F.nullif(slug(rest), F.lit("")), rest))
    return F.when(~id_.contains(":") | id_.rlike(_CANONICAL), id_).otherwise(written)


def is_blank(c: Column) -> Column:
    """Null, empty or white space only (Unicode)."""
    return F.coalesce(~c.rlike(r"(?U)\S"), F.lit(True))
