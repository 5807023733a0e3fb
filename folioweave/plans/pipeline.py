"""The retrofit of a corpus (K6, K10) and its legacy marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.functions import vocab


def gated(records: DataFrame, accepted: tuple[str, ...] = vocab.ACCEPTED_VERSIONS) -> DataFrame:
    """K6: records of the accepted versions; the others stay as they are."""
    return records.where(F.col("ir_version").isin(*accepted))


def restamped(records: DataFrame, changed: DataFrame, version: str, old: tuple[str, ...] = ("section-ir-0.12", "section-ir-0.13")) -> DataFrame:
    """The new version on records of the old ones that a retrofit changed."""
    flag = changed.select("record_no").dropDuplicates().withColumn("__c", F.lit(True))
    new = F.when(F.col("__c") & F.col("ir_version").isin(*old), F.lit(version)).otherwise(F.col("ir_version"))
    return records.join(flag, "record_no", "left").withColumn("ir_version", new).drop("__c")


def legacy_marks(payload):
    """Whether a record holds a ``paradigm_tags`` key, or a retired type under ``type``, ``unit_type`` or ``node_type``, at
    any depth. The payload is parsed and written again, so that every text in it is escaped: a key or value that only
    stands inside a text has a backslash before its quotation marks."""
    flat = F.try_parse_json(payload).cast("string")
    retired = "|".join(vocab.RETIRED_TYPES)
    return F.coalesce(flat.rlike(rf'(?<!\\)"paradigm_tags":|(?<!\\)"(?:type|unit_type|node_type)":"(?:{retired})"'), F.lit(False))
