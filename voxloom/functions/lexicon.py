"""Small vocabularies as tables: entity types, intents, and codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from voxloom.functions.buckets import EMOTIONS, GENDERS

#: Entity types to begin with; a domain adds its own. Not a closed list: no operator drops a type that is not in it.
ENTITY_TYPES = ("PERSON_NAME", "ORGANIZATION", "LOCATION", "CITY", "STATE", "COUNTRY", "ADDRESS", "DATE", "TIME", "DURATION", "AGE", "CARDINAL", "ORDINAL", "PERCENT", "MONEY", "CURRENCY", "PRODUCT", "EVENT", "LANGUAGE", "NATIONALITY", "OCCUPATION", "PHONE_NUMBER", "EMAIL", "URL")
INTENTS = ("INFORM", "QUESTION", "REQUEST", "COMMAND", "GREETING", "CONFIRMATION", "NEGATION", "OPINION", "EXPLAIN", "OTHER")


def entity_types(spark: SparkSession, extra: Iterable[str] = ()) -> DataFrame:
    """type and tag of every entity type."""
    kinds = dict.fromkeys([*ENTITY_TYPES, *(e.strip().upper().replace(" ", "_") for e in extra)])
    return spark.createDataFrame([(k, f"ENTITY_{k}") for k in kinds], "type string, tag string")


def intents(spark: SparkSession, extra: Iterable[str] = ()) -> DataFrame:
    return spark.createDataFrame([(k, f"INTENT_{k}") for k in dict.fromkeys([*INTENTS, *extra])], "intent string, tag string")


def codes(spark: SparkSession) -> DataFrame:
    """kind, code, label of gender and emotion codes."""
    rows = [(f"gender/{c}", str(k), v) for c, table in GENDERS.items() for k, v in table.items()] + [("emotion", k, v) for k, v in EMOTIONS.items()]
    return spark.createDataFrame(rows, "kind string, code string, label string")
