"""Repair of malformed JSON lines as Column expressions: every rule gives a candidate, and the first that parses is taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parses(c: Column) -> Column:
    """Whether c is exactly one JSON value: the parser alone would overlook what follows on the first."""
    v = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.coalesce(F.try_variant_get(v, "$[0]", "variant").isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull(), F.lit(False))


def parsed(c: Column) -> Column:
    """The value as a variant; null if it isn't exactly one."""
    return F.when(parses(c), F.try_parse_json(c))


def duration_inside(line: Column) -> Column:
    """{...}, "duration": d} with the duration moved into the object; else the head with the duration grafted on."""
    moved = F.replace(line, F.lit('}, "duration":'), F.lit(', "duration":'))
    head = F.concat(F.substring_index(line, '}, "duration":', 1), F.lit("}"))
    tail = F.trim(F.regexp_replace(F.substring_index(line, '}, "duration":', -1), r"^\}+|\}+$", ""))
    grafted = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(', "duration": '), tail, F.lit("}"))
    return F.when(line.contains('}, "duration":'), F.coalesce(F.when(parses(moved), moved), F.when(parses(head) & tail.rlike(r"^[0-9.eE+-]+$"), grafted)))


def balanced(line: Column) -> Column:
    """An open quote closed, missing braces added, commas before braces out."""
    c = F.trim(line)
    count = lambda x, mark: F.length(x) - F.length(F.replace(x, F.lit(mark), F.lit("")))
    quoted = F.when(count(c, '"') % 2 == 1, F.concat(c, F.lit('"'))).otherwise(c)
    missing = F.greatest(count(quoted, "{") - count(quoted, "}"), F.lit(0))
    return F.regexp_replace(F.concat(quoted, F.repeat(F.lit("}"), missing)), r",\s*\}", "}")


def repaired(line: Column) -> Column:
    """The line itself if it parses, else the first repair that does; null if none does."""
    closed = balanced(line)
    return F.coalesce(F.when(parses(line), line), duration_inside(line), F.when(parses(closed), closed))


def split_concatenated(df: DataFrame, value: str = "value") -> DataFrame:
    """}{ between objects split into rows; part counts them from 0."""
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, F.posexplode(F.split(F.trim(value), r"(?<=\})\s*(?=\{)")).alias("part", value))


def salvage_entities(line: Column) -> Column:
    """The line with those objects of its entities array that parse."""
    head = F.concat(F.substring_index(line, '"entities": [', 1), F.lit('"entities": ['))
    rest = F.substring_index(line, '"entities": [', -1)
    inner, tail = F.substring_index(rest, "]", 1), F.substr(rest, F.length(F.substring_index(rest, "]", 1)) + 1)
    objects = F.filter(F.transform(F.split(inner, r"(?<=\})\s*,\s*"), lambda x: F.trim(x)), lambda x: (x != "") & parses(x))
    return F.when(line.contains('"entities": ['), F.concat(head, F.array_join(objects, ", "), tail)).otherwise(line)


def from_error_log(line: Column) -> Column:
    """struct(text, duration) of a logged line: annotated_sentence before text; the last duration, or 0."""
    pick = lambda k: F.nullif(F.regexp_extract(line, rf'(?s)"{k}"\s*:\s*"(.*?)(?<!\\)"', 1), F.lit(""))
    durations = F.regexp_extract_all(line, F.lit(r'"duration"\s*:\s*([0-9.]+)'), 1)
    return F.struct(F.coalesce(pick("annotated_sentence"), pick("text")).alias("text"), F.coalesce(F.try_element_at(durations, F.lit(-1)).cast("double"), F.lit(0.0)).alias("duration"))


def clean_reply(reply: Column) -> Column:
    """A model's reply as a JSON array: fences out, from the first brace or bracket to the last, }}] to }], {"sentences": [..]} unwrapped, one object wrapped."""
    c = F.trim(F.regexp_replace(reply, r"```(?:json)?", ""))
    c = F.regexp_extract(c, r"(?s)([\[{].*[\]}])", 1)
    c = F.regexp_replace(c, r"\}\s*\}\s*\]", "}]")
    c = F.coalesce(F.nullif(F.regexp_extract(c, r'(?s)^\{\s*"sentences"\s*:\s*(\[.*\])\s*\}?$', 1), F.lit("")), c)
    return F.when(c.startswith("{"), F.concat(F.lit("["), c, F.lit("]"))).when(c != "", c)


def route_lines(df: DataFrame, value: str = "value", number: str = "line_number") -> DataFrame:
    """Every line with a route (ok, no_duration, error, blank), its fields, and for errors the type and a snippet."""
    from voxloom.sources.manifests import polymorphic_text

    said = polymorphic_text(F.col(value))
    v = parsed(F.col(value))
    duration = F.try_variant_get(v, "$.duration", "double")
    blank = F.trim(F.coalesce(F.col(value), F.lit(""))) == ""
    route = F.when(blank, "blank").when(said["error"].isNotNull(), "error").when(duration.isNull(), "no_duration").otherwise("ok")
    out = df.select(number, route.alias("route"), F.try_variant_get(v, "$.audio_filepath", "string").alias("audio_filepath"), said["text"].alias("text"), duration.alias("duration"), F.when(route == "error", said["error"]).alias("error"), F.when(route == "error", F.substring(value, 1, 250)).alias("snippet"))
    return out
