"""Predicates over manifests. A predicate is a Column that is never null, so that its complement is exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def ascii_only(c: Column) -> Column:
    return _sure(~c.rlike(r"[^\x00-\x7F]"))


def has_text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def lacks_duration(c: Column) -> Column:
    return c.isNull()


def has_p_pattern(c: Column, strict: bool = False) -> Column:
    """P noise: P p p runs, quoted or bracketed P, a P alone or next to a mark. strict adds every word that begins with p."""
    patterns = [r"(?U)\bP\s+p\s+p\s+p\s+p\s+p\b", r"(?U)\bP\s+P\s+P\b", r"(?U)\bP\s+p\s+p\b", r"(?U)\bP\s+p\b", r'"P"', r"\(P\)", r"(?U)\bp\s+p\s+p\b", r"(?U)\b\s+p\s+p\s+p\s+p\s+p\b"]
    hit = F.lit(False)
    for p in [*patterns, *([r"(?U)\bp"] if strict else [])]:
        hit = hit | c.rlike(p)
    # The letter P by itself, and beside marks.
    near = F.trim(c).rlike(r"(?U)^P$|[.!?,:;]\s+P(?!\S)|(?<!\S)P\s+[.!?,:;]")
    return _sure(hit | (c.rlike(r"(?U)\bP\b") & near))


def complete(path: Column, text: Column, duration: Column, suffix: str | None = None) -> Column:
    """A path (with a suffix), a text that isn't blank, and a numeric duration above 0."""
    ok = has_text(path) & has_text(text) & _sure(duration.try_cast("double") > 0)
    return ok & _sure(path.endswith(suffix)) if suffix else ok


def long_enough(seconds: Column, least: float = 1.0) -> Column:
    return _sure(seconds >= least)


def duration_mismatch(stated: Column, measured: Column, tolerance: float = 0.5) -> Column:
    """A warning, not a filter."""
    return _sure(F.abs(stated - measured) > tolerance)


def usable_duration(c: Column) -> Column:
    """The duration as a number, -1 if it isn't one."""
    return F.coalesce(c.try_cast("double"), F.lit(-1.0))


def rare_words(df: DataFrame, text: str, vocabulary: DataFrame, word: str = "word", below: int = 10, least_length: int = 3) -> DataFrame:
    """(word, n): words of the corpus that are in the vocabulary, occur fewer than below times and are long enough."""
    words = df.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") < below).join(vocabulary.select(F.col(word).alias("word")).distinct(), "word", "left_semi")
