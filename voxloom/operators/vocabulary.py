"""Spans of known phrases in texts by an Aho-Corasick automaton over a table of phrases, built by the tasks."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.batches import arrow_udf
from voxloom.staging import staged

#: Phrases whose UTF-8 has at most so many bytes in all, with 64 for each, are one automaton and one broadcast; larger tables are cut.
PART_BYTES = 8 << 20
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string())]))
SPANS = "array<struct<start:int,end:int,type:string>>"
_BUILT: dict[int, tuple] = {}


def _automaton(shared):
    """The automaton of a broadcast, kept for the tasks of a worker; one at a time."""
    if id(shared) not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for phrase, kind in shared.value:
            made.add_word(phrase, (len(phrase), kind))
        if len(made):
            made.make_automaton()
        _BUILT[id(shared)] = shared, made
    return _BUILT[id(shared)][1]


def _alone(text: str, start: int, end: int) -> bool:
    """Neither a letter nor a digit stands before or behind."""
    return not (start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum())


def longest_at_each_place(text: str, automaton, whole_words: bool) -> dict[int, tuple[int, str]]:
    found: dict[int, tuple[int, str]] = {}
    if len(automaton):
        for last, (size, kind) in automaton.iter(text):
            start = last + 1 - size
            if (start not in found or found[start][0] < last + 1) and (not whole_words or _alone(text, start, last + 1)):
                found[start] = last + 1, kind
    return found


def leftmost_longest(found: dict[int, tuple[int, str]]) -> list[dict]:
    out, free = [], 0
    for start in sorted(found):
        end, kind = found[start]
        if start >= free:
            out.append({"start": start, "end": end, "type": kind})
            free = end
    return out


def _parts(phrases: DataFrame, limit: int) -> list[list[tuple[str, str]]]:
    """The phrases, cut by how they begin: by the first character, and by more of them where one would be too many."""
    weight = F.sum(F.octet_length("phrase") + 64)
    groups, waiting = [], [("", 1)]
    while waiting:
        head, depth = waiting.pop()
        own = phrases.where(F.startswith("phrase", F.lit(head)))
        for r in own.groupBy(F.substring("phrase", 1, depth).alias("head")).agg(weight.alias("n"), F.max(F.char_length("phrase")).alias("longest")).orderBy("head").toLocalIterator():
            if r["n"] > limit and r["longest"] > depth:
                waiting.append((r["head"], depth + 1))
            else:
                groups.append((r["head"], depth, r["n"]))
    parts: list[list] = []
    size = limit + 1
    for group in sorted(groups):
        if size + group[2] > limit:
            parts.append([])
            size = 0
        parts[-1].append(group)
        size += group[2]
    return parts


def vocabulary_spans(df: DataFrame, text: str, phrases: DataFrame, name: str = "spans", whole_words: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """df with the spans (start, end, type) of phrases in a text, in code points, for inject_spans: leftmost, of those the longest, without overlap.

    phrases: phrase, type; null and empty phrases are none, of a phrase with several types the first by name counts. whole_words: neither a letter nor a digit may stand before or behind. Case counts.
    A null text has null spans. A table of phrases that is larger than part_bytes is cut by first characters, each cut one pass over the texts; between passes a text carries the longest phrase at each of its places.
    """
    known = phrases.where("phrase <> ''").groupBy("phrase").agg(F.min("type").alias("type"))
    known = staged(known, "phrases")
    (size,) = known.agg(F.coalesce(F.sum(F.octet_length("phrase") + 64), F.lit(0))).first()
    if size <= part_bytes:
        return df.withColumn(name, _found(df, F.col(text), None, known, whole_words, True))
    parts = _parts(known, part_bytes)
    out, held = df, None
    for i, part in enumerate(parts):
        wanted = F.lit(False)
        for head, depth, _ in part:
            wanted = wanted | (F.substring("phrase", 1, depth) == head)
        last = i == len(parts) - 1
        out = out.withColumn(name, _found(df, F.col(text), None if held is None else F.col(name), known.where(wanted), whole_words, last))
        held = name
        if not last:
            out = staged(out, "spans")
    return out


def _found(df: DataFrame, text: Column, before: Column | None, phrases: DataFrame, whole_words: bool, last: bool) -> Column:
    shared = df.sparkSession.sparkContext.broadcast([(r["phrase"], r["type"]) for r in phrases.toLocalIterator()])  # about part_bytes

    @arrow_udf(SPANS)
    def spans(texts: pa.Array, old: pa.Array) -> pa.Array:
        automaton, out = _automaton(shared), []
        for t, some in zip(texts.to_pylist(), old.to_pylist()):
            if t is None:
                out.append(None)
                continue
            found = longest_at_each_place(t, automaton, whole_words)
            for s in some or ():
                if s["start"] not in found or found[s["start"]][0] < s["end"]:
                    found[s["start"]] = s["end"], s["type"]
            out.append(leftmost_longest(found) if last else [{"start": a, "end": b, "type": k} for a, (b, k) in found.items()])
        return pa.array(out, _SPAN)

    return spans(text.cast("string"), F.lit(None).cast(SPANS) if before is None else before)
