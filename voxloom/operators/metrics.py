"""Recognition quality: word and character error rates, entity scores, confusion."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.batches import arrow_udf
from voxloom.functions.buckets import safe_divide
from voxloom.functions.tags import drop_upper_words, entity_spans
from voxloom.staging import staged


def _letters(words: list[str], known: dict[str, int]) -> str:
    """Words as one character each, numbered in a pair's own alphabet. Surrogates are no characters, so numbers from 0xD700 up go behind them."""
    try:
        return "".join([chr(n + 0x100 if n < 0xD700 else n + 0x900) for n in [known.setdefault(w, len(known)) for w in words]])
    except ValueError:
        raise ValueError(f"a pair of texts has {len(known)} different words, more than there are characters to number them") from None


#: Symbols that one number holds as bits.
BLOCK = 8192


def distance(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """The least insertions, deletions and substitutions that make b of a.

    Equal ends don't take part. Of the rest, the longer one is cut into blocks whose symbols are the bits of one number (Myers, Hyyrö): for each symbol of
    the shorter one a few operations on it find a whole column of a block, and what its last place adds to the column before goes on to the next block.
    Memory is in proportion to both, and BLOCK * BLOCK bits.
    """
    short = min(len(a), len(b))
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), short)
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), short)
    tail = min(tail, short - head)
    b, a = sorted((a[head : len(a) - tail], b[head : len(b) - tail]), key=len)
    added = [1] * len(b)
    for at in range(0, len(a) if b else 0, BLOCK):
        places: dict[Hashable, int] = {}
        size = 0
        for x in a[at : at + BLOCK]:
            places[x] = places.get(x, 0) | 1 << size
            size += 1
        full, last = (1 << size) - 1, size - 1
        more, less = full, 0  # where a place has one more or one less than the place before
        for i, (y, above) in enumerate(zip(b, added)):
            same = places.get(y, 0)
            down = same | less
            if above < 0:
                same |= 1
            across = (((same & more) + more ^ more) | same) & full
            rises, falls = less | full ^ (across | more), more & across
            added[i] = (rises >> last) - (falls >> last)
            rises, falls = (rises << 1 | (above > 0)) & full, (falls << 1 | (above < 0)) & full
            more, less = falls | full ^ (down | rises), rises & down
    return len(a) + sum(added) if b else len(a)


def _edits(cut: Callable[[str], Sequence[str]]) -> Callable[..., Column]:
    """An Arrow UDF: edits, units and heard of two texts that cut takes apart."""

    @arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("edits", "units", "heard")]))
    def edits(refs: pa.Array, hyps: pa.Array) -> pa.Array:
        rows = []
        for r, h in zip(refs.to_pylist(), hyps.to_pylist()):
            r, h = cut(r or ""), cut(h or "")
            rows.append((distance(r, h), len(r), len(h)))
        return pa.StructArray.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(3)], ["edits", "units", "heard"])

    return edits


word_edits, char_edits = _edits(str.split), _edits(str)


def with_edits(df: DataFrame, ref: str, hyp: str, chars: bool = False) -> DataFrame:
    """edits, units and heard (words or characters of the reference and of the hypothesis) of each pair. Null and blank texts have no words. For time and memory see distance."""
    r, h = (F.col(c).cast("string") for c in (ref, hyp))
    e = char_edits(*[F.regexp_replace(c, r"\s+", " ") for c in (r, h)]) if chars else word_edits(r, h)
    return df.withColumn("_e", e).withColumns({c: F.col("_e")[c] for c in ("edits", "units", "heard")}).drop("_e")


def error_rate(df: DataFrame, ref: str, hyp: str, by: list[str] = (), chars: bool = False) -> DataFrame:
    """Micro rate by groups: sums of edits and units, rate = edits / units, infinite if there are no units."""
    return with_edits(df, ref, hyp, chars).groupBy(*by).agg(F.sum("edits").alias("edits"), F.sum("units").alias("units")).withColumn("rate", F.when(F.col("units") > 0, F.col("edits") / F.col("units")).otherwise(F.lit(float("inf"))))


def utterance_rates(df: DataFrame, ref: str, hyp: str) -> DataFrame:
    """rate of each pair: edits / words; infinite for an empty reference with a hypothesis, null if both are empty."""
    e = with_edits(df, ref, hyp)
    return e.withColumn("rate", F.when(F.col("units") > 0, F.col("edits") / F.col("units")).when(F.col("edits") > 0, F.lit(float("inf"))))


def macro_rate(df: DataFrame, ref: str, hyp: str, by: list[str] = ()) -> DataFrame:
    """Mean rate over pairs whose texts are both not blank."""
    return with_edits(df, ref, hyp).where("units > 0 and heard > 0").groupBy(*by).agg(F.avg(F.col("edits") / F.col("units")).alias("rate"), F.count("*").alias("pairs"))


def alignment(r: str, h: str) -> tuple[int, int, int]:
    """Insertions, deletions and substitutions of the best alignment that a walk back from the ends finds, which at every place takes a substitution (or equal characters) if one is best, else a deletion, else an insertion.

    Only the last row of distances is held, with the substitutions on the walk from each place: from them and the distance the
    others follow. Equal ends don't take part, since the walk takes them as they are.
    """
    same = next((i for i, (x, y) in enumerate(zip(reversed(r), reversed(h))) if x != y), min(len(r), len(h)))
    a, b = (np.frombuffer(x[: len(x) - same].encode("utf-32-le"), np.int32) for x in (r, h))
    at = np.arange(len(b) + 1)
    last, subs = at, np.zeros(len(b) + 1, np.int64)
    for i, x in enumerate(a.tolist(), 1):
        cost = (b != x).astype(np.int64)
        down, across = last + 1, last[:-1] + cost
        row = down.copy()
        np.minimum(across, down[1:], out=row[1:])
        row = np.minimum.accumulate(row - at) + at
        own = row == down  # a deletion, or the first column
        walked = np.where(own, subs, 0)
        crossed = row[1:] == across
        walked[1:] = np.where(crossed, subs[:-1] + cost, walked[1:])
        own[1:] |= crossed
        last, subs = row, walked[np.maximum.accumulate(np.where(own, at, 0))]  # an insertion goes on from the place to its left
    edits, substituted, longer = int(last[-1]), int(subs[-1]), len(b) - len(a)
    return (edits - substituted + longer) // 2, (edits - substituted - longer) // 2, substituted


def edit_kinds(df: DataFrame, ref: str, hyp: str) -> DataFrame:
    """insertions, deletions, substitutions of a best alignment of the words of each pair (see alignment), and units, the words of the reference."""
    kind = "struct<insertions:bigint,deletions:bigint,substitutions:bigint,units:bigint>"

    @arrow_udf(kind)
    def aligned(refs: pa.Array, hyps: pa.Array) -> pa.Array:
        rows = []
        for r, h in zip(refs.to_pylist(), hyps.to_pylist()):
            known: dict[str, int] = {}
            r, h = _letters((r or "").split(), known), _letters((h or "").split(), known)
            rows.append((*alignment(r, h), len(r)))
        return pa.StructArray.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(4)], ["insertions", "deletions", "substitutions", "units"])

    return df.withColumn("_k", aligned(F.col(ref).cast("string"), F.col(hyp).cast("string"))).select(*df.columns, "_k.*")


def error_detail(df: DataFrame, ref: str, hyp: str, by: list[str] = ()) -> DataFrame:
    """Rates of insertions, deletions and substitutions over reference words, by groups."""
    sums = edit_kinds(df, ref, hyp).groupBy(*by).agg(*[F.sum(k).alias(k) for k in ("insertions", "deletions", "substitutions", "units")])
    return sums.withColumns({k[:3] + "_rate": safe_divide(F.col(k).cast("double"), F.col("units")) for k in ("insertions", "deletions", "substitutions")})


def ner_counts(df: DataFrame, key: str, ref: str, hyp: str, reset: bool = True, by_label: bool = False, vocabulary: tuple[str, ...] | None = None) -> DataFrame:
    """tp, gt, pred per label over tagged texts: spans (label, phrase, occ) of the same row meet in an equi full join.

    by_label: spans count by their label alone, whatever their phrases. vocabulary: only these tags open spans.
    """
    spans = lambda c, flag: df.select(key, F.inline(entity_spans(F.col(c), reset, by_label, vocabulary))).withColumn(flag, F.lit(1))
    both = spans(ref, "gt").join(spans(hyp, "pred"), [key, "label", "phrase", "occ"], "full")
    return both.groupBy("label").agg(F.count("gt").alias("gt"), F.count("pred").alias("pred"), F.count(F.when(F.col("gt").isNotNull() & F.col("pred").isNotNull(), 1)).alias("tp"))


def scores(counts: DataFrame) -> DataFrame:
    """precision, recall, fscore from tp, gt, pred; 0 where nothing is to divide by."""
    p, r = safe_divide(F.col("tp").cast("double"), F.col("pred")), safe_divide(F.col("tp").cast("double"), F.col("gt"))
    return counts.withColumns({"precision": p, "recall": r}).withColumn("fscore", safe_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def ner_scores(df: DataFrame, key: str, ref: str, hyp: str, reset: bool = True, by_label: bool = False, vocabulary: tuple[str, ...] | None = None) -> DataFrame:
    """One row per label, and overall_micro and overall_macro (whose counts are the sums; NaN without labels is null here).

    The counts, a row a label, are staged: the texts are parsed once for all three.
    """
    per = staged(ner_counts(df, key, ref, hyp, reset, by_label, vocabulary), "ner")
    labelled = scores(per)
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gt", "pred", "tp")])
    micro = scores(total.select(F.lit("overall_micro").alias("label"), "gt", "pred", "tp"))
    macro = labelled.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gt", "pred", "tp")], *[F.avg(c).alias(c) for c in ("precision", "recall", "fscore")]).select(F.lit("overall_macro").alias("label"), "gt", "pred", "tp", "precision", "recall", "fscore")
    return labelled.select(*macro.columns).unionByName(micro.select(*macro.columns)).unionByName(macro)


def evaluation(df: DataFrame, key: str, ref: str, hyp: str, reset: bool = True, by_label: bool = False, vocabulary: tuple[str, ...] | None = None, chars: bool = False) -> DataFrame:
    """The composite report, as (metric, value): wer or cer of the texts without their upper-case words, then precision, recall and fscore of each label and overall of the tagged texts."""
    plain = df.select(key, drop_upper_words(F.coalesce(F.col(ref), F.lit(""))).alias("r"), drop_upper_words(F.coalesce(F.col(hyp), F.lit(""))).alias("h"))
    rate = error_rate(plain, "r", "h", chars=chars).select(F.lit("cer" if chars else "wer").alias("metric"), F.col("rate").alias("value"))
    found = ner_scores(df, key, ref, hyp, reset, by_label, vocabulary)
    values = F.array(*[F.struct(F.concat_ws(".", "label", F.lit(m)).alias("metric"), F.col(m).alias("value")) for m in ("precision", "recall", "fscore")])
    return rate.unionByName(found.select(F.inline(values)))


def same_length(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The positional zip of two lists as a join on their row key; an error if a row of one has no partner in the other."""
    a, b = (df.withColumn(f"_{n}", F.lit(True)) for n, df in (("a", left), ("b", right)))
    whole = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return a.join(b, key, "full").where(F.when(whole, True).otherwise(F.raise_error(F.lit("the lists differ in length")).cast("boolean"))).drop("_a", "_b")


def confusion(df: DataFrame, ref: str, hyp: str, families: tuple[str, ...] = ("AGE", "GER", "EMOTION", "INTENT")) -> DataFrame:
    """family, actual, predicted, n: the first tag of each family on either side; pairs in which one lacks it are dropped."""
    first = lambda c, f: F.nullif(F.regexp_extract(c, rf"\b({f}_[A-Z0-9_]+)", 1), F.lit(""))
    pairs = F.array(*[F.struct(F.lit(f).alias("family"), first(F.col(ref), f).alias("actual"), first(F.col(hyp), f).alias("predicted")) for f in families])
    return df.select(F.inline(pairs)).where("actual is not null and predicted is not null").groupBy("family", "actual", "predicted").agg(F.count("*").alias("n"))


def class_report(confused: DataFrame) -> DataFrame:
    """precision, recall, fscore and support of each class of a confusion table, which is staged, so that its texts are read once."""
    confused = staged(confused, "confusion")
    by = lambda c, n: confused.groupBy("family", F.col(c).alias("label")).agg(F.sum("n").alias(n))
    hit = confused.where("actual = predicted").select("family", F.col("actual").alias("label"), F.col("n").alias("tp"))
    joined = by("actual", "gt").join(by("predicted", "pred"), ["family", "label"], "full").join(hit, ["family", "label"], "left").fillna(0, ["gt", "pred", "tp"])
    return scores(joined).withColumnRenamed("gt", "support")


def f1_summary(report: DataFrame) -> DataFrame:
    """family, macro_f1 (the mean over its classes) and micro_f1 (of the summed counts) of a class report."""
    micro_p, micro_r = safe_divide(F.sum("tp").cast("double"), F.sum("pred")), safe_divide(F.sum("tp").cast("double"), F.sum("support"))
    both = report.groupBy("family").agg(F.avg("fscore").alias("macro_f1"), micro_p.alias("_p"), micro_r.alias("_r"))
    return both.select("family", "macro_f1", safe_divide(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r")).alias("micro_f1"))


def error_analysis(df: DataFrame, key: str, ref: str, hyp: str, reset: bool = True) -> DataFrame:
    """The rows behind the scores: label (and one row with label all for each text), the key, text, and the (label, phrase) pairs of both sides as JSON; line joins the three by tabs."""
    spans = lambda c: F.to_json(F.transform(entity_spans(F.col(c), reset), lambda s: F.array(s["label"], s["phrase"])))
    rows = df.select(key, F.coalesce(F.col(ref), F.lit("")).alias("text"), spans(ref).alias("gt"), spans(hyp).alias("pred"))
    labels = F.array_distinct(F.transform(F.concat(*[F.from_json(c, "array<array<string>>") for c in ("gt", "pred")]), lambda p: p[0]))
    return rows.withColumn("label", F.explode(F.concat(F.array(F.lit("all")), labels))).select("label", key, "text", "gt", "pred", F.concat_ws("\t", "text", "gt", "pred").alias("line"))
