"""Language of a document by expectation-maximisation over a mixture of n-gram models.

Each learned language is a smoothed distribution over hashed byte trigrams of letters (case folded for A-Z, everything
between letters is one space). A document is a mixture: EM estimates the shares of the languages from the likelihoods
of its trigrams, until no shares of these languages can have a likelihood that is better by more than a tolerance. The set of
languages starts as the most likely one and takes in the one that promises most for as long as the likelihood less a
penalty for each language (half the log of the number of trigrams, times a factor) grows; nothing else bounds the set.
The likelihood is concave in the shares, so its slope towards a language bounds what that can add: where no slope
is above the penalty, the set is final without another fit. The language with the largest share in it is predicted.

The fit of a text is absolute: what a trigram of it gains over chance (all trigrams alike) under the selected mixture, as a
part of what the fitted documents of these languages would gain in these shares, from 0 to 1. Texts in languages that
were never learned and letter noise have a fit near 0, even mixes of learned languages one near 1. The score is the
largest share, times the fit and, for a text in one language, the certainty that it isn't the next best one.

The models are fitted on a bounded sample: about fit_rows labelled rows of each language, picked by a hash of the id
(rows that share an id are picked together). More than LANGUAGES languages are an error: each is a table of 32,768 numbers.
"""

from __future__ import annotations

import codecs
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 15
#: Bytes of a text that are read at a time.
WINDOW = 1 << 18
#: The most languages that are learned; the log-likelihood by which a fit may fall short of the best one, and the rounds after which it may fall short by more.
LANGUAGES, TOLERANCE, ROUNDS = 250, 0.05, 1000
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_LETTER = regex.compile(r"\p{L}")


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed trigrams of a text and their counts; runs of non-letters are one space. Texts are read a window at a time, so memory doesn't grow with them."""
    counts, held = np.zeros(1 << BITS, np.int64), np.full(1, 32, np.uint8)  # held: the letters that begin the next trigrams
    raw = np.frombuffer(text, np.uint8)
    for a in range(0, len(raw) + 1, WINDOW):
        x = _FOLD[raw[a : a + WINDOW]] if a + WINDOW <= len(raw) else np.append(_FOLD[raw[a:]], np.uint8(32))
        x = np.concatenate((held, x[(x != 32) | (np.concatenate((held[-1:], x[:-1])) != 32)])).astype(np.uint32)
        h = ((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        counts += np.bincount(h, minlength=1 << BITS)
        held = x[-2:].astype(np.uint8)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: bytes) -> bool:
    decode = codecs.getincrementaldecoder("utf-8")("replace").decode
    return any(_LETTER.search(decode(text[a : a + WINDOW])) for a in range(0, len(text), WINDOW))


class Mixture:
    """Fitted models; assess(text) gives (language, score, fit, most: the fit and three standard errors of its mean over the trigrams, shares of the selected languages), infer(text) leaves out the fit."""

    def __init__(self, langs: list[str], counts: np.ndarray, penalty: float = 4.0):
        self.langs, self.penalty = langs, penalty
        smooth = counts + 0.5
        self.prob = smooth / smooth.sum(axis=1, keepdims=True)
        #: What a trigram of the fitted documents gains over chance, by language.
        self.usual = (counts * np.log(self.prob * counts.shape[1])).sum(axis=1) / np.maximum(counts.sum(axis=1), 1)

    def em(self, p: np.ndarray, n: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        """The log-likelihood and the shares from a start. A slope is how much likelihood a share adds, total at the best shares."""
        total = n.sum()
        for _ in range(ROUNDS):
            mix = w @ p
            slope = p @ (n / mix)
            if slope.max() - total <= TOLERANCE:
                break
            w = w * slope
            w /= w.sum()
        return float(n @ np.log(w @ p)), w

    def select(self, p: np.ndarray, n: np.ndarray, single: np.ndarray) -> tuple[list[int], np.ndarray, float]:
        """The languages, their shares and the log-likelihood."""
        total = float(n.sum())
        cost = self.penalty * 0.5 * math.log(total + 1)
        chosen = [int(np.argmax(single))]
        w, ll = np.ones(1), float(single[chosen[0]])
        while len(chosen) < len(p):
            slope = p @ (n / (w @ p[chosen]))
            slope[chosen] = -np.inf
            more = int(np.argmax(slope))
            if slope[more] - total <= cost:
                break
            new_ll, new_w = self.em(p[[*chosen, more]], n, np.append(w * 0.5, 0.5))
            if new_ll - ll <= cost:
                break
            chosen, w, ll = [*chosen, more], new_w, new_ll
        return chosen, w, ll

    def _fit(self, gain: float, chosen: list[int], w: np.ndarray) -> float:
        """A gain over chance per trigram as a part of the usual one of a mixture, whose choice of languages costs its entropy at most."""
        some = w[w > 0]
        return min(1.0, max(0.0, gain / max(1e-9, float((w * self.usual[chosen]).sum() + (some * np.log(some)).sum()))))

    def infer(self, text: bytes | None) -> tuple[str, float, dict[str, float]]:
        lang, score, _, _, shares = self.assess(text)
        return lang, score, shares

    def assess(self, text: bytes | None) -> tuple[str, float, float, float, dict[str, float]]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0, 0.0, 0.0, {}
        at, n = trigrams(text)
        if not len(at):
            return "und", 0.0, 0.0, 0.0, {}
        p, total = self.prob[:, at], int(n.sum())
        single = np.log(p) @ n
        chosen, w, ll = self.select(p, n, single)
        top = max(range(len(chosen)), key=lambda i: (w[i], -chosen[i]))
        gain = (single[chosen[top]] - np.delete(single, chosen[top]).max()) if len(self.langs) > 1 and len(chosen) == 1 else 0.0
        sure = 1 / (1 + math.exp(-min(50.0, max(-50.0, gain)))) if len(chosen) == 1 and len(self.langs) > 1 else 1.0
        each = np.log(w @ p[chosen])
        gain, error = ll / total + math.log(self.prob.shape[1]), math.sqrt(max(0.0, float(n @ (each - ll / total) ** 2)) / total / total)
        fit, most = (self._fit(x, chosen, w) for x in (gain, gain + 3 * error))
        return self.langs[chosen[top]], min(1.0, max(0.0, float(w[top]) * sure * fit)), fit, most, {self.langs[c]: float(x) for c, x in zip(chosen, w)}


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from fitting: crc32 of its id as text, mod 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = 2000) -> Mixture:
    """A mixture fitted on rows that aren't held out and have a language and an id; only bounded tables reach the driver."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and id is not null").where(~held_out("id"))
    sizes = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return Mixture([], np.ones((0, 1 << BITS)))
    upto = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(common.threshold(fit_rows / n)))]), F.col("lang"))
    sample = src.where(F.xxhash64("id") <= upto).select("lang", "text")
    common.small_batches(df.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), common.utf8(batch.column(1))):
                at, n = trigrams(text or b"")
                sums.setdefault(lang, np.zeros(1 << BITS, np.int64))[at] += n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bin", "n"])

    sums = sample.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    rows = sums.groupBy("lang").agg(F.collect_list("bin").alias("bins"), F.collect_list("n").alias("counts"))  # at most 32,768 each
    langs = sorted(sizes)
    counts = np.zeros((len(langs), 1 << BITS))
    for r in rows.toLocalIterator():
        counts[langs.index(r["lang"]), r["bins"]] = r["counts"]
    return Mixture(langs, counts)


def predict(model: Mixture, spark, text: Column) -> Column:
    """struct(lang, score, fit, most, shares) of a text column; null, empty or letterless texts are und with score 0."""
    shared = spark.sparkContext.broadcast(model)
    common.small_batches(spark)

    @F.arrow_udf("struct<lang:string,score:double,fit:double,most:double,shares:map<string,double>>")
    def assess(texts: pa.Array) -> pa.Array:
        found = [shared.value.assess(t) for t in common.utf8(texts)]
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.float64()))]
        return pa.StructArray.from_arrays([*columns, pa.array([list(f[4].items()) for f in found], pa.map_(pa.string(), pa.float64()))], ["lang", "score", "fit", "most", "shares"])

    return assess(text.cast("string"))


def identify(df: DataFrame, model: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, shares (language to share). Reads the id and the text alone.

    Null, empty and letterless texts are und with score 0 and no shares, as are all texts if no language was learned. Rows that
    repeat are predicted alike; ties go to the first language by name. A null id stays null and is not held out.
    """
    said = df.select(F.col(id_col).alias("id"), predict(model, df.sparkSession, F.col(text_col)).alias("said"))
    return said.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"), F.col("said.shares").alias("shares"))


def keep_known(df: DataFrame, model: Mixture, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with their columns as they are, whose text may fit the learned languages so well; it may mix any number of them evenly.

    A text is rejected only if its fit is below least by more than three standard errors, so a few odd trigrams (a number, an
    address, a key) in a short text do not make it foreign.
    """
    name = common.free_name(df.columns, "said")
    out = df.withColumn(name, predict(model, df.sparkSession, F.col(text_col)))
    return out.where((F.col(f"{name}.lang") != "und") & (F.col(f"{name}.most") >= least)).select(*[F.col(f"`{c}`") for c in df.columns])
