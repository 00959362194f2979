"""Quality by hierarchical empirical Bayes.

A logistic model over hashed byte trigrams, hashed words and a few statistics of the whole text, fitted on a bounded
sample of labelled rows, gives each document its own evidence. Documents are summed by host and by host and path; each level's rate is shrunk to the level above, by a
prior strength that is estimated from how much the rates of that level differ (method of moments), so a sparse site
stays near its parent. A document's quality adds to its own log-odds the shift from the global rate to its path's.

Host and path are read from a source column: what stands before and after the first '/', behind any scheme. Sources
without a '/' have one path each, '', which then is the host once more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Statistics (the first is constant), and hashed bins for trigrams and for words each.
STATISTICS, BINS = 11, 512
N_FEATURES = STATISTICS + 2 * BINS
_CLASS = np.zeros((256, 7), np.float64)  # lower, upper, digit, white space, stops, other marks, wide
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b, 6 if _b >= 128 else 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c.isspace() else 4 if _c in ".,;:?'\"-()" else 5] = 1
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


#: Bytes of a text that are read at a time, and powers of the multiplier and its inverse up to so many.
WINDOW = 1 << 18


def _powers(base: int) -> np.ndarray:
    out = np.full(WINDOW + 2, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_MULTIPLIER), _powers(_INVERSE)


class _Pieces:
    """Hashes of the pieces of a text between separators, the same wherever a piece stands and wherever windows cut it."""

    def __init__(self, keep_empty: bool):
        self.keep_empty, self.held, self.size = keep_empty, 0, 0  # of the piece that the last window left open

    def feed(self, sums: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Pieces that end in a window. sums: running sums of its symbols times powers; apart: where its separators stand."""
        starts, ends = np.concatenate(([0], apart + 1)), np.append(apart, len(sums) - 1)
        hashes, sizes = (sums[ends] - sums[starts]) * _DOWN[starts], ends - starts
        begun = int(hashes[0]) * pow(_MULTIPLIER, self.size, 1 << 64) + self.held & (1 << 64) - 1, int(sizes[0]) + self.size
        if not len(apart):
            self.held, self.size = begun
            return hashes[:0]
        hashes[0], sizes[0] = begun
        self.held, self.size = int(hashes[-1]), int(sizes[-1])
        hashes, sizes = hashes[:-1], sizes[:-1]
        return hashes if self.keep_empty else hashes[sizes > 0]

    def last(self) -> np.ndarray:
        return np.array([self.held] * (self.keep_empty or self.size > 0), np.uint64)


class _Distinct:
    """How many hashes there were, and how many different ones. Memory grows with these alone."""

    def __init__(self):
        self.n, self.kept, self.new, self.waiting = 0, np.empty(0, np.uint64), [], 0

    def add(self, hashes: np.ndarray) -> None:
        self.n += len(hashes)
        self.new.append(np.unique(hashes))
        self.waiting += len(self.new[-1])
        if self.waiting > max(WINDOW, len(self.kept)):
            self.settle()

    def settle(self) -> int:
        self.kept, self.new, self.waiting = np.unique(np.concatenate((self.kept, *self.new))), [], 0
        return len(self.kept)


def _binned(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes * _MIX >> np.uint64(64 - 9)).astype(np.int64), minlength=BINS)


def features(text: bytes | None) -> np.ndarray:
    """Statistics, trigrams and words of a whole text, A-Z folded; a null or empty one has the constant and zeros. Texts are read a window at a time."""
    out = np.zeros(N_FEATURES)
    out[0] = 1
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    kinds, grams, bins = np.zeros(256, np.int64), np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    words, lines, each_word, each_line = _Pieces(False), _Pieces(True), _Distinct(), _Distinct()
    for a in range(0, len(raw), WINDOW):
        part = raw[a : a + WINDOW]
        kinds += np.bincount(part, minlength=256)
        x = _FOLD[raw[a : a + WINDOW + 2]]  # trigrams reach into the next window
        grams += _binned(x[:-2] << np.uint64(16) | x[1:-1] << np.uint64(8) | x[2:])
        for pieces, each, symbols, apart in ((words, each_word, x[: len(part)], _SPACE[part]), (lines, each_line, part.astype(np.uint64), part == 10)):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((symbols + np.uint64(1)) * _UP[: len(part)], dtype=np.uint64, out=sums[1:])
            found = pieces.feed(sums, np.flatnonzero(apart))
            each.add(found)
            if pieces is words:
                bins += _binned(found)
    last = words.last()
    bins += _binned(last)
    each_word.add(last)
    each_line.add(lines.last())
    share = kinds @ _CLASS / len(text)
    n = max(1, each_word.n)
    out[1:7] = share[1], share[2], share[4], share[5], share[3], share[6]
    out[7] = np.log1p(each_word.n) / 10
    out[8] = each_word.settle() / n
    out[9] = np.log1p(len(text) / n)  # a text that is one word of any length stays within what the others have
    out[10] = each_line.settle() / each_line.n
    out[STATISTICS : STATISTICS + BINS] = np.sqrt(grams / max(1, grams.sum()))
    out[STATISTICS + BINS :] = np.sqrt(bins / max(1, bins.sum()))
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the features, their centers and scales, and the share of good labels they were fitted on."""

    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    rate: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        w = self.weights / self.scale
        return np.clip(x @ w - self.center @ w, -30, 30)


def _minimum(f, w: np.ndarray, rounds: int, keep: int = 10) -> np.ndarray:
    """The least value of a smooth convex function (f gives value and slope), by steps along slopes that the last changes of the slope correct."""
    value, slope = f(w)
    changes: list[tuple] = []
    for _ in range(rounds):
        d, taken = -slope, []
        for s, y in reversed(changes):
            taken.append((s @ d) / (s @ y))
            d = d - taken[-1] * y
        if changes:
            s, y = changes[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(changes, reversed(taken)):
            d = d + (a - (y @ d) / (s @ y)) * s
        down, step = slope @ d, 1.0
        if down > -1e-9:
            break
        while True:
            new_value, new_slope = f(w + step * d)
            if new_value <= value + 1e-4 * step * down or step < 1e-10:
                break
            step /= 2
        change = step * d, new_slope - slope
        if change[0] @ change[1] > 1e-12:
            changes = [*changes, change][-keep:]
        done = value - new_value < 1e-9 * max(1.0, abs(value))
        w, value, slope = w + step * d, new_value, new_slope
        if done:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 300) -> Model:
    """The likeliest weights with a ridge; without rows of both classes the evidence is the smoothed rate alone. Statistics are scaled, shares of bins are not, so that the ridge holds rare ones back."""
    rate = (y.sum() + 1) / (len(y) + 2)
    center, scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
    w = np.zeros(N_FEATURES)
    w[0] = np.log(rate / (1 - rate))
    if len(y) and 0 < y.sum() < len(y):
        center[1:] = x[:, 1:].mean(axis=0, dtype=np.float64)
        scale[1:STATISTICS] = np.maximum(x[:, 1:STATISTICS].std(axis=0, dtype=np.float64), 1e-6)
        z = ((x - center.astype(np.float32)) / scale.astype(np.float32)).astype(np.float32)
        held = np.full(N_FEATURES, ridge)
        held[0] = 1e-6

        def loss(w):
            s = (z @ w.astype(np.float32)).astype(np.float64)
            slope = z.T @ (1 / (1 + np.exp(-np.clip(s, -500, 500))) - y).astype(np.float32)
            return float((np.logaddexp(0, s) - y * s).sum() + 0.5 * (held * w * w).sum()), slope.astype(np.float64) + held * w

        w = _minimum(loss, w, rounds)
    return Model(w, center, scale, float(rate))


def held_out(id_col: str) -> Column:
    """A fifth of the documents, by a checksum of their ids, that fitting never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def host_of(source: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(source.cast("string")), r"^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)", 1), F.lit(""))


def path_of(source: Column) -> Column:
    return F.coalesce(F.regexp_extract(source.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]*)", 1), F.lit(""))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", fit_rows: int = 10_000) -> Model:
    """Fit on about fit_rows labelled rows, picked by a hash of the id from those that aren't held out.

    Null labels and ids are left out; a document with several labels has their mean, good from a half up.
    """
    marks = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y is not null").where(~held_out("id")).groupBy("id").agg(F.avg("y").alias("y"))
    n = marks.count()
    marks = marks.where(F.xxhash64("id") <= F.lit(common.threshold(fit_rows / max(1, n))))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(common.maybe_broadcast(marks, 32 * min(n, 2 * fit_rows)), "id")
    made = rows.select((F.col("y") >= 0.5).cast("double").alias("y"), packed(df.sparkSession, F.col("text")).alias("x")).toPandas()
    x = np.zeros((len(made), N_FEATURES), np.float32)
    for i, row in enumerate(made["x"]):
        x[i, :STATISTICS], x[i, STATISTICS:] = np.frombuffer(row, np.float32, STATISTICS), np.frombuffer(row, np.float16, offset=4 * STATISTICS)
    if not np.isfinite(x).all():
        raise ValueError("a labelled text has a feature that isn't a finite number")
    return fit_logistic(x, made["y"].to_numpy(np.float64))


def packed(spark, text: Column) -> Column:
    """Statistics as 32-bit numbers and shares of bins as 16-bit ones, of which fit_rows texts fit the driver: about 20 MB for 10,000."""
    common.small_batches(spark)

    @F.arrow_udf("binary")
    def made(texts: pa.Array) -> pa.Array:
        rows = (features(t) for t in common.utf8(texts))
        return pa.array([x[:STATISTICS].astype(np.float32).tobytes() + x[STATISTICS:].astype(np.float16).tobytes() for x in rows], pa.binary())

    return made(text.cast("string"))


def evidence(model: Model, spark, text: Column) -> Column:
    """The log-odds of quality that a text gives alone."""
    common.small_batches(spark)

    @F.arrow_udf("double")
    def said(texts: pa.Array) -> pa.Array:
        return pa.array(model.evidence(np.stack([features(t) for t in common.utf8(texts)])) if len(texts) else [], pa.float64())

    return said(text.cast("string"))


def _strength(rates: DataFrame) -> float:
    """Prior strength from rates (n, s: documents and summed probability, up: the parent's rate): how far rates lie apart beyond chance."""
    r = rates.where("n > 1").select(F.sum("n"), F.sum(F.expr("n * pow(s / n - up, 2)")), F.sum(F.expr("up * (1 - up)")), F.sum(F.expr("n * up * (1 - up)")), F.count("*")).first()
    if not r[4] or not r[0]:
        return 100.0
    between = max(1e-6, (r[1] - r[2]) / r[0])
    return float(min(1e4, max(1.0, r[3] / r[0] / between - 1)))


def site_rates(scored: DataFrame) -> tuple[DataFrame, float, int]:
    """Shrunk rates of paths from (host, path, p): (host, path, host_rate, path_rate), the global rate, and the bytes of the rows.

    Rows are summed on the map side before they are shuffled, so a host with a third of all rows is one row a task.
    """
    paths = common.staged(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    total = paths.agg(F.sum("n"), F.sum("s"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 32), F.lit(0))).first()
    rate = float(min(0.999, max(0.001, ((total[1] or 0.0) + 1) / ((total[0] or 0) + 2))))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    a = _strength(hosts.select(F.col("hn").alias("n"), F.col("hs").alias("s"), F.lit(rate).alias("up")))
    hosts = hosts.select("host", ((F.col("hs") + a * rate) / (F.col("hn") + a)).alias("host_rate"))
    joined = paths.join(hosts, "host")
    b = _strength(joined.select("n", "s", F.col("host_rate").alias("up")))
    rates = joined.select("host", "path", "host_rate", ((F.col("s") + b * F.col("host_rate")) / (F.col("n") + b)).alias("path_rate"))
    return common.staged(rates, "rates"), rate, int(total[2])


def _good(quality: str, least: float) -> Column:
    """NaN, which Spark orders above all numbers, is not good."""
    return ~F.isnan(quality) & (F.col(quality) >= least)


def _logit(c) -> Column:
    return F.log(c / (1 - c))


def _shifted(df: DataFrame, model: Model, names: dict[str, str], source_col: str) -> DataFrame:
    rates, rate, size = site_rates(df.select(F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path"), F.expr(f"1 / (1 + exp(-`{names['own']}`))").alias("p")))
    sites = rates.select(*[F.col(c).alias(names[c]) for c in ("host", "path", "host_rate", "path_rate")])
    joined = df.join(common.maybe_broadcast(sites, size), [names["host"], names["path"]])
    shift = _logit(F.col(names["path_rate"])) - float(np.log(rate / (1 - rate)))
    return joined.withColumn(names["quality"], 1 / (1 + F.exp(-(F.col(names["own"]) + shift))))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", least: float = 0.5) -> DataFrame:
    """One row per input row: id, held_out, host, path, evidence, host_rate, path_rate, quality (0 to 1), kept (quality >= least).

    A null or empty text has the evidence of its statistics (zeros); a null source is the host ''. Null ids stay null.
    """
    src = df.select(F.col(id_col).alias("id"), host_of(F.col(source_col)).alias("host"), path_of(F.col(source_col)).alias("path"), evidence(model, df.sparkSession, F.col(text_col)).alias("own"))
    out = _shifted(common.staged(src, "evidence"), model, {c: c for c in ("host", "path", "own", "host_rate", "path_rate", "quality")}, source_col)
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "host", "path", F.col("own").alias("evidence"), "host_rate", "path_rate", "quality", _good("quality", least).alias("kept"))


def keep_good(df: DataFrame, model: Model, text_col: str = "text", source_col: str = "source", least: float = 0.5) -> DataFrame:
    """The rows of quality from least up, with their columns as they are; null texts and sources as in score.

    The rows are staged with their evidence, so that texts are read for it once.
    """
    names = {c: common.free_name(df.columns, c) for c in ("host", "path", "own", "host_rate", "path_rate", "quality")}
    made = df.withColumns({names["host"]: host_of(F.col(source_col)), names["path"]: path_of(F.col(source_col)), names["own"]: evidence(model, df.sparkSession, F.col(text_col))})
    out = _shifted(common.staged(made, "evidence"), model, names, source_col)
    return out.where(_good(names["quality"], least)).select(*[F.col(f"`{c}`") for c in df.columns])
