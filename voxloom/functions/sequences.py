"""Labels of words and characters by counted models: punctuation and capitals of spoken text, and where sentences end.

Parameters are counted by Spark over whole tables; what a model keeps of them is bounded by parameters, so it can be broadcast.
Texts are decoded on Arrow batches, many sequences side by side, by the best path over all label sequences (Viterbi).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.batches import arrow_udf, small_batches
from voxloom.staging import drop, staged

#: Marks behind words, after none; the state at the begin of a line is the one behind them.
MARKS = ".,?!;:"
FIRST = len(MARKS) + 1
#: Words longer than this count by their last characters, so that a vocabulary has a bounded size.
LONGEST_WORD = 64
#: Words that are decoded at once; a longer line is decoded by itself.
WINDOW = 200_000
_OTHER, _BEGIN, _END = 0, 1, 2
_SPACE = re.compile("([ \t\r\f\v]+)")


def viterbi(lengths: np.ndarray, start: np.ndarray, step: Callable[[np.ndarray], np.ndarray], last: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The states of the best path of each of many sequences that lie one behind another, none of them empty; of equal paths the one with the smaller states, from the end.

    start: a score for each state before the first place. step: for places, scores (place, state before, state); states that only start may be left out at the end of the last axis.
    last: for the last places, scores (place, state). Sequences go side by side; one byte a place and state is kept.
    """
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes, begin = lengths[order], (np.cumsum(lengths) - lengths)[order]
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")
    best = np.tile(np.asarray(start, np.float64), (len(sizes), 1))
    back = path = None
    for i in range(longest):
        n = live[i]
        at = begin[:n] + i
        scores = best[:n, :, None] + step(at)
        if back is None:
            back, path = np.empty((int(lengths.sum()), scores.shape[2]), np.uint8), np.empty(int(lengths.sum()), np.uint8)
        came = scores.argmax(1)
        back[at] = came
        best[:n, : scores.shape[2]] = np.take_along_axis(scores, came[:, None], 1)[:, 0]
        best[:n, scores.shape[2] :] = -np.inf
    if path is None:
        return np.empty(0, np.uint8)
    state = (best + last(begin + sizes - 1)).argmax(1)
    for i in range(longest - 1, -1, -1):
        n = live[i]
        at = begin[:n] + i
        path[at] = state[:n]
        state[:n] = back[at, np.minimum(state[:n], back.shape[1] - 1)]
    return path


def _witten_bell(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities on the last axis: counts, and as much of the ones below as there are different events; the ones below where nothing was counted."""
    kinds, total = (counts > 0).sum(-1, keepdims=True), counts.sum(-1, keepdims=True)
    return np.where(total > 0, (counts + kinds * below) / np.maximum(total + kinds, 1), below)


# Punctuation and capitals


def spoken(c: Column) -> Column:
    """A text as it is heard: lower case, without the marks behind words. White space and words made of marks alone stay."""
    return F.regexp_replace(F.lower(c), r"([^\s.,?!;:])[.,?!;:]+(?=\s|\z)", "$1")


#: For each word of a line: itself without marks, in lower case (w); its case (s: 0 as it is, 1 first letter, 2 all); the mark behind it (m).
_WORDS = [
    r"filter(split(line, '[ \\t\\r\\f\\x0B]+'), x -> x <> '') AS x",
    f"transform(x, x -> named_struct('x', x, 'c', trim(TRAILING '{MARKS}' FROM x))) AS x",
    f"""transform(x, x -> IF(x.c = '', named_struct('w', right(x.x, {LONGEST_WORD}), 's', 0, 'm', 0), named_struct('w', right(lower(x.c), {LONGEST_WORD}),
        's', CASE WHEN x.c = lower(x.c) THEN 0 WHEN x.c = upper(x.c) AND char_length(x.c) > 1 THEN 2 WHEN substr(x.c, 1, 1) <> lower(substr(x.c, 1, 1)) THEN 1 ELSE 0 END,
        'm', IF(x.c = x.x, 0, locate(right(x.x, 1), '{MARKS}'))))) AS x""",
]


def marked_words(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line, pos, w, s, m of every word: its lower-cased form, its case and the number of the mark behind it (0: none). Null texts have none."""
    words = df.select(F.col(key).alias("k"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("n", "line"))
    for step in _WORDS:
        words = words.selectExpr("k", "n", step)
    return words.selectExpr("k", "n", "posexplode(x) AS (pos, x)").selectExpr(f"k AS `{key}`", "n AS line", "pos", "x.w", "x.s", "x.m")


def _steps(df: DataFrame, text: str) -> DataFrame:
    """p, q, w, s, m, n: how often a word w with case s and mark m follows a word p with mark q; ' ^' begins a line and ' $' ends it."""
    words = df.select(F.explode(F.split(F.col(text).cast("string"), "\n")).alias("line"))
    for step in _WORDS:
        words = words.selectExpr(step)
    each = f"transform(x, (y, i) -> named_struct('p', IF(i = 0, ' ^', x[i - 1].w), 'q', IF(i = 0, {FIRST}, x[i - 1].m), 'w', y.w, 's', y.s, 'm', y.m))"
    end = "array(named_struct('p', x[size(x) - 1].w, 'q', x[size(x) - 1].m, 'w', ' $', 's', 0, 'm', 0))"
    return words.where("size(x) > 0").selectExpr(f"inline(concat({each}, {end}))").groupBy("p", "q", "w", "s", "m").agg(F.count("*").alias("n"))


class Punctuator:
    """Puts marks and capitals in a list of texts: a model that fit_punctuation counted, for providers.punctuate.

    A line's words and labels have the score P(word | word and mark before) P(case, mark | word, mark before), and P(end | last word and mark). Marks and capitals that a text has already
    are taken as known. Lines are decoded one by one; white space stays.
    """

    def __init__(self, shared):
        self.shared = shared
        self.by_case = None  # made where the model is used

    def __call__(self, texts: list[str]) -> list[str]:
        done, waiting, size = [], [], 0
        for text in texts:
            for line in text.split("\n"):
                waiting.append(_SPACE.split(line))
                size += len(waiting[-1])
                if size >= WINDOW:
                    done += self._decoded(waiting)
                    waiting, size = [], 0
        lines = iter(done + self._decoded(waiting))
        return ["\n".join(next(lines) for _ in range(t.count("\n") + 1)) for t in texts]

    def _decoded(self, lines: list[list[str]]) -> list[str]:
        m = self.shared.value
        seen: dict[str, int] = {}
        kinds, found, places, lengths = [], [], [], []
        for n, pieces in enumerate(lines):
            before = len(found)
            for k in range(0, len(pieces), 2):
                if piece := pieces[k]:
                    if piece not in seen:
                        word, case, mark = known(piece)
                        seen[piece] = len(kinds)
                        kinds.append((m["words"].get(word) or m["endings"].get(word[-2:], _OTHER), case, mark))
                    found.append(seen[piece])
                    places.append((n, k))
            lengths.append(len(found) - before)
        if not found:
            return ["".join(p) for p in lines]
        ids, cases, marks = np.array(kinds)[found].T.copy()
        lengths = np.array(lengths)
        lengths = lengths[lengths > 0]
        first = np.zeros(len(ids), bool)
        first[np.cumsum(lengths) - lengths] = True
        before = np.where(first, _BEGIN, np.roll(ids, 1))
        case_known = np.zeros((4, 3), np.float32)
        mark_known = np.zeros((FIRST + 1, FIRST))
        case_known[:3][~np.eye(3, dtype=bool)] = mark_known[:FIRST][~np.eye(FIRST, dtype=bool)] = -np.inf
        if self.by_case is None:  # scores of the best case, for each case that is known and for an open one
            self.by_case = np.stack([(m["labels"] + own[:, None]).max(2) for own in case_known])
        behind = follows(m, before, ids)

        def step(at):
            return self.by_case[cases[at], ids[at]] + mark_known[marks[at]][:, None] + behind[at][:, :, None]

        start = np.full(FIRST + 1, -np.inf)
        start[FIRST] = 0.0
        path = viterbi(lengths, start, step, lambda at: follows(m, ids[at], np.full(len(at), _END)))
        came = np.where(first, FIRST, np.roll(path, 1))
        case = (m["labels"][ids, came, :, path] + case_known[cases]).argmax(1)
        new_case, new_mark = np.where(cases == 3, case, 0), np.where(marks == FIRST, path, 0)
        changed = np.flatnonzero((new_case > 0) | (new_mark > 0))
        for i, c, mark in zip(changed.tolist(), new_case[changed].tolist(), new_mark[changed].tolist()):
            n, k = places[i]
            word = lines[n][k]
            lines[n][k] = (word.upper() if c == 2 else word[:1].upper() + word[1:] if c == 1 else word) + (MARKS[mark - 1] if mark else "")
        return ["".join(p) for p in lines]


def known(word: str) -> tuple[str, int, int]:
    """A word's form in the vocabulary, and its case and mark where it has them already (3 and FIRST where they are open). Words made of marks alone stay as they are."""
    core = word.rstrip(MARKS)
    if not core:
        return word[-LONGEST_WORD:], 0, 0
    low = core.lower()
    case = 3 if core == low else 2 if core == core.upper() and len(core) > 1 else 1 if core[0] != core[0].lower() else 0
    return low[-LONGEST_WORD:], case, FIRST if core == word else MARKS.index(word[-1]) + 1


def follows(m: dict, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log P(word | word before, mark before) for every mark before."""
    key = before.astype(np.int64) * len(m["alone"]) + word
    at = np.minimum(np.searchsorted(m["pairs"], key), len(m["pairs"]) - 1)
    return np.where((m["pairs"][at] == key)[:, None], m["after"][at], m["back_off"][before] + m["alone"][word])


def fit_punctuation(df: DataFrame, text: str, words: int = 20_000, endings: int = 2_000, pairs: int = 200_000, least: int = 3) -> Punctuator:
    """A punctuator counted over all rows of df, whose texts have their marks and capitals.

    It keeps the most frequent words (at most `words`, each counted at least `least` times), two-letter endings that stand for other words (at most `endings`) and pairs of them with the mark
    between (at most `pairs`), ties by name: some 30 MB at the defaults, whatever the size of df. Rarer events back off to the mark before, by Witten and Bell's weights. Null texts count nothing;
    without any text all words are left as they are.
    """
    spark = df.sparkSession
    steps = staged(_steps(df, text), "steps")
    often = steps.where("w <> ' $'").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    kept = [r["w"] for r in often.orderBy(F.desc("n"), "w").limit(words).collect()]
    id_of = spark.createDataFrame([(" ^", _BEGIN), (" $", _END), *((w, i + 3) for i, w in enumerate(kept))], "word string, id int")
    rest = steps.where("w <> ' $'").join(F.broadcast(id_of), steps["w"] == id_of["word"], "left_anti").groupBy(F.right("w", F.lit(2)).alias("e")).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    ends = [r["e"] for r in rest.orderBy(F.desc("n"), "e").limit(endings).collect()]
    end_of = spark.createDataFrame([(e, i + 3 + len(kept)) for i, e in enumerate(ends)], "ending string, of_ending int")
    named = steps
    for c in ("p", "w"):
        named = named.join(F.broadcast(id_of), named[c] == id_of["word"], "left").join(F.broadcast(end_of), F.right(c, F.lit(2)) == end_of["ending"], "left")
        named = named.withColumn(c, F.coalesce("id", "of_ending", F.lit(_OTHER))).select("p", "q", "w", "s", "m", "n")
    named = staged(named.groupBy("p", "q", "w", "s", "m").agg(F.sum("n").alias("n")), "named")
    table = lambda t: {c: t.column(c).to_numpy() for c in t.column_names}
    label = table(named.groupBy("w", "q", "s", "m").agg(F.sum("n").alias("n")).toArrow())
    pair = table(named.groupBy("p", "q", "w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p", "q", "w").limit(pairs).toArrow())
    drop(steps)
    drop(named)

    size = 3 + len(kept) + len(ends)
    counts = np.zeros((size, FIRST + 1, 3 * FIRST))
    counts[label["w"], label["q"], label["s"] * FIRST + label["m"]] = label["n"]
    word_counts = counts.sum(2)
    counts[_END] = 0
    after_mark = _witten_bell(counts.sum(0), np.full(3 * FIRST, 1 / (3 * FIRST)))
    labels = np.log(_witten_bell(counts, after_mark)).astype(np.float32).reshape(size, FIRST + 1, 3, FIRST)
    anywhere = (word_counts.sum(1) + 1) / (word_counts.sum() + size)
    alone = np.log(_witten_bell(word_counts.T, anywhere)).T
    kinds, total = np.zeros((size, FIRST + 1)), np.zeros((size, FIRST + 1))
    np.add.at(kinds, (pair["p"], pair["q"]), 1)
    np.add.at(total, (pair["p"], pair["q"]), pair["n"])
    back_off = np.log(np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0))
    keys, at = np.unique(pair["p"].astype(np.int64) * size + pair["w"], return_inverse=True)
    after = np.exp((back_off[keys // size] + alone[keys % size]))
    after[at, pair["q"]] += pair["n"] / (total + kinds)[pair["p"], pair["q"]]
    model = {"words": {w: i + 3 for i, w in enumerate(kept)}, "endings": {e: i + 3 + len(kept) for i, e in enumerate(ends)}, "labels": labels, "alone": alone, "back_off": back_off,
        "pairs": keys if len(keys) else np.array([-1]), "after": np.log(after) if len(keys) else np.zeros((1, FIRST + 1))}
    return Punctuator(spark.sparkContext.broadcast(model))


def mark_scores(df: DataFrame, key: str, reference: str, punctuated: str) -> DataFrame:
    """mark, n_reference, n_punctuated, n_right, f1 over all words of two columns that have the same words."""
    marks = F.expr(f"substr('{MARKS}', m, 1)")
    want = marked_words(df, key, reference).withColumn("want", marks)
    got = marked_words(df, key, punctuated).withColumn("got", marks).select(key, "line", "pos", "got")
    each = want.join(got, [key, "line", "pos"]).select(F.explode(F.array_distinct(F.array("want", "got"))).alias("mark"), "want", "got").where("mark <> ''")
    same = lambda c: F.count(F.when(c, 1))
    out = each.groupBy("mark").agg(same(F.expr("want = mark")).alias("n_reference"), same(F.expr("got = mark")).alias("n_punctuated"), same(F.expr("want = mark AND got = mark")).alias("n_right"))
    return out.withColumn("f1", 2 * F.col("n_right") / (F.col("n_reference") + F.col("n_punctuated")))


# Where sentences end

#: Characters that end a sentence in texts that have them, and the white space between words.
STOPS = ".!?。！？"
_BLANK = " \t\n\r\f\v"
#: Labels of characters: alone, first, within and last in a sentence; the state before a text is the one behind them.
ALONE, HEAD, INNER, TAIL = range(4)
#: Characters that are counted or decoded at once; a longer text is by itself.
CHARACTERS = 2_000_000
#: Of fewer texts than this, each is decoded by itself.
FEW = 24
#: The states that each label may follow: a sentence begins where another has ended, and goes on after its first character.
_BEFORE = ((ALONE, TAIL), (ALONE, TAIL), (HEAD, INNER), (HEAD, INNER))
#: The state before, by 16 * state + a bit for each label, set where the second of the states that it may follow is the better one.
_CAME = np.array([_BEFORE[s][bits >> s & 1] for s in range(4) for bits in range(16)], np.uint8)


def _windows(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of all texts in lists of some CHARACTERS, the longest texts first: those alike in length go side by side."""
    waiting, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        waiting.append(i)
        size += len(texts[i])
        if size >= CHARACTERS:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


def _characters(texts: list[str], apart: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one behind another: code points; where each text begins, and the end of all; the places of characters, which are neither white space nor in apart; what each shows:
    2 * its code point, and 1 more if no character follows it at once."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    begins = np.cumsum([0, *map(len, texts)])
    gap = np.zeros(len(points) + 1, bool)
    for c in _BLANK + apart:
        gap[:-1] |= points == ord(c)
    at = np.flatnonzero(~gap[:-1])
    gap[begins] = True  # behind a text's last character
    return points, begins, at, 2 * points[at].astype(np.int32) + gap[at + 1]


def _counts(texts: list[str]) -> tuple[np.ndarray, Counter]:
    """How often each label goes with what is shown (at 4 * that + label), and what the sentences of texts with stops are: by their size, by the first ones and by neighbours."""
    points, begins, at, shows = _characters(texts, STOPS)
    cut = np.zeros(len(points) + 1, np.int32)
    for c in STOPS:
        cut[:-1] |= points == ord(c)
    cut[begins] = 1
    sentence = np.cumsum(cut, dtype=np.int32)[at]
    head = np.flatnonzero(np.diff(sentence, prepend=-1))
    size = np.diff(head, append=len(at))
    label = np.full(len(at), INNER)
    label[head + size - 1] = TAIL
    label[head] = np.where(size == 1, ALONE, HEAD)
    first = np.diff(np.searchsorted(begins, at[head], "right"), prepend=-1) > 0
    one = size == 1
    kinds = Counter(one=np.sum(first & one), many=np.sum(first & ~one), within=np.maximum(size - 3, 0).sum(), two=np.sum(size == 2), more=np.sum(size > 2))
    for a, was in (("one", one[:-1]), ("many", ~one[:-1])):
        for b, then in (("one", one[1:]), ("many", ~one[1:])):
            kinds[f"{a}_{b}"] = np.sum(was & then & ~first[1:])
    return np.bincount(4 * shows + label), kinds


def _label_counts(df: DataFrame, text: str) -> DataFrame:
    """l, c, n: how often a label l shows c, a character and a space behind it if white space or the sentence's end follows; and with no l, how many sentences are of kind c."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(0, np.int64), Counter()
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            for which in _windows(texts):
                n, found = _counts([texts[i] for i in which])
                if len(n) > len(total):
                    total, n = n, total
                total[: len(n)] += n
                kinds.update(found)
        some = np.flatnonzero(total)
        shown = [chr(k >> 3) + " " * (k >> 2 & 1) for k in some.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([*(some % 4).tolist(), *[None] * len(kinds)], pa.int32()), pa.array([*shown, *kinds], pa.string()), pa.array([*total[some].tolist(), *map(int, kinds.values())], pa.int64())], ["l", "c", "n"])

    small_batches(df.sparkSession)
    return df.select(F.col(text).cast("string")).mapInArrow(count, "l int, c string, n long").groupBy("l", "c").agg(F.sum("n").alias("n"))


class Segmenter:
    """Where the sentences of texts without stops end: a hidden Markov model of character labels that fit_segments counted. White space has no label."""

    def __init__(self, shared):
        self.shared = shared
        self.numbers = None  # made where the model is used, with first, scores and rows

    def __call__(self, texts: list[str]) -> list[list[int]]:
        """For each text, how many characters lie before and in each sentence's last character."""
        if self.numbers is None:
            self._prepare()
        out: list[list[int]] = [[] for _ in texts]
        for which in _windows(texts):
            _, begins, at, shows = _characters([texts[i] for i in which])
            last = self._last(self.numbers[np.minimum(shows, len(self.numbers) - 1)], np.diff(np.searchsorted(at, begins)))
            ends = at[last] + 1
            cuts = np.searchsorted(ends, begins, "right").tolist()
            for i, a, b, begin in zip(which, cuts, cuts[1:], begins.tolist()):
                out[i] = (ends[a:b] - begin).tolist()
        return out

    def _prepare(self) -> None:
        m = self.shared.value
        shows = np.array([2 * ord(c[0]) + len(c) - 1 for c in m["characters"]], np.int64)
        numbers = np.zeros(shows.max(initial=0) + 2, np.int32)  # the last stands for all that lie beyond
        numbers[shows] = np.array(list(m["characters"].values()), np.int32)
        steps = m["moves"] + m["shows"][:, None]
        self.scores = np.stack([steps[:, _BEFORE[s][k], s] for k in range(2) for s in range(4)])
        self.first = np.ascontiguousarray(steps[:, 4, :HEAD + 1].T)
        self.rows: dict[int, tuple] = {}
        self.numbers = numbers

    def _last(self, seen: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each character, whether a sentence ends there on the best path of its text; of equal paths the one with the smaller states, from the end.

        Texts go side by side, those with the most characters first, a place at a time; when few are left, each goes on by itself. A label follows one of two states, so a bit tells which.
        """
        order = np.argsort(-lengths, kind="stable")[: np.count_nonzero(lengths)]
        sizes, begin = lengths[order], (np.cumsum(lengths) - lengths)[order]
        last = np.zeros(len(seen), bool)
        if not len(order):
            return last
        together = int(sizes[FEW - 1]) if len(order) >= FEW else 1
        each = np.minimum(sizes, together)
        of = np.repeat(np.arange(len(order), dtype=np.int32), each)
        place = np.arange(len(of), dtype=np.int32) - np.repeat((np.cumsum(each) - each).astype(np.int32), each)
        rows = np.concatenate([[0], np.cumsum(np.bincount(place))])
        source = np.empty(len(of), np.int32)  # place by place
        source[rows[place] + of] = begin[of] + place
        shown, rows = seen[source], rows.tolist()
        second = np.zeros((2, 2, len(of)), bool)
        best = np.full((2, 2, len(order)), -np.inf)
        best[0] = self.first[:, shown[: len(order)]]
        for a, b in zip(rows[1:], rows[2:]):
            now, (one, two) = best[:, :, : b - a], self.scores.take(shown[a:b], 1).reshape(2, 2, 2, b - a)
            one += now[0, :, None]
            two += now[1, ::-1, None]
            np.greater(two, one, out=second[:, :, a:b])
            np.maximum(one, two, out=now)
        bits = second[0, 0] | second[0, 1] << np.uint8(1) | second[1, 0] << np.uint8(2) | second[1, 1] << np.uint8(3)
        state = np.where(best[1, 1] > best[0, 0], TAIL, ALONE).astype(np.uint8)
        for k in np.flatnonzero(sizes > together).tolist():
            rest = slice(begin[k] + together, begin[k] + sizes[k])
            last[rest], state[k] = self._rest(best[:, :, k].ravel().tolist(), seen[rest].tolist())
        path = np.empty(len(of), np.uint8)
        for a, b in zip(rows[-2::-1], rows[:0:-1]):
            path[a:b] = now = state[: b - a]
            state[: b - a] = _CAME.take(16 * now + bits[a:b])
        last[source] = (path == ALONE) | (path == TAIL)
        return last

    def _rest(self, best: list[float], seen: list[int]) -> tuple[np.ndarray, int]:
        """The same for one text from a place on, whose states have these scores before, and the best path's state before."""
        for c in set(seen).difference(self.rows):
            self.rows[c] = tuple(self.scores[:, c].tolist())
        alone, head, inner, tail = best
        bits = bytearray(len(seen))
        for i, (to_alone, to_head, to_inner, to_tail, tail_alone, tail_head, inner_inner, inner_tail) in enumerate(map(self.rows.__getitem__, seen)):
            to_alone += alone
            to_head += alone
            to_inner += head
            to_tail += head
            b = 0
            if (x := tail + tail_alone) > to_alone:
                to_alone, b = x, 1
            if (x := tail + tail_head) > to_head:
                to_head = x
                b += 2
            if (x := inner + inner_inner) > to_inner:
                to_inner = x
                b += 4
            if (x := inner + inner_tail) > to_tail:
                to_tail = x
                b += 8
            bits[i] = b
            alone, head, inner, tail = to_alone, to_head, to_inner, to_tail
        state, came = TAIL if tail > alone else ALONE, _CAME.tolist()
        path = bytearray(len(seen))
        for i in range(len(seen) - 1, -1, -1):
            path[i] = state
            state = came[16 * state + bits[i]]
        path = np.frombuffer(path, np.uint8)
        return (path == ALONE) | (path == TAIL), state


def fit_segments(df: DataFrame, text: str, characters: int = 1 << 17) -> Segmenter:
    """A segmenter counted over all texts of df, which have their stops.

    What a label shows is a character and whether white space follows; the most frequent ones are kept (at most `characters`, ties by name), the rest are one. Every count has one added.
    Null texts and texts of stops alone count nothing.
    """
    shows = staged(_label_counts(df, text), "shows")
    kept = [r["c"] for r in shows.where("l IS NOT NULL").groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(characters).collect()]
    id_of = {c: i + 1 for i, c in enumerate(kept)}
    counts, r = np.ones((len(kept) + 1, 4)), Counter()
    for label, c, n in shows.toLocalIterator():  # a row for each character and label: at most the code points there are, eight times
        if label is None:
            r[c] = n
        else:
            counts[id_of.get(c, 0), label] += n
    drop(shows)
    moves = np.full((5, 4), -np.inf)
    for state, to in ((4, {ALONE: r["one"], HEAD: r["many"]}), (ALONE, {ALONE: r["one_one"], HEAD: r["one_many"]}), (TAIL, {ALONE: r["many_one"], HEAD: r["many_many"]}),
                      (HEAD, {INNER: r["more"], TAIL: r["two"]}), (INNER, {INNER: r["within"], TAIL: r["more"]})):
        for k, n in to.items():
            moves[state, k] = np.log((n + 1) / (sum(to.values()) + 2))
    model = {"characters": id_of, "shows": np.log(counts / counts.sum(0)), "moves": moves}
    return Segmenter(df.sparkSession.sparkContext.broadcast(model))


def unstopped(c: Column) -> Column:
    """A text without the characters that end sentences."""
    return F.regexp_replace(c, f"[{STOPS}]+", "")


def segment(c: Column, model: Segmenter, stop: str = "。") -> Column:
    """struct(ends, text): the characters before and in the last one of every sentence, and the text with a stop behind each. A null text has null in both; one without characters has no sentence."""
    kind = pa.struct([("ends", pa.list_(pa.int32())), ("text", pa.string())])

    @arrow_udf("struct<ends:array<int>,text:string>")
    def put(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        found = iter(model([t for t in given if t is not None]))
        out = []
        for t in given:
            if t is None:
                out.append({"ends": None, "text": None})
                continue
            ends = next(found)
            cuts = [0, *ends]
            out.append({"ends": ends, "text": "".join(t[a:b] + stop for a, b in zip(cuts, ends)) + t[cuts[-1] :]})
        return pa.array(out, kind)

    return put(c)


def sentence_ends(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, end: for every sentence of a text with stops, the characters before and in its last one once the stops are taken out."""
    pieces = df.select(F.col(key), F.posexplode(F.split(F.col(text).cast("string"), f"[{STOPS}]+")).alias("pos", "s"))
    before = F.coalesce(F.sum(F.char_length("s")).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = F.char_length(F.regexp_replace("s", r"\s+\z", ""))
    return pieces.select(key, (before + kept).cast("int").alias("end"), kept.alias("n")).where("n > 0").drop("n")


def end_scores(reference: DataFrame, segmented: DataFrame) -> DataFrame:
    """n_reference, n_segmented, n_right, f1 of two frames of sentence ends alike in their columns, without repeats."""
    both = reference.withColumn("r", F.lit(1)).join(segmented.withColumn("s", F.lit(1)), reference.columns, "full")
    out = both.agg(F.count("r").alias("n_reference"), F.count("s").alias("n_segmented"), F.count(F.col("r") + F.col("s")).alias("n_right"))
    return out.withColumn("f1", F.expr("try_divide(2 * n_right, n_reference + n_segmented)"))
