"""Numbers as words and back: spelling as Column expressions, inverse normalisation by a weighted transducer.

The grammar's table has, for a state and the class of a word, the next state; registers hold the value so far. From every token the transducer gives the phrases that begin there, each with
a weight; a token by itself costs more than a phrase, an ambiguous word as much as it is unlikely to be a number. The cheapest path over all tokens is the result, so every token is in it once.
It is looked for run by run: between words that no phrase has side by side, a text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.batches import arrow_udf

# English number words, months, currencies and units.
UNITS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
TEENS = ("ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
SCALES = ("thousand", "million", "billion", "trillion")
ODD_ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
MONEY = {"dollar": "$", "euro": "€", "pound": "£", "rupee": "₹", "yen": "¥"}
HUNDREDTHS = ("cent", "cents", "pence", "paise")
MEASURES = {"percent": "%", "kilometer": " km", "meter": " m", "centimeter": " cm", "kilogram": " kg", "gram": " g", "liter": " l", "degree": "°"}


def _ordinal(word: str) -> str:
    return ODD_ORDINALS.get(word) or (word[:-1] + "ieth" if word.endswith("y") else word + "th")


#: Word to class and value.
_CLASSES = {"zero": ("zero", 0), "hundred": ("hundred", 100), "and": ("and", 0)}
_CLASSES |= {w: ("unit", i + 1) for i, w in enumerate(UNITS)} | {w: ("teen", i + 10) for i, w in enumerate(TEENS)} | {w: ("tens", 10 * i + 20) for i, w in enumerate(TENS)}
_CLASSES |= {w: ("scale", 1000 ** (i + 1)) for i, w in enumerate(SCALES)}
_ORDINALS = {_ordinal(w): x for w, x in _CLASSES.items() if x[0] != "and"}

_BELOW = {"unit": "ones", "teen": "teens", "tens": "tens"}  # what ends a group of three
_AFTER = {"unit": "last", "teen": "last", "tens": "last tens"}  # the same behind a hundred
#: State and class to the next state. A group of three digits, then its scale, then a group of a smaller scale.
ARCS = {(s, c): to for s, row in {
    "start": _BELOW | {"zero": "zero"}, "ones": {"hundred": "hundred", "scale": "scale"}, "teens": {"hundred": "hundred", "scale": "scale"}, "tens": {"unit": "last", "scale": "scale"},
    "hundred": _AFTER | {"and": "and", "scale": "scale"}, "and": _AFTER, "last": {"scale": "scale"}, "last tens": {"unit": "last", "scale": "scale"}, "scale": _BELOW | {"and": "and"},
}.items() for c, to in row.items()}
FINAL = frozenset(("ones", "teens", "tens", "hundred", "last", "last tens", "scale", "zero"))

_MARKS = ".,;:?!"
#: Weights: a token by itself, a phrase, a phrase for each of its tokens, a word that is rather no number (second) where it stands alone.
PLAIN, PHRASE, EACH, UNLIKELY = 1.0, 0.2, 0.01, 1.5


def cardinals(words: list[str], i: int) -> Iterator[tuple[int, int, bool]]:
    """(end, value, whether an ordinal) of every number that begins at word i; a None among the words ends all."""
    state, total, group, limit = "start", 0, 0, 1 << 62
    while i < len(words) and words[i] is not None:
        for table, ordinal in ((_ORDINALS, True), (_CLASSES, False)):
            kind, value = table.get(words[i], (None, 0))
            to = ARCS.get((state, kind))
            if to is None or kind == "scale" and (value >= limit or not group):
                continue
            if kind == "scale":
                done = total + group * value, 0, value
            else:
                done = total, group * 100 if kind == "hundred" else group + value, limit
            if ordinal:
                yield i + 1, done[0] + done[1], True
                continue
            state, (total, group, limit) = to, done
            if state in FINAL:
                yield i + 1, total + group, False
            break
        else:
            return
        i += 1


def nth(n: int) -> str:
    return f"{n}{'th' if n % 100 in (11, 12, 13) else {1: 'st', 2: 'nd', 3: 'rd'}.get(n % 10, 'th')}"


def years(words: list[str], i: int) -> Iterator[tuple[int, int]]:
    """(end, year) from 1000 to 2999, as a number or as two of two digits."""
    for j, n, ordinal in cardinals(words, i):
        if ordinal:
            continue
        if 1000 <= n <= 2999:
            yield j, n
        if 10 <= n <= 29:
            k = j + (words[j : j + 1] == ["oh"])
            yield from ((m, 100 * n + rest) for m, rest, other in cardinals(words, k) if not other and (1 <= rest <= 9 if k > j else 10 <= rest <= 99))


def _one(table: dict, word: str | None):
    return None if word is None else table.get(word) or table.get(word[:-1] if word.endswith("s") else word)


def phrases(words: list[str], i: int) -> Iterator[tuple[int, str, float]]:
    """(end, what it is written as, weight) of every phrase that begins at word i."""
    at = lambda j: words[j] if j < len(words) else None
    for j, n, ordinal in cardinals(words, i):
        if ordinal:
            yield j, nth(n), UNLIKELY if j == i + 1 and words[i] == "second" else PHRASE
            if at(j) == "of" and at(j + 1) in MONTHS and 1 <= n <= 31:
                yield from _dates(words, j + 2, MONTHS.index(words[j + 1]) + 1, n)
            continue
        yield j, str(n), PHRASE
        if at(j) == "point":
            k, digits = j + 1, ""
            while at(k) is not None and _CLASSES.get(words[k], ("", 0))[0] in ("unit", "zero"):
                digits += str(_CLASSES[words[k]][1])
                k += 1
                yield k, f"{n}.{digits}", PHRASE
                yield from _measured(words, k, f"{n}.{digits}")
        yield from _measured(words, j, str(n))
        if sign := _one(MONEY, at(j)):
            k = j + 1 + (at(j + 1) == "and")
            yield from ((m + 1, f"{sign}{n}.{c:02d}", PHRASE) for m, c, other in cardinals(words, k) if not other and c < 100 and at(m) in HUNDREDTHS)
    if at(i) in MONTHS:
        k = i + 1 + (at(i + 1) == "the")
        for j, n, ordinal in cardinals(words, k):
            if ordinal and 1 <= n <= 31:
                yield from _dates(words, j, MONTHS.index(words[i]) + 1, n)


def _measured(words: list[str], j: int, number: str) -> Iterator[tuple[int, str, float]]:
    word = words[j] if j < len(words) else None
    if sign := _one(MONEY, word):
        yield j + 1, f"{sign}{number}", PHRASE
    elif sign := _one(MEASURES, word):
        yield j + 1, f"{number}{sign}", PHRASE
    elif word == "per" and words[j + 1 : j + 2] == ["cent"]:
        yield j + 2, f"{number}%", PHRASE


def _dates(words: list[str], j: int, month: int, day: int) -> Iterator[tuple[int, str, float]]:
    yield j, f"{MONTHS[month - 1].title()} {day}", PHRASE
    for k, year in years(words, j):
        yield k, f"{year}-{month:02d}-{day:02d}", PHRASE


_BEGINS = frozenset(_CLASSES.keys() - {"and", "hundred", *SCALES} | _ORDINALS.keys() | set(MONTHS))


#: Kinds of words in a phrase, and which may stand behind which. Between words whose kinds may not meet, no phrase goes on.
_KINDS = ("number", "ordinal", "and", "point", "of", "the", "oh", "month", "money", "measure", "hundredth", "per", "cent")
_MEETS = {"number": ("number", "ordinal", "and", "point", "money", "measure", "hundredth", "per", "oh"), "ordinal": ("number", "of"), "and": ("number", "ordinal"), "point": ("number",), "of": ("month",), "the": ("number", "ordinal"),
    "oh": ("number",), "month": ("number", "ordinal", "the"), "money": ("number", "and"), "per": ("cent",)}
_BIT = {k: 1 << i for i, k in enumerate(_KINDS)}


def _joins() -> dict[str, tuple[int, int]]:
    """Word to the bits of its kinds and of the kinds that may stand behind it."""
    kinds: dict[str, set[str]] = {}
    for kind, words in (("number", _CLASSES.keys() - {"and"}), ("ordinal", _ORDINALS), ("month", MONTHS), ("hundredth", HUNDREDTHS), *((k, (k,)) for k in ("and", "point", "of", "the", "oh", "per", "cent")),
                        *((k, [*names, *(n + "s" for n in names)]) for k, names in (("money", MONEY), ("measure", MEASURES)))):
        for w in words:
            kinds.setdefault(w, set()).add(kind)
    return {w: (sum(_BIT[k] for k in own), sum(_BIT[k] for k in {to for k in own for to in _MEETS.get(k, ())})) for w, own in kinds.items()}


_JOINS = _joins()


class _Graph:
    """The edges of a text, found from each token where they are asked for."""

    def __init__(self, tokens: Sequence[str]):
        self.tokens, self.words, self.index, self.tails = tokens, [], [], []
        for t in tokens:
            core = t.rstrip(_MARKS)
            self.index.append(len(self.words))
            self.words.append(core.lower())
            self.tails.append(t[len(core) :])
            if self.tails[-1]:
                self.words.append(None)
        self.ends = {i + 1: n + 1 for n, i in enumerate(self.index)}

    def of(self, n: int) -> list[tuple[int, str, float]]:
        own, i, ends = [(n + 1, self.tokens[n], PLAIN)], self.index[n], self.ends
        if self.words[i] in _BEGINS:
            own += [(ends[j], said + self.tails[ends[j] - 1], weight + EACH * (ends[j] - n)) for j, said, weight in phrases(self.words, i) if ends[j] > n]
        return own


def edges(tokens: list[str]) -> list[list[tuple[int, str, float]]]:
    """From each token the token by itself and the phrases that begin there, as (end, written, weight). Marks behind a token end a phrase."""
    graph = _Graph(tokens)
    return [graph.of(n) for n in range(len(tokens))]


@lru_cache(1 << 14)
def _cheapest(tokens: tuple[str, ...]) -> str:
    """What the tokens of a run are written as. What is left from a token costs at least one phrase of all of it, so edges that can't be part of a cheapest path are not followed, and those from places that none leads to are not looked for."""
    graph, end = _Graph(tokens), len(tokens)
    best: dict[int, tuple[float, int, str]] = {end: (0.0, -end, "")}
    edges_of: dict[int, list] = {}
    waiting = [0]
    while waiting:
        n = waiting[-1]
        if n not in edges_of:
            edges_of[n] = sorted(((round(w if to == end else w + PHRASE + EACH * (end - to), 9), -to, w, said) for to, said, w in graph.of(n)), key=lambda x: x[:2])
        found = None
        for least, to, weight, said in edges_of[n]:
            if found is not None and least > found[0]:
                break
            if -to not in best:
                waiting.append(-to)
                break
            x = round(weight + best[-to][0], 9), to, said
            if found is None or x[:2] < found[:2]:
                found = x
        if waiting[-1] == n:
            best[n] = found
            waiting.pop()
    out, n = [], 0
    while n < end:
        _, to, said = best[n]
        out.append(said)
        n = -to
    return " ".join(out)


#: Runs of at most so many tokens are kept for the next texts.
_KEPT_RUN = 32


def normalize(text: str) -> str:
    """Number phrases of a text, whose tokens stand between single spaces, written with digits: the cheapest path, and of equally cheap ones the one whose first phrase is longest."""
    out: list[str] = []
    run: list[str] = []
    begun, behind = False, 0

    def close() -> None:
        if begun:
            out.append((_cheapest if len(run) <= _KEPT_RUN else _cheapest.__wrapped__)(tuple(run)))
        else:
            out.extend(run)
        run.clear()

    for token in text.split(" "):
        core = token.rstrip(_MARKS)
        word = core.lower()
        own, after = _JOINS.get(word, (0, 0))
        if not behind & own:
            close()
            begun = False
        run.append(token)
        begun = begun or word in _BEGINS
        behind = after if len(core) == len(token) else 0
    close()
    return " ".join(out)


def inverse_normalize(c: Column) -> Column:
    """Spelled cardinals, ordinals, decimals, dates, money and measures of English texts in digits. Null stays null; texts without number words stay as they are."""

    @arrow_udf("string")
    def plain(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else normalize(t) for t in texts.to_pylist()], pa.string())

    return plain(c)


def _let(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def _group(g: Column) -> Column:
    """The words of a number from 1 to 999."""
    word = lambda words, at: F.get(F.array(*map(F.lit, words)), at.cast("int"))  # noqa: E731  null where there is none
    small = lambda r: F.when(r < 10, word(UNITS, r - 1)).when(r < 20, word(TEENS, r - 10)).otherwise(F.concat_ws(" ", word(TENS, F.floor(r / 10) - 2), word(UNITS, r % 10 - 1)))
    return F.concat_ws(" ", F.concat(word(UNITS, F.floor(g / 100) - 1), F.lit(" hundred")), _let(g % 100, small))


def spell(n: Column) -> Column:
    """The words of a whole number from 0 below 10^15; null for others."""

    def part(group: Column, scale: str) -> Column:
        return _let(group, lambda g: F.when(g > 0, F.concat(_group(g), F.lit(scale))))

    def said(x: Column) -> Column:
        parts = [part(F.floor(x / F.lit(1000**k)).cast("long") % 1000, f" {SCALES[k - 1]}" if k else "") for k in range(len(SCALES), -1, -1)]
        return F.when(x == 0, F.lit("zero")).when((x > 0) & (x < 10**15), F.concat_ws(" ", *parts))

    return _let(n.cast("long"), said)


def spell_ordinal(n: Column) -> Column:
    """The words of a number's ordinal, from 1."""
    odd = F.create_map(*[F.lit(x) for pair in ODD_ORDINALS.items() for x in pair])

    def said(words: Column) -> Column:
        last = F.substring_index(words, " ", -1)
        ends = F.coalesce(F.try_element_at(odd, last), F.when(last.endswith("y"), F.regexp_replace(last, "y$", "ieth")).otherwise(F.concat(last, F.lit("th"))))
        return F.concat(F.regexp_replace(words, "[a-z]+$", ""), ends)

    return F.when(n > 0, _let(spell(n), said))
