"""Inline tags of transcripts as Column expressions: ENTITY_X phrase END spans and AGE_, GER_, GENDER_, EMOTION_, INTENT_ suffixes.

Tag families, patterns and word lists are fixed values of this format. Every function takes and returns a Column; null stays null. (?U) gives \\w, \\b and \\s their Unicode meaning.
Rules whose replacement depends on what was matched are Arrow UDFs (see text_rule); all others stay in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.batches import arrow_udf

#: Metadata families in the order in which they are put at the end of a text.
FAMILIES = ("AGE_", "GER_", "EMOTION_", "INTENT_")
METADATA = r"(?U)\b((?:INTENT|AGE|GER|EMOTION)_\w+)\b"


def text_rule(rule: Callable[[str], str]) -> Callable[[Column], Column]:
    """An Arrow UDF that maps texts by a Python rule, a batch at a time."""

    @arrow_udf(T.StringType())
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else rule(t) for t in texts.to_pylist()], pa.string())

    return apply


def squeeze(c: Column) -> Column:
    """White space runs to one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """Words between white space; none for a blank text."""
    return F.filter(F.split(squeeze(c), " "), lambda w: w != "")


def strip_entity_tags(c: Column) -> Column:
    """ENTITY_X phrase END to phrase, shortest phrase first."""
    return F.regexp_replace(c, r"ENTITY_[A-Z_]+\s+(.+?)\s+END", "$1")


def remove_existing_tags(c: Column) -> Column:
    """Drop NER_ and ENTITY_ tags and every END, also inside words."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)(NER|ENTITY)_\w+\s?", ""), r"(?U)\s?END", "")


def strip_inline_tags(c: Column) -> Column:
    """Drop standalone tags without regard to case, and collapse the gaps that are two or more long."""
    gone = F.regexp_replace(c, r"(?i)\b(AGE_[0-9]+_[0-9]+|GER_[A-Z]+|EMOTION_[A-Z]+|INTENT_[A-Z]+|ENTITY_[A-Z0-9_]+)\b", "")
    return F.trim(F.regexp_replace(gone, r"(?U)\s{2,}", " "))


def strip_all_tags(c: Column) -> Column:
    """Drop every upper-case tag with an underscore."""
    return squeeze(F.regexp_replace(c, r"[A-Z]+(_[A-Z0-9]+)+", ""))


def strip_all_columns(df: DataFrame) -> DataFrame:
    """strip_all_tags on every string column; the others stay as they are."""
    return df.select(*[strip_all_tags(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def metadata_of(c: Column) -> Column:
    """Distinct metadata tags: families in their fixed order, sorted within each."""
    rank = lambda t: F.when(t.startswith(FAMILIES[0]), 0).when(t.startswith(FAMILIES[1]), 1).when(t.startswith(FAMILIES[2]), 2).otherwise(3)
    found = F.transform(F.array_distinct(F.regexp_extract_all(c, F.lit(METADATA), 1)), lambda t: F.struct(rank(t).alias("r"), t.alias("t")))
    return F.transform(F.array_sort(found), lambda s: s["t"])


def reorder_metadata(c: Column) -> Column:
    """Move metadata tags to the end; a text without them ends in a space, as a text with them has one before the first."""
    return F.concat(squeeze(F.regexp_replace(c, METADATA, "")), F.lit(" "), F.array_join(metadata_of(c), " "))


def parse_metadata(c: Column) -> dict[str, Column]:
    """age_group ('a-b' or 'a+'), gender, emotion, intent (null if absent) and text, the rest."""
    ranged = F.regexp_extract(c, r"AGE_(\d+)_(\d+)", 1) != ""
    plus = F.regexp_extract(c, r"AGE_(\d+)PLUS", 1)
    none_if_empty = lambda x: F.nullif(x, F.lit(""))
    age = F.when(ranged, F.concat_ws("-", F.regexp_extract(c, r"AGE_(\d+)_(\d+)", 1), F.regexp_extract(c, r"AGE_(\d+)_(\d+)", 2))).when(plus != "", F.concat(plus, F.lit("+")))
    rest = F.when(ranged, F.regexp_replace(c, r"AGE_\d+_\d+", "")).otherwise(F.regexp_replace(c, r"AGE_\d+PLUS", ""))
    for family in (r"GER_(FEMALE|MALE)", r"(?U)EMOTION_\w+", r"(?U)INTENT_\w+"):
        rest = F.regexp_replace(rest, family, "")
    return {
        "age_group": age,
        "gender": F.element_at(F.create_map(F.lit("FEMALE"), F.lit("Female"), F.lit("MALE"), F.lit("Male")), none_if_empty(F.regexp_extract(c, r"GER_(FEMALE|MALE)", 1))),
        "emotion": none_if_empty(F.regexp_extract(c, r"(?U)EMOTION_(\w+)", 1)),
        "intent": none_if_empty(F.regexp_extract(c, r"(?U)INTENT_(\w+)", 1)),
        "text": squeeze(rest),
    }


def append_metadata(text: Column, **tags: Column) -> Column:
    """Text, then FAMILY_value for each keyword whose value isn't null, in the order given."""
    return F.concat_ws(" ", F.trim(text), *[F.concat(F.lit(k.upper() + "_"), v) for k, v in tags.items()])


def format_tag(kind: Column | str, value: Column) -> Column:
    """KIND_VALUE in upper case, with _ for space, - and /."""
    return F.concat(F.upper(F.lit(kind) if isinstance(kind, str) else kind), F.lit("_"), F.translate(F.upper(value), " -/", "___"))


def safe_tag(kind: str, value: Column) -> Column:
    """KIND_VALUE in upper case, white space runs to _."""
    return F.concat(F.lit(kind.upper() + "_"), F.upper(F.regexp_replace(F.trim(value), r"(?U)\s+", "_")))


def last_intent(c: Column, default: str = "INTENT_OTHER") -> Column:
    """The last INTENT_ token, or the default."""
    return F.coalesce(F.try_element_at(F.filter(tokens(c), lambda t: t.startswith("INTENT_")), F.lit(-1)), F.lit(default))


def fill_placeholders(c: Column, **values: Column) -> Column:
    """FAMILY_PLACEHOLDER to FAMILY_value; a null value leaves the placeholder."""
    for family, value in values.items():
        mark = family.upper() + "_PLACEHOLDER"
        c = F.replace(c, F.lit(mark), F.coalesce(F.concat(F.lit(family.upper() + "_"), value), F.lit(mark)))
    return c


# Repair of tags that a language model has written.

_TAG = r"(ENTITY_[A-Z0-9_]++)"  # possessive: never gives back the last letter of a correct tag
_META = r"(?:AGE_|GENDER_|EMOTION_|INTENT_)"


def _tag(legacy: bool) -> str:
    return r"(ENTITY_[A-Z0-9_]+)" if legacy else _TAG


def join_tag_parts(joiner: str = "") -> Callable[[Column], Column]:
    """Spaces inside the type of a tag out (or to joiner): ENTITY_PERSON_NAM E to ENTITY_PERSON_NAME."""
    pattern = re.compile(r"\bENTITY_([A-Z0-9_]+(?: +[A-Z0-9_]+)+)\b(?=\s+\S)")
    return text_rule(lambda t: pattern.sub(lambda m: "ENTITY_" + joiner.join(m[1].split()), t))


def _punctuation(c: Column, marks: str) -> Column:
    c = F.regexp_replace(c, rf"(?U)\s+([{marks}])", "$1")
    return squeeze(F.regexp_replace(c, rf"(?U)([{marks}])(\w)", "$1 $2"))


def fix_end_family_a(c: Column, marks: str = "?!:;,.", legacy: bool = False) -> Column:
    """END before metadata out, doubled END to one, a missing END added before the next tag or at the end, spaces around tags and marks.

    legacy=True keeps a known fault: it splits the last letter off a correct tag.
    """
    c = squeeze(c)
    c = F.regexp_replace(c, rf"(?U)\s+END\s+(\b{_META}|$)", " $1")
    for _ in range(2):
        c = F.regexp_replace(c, r"(?U)\s+END\s+END\b", " END")
    c = F.regexp_replace(c, rf"(ENTITY_[A-Z0-9_]+ \S.*?)(?= (?:{_META}|ENTITY_)|$)(?<! END)", "$1 END")  # all white space is single spaces here
    c = F.regexp_replace(c, rf"(?U){_tag(legacy)}(\S)", "$1 $2")
    c = F.regexp_replace(c, r"(?U)(\S)(END\b)", "$1 $2")
    return _punctuation(c, marks)


def fix_end_family_b(c: Column, marks: str = "?!:;,.।", legacy: bool = False) -> Column:
    """As family A, but END is not added, and goes before metadata and at the end even if that leaves a span open."""
    c = squeeze(c)
    c = F.regexp_replace(c, rf"(?U)\b{_tag(legacy)}(\S)", "$1 $2")
    c = F.regexp_replace(c, r"(?U)(\S)(END\b)", "$1 $2")
    c = F.regexp_replace(c, r"(?U)(\bEND)(\S)", "$1 $2")
    for _ in range(2):
        c = F.regexp_replace(c, r"(?U)\bEND\s+END\b", "END")
    for _ in range(2):
        c = F.regexp_replace(c, rf"(?U)\bEND\s*(\b{_META}|$)", "$1")
    return _punctuation(c, marks)


def fix_end_family_c(c: Column, marks: str = "।?!:;,.", legacy: bool = False) -> Column:
    """END after a closing mark, before INTENT_ and doubled out; spaces; then one END added to the last open span before INTENT_, a tag or the end."""
    c = F.regexp_replace(squeeze(c), rf"(?U)([{marks}])(\s+END)(?=\s+INTENT_|\s*$)", "$1")
    c = F.regexp_replace(c, r"(?U)END(\s+END)+", "END")
    c = F.regexp_replace(c, r"(?U)\sEND\s+(INTENT_)", " $1")
    c = F.regexp_replace(c, rf"(?U){_tag(legacy)}(\S)", "$1 $2")
    c = _punctuation(F.regexp_replace(c, r"(?U)(\S)(END\b)", "$1 END"), marks)
    return _close_last_span(c)


#: A Python rule, since the JVM's matcher recurses for every word of an open span.
_close_last_span = text_rule(lambda t: " ".join(re.sub(r"(ENTITY_[A-Z0-9_]+\s+\S+(?:\s+\S+)*)(?!\s+END)(?=\s+INTENT_|\s+ENTITY_|\s*$)", r"\1 END", t).split()))


def fix_end_of_reply(c: Column) -> Column:
    """After a single-word span: space before END, space after a tag, END appended where a tag's word has none."""
    c = F.regexp_replace(c, r"(?U)(\S)(END\b)", "$1 $2")
    c = F.regexp_replace(c, rf"(?U){_TAG}(\S)", "$1 $2")
    return F.regexp_replace(c, r"(?U)(ENTITY_[A-Z0-9_]++\s+\S++)(?!\s+END\b)(?=\s|$)", "$1 END")


def glue_split_tags(c: Column) -> Column:
    """Tags that were split in two glued again, longest forms first, then END kept only once behind each tag (nowhere without tags)."""
    for pattern, to in ((r"(ENTITY_[A-Z]+)_([A-Z]+)\s+([A-Z]+)", "$1_$2$3"), (r"(ENTITY_[A-Z]+)\s+([A-Z]+)", "$1$2"), (r"(ENTITY_[A-Z]+)_([A-Z]{2,})\s+([A-Z])", "$1_$2$3"), (r"(ENTITY_[A-Z_]+)\s+([A-Z]+)", "$1$2")):
        c = F.regexp_replace(c, pattern, to)
    parts = F.split(c, r"(?=ENTITY_[A-Z_])")
    once = F.transform(parts, lambda p: F.when(p.startswith("ENTITY_") & p.contains("END"), F.concat(F.substring_index(p, "END", 1), F.lit("END"), F.replace(F.substr(p, F.length(F.substring_index(p, "END", 1)) + 4), F.lit("END"), F.lit("")))).otherwise(p))
    return F.when(c.rlike("ENTITY_[A-Z_]+"), F.array_join(once, "")).otherwise(F.regexp_replace(c, r"(?U)\bEND\b", ""))


def _fix_case(text: str) -> str:
    text = re.sub(r"Entity_([a-z_]+)ENTITY_", "ENTITY_", text)
    text = re.sub(r"(^|\s|[.,:;!?])([Ee]ntity_(?:[a-zA-Z]+_?)+)", lambda m: m[1] + m[2].upper(), text)
    return re.sub(r"\b[Ee][Nn][Dd]\b", "END", text.replace("Entity_", "ENTITY_"))


#: Entity_x to ENTITY_X, overlapping tags to one, end to END.
fix_tag_case = text_rule(_fix_case)


def _capitalised(text: str) -> str:
    up = lambda m: m[1] + " ".join(w.capitalize() for w in m[2].split()) + m[3]
    text = re.sub(r"(ENTITY_\w+\s+[\w\s]+)END", r"\1 END", text)
    for kinds in ("PERSON_NAME", r"(?:LOCATION|CITY|COUNTRY|STATE)\w*"):
        text = re.sub(rf"(ENTITY_{kinds}\s+)([^E][^N][^D]*)(\s+END|\s+\w)", up, text)
    return text


#: Words of PERSON_NAME and place spans capitalised.
capitalize_entities = text_rule(_capitalised)

#: Kinds of spans whose words are capitalised, and those whose numbers are written as digits.
CAPITALISED = frozenset(("PERSON", "ORG", "GPE", "LOC", "FAC", "NORP"))


def normalize_span_contents(spell: Callable[[str], str]) -> Callable[[Column], Column]:
    """CARDINAL spans through spell, names capitalised; NER_ and ENTITY_ spans."""

    def one(m: re.Match) -> str:
        kind, phrase = m[2], m[3].strip()
        out = spell(phrase) if kind == "CARDINAL" else " ".join(w.capitalize() for w in phrase.split()) if kind in CAPITALISED else phrase
        return f"{m[1]}_{kind} {out} END"

    pattern = re.compile(r"\b(NER|ENTITY)_([A-Z_]+)\s+(.+?)\s+END\b")
    return text_rule(lambda t: pattern.sub(one, t))


def _first_ner(text: str) -> str:
    out, seen = [], set()
    for w in text.split():
        if not (w.startswith("NER_") or w == "END"):
            seen.clear()
        elif w in seen:
            continue
        else:
            seen.add(w)
        out.append(w)
    return " ".join(out)


#: Of NER_ tags and END that repeat before the next plain word, only the first. A Python rule: one pass, where an array that grows in the JVM is copied for every word.
collapse_repeated_ner = text_rule(_first_ner)


def is_tag(w: Column) -> Column:
    return w.startswith("ENTITY_") | (w == "END") | w.startswith("AGE_") | w.startswith("GER_") | w.startswith("EMOTION_") | w.startswith("INTENT_")


# Repeats are found by looking ahead at the next copies, not by a repeated group, for which the JVM's matcher would recurse once a copy.


def collapse_word_runs(c: Column) -> Column:
    """At most two of equal neighbouring words; tags are exempt."""
    return F.regexp_replace(squeeze(c), r"(?<![^ ])(?!(?:ENTITY_|AGE_|GER_|EMOTION_|INTENT_)|END(?![^ ]))([^ ]++) (?=\1 \1(?![^ ]))", "")


def collapse_repeats(c: Column, times: int = 3) -> Column:
    """Three or more of a word to one, again and again (up to times rounds)."""
    for _ in range(times):
        marked = F.regexp_replace(c, r"(?U)\b(\w++)\s+(?=\1\s+\1\b)", "\u0000")
        c = F.regexp_replace(marked, r"(?U)\x00+(\w++)\s+\1\b", "$1")
    return c


def collapse_repeated_spans(c: Column) -> Column:
    """An entity span that follows on itself once only."""
    return F.regexp_replace(c, r"(?U)(ENTITY_[A-Z]+\s+\w+\s+END)\s+(?=\1)", "")


def metadata_to_end(c: Column) -> Column:
    """Repeats collapsed, every metadata tag taken out (also at the end) and put once behind the text, sorted."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)((?:AGE|GER|EMOTION|INTENT)_\w+)"), 1)))
    rest = squeeze(F.regexp_replace(collapse_repeats(c), r"(?U)(AGE|GER|EMOTION|INTENT)_\w+", ""))
    return F.trim(F.concat_ws(" ", rest, F.array_join(found, " ")))


def _brackets_up(text: str) -> str:
    for pattern in (r"<[^>]*>", r"\[[^\]]*\]", r"\{[^\}]*\}", r"\([^\)]*\)"):
        text = re.sub(pattern, lambda m: " " + " ".join(w.upper() for w in m[0][1:-1].split()) + " ", text)
    return re.sub(r"\s+", " ", text).strip()


#: <..>, [..], {..}, (..) to their contents in upper case.
upper_brackets = text_rule(_brackets_up)


def drop_brackets(c: Column) -> Column:
    for pattern in (r"<[^>]*>", r"\[[^\]]*\]", r"\{[^}]*\}"):
        c = F.regexp_replace(c, pattern, "")
    return c


def drop_latin_words(c: Column) -> Column:
    """Brackets out, then every word of ASCII letters alone but END and tags."""
    keep = lambda w: ~w.rlike("^[a-zA-Z]+$") | (w == "END")  # noqa: E731  tags have an underscore
    return F.array_join(F.filter(tokens(drop_brackets(c)), keep), " ")


def keep_vocabulary(c: Column, vocabulary: Column) -> Column:
    """Only words (in lower case) of an array column, tags, numbers and single marks."""
    keep = lambda w: is_tag(w) | w.rlike(r"^\d+$") | w.isin(",", ".", "!", "?", ";", ":", "-") | F.array_contains(vocabulary, F.lower(w))
    return F.array_join(F.filter(tokens(c), keep), " ")


def _ner_case(text: str) -> str:
    words, out, i = text.split(), [], 0
    while i < len(words):
        if words[i].upper().startswith("NER_"):
            out.append(words[i].upper())
            out += [w.lower() for w in words[i + 1 : i + 2]]
            i += 2
            if i < len(words) and words[i].upper() == "END":
                out.append("END")
                i += 1
        else:
            w = words[i]
            out.append(w.upper() if w.upper() == "END" or re.match(r"(?i)(AGE|GER|GENDER|EMOTION|INTENT)_", w) else w.lower())
            i += 1
    return " ".join(out)


#: NER_ tags, END and metadata in upper case, all other words in lower case.
normalize_ner_case = text_rule(_ner_case)


def drop_upper_words(c: Column) -> Column:
    """Without the words (between single spaces) whose cased letters are all upper case."""
    return F.array_join(F.filter(F.split(c, " "), lambda w: ~((F.lower(w) != w) & (F.upper(w) == w))), " ")  # few words need both


def _put_spans(text: str, spans: list[dict]) -> str:
    ordered = sorted((x["start"], x["end"], x["type"]) for x in spans)
    if any(a[1] > b[0] for a, b in zip(ordered, ordered[1:])):  # they overlap: one after the other, from the right
        for start, end, kind in reversed(ordered):
            text = f"{text[:start]}ENTITY_{kind.upper()} {text[start:end]} END{text[end:]}"
        return text
    out, at = [], 0
    for start, end, kind in ordered:
        out += [text[at:start], "ENTITY_", kind.upper(), " ", text[start:end], " END"]
        at = end
    return "".join([*out, text[at:]])


def inject_spans(text: Column, spans: Column) -> Column:
    """ENTITY_TYPE phrase END put in by offset; spans: array of (start, end, type) in code points, as if from the right. A null text, null spans or a null in one give null. Time is in proportion to text and spans that don't overlap."""

    @arrow_udf("string")
    def put(texts: pa.Array, rows: pa.Array) -> pa.Array:
        whole = lambda t, some: t is not None and some is not None and all(x is not None and None not in x.values() for x in some)
        return pa.array([_put_spans(t, some) if whole(t, some) else None for t, some in zip(texts.to_pylist(), rows.to_pylist())], pa.string())

    return put(text, spans.cast("array<struct<start:int,end:int,type:string>>"))


def inject_strings(text: Column, entities: Column) -> Column:
    """As inject_spans by phrase: the first place of each, longest phrases first, then in the order given; entities: array of (text, type)."""
    numbered = F.transform(entities, lambda e, i: F.struct((-F.length(e["text"])).alias("k"), i.alias("i"), e["text"].alias("text"), e["type"].alias("type")))

    def step(t, e):
        at = F.position(e["text"], t)
        return F.when(at > 0, F.concat(F.substr(t, F.lit(1), at - 1), F.lit("ENTITY_"), F.upper(e["type"]), F.lit(" "), e["text"], F.lit(" END"), F.substr(t, at + F.length(e["text"])))).otherwise(t)

    return F.aggregate(F.filter(F.array_sort(numbered), lambda e: e["text"] != ""), text, step)


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), ("occ", pa.int32())]))
_SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("occ", T.IntegerType())]))


def _numbered(pairs: list[tuple[str, str]]) -> list[dict]:
    seen: dict[tuple, int] = {}
    out = []
    for pair in pairs:
        seen[pair] = seen.get(pair, 0) + 1
        out.append({"label": pair[0], "phrase": pair[1], "occ": seen[pair]})
    return out


def entity_spans(c: Column, reset: bool = True, by_label: bool = False, vocabulary: tuple[str, ...] | None = None) -> Column:
    """array of (label, phrase, occ): spans by a token walk; occ numbers equal pairs from 1.

    A tag inside an open span starts a new one. With reset END closes the span; without, the phrase goes on growing and is given again at
    the next END. Spans without words are none. by_label puts one constant in place of all phrases. vocabulary: the words that
    are tags (any ENTITY_X if it is None); others are words like any other. A null text has none. One pass over the words of a text.
    """
    known = None if vocabulary is None else frozenset(vocabulary)
    tag = re.compile(r"ENTITY_[A-Z0-9_]+").fullmatch if known is None else known.__contains__

    def walk(text: str) -> list[dict]:
        label, words, out = None, [], []
        for w in text.replace("  ", " ").split(" "):
            if tag(w):
                label, words = w, []
            elif w == "END":
                if label and words:
                    out.append((label, "phrase" if by_label else " ".join(words)))
                if reset:
                    label, words = None, []
            elif label:
                words.append(w)
        return _numbered(out)

    @arrow_udf(_SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[] if t is None else walk(t) for t in texts.to_pylist()], _SPAN)

    return spans(c)


@arrow_udf(_SPANS)
def number_repeats(pairs: pa.Array) -> pa.Array:
    """Pairs (label, phrase) of an array with occ: how often each has stood up to here."""
    return pa.array([None if row is None else _numbered([(p["label"], p["phrase"]) for p in row]) for row in pairs.to_pylist()], _SPAN)


def repair_bio(words: Column, labels: Column, text: Column | None = None) -> Column:
    """Labels made as many as words (padded with O, cut), types in upper case without spaces, all else O; with text, no words (or null) stand for those of the text in lower case."""
    if text is not None:
        words = bio_words(words, text)
    n = F.size(words)
    padded = F.slice(F.concat(F.coalesce(labels, F.array().cast("array<string>")), F.array_repeat(F.lit("O"), n)), F.lit(1), n)
    fixed = lambda t: F.when(t.rlike("^[BI]-"), F.concat(F.substring(t, 1, 2), F.upper(F.replace(F.substr(t, F.lit(3)), F.lit(" "), F.lit(""))))).otherwise("O")
    return F.transform(padded, lambda t: F.coalesce(fixed(t), F.lit("O")))


def bio_words(words: Column, text: Column) -> Column:
    """The words of a reply, or those of the text in lower case if it has none."""
    return F.when(F.coalesce(F.size(words), F.lit(0)) > 0, words).otherwise(tokens(F.lower(F.coalesce(text, F.lit("")))))


def keep_head_of_age(c: Column, normalize: Callable[[Column], Column]) -> Column:
    """The text before AGE_ normalised and the first AGE_ part put back; what follows a second AGE_ is lost."""
    parts = F.split(c, "AGE_")
    return F.when(F.size(parts) > 1, F.concat(normalize(F.trim(parts[0])), F.lit(" AGE_"), parts[1])).otherwise(normalize(c))
