"""Age buckets, codes of genders and emotions, durations and keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Age words of a crowd-sourced speech table ("fourties" is spelled so there), by the age they stand for (fixed values).
AGE_WORDS = {"twenties": 25, "thirties": 35, "fourties": 45, "fifties": 55, "sixties": 65, "seventies": 75, "eighties": 85, "nineties": 95}
#: Three conventions for gender codes (fixed values).
GENDERS = {"female_first": {0: "FEMALE", 1: "MALE", 2: "OTHER"}, "male_first": {0: "MALE", 1: "FEMALE", 2: "OTHER"}, "binary": {1: "MALE"}}
#: Emotion labels to their short codes (fixed values).
EMOTIONS = {"neutral": "NEU", "happy": "HAP", "happiness": "HAP", "sad": "SAD", "sadness": "SAD", "angry": "ANG", "anger": "ANG", "fear": "FEA", "surprise": "SUR", "disgust": "DIS", "calm": "CAL"}


def _steps(value: Column, bounds: list[tuple[float, str]], last: str, inclusive: bool = False) -> Column:
    out = None
    for bound, name in bounds:
        hit = value <= bound if inclusive else value < bound
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(value.isNotNull(), last)


_FIVE = [(18, "0_18"), (30, "18_30"), (45, "30_45"), (60, "45_60")]


def age_scaled(age: Column) -> Column:
    """Model output 0 to 1, as a percentage with two decimals."""
    return _steps(F.bround(age * 100, 2), _FIVE, "60PLUS")


def age_scaled_whole(age: Column) -> Column:
    """As age_scaled with whole percentages, halves to even; UNKNOWN below 0."""
    a = F.bround(age * 100)
    return F.when(a < 0, "UNKNOWN").otherwise(_steps(a, _FIVE, "60PLUS"))


def age_district(age: Column) -> Column:
    return _steps(age, [(18, "0_17"), (30, "18_29"), (45, "30_44"), (60, "45_59")], "60PLUS")


def age_lecture(age: Column) -> Column:
    return _steps(age, [(17, "0-17"), (29, "18-29"), (44, "30-44"), (59, "45-59")], "60+", inclusive=True)


def age_inclusive(age: Column) -> Column:
    return _steps(age, _FIVE, "60PLUS", inclusive=True)


def age_service(age: Column, scale: float = 100.0) -> Column:
    """Census-like bands; scale 1 takes the model output as it is, which always gives the first band."""
    return _steps(F.bround(age * scale, 1), [(18, "0-17"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")], "65+")


def age_word(word: Column) -> Column:
    """Bucket of an age word in any case; all others (also "teens", and words with spaces around them) and null stand for 20."""
    table = F.create_map(*[x for k, v in AGE_WORDS.items() for x in (F.lit(k), F.lit(v))])
    return _steps(F.coalesce(F.try_element_at(table, F.lower(word)), F.lit(20)), _FIVE, "60PLUS")


def age_years(age: Column) -> Column:
    """Ages already from 0 to 100, rounded with halves to even."""
    return _steps(F.bround(age), _FIVE, "60PLUS")


def gender_code(code: Column, convention: str = "female_first") -> Column:
    """Name of a code; the binary convention has FEMALE for all that isn't 1."""
    table = F.create_map(*[x for k, v in GENDERS[convention].items() for x in (F.lit(k), F.lit(v))])
    return F.when(code.isNotNull(), F.coalesce(F.try_element_at(table, code.cast("int")), F.lit("FEMALE" if convention == "binary" else "OTHER")))


def emotion_code(label: Column) -> Column:
    """Short code of an emotion; others are their first three letters in upper case."""
    table = F.create_map(*[x for k, v in EMOTIONS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(label))), F.upper(F.substring(F.trim(label), 1, 3)))


#: Emotion labels to their short names in mixed case, and what stands for failures (fixed values).
EMOTION_NAMES = {"ANGER": "Ang", "NEUTRAL": "Neu", "SADNESS": "Sad", "HAPPINESS": "Hap", "FEAR": "Fea", "DISGUST": "Dis", "SURPRISE": "Sur", "ERRORLOADINGMODEL": "Err", "NO_AUDIO": "NA", "EXTRACTION_ERROR": "Err", "UNKNOWN": "Unk"}


def emotion_name(label: Column) -> Column:
    """Short name of an emotion or failure in any case; Unk for others and null."""
    table = F.create_map(*[F.lit(x) for pair in EMOTION_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(label)), F.lit("Unk"))


def title(c: Column) -> Column:
    """Underscores to spaces; the first letter of every run of letters (also behind - and ') in upper case, all others in lower case."""
    runs = F.split(F.replace(c, F.lit("_"), F.lit(" ")), r"(?U)(?<!\p{L})(?=\p{L})")
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def clock(seconds: Column) -> Column:
    """HH:MM:S.ss, seconds without a leading zero."""
    whole = F.floor(seconds / 60)
    return F.format_string("%02d:%02d:%.2f", F.floor(seconds / 3600), F.pmod(whole, F.lit(60)), F.pmod(seconds, F.lit(60.0)))


def timestamp_seconds(stamp: Column) -> Column:
    """Seconds of HH:MM:SS,mmm or HH:MM:SS.mmm; 0 for anything else."""
    part = lambda i: F.try_element_at(F.regexp_extract_all(stamp, F.lit(r"^\s*(\d{2}):(\d{2}):(\d{2})[,.](\d{3})"), F.lit(i)), F.lit(1)).cast("int")
    return F.coalesce(part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000.0, F.lit(0.0))


def content_key(*columns: Column, separator: str = "|||") -> Column:
    """SHA-1 of the columns joined; nulls are ''."""
    return F.sha1(F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def text_key(text: Column, *others: Column) -> Column:
    """MD5 of the text, or of the other columns as JSON if it is null."""
    return F.md5(F.coalesce(text, F.to_json(F.struct(*others))) if others else text)


def missing_to_null(c: Column, words: tuple[str, ...] = ("", "NA", "NONE", "NULL")) -> Column:
    """Null for a value that only says that there is none."""
    return F.when(~F.upper(F.trim(c)).isin(*words), c)


def gender_or_model(gender: Column, predicted: Column) -> Column:
    """The manifest's gender in upper case if it is one, else the model's."""
    return F.coalesce(F.upper(F.trim(missing_to_null(gender, ("", "NA")))), predicted)


def age_chain(reassigned: Column, original: Column, predicted: Column) -> Column:
    return F.coalesce(missing_to_null(reassigned), missing_to_null(original), predicted, F.lit("UNKNOWN"))


def known_gender(c: Column) -> Column:
    """FEMALE, MALE, OTHER or UNKNOWN."""
    up = F.upper(F.trim(c))
    return F.when(up.isin("FEMALE", "MALE", "OTHER"), up).otherwise("UNKNOWN")


def safe_divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))
