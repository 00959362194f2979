"""Queries over tagged transcripts: tags, cleaning, buckets, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.catalog import query
from voxloom.functions import buckets, paths, tags
from voxloom.operators import aggregates
from voxloom.plans.base import TAGGED, table, tagged
from voxloom.sources import sinks

_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query("manifest_basic", f"WITH {TAGGED} SELECT doc_id, audio_filepath, text, duration FROM t")
def manifest_basic(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", "audio_filepath", "text", "duration")


@query("manifest_hours_by_lang", f"WITH {TAGGED} SELECT lang, count(*) AS n, round(sum(duration) / 3600, 4) AS total_hours, round(avg(duration), 4) AS avg_seconds FROM t GROUP BY lang")
def manifest_hours_by_lang(spark, sf_dir):
    return aggregates.durations(tagged(spark, sf_dir), ["lang"]).select("lang", "n", F.round("total_hours", 4).alias("total_hours"), F.round("avg_seconds", 4).alias("avg_seconds"))


@query("clock_format", f"WITH {TAGGED} SELECT doc_id, printf('%02d:%02d:%.2f', floor(duration / 3600)::BIGINT, floor(duration / 60)::BIGINT % 60, duration % 60) AS clock FROM t")
def clock_format(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", buckets.clock(F.col("duration")).alias("clock"))


_AGE_SQL = """WITH a AS (SELECT doc_id, (doc_id % 100) / 100::DOUBLE AS age, (doc_id % 100)::DOUBLE AS years FROM documents),
b AS (SELECT *, round_even(age * 100, 2) AS pct, round_even(age * 100, 0) AS whole FROM a)
SELECT doc_id,
 CASE WHEN pct < 18 THEN '0_18' WHEN pct < 30 THEN '18_30' WHEN pct < 45 THEN '30_45' WHEN pct < 60 THEN '45_60' ELSE '60PLUS' END AS scaled,
 CASE WHEN whole < 0 THEN 'UNKNOWN' WHEN whole < 18 THEN '0_18' WHEN whole < 30 THEN '18_30' WHEN whole < 45 THEN '30_45' WHEN whole < 60 THEN '45_60' ELSE '60PLUS' END AS scaled_whole,
 CASE WHEN years < 18 THEN '0_17' WHEN years < 30 THEN '18_29' WHEN years < 45 THEN '30_44' WHEN years < 60 THEN '45_59' ELSE '60PLUS' END AS district,
 CASE WHEN years <= 17 THEN '0-17' WHEN years <= 29 THEN '18-29' WHEN years <= 44 THEN '30-44' WHEN years <= 59 THEN '45-59' ELSE '60+' END AS lecture,
 CASE WHEN years <= 18 THEN '0_18' WHEN years <= 30 THEN '18_30' WHEN years <= 45 THEN '30_45' WHEN years <= 60 THEN '45_60' ELSE '60PLUS' END AS inclusive,
 CASE WHEN pct < 18 THEN '0-17' WHEN pct < 25 THEN '18-24' WHEN pct < 35 THEN '25-34' WHEN pct < 45 THEN '35-44' WHEN pct < 55 THEN '45-54' WHEN pct < 65 THEN '55-64' ELSE '65+' END AS service,
 ['18_30', '30_45', '45_60', '45_60', '60PLUS', '60PLUS', '60PLUS', '60PLUS', '18_30', '18_30', '18_30', '45_60'][doc_id % 12 + 1] AS word,
 CASE WHEN years < 18 THEN '0_18' WHEN years < 30 THEN '18_30' WHEN years < 45 THEN '30_45' WHEN years < 60 THEN '45_60' ELSE '60PLUS' END AS years FROM b"""


@query("age_bucket_all", _AGE_SQL)
def age_bucket_all(spark, sf_dir):
    age, years = F.expr("CAST(doc_id % 100 AS DOUBLE) / 100"), F.expr("CAST(doc_id % 100 AS DOUBLE)")
    word = F.expr("element_at(array('twenties', 'thirties', 'fourties', 'fifties', 'sixties', 'seventies', 'eighties', 'nineties', 'teens', 'other', NULL, 'Fourties'), CAST(doc_id % 12 AS INT) + 1)")
    return table(spark, sf_dir, "documents").select("doc_id", buckets.age_scaled(age).alias("scaled"), buckets.age_scaled_whole(age).alias("scaled_whole"), buckets.age_district(years).alias("district"), buckets.age_lecture(years).alias("lecture"), buckets.age_inclusive(years).alias("inclusive"), buckets.age_service(age).alias("service"), buckets.age_word(word).alias("word"), buckets.age_years(years).alias("years"))


@query("code_maps", """SELECT event_id, ['FEMALE', 'MALE', 'OTHER'][user_id % 3 + 1] AS female_first, ['MALE', 'FEMALE', 'OTHER'][user_id % 3 + 1] AS male_first,
    CASE WHEN user_id % 3 = 1 THEN 'MALE' ELSE 'FEMALE' END AS binary_code, upper(substr(event_type, 1, 3)) AS emotion, upper(event_type[1]) || event_type[2:] AS title FROM events""")
def code_maps(spark, sf_dir):
    code = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select("event_id", *[buckets.gender_code(code, k).alias(n) for k, n in (("female_first", "female_first"), ("male_first", "male_first"), ("binary", "binary_code"))], buckets.emotion_code(F.col("event_type")).alias("emotion"), buckets.title(F.col("event_type")).alias("title"))


@query("parse_metadata", f"""WITH {TAGGED}, r AS (SELECT doc_id, text,
    CASE WHEN regexp_matches(text, 'AGE_\\d+_\\d+') THEN regexp_extract(text, 'AGE_(\\d+)_(\\d+)', 1) || '-' || regexp_extract(text, 'AGE_(\\d+)_(\\d+)', 2) WHEN regexp_matches(text, 'AGE_\\d+PLUS') THEN regexp_extract(text, 'AGE_(\\d+)PLUS', 1) || '+' END AS age_group,
    CASE regexp_extract(text, 'GER_(FEMALE|MALE)', 1) WHEN 'FEMALE' THEN 'Female' WHEN 'MALE' THEN 'Male' END AS gender,
    nullif(regexp_extract(text, 'EMOTION_(\\w+)', 1), '') AS emotion, nullif(regexp_extract(text, 'INTENT_(\\w+)', 1), '') AS intent,
    regexp_replace(regexp_replace(regexp_replace(CASE WHEN regexp_matches(text, 'AGE_\\d+_\\d+') THEN regexp_replace(text, 'AGE_\\d+_\\d+', '', 'g') ELSE regexp_replace(text, 'AGE_\\d+PLUS', '', 'g') END, 'GER_(FEMALE|MALE)', '', 'g'), 'EMOTION_\\w+', '', 'g'), 'INTENT_\\w+', '', 'g') AS rest FROM t)
    SELECT doc_id, age_group, gender, emotion, intent, {_SQUEEZE.format('rest')} AS text FROM r""")
def parse_metadata(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", *[c.alias(n) for n, c in tags.parse_metadata(F.col("text")).items()])


@query("reorder_metadata", f"""WITH {TAGGED}, m AS (SELECT doc_id, 'INTENT_ASK ' || text || ' AGE_0_18' AS text FROM t), f AS (SELECT doc_id, text, list_sort(list_distinct(regexp_extract_all(text, '\\b((?:INTENT|AGE|GER|EMOTION)_\\w+)\\b', 1))) AS g FROM m)
    SELECT doc_id, {_SQUEEZE.format("regexp_replace(text, '\\b((?:INTENT|AGE|GER|EMOTION)_\\w+)\\b', '', 'g')")} || ' ' || array_to_string(list_concat(list_concat(list_filter(g, lambda x: starts_with(x, 'AGE_')), list_filter(g, lambda x: starts_with(x, 'GER_'))), list_concat(list_filter(g, lambda x: starts_with(x, 'EMOTION_')), list_filter(g, lambda x: starts_with(x, 'INTENT_')))), ' ') AS text FROM f""")
def reorder_metadata(spark, sf_dir):
    mixed = F.concat(F.lit("INTENT_ASK "), F.col("text"), F.lit(" AGE_0_18"))
    return tagged(spark, sf_dir).select("doc_id", tags.reorder_metadata(mixed).alias("text"))


@query("strip_tags", f"""WITH {TAGGED} SELECT doc_id, trim(regexp_replace(regexp_replace(text, '(?i)\\b(AGE_[0-9]+_[0-9]+|GER_[A-Z]+|EMOTION_[A-Z]+|INTENT_[A-Z]+|ENTITY_[A-Z0-9_]+)\\b', '', 'g'), '\\s{{2,}}', ' ', 'g')) AS inline_stripped,
    {_SQUEEZE.format("regexp_replace(text, '[A-Z]+(_[A-Z0-9]+)+', '', 'g')")} AS all_stripped FROM t""")
def strip_tags(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.strip_inline_tags(F.col("text")).alias("inline_stripped"), tags.strip_all_tags(F.col("text")).alias("all_stripped"))


@query("strip_entity_tags", f"WITH {TAGGED} SELECT doc_id, regexp_replace(text, 'ENTITY_[A-Z_]+\\s+(.+?)\\s+END', '\\1', 'g') AS text FROM t")
def strip_entity_tags(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.strip_entity_tags(F.col("text")).alias("text"))


@query("remove_existing_tags", f"WITH {TAGGED} SELECT doc_id, regexp_replace(regexp_replace(text, '(NER|ENTITY)_\\w+\\s?', '', 'g'), '\\s?END', '', 'g') AS text FROM t")
def remove_existing_tags(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.remove_existing_tags(F.col("text")).alias("text"))


@query("tag_vocab", f"""WITH {TAGGED}, x AS (SELECT unnest(regexp_extract_all(text, '\\b([A-Z]+_[A-Z0-9_]+)\\b', 1)) AS tag FROM t)
    SELECT string_split(tag, '_')[1] AS prefix, string_agg(DISTINCT tag, ',' ORDER BY tag) AS labels FROM x GROUP BY 1""")
def tag_vocab(spark, sf_dir):
    return aggregates.label_vocabulary(tagged(spark, sf_dir), "text")


@query("tag_counts", f"""WITH {TAGGED}, x AS (SELECT unnest(regexp_extract_all(text, '\\b([A-Z]+_[A-Z0-9_]+)\\b', 1)) AS tag FROM t)
    SELECT tag, count(*) AS n, string_split(tag, '_')[1] AS prefix FROM x GROUP BY tag""")
def tag_counts(spark, sf_dir):
    return aggregates.tag_counts(tagged(spark, sf_dir), "text")


@query("tag_prefix_counts", f"""WITH {TAGGED}, x AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\b([A-Z]+_[A-Z0-9_]+)\\b', 1)) AS tag FROM t)
    SELECT string_split(tag, '_')[1] AS prefix, count(*) AS tags FROM x GROUP BY 1""")
def tag_prefix_counts(spark, sf_dir):
    return aggregates.prefix_counts(tagged(spark, sf_dir), "text")


_RUNS = "replace(text, chr(10), ' the the the END END END and and ')"


@query("word_run_collapse", f"""WITH w AS (SELECT doc_id, list_filter(string_split({_RUNS}, ' '), lambda x: x <> '') AS w FROM documents)
    SELECT doc_id, array_to_string(list_filter(w, lambda x, i: x = 'END' OR i < 3 OR NOT (w[i - 1] = x AND w[i - 2] = x)), ' ') AS text FROM w""")
def word_run_collapse(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tags.collapse_word_runs(F.expr(_RUNS)).alias("text"))


_W = "\\pL\\pN\\pM_"
#: Words and what stands between them in turn; of three or more equal words with only white space between them, the last.
_ONCE = f"""WITH w AS (SELECT doc_id, regexp_extract_all({_RUNS}, '[{_W}]+|[^{_W}]+') AS t FROM documents), s AS (SELECT doc_id, t, list_transform(t, lambda x, i: coalesce(x = t[i + 2] AND regexp_full_match(t[i + 1], '\\s+') AND regexp_matches(x, '[{_W}]'), false)) AS s FROM w),
    g AS (SELECT doc_id, t, list_transform(s, lambda x, i: x AND (coalesce(s[i + 2], false) OR (i > 2 AND coalesce(s[greatest(i - 2, 1)], false)))) AS g FROM s),
    o AS (SELECT doc_id, array_to_string(list_filter(t, lambda x, i: NOT (g[i] OR (i > 1 AND g[greatest(i - 1, 1)]))), '') AS text FROM g)"""


@query("word_repeat_fixpoint", f"{_ONCE} SELECT doc_id, text, {_SQUEEZE.format('text')} || ' AGE_0_18' AS moved FROM o")
def word_repeat_fixpoint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tags.collapse_repeats(F.expr(_RUNS)).alias("text"), tags.metadata_to_end(F.concat(F.lit("AGE_0_18 "), F.expr(_RUNS))).alias("moved"))


def _broken(spark, sf_dir):
    """Tagged texts with the faults of model replies."""
    return tagged(spark, sf_dir).select("doc_id", F.expr("replace(replace(text, ' END ', CASE WHEN doc_id % 2 = 0 THEN ' END END ' ELSE 'END ' END), 'ENTITY_PERSON_NAME', CASE WHEN doc_id % 4 = 1 THEN 'ENTITY_PERSON_NAM E' ELSE 'ENTITY_PERSON_NAME' END)").alias("text"))


_BROKEN = f"WITH {TAGGED}, b AS (SELECT doc_id, replace(replace(text, ' END ', CASE WHEN doc_id % 2 = 0 THEN ' END END ' ELSE 'END ' END), 'ENTITY_PERSON_NAME', CASE WHEN doc_id % 4 = 1 THEN 'ENTITY_PERSON_NAM E' ELSE 'ENTITY_PERSON_NAME' END) AS text FROM t)"


def _steps(*steps: tuple[str, str]) -> str:
    """SQL of replacements (pattern, with what) one after the other, over texts with white space runs as one space."""
    out = _SQUEEZE.format("text")
    for pattern, to in steps:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


def _marks(c: str, marks: str) -> str:
    return _SQUEEZE.format(f"regexp_replace(regexp_replace({c}, '\\s+([{marks}])', '\\1', 'g'), '([{marks}])([{_W}])', '\\1 \\2', 'g')")


_SPACED = ("(ENTITY_[A-Z0-9_]+)([^A-Z0-9_\\s])", "\\1 \\2")
_BEFORE_END = (f"(\\S)END([^{_W}]|$)", "\\1 END\\2")
#: The last span is open until metadata follows, and a text without an END right before that gets one.
_A = _steps(("\\s+END\\s+(AGE_|GENDER_|EMOTION_|INTENT_|$)", " \\1"), ("\\s+END\\s+END", " END"), ("(ENTITY_[A-Z0-9_]+\\s+\\S.*?)(\\s+(AGE_|GENDER_|EMOTION_|INTENT_))", "\\1 END\\2"), _SPACED, _BEFORE_END)
_B = _steps(_SPACED, _BEFORE_END, (f"(^|[^{_W}])END(\\S)", "\\1END \\2"), ("END\\s+END", "END"), ("END\\s*(AGE_|GENDER_|EMOTION_|INTENT_|$)", "\\1"))
_C = _steps(("([।?!:;,.])\\s+END(\\s+INTENT_|\\s*$)", "\\1\\2"), ("END(\\s+END)+", "END"), ("\\sEND\\s+(INTENT_)", " \\1"), _SPACED, _BEFORE_END)
_REPLY = f"""regexp_replace(regexp_replace(text, '(\\S)END([^{_W}]|$)', '\\1 END\\2', 'g'), '(ENTITY_[A-Z0-9_]+)([^A-Z0-9_\\s])', '\\1 \\2', 'g')"""
_GLUED = "text"
for _pattern, _to in (("(ENTITY_[A-Z]+)_([A-Z]+)\\s+([A-Z]+)", "\\1_\\2\\3"), ("(ENTITY_[A-Z]+)\\s+([A-Z]+)", "\\1\\2"), ("(ENTITY_[A-Z]+)_([A-Z]{2,})\\s+([A-Z])", "\\1_\\2\\3"), ("(ENTITY_[A-Z_]+)\\s+([A-Z]+)", "\\1\\2")):
    _GLUED = f"regexp_replace({_GLUED}, '{_pattern}', '{_to}', 'g')"

for _name, _rule, _sql in (
    ("fix_end_family_a", tags.fix_end_family_a, f"{_BROKEN}, a AS (SELECT doc_id, {_A} AS text FROM b) SELECT doc_id, {_marks('text', '?!:;,.')} AS text FROM a"),
    ("fix_end_family_b", tags.fix_end_family_b, f"{_BROKEN}, a AS (SELECT doc_id, {_B} AS text FROM b) SELECT doc_id, {_marks('text', '?!:;,.।')} AS text FROM a"),
    ("fix_end_family_c", tags.fix_end_family_c, f"{_BROKEN}, a AS (SELECT doc_id, {_C} AS text FROM b) SELECT doc_id, {_marks('text', '।?!:;,.')} || CASE WHEN doc_id % 3 < 2 THEN ' END' ELSE '' END AS text FROM a"),
    ("fix_end_of_reply", tags.fix_end_of_reply, f"{_BROKEN}, a AS (SELECT doc_id, {_REPLY} AS text FROM b) SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN regexp_replace(text, '(ENTITY_[A-Z0-9_]+\\s+\\S+)', '\\1 END') ELSE text END AS text FROM a"),
    ("glue_split_tags", tags.glue_split_tags, f"""{_BROKEN}, a AS (SELECT doc_id, {_GLUED} AS text FROM b)
        SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN substr(text, 1, position('END' IN text) + 2) || replace(substr(text, position('END' IN text) + 3), 'END', '') ELSE regexp_replace(text, '(^|[^{_W}])END([^{_W}]|$)', '\\1\\2', 'g') END AS text FROM a"""),
    ("join_tag_parts", tags.join_tag_parts(), f"{_BROKEN} SELECT doc_id, replace(text, 'ENTITY_PERSON_NAM E ', 'ENTITY_PERSON_NAME ') AS text FROM b"),
    ("fix_tag_case", tags.fix_tag_case, f"{_BROKEN}, a AS (SELECT doc_id, regexp_replace(text, '(^|[^{_W}])[Ee][Nn][Dd]([^{_W}]|$)', '\\1END\\2', 'g') AS text FROM b) SELECT doc_id, regexp_replace(text, '(^|[^{_W}])[Ee][Nn][Dd]([^{_W}]|$)', '\\1END\\2', 'g') AS text FROM a"),
    ("capitalize_entities", tags.capitalize_entities, f"{_BROKEN} SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN text WHEN doc_id % 2 = 0 THEN replace(replace(text, 'paris END END', 'Paris END  END'), 'Roy END END', 'Roy END  END') ELSE replace(replace(text, 'parisEND', 'Paris END'), 'RoyEND', 'Roy END') END AS text FROM b"),
    ("normalize_ner_case", tags.normalize_ner_case, f"{_BROKEN} SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: CASE WHEN upper(w) = 'END' OR regexp_matches(w, '^(?i)(AGE|GER|GENDER|EMOTION|INTENT)_') THEN upper(w) ELSE lower(w) END), ' ') AS text FROM b"),
):
    query(_name, _sql)(lambda spark, sf_dir, rule=_rule: _broken(spark, sf_dir).select("doc_id", rule(F.col("text")).alias("text")))


_UPPER = "html"
for _open, _close in ("<>", ("\\[", "\\]"), ("\\{", "\\}"), ("\\(", "\\)")):
    _UPPER = f"""array_to_string(list_transform(regexp_extract_all({_UPPER}, '{_open}[^{_close}]*{_close}|[^{_open}]+|{_open}'), lambda x: CASE WHEN regexp_full_match(x, '{_open}[^{_close}]*{_close}') THEN ' ' || upper(replace(trim(regexp_replace(x[2:-2], '\\s+', ' ', 'g')), 'ß', 'SS')) || ' ' ELSE x END), '')"""


@query("upper_brackets", f"SELECT page_id, {_SQUEEZE.format(_UPPER)} AS text FROM pages")
def upper_brackets(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tags.upper_brackets(F.col("html")).alias("text"))


@query("collapse_repeated_ner", """WITH w AS (SELECT doc_id, list_filter(string_split('NER_CITY NER_CITY END END ' || replace(text, chr(10), ' END NER_X END '), ' '), lambda x: x <> '') AS w FROM documents)
    SELECT doc_id, array_to_string(list_filter(w, lambda x, i: NOT (x = 'END' OR starts_with(x, 'NER_')) OR NOT list_contains(list_slice(w, i - list_position(list_reverse(list_concat(['#'], list_transform(w[1:i - 1], lambda y: CASE WHEN y = 'END' OR starts_with(y, 'NER_') THEN 't' ELSE '#' END))), '#') + 1, i - 1), x)), ' ') AS text FROM w""")
def collapse_repeated_ner(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tags.collapse_repeated_ner(F.expr("concat('NER_CITY NER_CITY END END ', replace(text, chr(10), ' END NER_X END '))")).alias("text"))


@query("bracket_clean", "SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '\\[[^\\]]*\\]', '', 'g'), '\\{[^}]*\\}', '', 'g') AS text FROM pages")
def bracket_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tags.drop_brackets(F.col("html")).alias("text"))


@query("english_token_drop", f"WITH {TAGGED} SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]*>', '', 'g'), '\\[[^\\]]*\\]', '', 'g'), '\\{{[^}}]*\\}}', '', 'g'), ' '), lambda x: x <> '' AND (NOT regexp_full_match(x, '[a-zA-Z]+') OR x = 'END')), ' ') AS text FROM t")
def english_token_drop(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.drop_latin_words(F.col("text")).alias("text"))


@query("vocabulary_filter", """SELECT doc_id, array_to_string(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '' AND (lower(x) IN ('the', 'of', 'and', 'to', 'de', 'la', 'der') OR regexp_full_match(x, '\\d+') OR x IN (',', '.', '!', '?', ';', ':', '-'))), ' ') AS text FROM documents""")
def vocabulary_filter(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in ("the", "of", "and", "to", "de", "la", "der")])
    return table(spark, sf_dir, "documents").select("doc_id", tags.keep_vocabulary(F.col("text"), words).alias("text"))


@query("append_metadata", """SELECT doc_id, trim(text, ' ') || ' AGE_' || CASE WHEN doc_id % 2 = 0 THEN '18_30' ELSE '30_45' END || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' GENDER_MALE' END || ' EMOTION_NEU' AS text,
    upper('intent') || '_' || translate(upper(lang || ' a-b/c'), ' -/', '___') AS tag, 'DOMAIN_' || upper(replace(lang || ' health', ' ', '_')) AS safe FROM documents""")
def append_metadata(spark, sf_dir):
    age, gender = F.expr("CASE WHEN doc_id % 2 = 0 THEN '18_30' ELSE '30_45' END"), F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'MALE' END")
    return table(spark, sf_dir, "documents").select("doc_id", tags.append_metadata(F.col("text"), age=age, gender=gender, emotion=F.lit("NEU")).alias("text"), tags.format_tag("intent", F.concat("lang", F.lit(" a-b/c"))).alias("tag"), tags.safe_tag("domain", F.concat("lang", F.lit("  health"))).alias("safe"))


@query("placeholders", f"""WITH {TAGGED} SELECT doc_id, replace(replace('AGE_PLACEHOLDER GENDER_PLACEHOLDER ' || text, 'AGE_PLACEHOLDER', 'AGE_' || doc_id % 90), 'GENDER_PLACEHOLDER', CASE WHEN doc_id % 2 = 0 THEN 'GENDER_F' ELSE 'GENDER_PLACEHOLDER' END) AS text,
    coalesce(list_filter(string_split(text, ' '), lambda x: starts_with(x, 'INTENT_'))[-1], 'INTENT_OTHER') AS intent FROM t""")
def placeholders(spark, sf_dir):
    marked = F.concat(F.lit("AGE_PLACEHOLDER GENDER_PLACEHOLDER "), F.col("text"))
    return tagged(spark, sf_dir).select("doc_id", tags.fill_placeholders(marked, age=F.expr("CAST(doc_id % 90 AS STRING)"), gender=F.expr("CASE WHEN doc_id % 2 = 0 THEN 'F' END")).alias("text"), tags.last_intent(F.col("text")).alias("intent"))


@query("drop_upper_words", f"WITH {TAGGED} SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: NOT (upper(w) = w AND lower(w) <> w)), ' ') AS text FROM t")
def drop_upper_words(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.drop_upper_words(F.col("text")).alias("text"))


@query("inject_entities", """SELECT doc_id, CASE WHEN length(text) >= 8 THEN 'ENTITY_FIRST ' || substr(text, 1, 3) || ' END' || substr(text, 4, 2) || 'ENTITY_SECOND ' || substr(text, 6, 2) || ' END' || substr(text, 8) ELSE text END AS by_offset,
    CASE WHEN position('the' IN text) > 0 THEN substr(text, 1, position('the' IN text) - 1) || 'ENTITY_WORD the END' || substr(text, position('the' IN text) + 3) ELSE text END AS by_text FROM documents""")
def inject_entities(spark, sf_dir):
    spans = F.expr("filter(array(named_struct('start', 0, 'end', 3, 'type', 'first'), named_struct('start', 5, 'end', 7, 'type', 'second')), x -> length(text) >= 8)")
    words = F.expr("array(named_struct('text', 'the', 'type', 'word'))")
    return table(spark, sf_dir, "documents").select("doc_id", tags.inject_spans(F.col("text"), spans).alias("by_offset"), tags.inject_strings(F.col("text"), words).alias("by_text"))


@query("bio_repair", """WITH w AS (SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM documents),
    l AS (SELECT doc_id, w, ['B-city', 'i-x', 'B-PERSON NAME', 'O', 'I-person'][1:(doc_id % 6)::INT] AS l FROM w)
    SELECT doc_id, len(w) AS n, array_to_string(list_transform(w, lambda x, i: CASE WHEN i > len(l) THEN 'O' WHEN regexp_matches(l[i], '^[BI]-.') THEN substr(l[i], 1, 2) || upper(replace(substr(l[i], 3), ' ', '')) ELSE 'O' END), ' ') AS labels FROM l""")
def bio_repair(spark, sf_dir):
    words = tags.tokens(F.col("text"))
    labels = F.expr("slice(array('B-city', 'i-x', 'B-PERSON NAME', 'O', 'I-person'), 1, CAST(doc_id % 6 AS INT))")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("long").alias("n"), F.array_join(tags.repair_bio(words, labels), " ").alias("labels"))


@query("path_functions", """SELECT doc_id, 'a' || doc_id || '.b.WAV' AS base, 'a' || doc_id || '.b' AS stem, '/data/' || source || '/raw' AS dir, 'wav' AS ext, 'audio/wav' AS mime,
    source || '/raw/a' || doc_id || '.b.WAV' AS relative, '/data/' || source || '/a' || doc_id || '.b.WAV' AS dropped, '/root/x' || doc_id AS joined, 'bucket' AS bucket, source || '/' || doc_id AS blob, 'a_b' || doc_id AS title, 'ab' || doc_id AS name FROM documents""")
def path_functions(spark, sf_dir):
    p = F.expr("concat('/data/', source, '/raw/a', doc_id, '.b.WAV')")
    uri = paths.parse_object_uri(F.expr("concat('gs://bucket/', source, '/', doc_id)"))
    return table(spark, sf_dir, "documents").select("doc_id", paths.basename(p).alias("base"), paths.stem(p).alias("stem"), paths.dirname(p).alias("dir"), paths.extension(p).alias("ext"), paths.mime_type(p).alias("mime"), paths.relative_to(p, "/data").alias("relative"), paths.drop_segment(p, "raw").alias("dropped"), paths.join_path("/root/", F.expr("concat('x', doc_id)")).alias("joined"), uri["bucket"].alias("bucket"), uri["blob"].alias("blob"), paths.safe_title(F.expr("concat('a b', doc_id, '?')")).alias("title"), paths.safe_name(F.expr("concat('a b', doc_id, '?')")).alias("name"))


@query("url_parse", "SELECT page_id, regexp_extract(url, '^https?://([^/]+)/(.+)$', 1) AS host, regexp_extract(url, '^https?://([^/]+)/(.+)$', 2) AS rest FROM pages")
def url_parse(spark, sf_dir):
    part = paths.parse_object_uri(F.col("url"), "https?")
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(part["bucket"], F.lit("")).alias("host"), F.coalesce(part["blob"], F.lit("")).alias("rest"))


@query("content_keys", "SELECT doc_id, md5(text) AS md5, sha1(text || '|||' || lang) AS sha1 FROM documents")
def content_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"), buckets.content_key(F.col("text"), F.col("lang")).alias("sha1"))


@query("missing_chains", """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN event_type ELSE coalesce(CASE WHEN user_id % 4 > 0 THEN 'u' || user_id % 4 END, 'UNKNOWN') END AS age,
    CASE WHEN event_type = 'view' THEN 'MODEL' ELSE upper(event_type) END AS gender, CASE WHEN event_type = 'error' THEN 'FEMALE' ELSE 'UNKNOWN' END AS known FROM events""")
def missing_chains(spark, sf_dir):
    a = F.expr("CASE event_type WHEN 'view' THEN 'NA' WHEN 'click' THEN ' null ' ELSE event_type END")
    return table(spark, sf_dir, "events").select("event_id", buckets.age_chain(a, F.expr("CASE WHEN user_id % 4 > 0 THEN concat('u', user_id % 4) ELSE '' END"), F.lit(None).cast("string")).alias("age"), buckets.gender_or_model(F.expr("CASE event_type WHEN 'view' THEN 'na' ELSE event_type END"), F.lit("MODEL")).alias("gender"), buckets.known_gender(F.expr("CASE event_type WHEN 'error' THEN ' female' ELSE event_type END")).alias("known"))


@query("timestamps", """SELECT event_id, CASE WHEN user_id % 9 = 0 THEN 0.0::DOUBLE ELSE (event_id % 24) * 3600 + (event_id % 60) * 60 + user_id % 60 + (event_id % 1000) / 1000::DOUBLE END AS seconds FROM events""")
def timestamps(spark, sf_dir):
    stamp = F.expr("CASE WHEN user_id % 9 = 0 THEN 'soon' ELSE format_string('%02d:%02d:%02d,%03d', event_id % 24, event_id % 60, user_id % 60, event_id % 1000) END")
    return table(spark, sf_dir, "events").select("event_id", buckets.timestamp_seconds(stamp).alias("seconds"))


@query("batch_requests", """WITH b AS (SELECT page_id // 10 AS batch, count(*) AS n FROM pages GROUP BY 1) SELECT 'request-' || batch AS custom_id, n FROM b""")
def batch_requests(spark, sf_dir):
    return sinks.batch_requests(table(spark, sf_dir, "pages"), "page_id", "url", 10, "model", "annotate").select("custom_id", F.col("n").cast("long").alias("n"))
