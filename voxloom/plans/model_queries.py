"""Queries over model steps with their deterministic stand-ins, and over audio that is made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.catalog import query
from voxloom.functions import buckets, numbers, providers, sequences, tags
from voxloom.operators import aggregates, filters, vocabulary
from voxloom.plans.base import TAGGED, table, tagged

_WORDS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"
#: Whether the first letter of a word x is a capital.
_CAPITAL = "(upper(x[1]) = x[1] AND lower(x[1]) <> x[1])"


def _unit(kind: str, key: str, digits: int = 12) -> str:
    """SQL of a stand-in's number from 0 to 1."""
    return f"(('0x' || substr(sha256('{kind}' || chr(0) || {key}), 1, {digits}))::BIGINT / {16 ** digits}::DOUBLE)"


_INTENT = "CASE WHEN regexp_matches({0}, '\\?\\s*$') THEN 'INTENT_QUESTION' ELSE 'INTENT_INFORM' END"


def _annotated(c: str) -> str:
    """SQL of StubAnnotator: the first capitalised word in a span, an intent at the end."""
    w = _WORDS.format(c)
    first = f"list_position(list_transform({w}, lambda x: {_CAPITAL}), true)"
    return f"array_to_string(list_append(list_transform({w}, lambda x, i: CASE WHEN i = {first} THEN 'ENTITY_PERSON_NAME ' || x || ' END' ELSE x END), {_INTENT.format(c)}), ' ')"


@query("annotate_stub", f"SELECT conv_id, turn, text, {_annotated('text')} AS annotated, NULL::VARCHAR AS error FROM conversations")
def annotate_stub(spark, sf_dir):
    return providers.annotate_batches(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text", providers.StubAnnotator)


@query("annotate_pairs_stub", f"""WITH a AS (SELECT conv_id, turn, role AS question, text AS answer, {_annotated('role')} AS question_annotated, {_annotated('text')} AS answer_annotated FROM conversations)
    SELECT *, regexp_extract(answer_annotated, '(INTENT_[A-Z_]+)$', 1) AS answer_intent FROM a""")
def annotate_pairs_stub(spark, sf_dir):
    q = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("question"), F.col("text").alias("answer"))
    return providers.annotate_pairs(q, "question", "answer", providers.StubAnnotator)


@query("emotion_stub", f"SELECT doc_id, 'EMOTION_' || ['NEU', 'HAP', 'SAD', 'ANG'][floor(4 * {_unit('emotion', 'text')})::INT + 1] AS emotion FROM documents")
def emotion_stub(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", providers.text_emotion(F.col("text")).alias("emotion"))


@query("audio_traits_stub", f"""WITH k AS (SELECT doc_id, n_chars, sha256(text) AS k FROM documents)
    SELECT doc_id, CASE WHEN n_chars >= 100 THEN round({_unit('age', 'k')}, 4) END AS age, CASE WHEN n_chars >= 100 THEN floor(3 * {_unit('gender', 'k')})::INT END AS gender,
    CASE WHEN n_chars >= 100 THEN ['neutral', 'happy', 'sad', 'angry'][floor(4 * {_unit('emotion', 'k')})::INT + 1] ELSE 'Audio_Too_Short' END AS emotion FROM k""")
def audio_traits_stub(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", providers.audio_traits(F.col("text").cast("binary"), F.expr("n_chars / 100D")).alias("t")).select("doc_id", "t.*")


@query("entity_spans_stub", f"SELECT conv_id, turn, array_to_string(list_transform(string_split(text, ' '), lambda x: CASE WHEN {_CAPITAL} THEN 'ENTITY_PERSON ' || x || ' END' ELSE x END), ' ') AS text FROM conversations")
def entity_spans_stub(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tags.inject_spans(F.col("text"), providers.entity_provider(F.col("text"))).alias("text"))


@query("diarize_stub", """WITH t AS (SELECT doc_id, n_chars / 15::DOUBLE AS seconds, unnest(range(0, greatest(floor(n_chars / 15::DOUBLE)::BIGINT, 1), 5)) AS s FROM documents WHERE n_chars > 0)
    SELECT doc_id, (s // 5)::INT AS pos, s::DOUBLE AS start, least(seconds, s + 5) AS "end", 'SPEAKER_0' || (s // 5) % 2 AS speaker FROM t""")
def diarize_stub(spark, sf_dir):
    return providers.diarize(table(spark, sf_dir, "documents").select("doc_id", F.expr("n_chars / 15D").alias("seconds")), "doc_id", "seconds")


_NUMBERS = "['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve']"


@query("inverse_normalize_stub", f"""WITH {TAGGED} SELECT doc_id, array_to_string(list_transform(string_split(trim(string_split(text, 'AGE_')[1]), ' '), lambda x: coalesce((list_position({_NUMBERS}, lower(x)) - 1)::VARCHAR, x)), ' ') || ' AGE_' || string_split(text, 'AGE_')[2] AS text, text AS stopped FROM t""")
def inverse_normalize_stub(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", tags.keep_head_of_age(F.col("text"), lambda c: providers.inverse_normalize(c, providers.to_twelve)).alias("text"), providers.sentence_stops(F.col("text")).alias("stopped"))


@query("sentence_stops_stub", "SELECT doc_id, substr(text, 1, 1) || replace(substr(text, 2), chr(10), '。' || chr(10)) AS text FROM documents")
def sentence_stops_stub(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", providers.sentence_stops(F.col("text")).alias("text"))


@query("punctuate_stub", "SELECT conv_id, turn, CASE WHEN regexp_full_match(text, '\\s*') THEN text ELSE upper(text[1]) || text[2:] || CASE WHEN text[-1] IN ('.', '?', '!') THEN '' ELSE '.' END END AS text FROM conversations")
def punctuate_stub(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", providers.punctuate(F.col("text")).alias("text"))


@query("bio_annotate_stub", f"""WITH w AS (SELECT conv_id, turn, text, {_WORDS.format('text')} AS w, {_WORDS.format('lower(text)')} AS low FROM conversations)
    SELECT conv_id, turn, array_to_string(low, ' ') AS tokens, array_to_string(list_transform(w, lambda x, i: CASE WHEN i < len(w) AND {_CAPITAL} THEN 'B-PERSON' ELSE 'O' END), ' ') AS tags, CASE WHEN ends_with(text, '?') THEN 'QUESTION' ELSE 'INFORM' END AS intent FROM w""")
def bio_annotate_stub(spark, sf_dir):
    out = providers.annotate_bio(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text")
    return out.select("conv_id", "turn", F.array_join("tokens", " ").alias("tokens"), F.array_join("tags", " ").alias("tags"), "intent")


@query("entities_intents_stub", f"""WITH h AS (SELECT doc_id, substr(text, 1, 6000) AS t FROM documents), w AS (SELECT doc_id, t, {_WORDS.format('t')} AS w FROM h)
    SELECT doc_id, array_to_string(list_transform(list_filter(w, lambda x: {_CAPITAL})[1:3], lambda x: trim(x, '.,;:!?') || ':PERSON'), '|') AS entities, CASE WHEN len(w) = 0 THEN '' WHEN regexp_matches(t, '\\?\\s*$') THEN 'QUESTION' ELSE 'INFORM' END AS intents, CASE WHEN len(w) > 0 THEN len(w) END AS words FROM w""")
def entities_intents_stub(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", providers.entities_and_intents(F.col("text")).alias("e"), providers.json_reply(F.col("text")).alias("summary"))
    named = F.array_join(F.transform("e.entities", lambda x: F.concat(x["text"], F.lit(":"), x["type"])), "|")
    return d.select("doc_id", named.alias("entities"), F.array_join("e.intents", ",").alias("intents"), F.get_json_object("summary", "$.words").cast("long").alias("words"))


@query("rare_keywords_stub", f"""WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM documents) WHERE length(word) >= 3 GROUP BY word),
    r AS (SELECT word FROM c WHERE n < 10 AND word IN (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) FROM benchmark)),
    w AS (SELECT DISTINCT doc_id, unnest({_WORDS.format('text')}) AS w FROM documents),
    k AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY length(w) DESC, w) AS n FROM w),
    p AS (SELECT doc_id, n, unnest(list_transform(string_split(w, ','), lambda x: trim(x))) AS keyword, generate_subscripts(string_split(w, ','), 1) AS i FROM k WHERE n <= 300),
    f AS (SELECT doc_id, keyword, row_number() OVER (PARTITION BY doc_id, lower(keyword) ORDER BY n, i) AS o FROM p)
    SELECT doc_id, keyword FROM f WHERE o = 1 AND length(keyword) >= 3 AND lower(keyword) IN (SELECT word FROM r)""")
def rare_keywords_stub(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rare = filters.rare_words(d, "text", aggregates.word_counts(table(spark, sf_dir, "benchmark"), "text"))
    return providers.rare_keywords(d, "doc_id", "text", rare)


def _little(c: str) -> str:
    """SQL (of Spark and DuckDB alike) of a number as four bytes in hex, the least first."""
    h = f"lpad(hex({c}), 8, '0')"
    return f"concat(substr({h}, 7, 2), substr({h}, 5, 2), substr({h}, 3, 2), substr({h}, 1, 2))"


#: A WAV of 100 8-bit samples a second, n_chars % 500 of them: a rising ramp of the document's own pitch.
_WAV = f"""unhex(concat('52494646', {_little('36 + n')}, '57415645666D7420', {_little('16')}, '01000100', {_little('100')}, {_little('100')}, '01000800', '64617461', {_little('n')}, repeat(lpad(hex(doc_id % 256), 2, '0'), CAST(n AS INT))))"""


def _audio(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id", "n_chars % 500 AS n").selectExpr("doc_id", "n", f"{_WAV} AS audio")


_AUDIO = f"a AS (SELECT doc_id, n, {_WAV} AS audio FROM (SELECT doc_id, n_chars % 500 AS n FROM documents))"


@query("transcribe_stub", f"""WITH {_AUDIO}, k AS (SELECT doc_id, n, sha256(audio) AS k FROM a)
    SELECT doc_id, array_to_string(list_transform(range(0, n // 100), lambda i: 'w' || substr(k, (i % 60 + 1)::INT, 4)), ' ') AS text, (n // 100)::BIGINT AS words, (n // 100)::DOUBLE AS last FROM k""")
def transcribe_stub(spark, sf_dir):
    heard = _audio(spark, sf_dir).select("doc_id", providers.transcribe(F.col("audio"), boost='{"paris": 2}\n{"rome": 1.5}').alias("t"))
    return heard.select("doc_id", "t.text", F.size("t.words").cast("long").alias("words"), F.coalesce(F.try_element_at("t.words", F.lit(-1))["end"], F.lit(0.0)).alias("last"))


@query("audio_measures", "SELECT doc_id, (n_chars % 500) / 100::DOUBLE AS seconds, greatest(least(n_chars % 500, 150) - 50, 0) / 100::DOUBLE AS cut, (n_chars % 500) * 2 / 200::DOUBLE AS resampled FROM documents")
def audio_measures(spark, sf_dir):
    a = F.col("audio")
    return _audio(spark, sf_dir).select("doc_id", providers.audio_duration(a).alias("seconds"), providers.audio_duration(providers.cut_audio(a, F.lit(0.5), F.lit(1.5))).alias("cut"), providers.audio_duration(providers.resample(a, 200)).alias("resampled"))


@query("span_contents", f"""WITH {TAGGED} SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'NER_PERSON Ana Maria END ' ELSE 'ENTITY_CARDINAL 7 END ' END || text AS text FROM t""")
def span_contents(spark, sf_dir):
    text = F.concat(F.expr("CASE doc_id % 3 WHEN 0 THEN 'NER_PERSON ana  MARIA END ' ELSE 'ENTITY_CARDINAL seven END ' END"), F.col("text"))
    return tagged(spark, sf_dir).select("doc_id", tags.normalize_span_contents(lambda p: "7" if p == "seven" else p)(text).alias("text"))


@query("repeated_spans", f"WITH {TAGGED} SELECT doc_id, 'ENTITY_CITY rome END x ENTITY_CITY rome END ' || text AS text FROM t")
def repeated_spans(spark, sf_dir):
    text = F.concat(F.lit("ENTITY_CITY rome END ENTITY_CITY rome END x ENTITY_CITY rome END "), F.col("text"))
    return tagged(spark, sf_dir).select("doc_id", tags.collapse_repeated_spans(text).alias("text"))


@query("strip_all_columns", "SELECT event_id, event_type || ' a' AS a, 'x' AS b FROM events")
def strip_all_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "concat(event_type, ' TAG_X  a') AS a", "concat(' x AGE_', user_id, '_9') AS b")
    return tags.strip_all_columns(rows)


@query("titles", "SELECT event_id, array_to_string(list_transform(string_split(event_type, '_'), lambda x: upper(x[1]) || lower(x[2:])), ' ') || ' Of' || '-It''S ' || user_id || 'X' AS title, CASE event_type WHEN 'click' THEN 'Ang' WHEN 'view' THEN 'NA' ELSE 'Unk' END AS emotion FROM events")
def titles(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", buckets.title(F.expr("concat(event_type, '_of-it''s ', user_id, 'x')")).alias("title"), buckets.emotion_name(F.expr("CASE event_type WHEN 'click' THEN 'anger' WHEN 'view' THEN 'No_Audio' ELSE event_type END")).alias("emotion"))


@query("text_keys", """SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN '{"doc_id":' || doc_id || ',"lang":"' || coalesce(lang, '') || '"}' ELSE text END) AS key FROM documents""")
def text_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", buckets.text_key(F.expr("CASE WHEN doc_id % 3 <> 0 THEN text END"), F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("lang")).alias("key"))


@query("inverse_normalize", """SELECT o_orderkey, 'order ' || (o_orderkey * 999983 + 7) % 1000000000000 || ' costs $' || (o_totalprice * 100)::BIGINT // 100 || CASE WHEN (o_totalprice * 100)::BIGINT % 100 = 0 THEN '' ELSE '.' || lpad(((o_totalprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') END
    || ', on ' || strftime(o_orderdate, '%Y-%m-%d') || ' the ' || CASE WHEN o_custkey = 1 THEN 'second' ELSE (o_custkey + 1) || CASE WHEN (o_custkey + 1) % 100 IN (11, 12, 13) THEN 'th' ELSE ['st', 'nd', 'rd'][CASE WHEN (o_custkey + 1) % 10 BETWEEN 1 AND 3 THEN ((o_custkey + 1) % 10)::INT END] END || ' asked for ' || o_custkey % 90 + 2 || ' kg and '
    || o_custkey % 100 || '% more. ' || o_orderpriority AS text FROM orders""".replace("ELSE ['st', 'nd', 'rd'][CASE WHEN (o_custkey + 1) % 10 BETWEEN 1 AND 3 THEN ((o_custkey + 1) % 10)::INT END] END", "WHEN (o_custkey + 1) % 10 = 1 THEN 'st' WHEN (o_custkey + 1) % 10 = 2 THEN 'nd' WHEN (o_custkey + 1) % 10 = 3 THEN 'rd' ELSE 'th' END END"))
def inverse_normalize(spark, sf_dir):
    """Orders told in words, whose numbers come back as digits."""
    o = table(spark, sf_dir, "orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    paid = F.concat(numbers.spell(F.floor(F.col("cents") / 100)), F.lit(" dollars"), F.when(F.col("cents") % 100 > 0, F.concat(F.lit(" and "), numbers.spell(F.col("cents") % 100), F.lit(" cents"))).otherwise(""))
    day = F.concat(F.date_format("o_orderdate", "MMMM"), F.lit(" "), numbers.spell_ordinal(F.dayofmonth("o_orderdate")), F.lit(" "), numbers.spell(F.year("o_orderdate")))
    said = F.concat(F.lit("order "), numbers.spell((F.col("o_orderkey") * 999983 + 7) % 10**12), F.lit(" costs "), paid, F.lit(", on "), day, F.lit(" the "), numbers.spell_ordinal(F.col("o_custkey") + 1), F.lit(" asked for "),
        numbers.spell(F.col("o_custkey") % 90 + 2), F.lit(" kilograms and "), numbers.spell(F.col("o_custkey") % 100), F.lit(" percent more. "), "o_orderpriority")
    return o.select("o_orderkey", numbers.inverse_normalize(said).alias("text"))


@query("vocabulary_spans", r"""WITH w AS (SELECT item_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM benchmark),
    b AS (SELECT item_id, unnest(list_concat(list_transform(list_filter(range(1, len(w)), lambda i: w[i] <> w[i + 1]), lambda i: w[i] || ' ' || w[i + 1]), [array_to_string(w[1:6], ' ')])) AS phrase FROM w),
    v AS (SELECT phrase, min('KIND_' || item_id % 3) AS type FROM b WHERE phrase <> '' GROUP BY phrase),
    c AS (SELECT doc_id, text, phrase, type, string_split(text, phrase) AS parts FROM documents JOIN v ON contains(text, phrase)),
    p AS (SELECT doc_id, text, phrase, type, unnest(list_transform(range(1, len(parts)), lambda i: list_sum(list_transform(parts[1:i], lambda x: length(x))) + (i - 1) * length(phrase)))::BIGINT AS start FROM c),
    a AS (SELECT doc_id, start, max_by({'e': start + length(phrase), 't': type}, length(phrase)) AS best FROM p
        WHERE NOT regexp_matches(substr(text, start, CASE WHEN start > 0 THEN 1 ELSE 0 END), '[\pL\p{N}]') AND NOT regexp_matches(substr(text, start + length(phrase) + 1, 1), '[\pL\p{N}]') GROUP BY doc_id, start),
    l AS (SELECT doc_id, list([{'s': start, 'e': best.e, 't': best.t}] ORDER BY start) AS found FROM a GROUP BY doc_id),
    g AS (SELECT doc_id, list_reduce(found, lambda x, y: CASE WHEN y[1].s >= x[-1].e THEN list_concat(x, y) ELSE x END) AS kept FROM l)
    SELECT d.doc_id, coalesce(array_to_string(list_transform(kept, lambda x: x.s || '-' || x.e || ' ' || x.t), ','), '') AS spans, coalesce(list_reduce(list_concat([text], list_transform(list_reverse(kept), lambda x: x.s || '|' || x.e || '|' || x.t)),
        lambda t, x: substr(t, 1, split_part(x, '|', 1)::INT) || 'ENTITY_' || split_part(x, '|', 3) || ' ' || substr(t, split_part(x, '|', 1)::INT + 1, split_part(x, '|', 2)::INT - split_part(x, '|', 1)::INT) || ' END' || substr(t, split_part(x, '|', 2)::INT + 1)), text) AS tagged
    FROM documents d LEFT JOIN g USING (doc_id)""")
def vocabulary_spans(spark, sf_dir):
    """Pairs of different neighbouring words and first six words of benchmark items, wherever they stand in documents. (Pairs of one word overlap themselves, which the SQL doesn't see.)"""
    w = table(spark, sf_dir, "benchmark").select("item_id", F.filter(F.split("text", " "), lambda x: x != "").alias("w"))
    two = F.filter(F.transform("w", lambda x, i: F.when(x != F.get(F.col("w"), i + 1), F.concat(x, F.lit(" "), F.get(F.col("w"), i + 1)))), lambda x: x.isNotNull())
    phrases = w.select(F.explode(F.concat(two, F.array(F.array_join(F.slice("w", 1, 6), " ")))).alias("phrase"), F.concat(F.lit("KIND_"), F.col("item_id") % 3).alias("type"))
    found = vocabulary.vocabulary_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", phrases)
    shown = F.array_join(F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"], F.lit(" "), s["type"])), ",")
    return found.select("doc_id", shown.alias("spans"), tags.inject_spans(F.col("text"), F.col("spans")).alias("tagged"))


#: Rows that models are fitted on; the others are held out.
_FITTED = "crc32(CAST(doc_id AS STRING)) % 3 <> 1"


def _punctuated(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    model = sequences.fit_punctuation(d.where(_FITTED), "text")
    return d.select("doc_id", "text", providers.punctuate(sequences.spoken(F.col("text")), model).alias("punctuated"))


@query("punctuate")
def punctuate(spark, sf_dir):
    """All documents as they are heard, with marks and capitals from a model of two thirds of them."""
    return _punctuated(spark, sf_dir).select("doc_id", F.col("punctuated").alias("text"))


@query("punctuation_scores")
def punctuation_scores(spark, sf_dir):
    """How well marks are found in the documents that were held out."""
    return sequences.mark_scores(_punctuated(spark, sf_dir).where(f"NOT ({_FITTED})"), "doc_id", "text", "punctuated")


def _segmented(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    model = sequences.fit_segments(d.where(_FITTED), "text")
    return d.select("doc_id", sequences.segment(sequences.unstopped(F.col("text")), model).alias("s")).select("doc_id", "s.*")


@query("sentence_segments")
def sentence_segments(spark, sf_dir):
    """All documents without their stops, and where a model of two thirds of them puts stops."""
    return _segmented(spark, sf_dir).select("doc_id", F.array_join("ends", ",").alias("ends"), "text")


@query("sentence_ends", r"""WITH p AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?。！？]+')) AS s, generate_subscripts(string_split_regex(text, '[.!?。！？]+'), 1) AS i FROM documents),
    e AS (SELECT doc_id, s, sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i) - length(s) + length(regexp_replace(s, '\s+$', '')) AS e FROM p)
    SELECT doc_id, e::INT AS "end" FROM e WHERE NOT regexp_full_match(s, '\s*')""")
def sentence_ends(spark, sf_dir):
    return sequences.sentence_ends(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("segment_scores")
def segment_scores(spark, sf_dir):
    """How well ends of sentences are found in the documents that were held out."""
    held = f"NOT ({_FITTED})"
    found = _segmented(spark, sf_dir).where(held).select("doc_id", F.explode_outer("ends").alias("end")).where("end IS NOT NULL")  # explode would have the texts segmented once more, to leave out those without ends beforehand
    return sequences.end_scores(sequences.sentence_ends(table(spark, sf_dir, "documents").where(held), "doc_id", "text"), found)
