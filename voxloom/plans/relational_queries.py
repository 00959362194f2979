"""Queries over joins, windows, aggregates, repair and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.catalog import query
from voxloom.functions import buckets, tags
from voxloom.operators import aggregates, filters, joins, metrics, repair, windows
from voxloom.plans.base import PAIRS, TAGGED, TURNS, UTTERANCES, pairs, table, tagged, turns, utterances
from voxloom.sources import manifests, sinks, subtitles
from voxloom.staging import scratch
from voxloom.streaming import ingest


@query("filter_non_ascii", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]')")
def filter_non_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(filters.ascii_only(F.col("text"))).select("doc_id")


@query("filter_required", f"WITH {TAGGED} SELECT doc_id FROM t WHERE duration > 60 AND audio_filepath LIKE '%5.wav'")
def filter_required(spark, sf_dir):
    return tagged(spark, sf_dir).where(filters.complete(F.col("audio_filepath"), F.col("text"), F.col("duration").cast("string"), "5.wav") & filters.long_enough(F.col("duration"), 60.000001)).select("doc_id")


_N, _M = "(^|[^\\pL\\pN_])", "([^\\pL\\pN_]|$)"


@query("p_pattern", f"""WITH m AS (SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' P p x' WHEN 1 THEN '. P' WHEN 2 THEN ' (P)' WHEN 3 THEN ' P alone' ELSE '' END AS text FROM documents)
    SELECT doc_id FROM m WHERE regexp_matches(text, '{_N}P\\s+P\\s+P{_M}') OR regexp_matches(text, '{_N}P\\s+p{_M}') OR contains(text, '"P"') OR contains(text, '(P)') OR regexp_matches(text, '{_N}p\\s+p\\s+p{_M}')
    OR regexp_matches(text, '[\\pL\\pN_]\\s+p\\s+p\\s+p\\s+p\\s+p{_M}') OR regexp_full_match(trim(text), 'P') OR regexp_matches(text, '[.!?,:;]\\s+P(\\s|$)') OR regexp_matches(text, '(^|\\s)P\\s+[.!?,:;]')""")
def p_pattern(spark, sf_dir):
    m = table(spark, sf_dir, "documents").withColumn("text", F.expr("concat(text, CASE doc_id % 5 WHEN 0 THEN ' P p x' WHEN 1 THEN '. P' WHEN 2 THEN ' (P)' WHEN 3 THEN ' P alone' ELSE '' END)"))
    return m.where(filters.has_p_pattern(F.col("text"))).select("doc_id")


@query("p_pattern_strict", f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{_N}p') OR regexp_matches(text, '{_N}P\\s+[Pp]{_M}') OR contains(text, '(P)') OR contains(text, '\"P\"') OR regexp_matches(text, '[.!?,:;]\\s+P(\\s|$)') OR regexp_matches(text, '(^|\\s)P\\s+[.!?,:;]')")
def p_pattern_strict(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(filters.has_p_pattern(F.col("text"), strict=True)).select("doc_id")


@query("lacks_duration", "SELECT event_id FROM events WHERE event_id % 4 = 0")
def lacks_duration(spark, sf_dir):
    return table(spark, sf_dir, "events").where(filters.lacks_duration(F.expr("CASE WHEN event_id % 4 <> 0 THEN value END"))).select("event_id")


@query("duration_checks", "SELECT doc_id, abs(n_chars / 15::DOUBLE - (n_chars + doc_id % 20) / 15::DOUBLE) > 0.5 AS mismatch, CASE WHEN doc_id % 4 = 0 THEN -1.0::DOUBLE ELSE n_chars::DOUBLE END AS usable FROM documents")
def duration_checks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", filters.duration_mismatch(F.expr("n_chars / 15D"), F.expr("(n_chars + doc_id % 20) / 15D")).alias("mismatch"), filters.usable_duration(F.expr("CASE WHEN doc_id % 4 = 0 THEN 'x' ELSE CAST(n_chars AS STRING) END")).alias("usable"))


@query("word_counts", "WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM benchmark) SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word")
def word_counts(spark, sf_dir):
    return aggregates.word_counts(table(spark, sf_dir, "benchmark"), "text")


@query("rare_words", """WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM documents), v AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM benchmark)
    SELECT word, count(*) AS n FROM w WHERE length(word) >= 3 AND word IN (SELECT word FROM v) GROUP BY word HAVING count(*) < 10""")
def rare_words(spark, sf_dir):
    return filters.rare_words(table(spark, sf_dir, "documents"), "text", aggregates.word_counts(table(spark, sf_dir, "benchmark"), "text"))


@query("resume_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_anti(spark, sf_dir):
    return joins.not_done(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("reference_anti_two_key", f"""WITH {TAGGED}, d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN audio_filepath ELSE 'other/' || doc_id || '.wav' END AS p FROM t WHERE doc_id IN (SELECT doc_id FROM labels))
    SELECT doc_id FROM t WHERE audio_filepath NOT IN (SELECT p FROM d) AND string_split(audio_filepath, '/')[-1] NOT IN (SELECT string_split(p, '/')[-1] FROM d)""")
def reference_anti_two_key(spark, sf_dir):
    t = tagged(spark, sf_dir).select("doc_id", "audio_filepath")
    done = t.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select(F.expr("CASE WHEN doc_id % 2 = 0 THEN audio_filepath ELSE concat('other/', doc_id, '.wav') END").alias("audio_filepath"))
    return joins.not_done_by_path(t, done).select("doc_id")


@query("coalesced_key_anti", """WITH k AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR END, CASE WHEN doc_id % 3 = 1 THEN source END, sha1(text || '|||' || lang)) AS k FROM documents)
    SELECT doc_id, k FROM k WHERE k NOT IN (SELECT doc_id::VARCHAR FROM labels WHERE doc_id IS NOT NULL)""")
def coalesced_key_anti(spark, sf_dir):
    k = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.expr("CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS STRING) END"), F.expr("CASE WHEN doc_id % 3 = 1 THEN source END"), buckets.content_key(F.col("text"), F.col("lang"))).alias("k"))
    return joins.not_done(k, table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("k")), "k").select("doc_id", "k")


@query("prefix_anti", "WITH l AS (SELECT doc_id, text FROM documents UNION ALL SELECT 1000000 + item_id, text || ' and on' FROM benchmark) SELECT doc_id FROM l WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text <> '' AND starts_with(l.text, b.text))")
def prefix_anti(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    lines = aggregates.union_all(table(spark, sf_dir, "documents").selectExpr("doc_id", "text AS value"), b.selectExpr("1000000 + item_id AS doc_id", "concat(text, ' and on') AS value"))
    return joins.without_prefixes(lines, b.selectExpr("text AS prefix")).select("doc_id")


@query("prefix_anti_lengths", "WITH p AS (SELECT DISTINCT substr(text, 1, 1 + doc_id * 7 % 1501) AS p FROM documents WHERE doc_id % 3 = 0) SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.p <> '' AND starts_with(d.text, p.p))")
def prefix_anti_lengths(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    prefixes = d.where("doc_id % 3 = 0").select(F.expr("substr(text, 1, CAST(1 + doc_id * 7 % 1501 AS INT))").alias("prefix"))
    return joins.without_prefixes(d.selectExpr("doc_id", "text AS value"), prefixes).select("doc_id")


@query("pair_join", f"WITH {TAGGED}, l AS (SELECT doc_id, any_value(quality) AS quality FROM labels GROUP BY doc_id) SELECT t.doc_id, audio_filepath, quality FROM t JOIN l USING (doc_id)")
def pair_join(spark, sf_dir):
    texts = table(spark, sf_dir, "labels").dropDuplicates(["doc_id"]).select(F.expr("concat('text/', doc_id, '.txt')").alias("text_path"), "quality")
    return joins.pair_by_stem(tagged(spark, sf_dir), texts).select("doc_id", "audio_filepath", "quality")


@query("unpaired", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def unpaired(spark, sf_dir):
    texts = table(spark, sf_dir, "labels").select(F.expr("concat('text/', doc_id, '.txt')").alias("text_path"))
    return joins.unpaired(tagged(spark, sf_dir), texts).select("doc_id")


@query("last_transcript", "WITH c AS (SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id) SELECT p.page_id, c.text FROM pages p JOIN c ON c.conv_id = p.page_id")
def last_transcript(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "page_id")
    return joins.last_transcript(table(spark, sf_dir, "pages").select("page_id"), said, "page_id", "text", "turn")


@query("left_default", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_default(spark, sf_dir):
    return joins.with_default(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", {"quality": -1, "toxic": 0})


_CORRECTED = """replace(replace(replace(ref, 'GER_OTHER', CASE WHEN doc_id % 2 = 0 THEN 'GER_NA' ELSE 'GENDER_NA' END), 'AGE_60PLUS', 'AGE_NA'), 'EMOTION_ANG', 'EMOTION_OOM_ERROR')"""


@query("gender_correction", f"""WITH {TAGGED}, m AS (SELECT doc_id, {_CORRECTED.replace('ref', 'text')} AS text FROM t), i AS (SELECT doc_id, CASE WHEN any_value(quality) = 1 THEN 'GER_M' ELSE 'GER_F' END AS g, '45_60' AS a FROM labels GROUP BY doc_id)
    SELECT doc_id, replace(replace(CASE WHEN g IS NULL THEN text WHEN contains(text, 'GER_NA') THEN replace(text, 'GER_NA', g) ELSE replace(text, 'GENDER_NA', g) END, CASE WHEN a IS NULL THEN '#?' ELSE 'AGE_NA' END, 'AGE_45_60'), 'EMOTION_OOM_ERROR', 'EMOTION_NEU') AS text FROM m LEFT JOIN i USING (doc_id)""")
def gender_correction(spark, sf_dir):
    return _corrected(spark, sf_dir).select("doc_id", "text")


def _corrected(spark, sf_dir):
    m = tagged(spark, sf_dir).withColumn("before", F.expr(_CORRECTED.replace("ref", "text")))
    info = table(spark, sf_dir, "labels").dropDuplicates(["doc_id"]).select("doc_id", F.expr("CASE WHEN quality = 1 THEN 'GER_M' ELSE 'GER_F' END").alias("g"), F.lit("45_60").alias("a"))
    c = F.col("before")
    sex = F.when(F.col("g").isNull(), c).when(c.contains("GER_NA"), F.replace(c, F.lit("GER_NA"), F.col("g"))).otherwise(F.replace(c, F.lit("GENDER_NA"), F.col("g")))
    aged = F.when(F.col("a").isNotNull(), F.replace(sex, F.lit("AGE_NA"), F.concat(F.lit("AGE_"), "a"))).otherwise(sex)
    return m.join(info, "doc_id", "left").withColumns({"sex": sex, "aged": aged, "text": F.replace(aged, F.lit("EMOTION_OOM_ERROR"), F.lit("EMOTION_NEU"))})


@query("correction_counts", f"""WITH {TAGGED}, m AS (SELECT doc_id, {_CORRECTED.replace('ref', 'text')} AS text FROM t), i AS (SELECT DISTINCT doc_id FROM labels)
    SELECT count(*) FILTER (i.doc_id IS NOT NULL AND (contains(text, 'GER_NA') OR contains(text, 'GENDER_NA'))) AS gender, count(*) FILTER (i.doc_id IS NOT NULL AND contains(text, 'AGE_NA')) AS age, count(*) FILTER (contains(text, 'EMOTION_OOM_ERROR')) AS emotion FROM m LEFT JOIN i USING (doc_id)""")
def correction_counts(spark, sf_dir):
    return aggregates.changes(_corrected(spark, sf_dir), {"gender": ("before", "sex"), "age": ("sex", "aged"), "emotion": ("aged", "text")})


@query("lookup_rewrite", "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'wav/' || d.doc_id ELSE d.source END AS path FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def lookup_rewrite(spark, sf_dir):
    renamed = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("new", F.expr("concat('wav/', doc_id)"))
    return joins.lookup_update(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path")), renamed, "doc_id", "path", "new")


@query("resolve_paths", "SELECT page_id, CASE WHEN page_id IN (SELECT doc_id FROM labels) THEN 'a/' || page_id WHEN page_id % 2 = 0 THEN 'b/' || page_id END AS resolved FROM pages")
def resolve_paths(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id")
    there = aggregates.union_all(table(spark, sf_dir, "labels").select(F.expr("concat('a/', doc_id)").alias("path")), p.where("page_id % 2 = 0").select(F.expr("concat('b/', page_id)").alias("path")))
    return joins.resolve_paths(p, there, F.expr("array(concat('a/', page_id), concat('b/', page_id), concat('c/', page_id))"), "page_id")


@query("dedup_name", "WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY event_type || '_' || (user_id % 50) ORDER BY ts, event_id) AS n FROM events) SELECT event_id FROM r WHERE n = 1")
def dedup_name(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("path", F.expr("concat('d', user_id % 3, '/', event_type, '_', user_id % 50)"))
    return windows.keep_first_name(e, "path", ["ts", "event_id"]).select("event_id")


@query("dedup_two_key", """WITH r AS (SELECT list({'n': event_id, 'p': user_id, 'c': CASE WHEN value < 0 THEN ceil(value) ELSE floor(value) END} ORDER BY event_id) AS rows FROM events),
    k AS (SELECT list_reduce(rows, lambda a, x: CASE WHEN list_contains(a.p, x.p) OR list_contains(a.c, x.c) THEN a ELSE {'n': list_append(a.n, x.n), 'p': list_append(a.p, x.p), 'c': list_append(a.c, x.c)} END, {'n': []::BIGINT[], 'p': []::BIGINT[], 'c': []::DOUBLE[]}) AS kept FROM
        (SELECT list_transform(rows, lambda x: {'n': x.n, 'p': x.p, 'c': x.c}) AS rows FROM r)) SELECT unnest(kept.n) AS event_id FROM k""")
def dedup_two_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", "user_id AS path", "CAST(value AS INT) AS content")
    return windows.keep_first_of_two_keys(e, "path", "content", "event_id").select("event_id")


_LINE = """CASE {k} % 7 WHEN 0 THEN concat('{{"audio_filepath":"', {k}, '.wav","text":"t', {k}, '"}}, "duration": ', {k} % 9, '.5}}') WHEN 1 THEN concat('{{"audio_filepath":"', {k}, '.wav","text":"cut', {k})
    WHEN 2 THEN concat('{{"audio_filepath":"', {k}, '.wav","text":{{"sentence":"s', {k}, '"}},"duration":2.5}}') WHEN 3 THEN concat('{{"text":"no path ', {k}, '"}}') WHEN 4 THEN concat('{{"audio_filepath":"', {k}, '.wav","text":["x"]}}') WHEN 5 THEN '' ELSE concat('{{"audio_filepath":"', {k}, '.wav","text":"plain ', {k}, '","duration":1.5}}') END""".format(k="event_id")


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id AS line_number", f"{_LINE} AS value")


@query("json_repair", f"""SELECT event_id AS line_number, CASE event_id % 7 WHEN 0 THEN '{{"audio_filepath":"' || event_id || '.wav","text":"t' || event_id || '", "duration": ' || event_id % 9 || '.5}}' WHEN 1 THEN '{{"audio_filepath":"' || event_id || '.wav","text":"cut' || event_id || '"}}' WHEN 5 THEN NULL ELSE {_LINE} END AS value FROM events""")
def json_repair(spark, sf_dir):
    return _lines(spark, sf_dir).select("line_number", repair.repaired(F.col("value")).alias("value"))


@query("text_coalesce", """SELECT event_id AS line_number, CASE event_id % 7 WHEN 2 THEN 's' || event_id WHEN 6 THEN 'plain ' || event_id END AS text,
    CASE WHEN event_id % 7 IN (0, 1, 5) THEN 'JSONDecodeError' WHEN event_id % 7 = 3 THEN 'KeyError: audio_filepath' WHEN event_id % 7 = 4 THEN 'ValueError' END AS error FROM events""")
def text_coalesce(spark, sf_dir):
    said = manifests.polymorphic_text(F.col("value"))
    return _lines(spark, sf_dir).select("line_number", said.alias("s")).select("line_number", "s.text", F.regexp_replace("s.error", "^ValueError.*", "ValueError").alias("error"))


@query("split_routes", """WITH r AS (SELECT CASE event_id % 7 WHEN 2 THEN 'ok' WHEN 6 THEN 'ok' WHEN 5 THEN 'blank' ELSE 'error' END AS route FROM events)
    SELECT route, count(*) AS n, round(count(*) / (SELECT count(*) FROM r)::DOUBLE, 6) AS share FROM r GROUP BY route""")
def split_routes(spark, sf_dir):
    return aggregates.route_counts(repair.route_lines(_lines(spark, sf_dir))).select("route", "n", F.round("share", 6).alias("share"))


@query("split_objects", """SELECT event_id, unnest([0, 1])::INT AS part, unnest([props, '{"x": ' || user_id || '}']) AS value FROM events""")
def split_objects(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", """concat(props, '{"x": ', user_id, '}') AS value""")
    return repair.split_concatenated(e)


@query("salvage_entities", """SELECT event_id, '{"a": 1, "entities": [{"t": "x"}, {"t": ' || user_id || '}], "duration": 4.0}' AS line FROM events""")
def salvage_entities(spark, sf_dir):
    line = F.expr("""concat('{"a": 1, "entities": [{"t": "x"}, {bad}, {"t": ', user_id, '}], "duration": 4.0}')""")
    return table(spark, sf_dir, "events").select("event_id", repair.salvage_entities(line).alias("line"))


@query("error_log_parse", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a ' || user_id ELSE 'b' END AS text, CASE WHEN event_id % 3 = 0 THEN 0.0::DOUBLE ELSE (user_id % 9)::DOUBLE + 0.25 END AS duration FROM events")
def error_log_parse(spark, sf_dir):
    line = F.expr("""concat('{"text": "b"', CASE WHEN event_id % 2 = 0 THEN concat(', "annotated_sentence": "a ', user_id, '"') ELSE '' END, CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(', "duration": ', user_id % 9, '.25') END, '}}')""")
    return table(spark, sf_dir, "events").select("event_id", repair.from_error_log(line).alias("s")).select("event_id", "s.*")


@query("reply_cleanup", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '[{"a": ' || user_id || '}]' WHEN 1 THEN '[{"b": ' || user_id || '}]' ELSE '[{"c": ' || user_id || '}]' END AS reply FROM events""")
def reply_cleanup(spark, sf_dir):
    reply = F.expr("""CASE event_id % 3 WHEN 0 THEN concat('```json', chr(10), '{"a": ', user_id, '}', chr(10), '```') WHEN 1 THEN concat('{"sentences": [{"b": ', user_id, '}]}') ELSE concat('Here: [{"c": ', user_id, '}}] done') END""")
    return table(spark, sf_dir, "events").select("event_id", repair.clean_reply(reply).alias("reply"))


@query("speaker_change", f"WITH {TURNS} SELECT conv_id, turn, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, false) AS changed FROM u")
def speaker_change(spark, sf_dir):
    return windows.speaker_change(turns(spark, sf_dir), "conv_id", "turn", "role").select("conv_id", "turn", "changed")


@query("speaker_number", f"WITH {TURNS}, f AS (SELECT conv_id, turn, min(turn) OVER (PARTITION BY conv_id, role) AS f FROM u) SELECT conv_id, turn, dense_rank() OVER (PARTITION BY conv_id ORDER BY f)::INT AS speaker_no FROM f")
def speaker_number(spark, sf_dir):
    return windows.speaker_number(turns(spark, sf_dir), "conv_id", "turn", "role").select("conv_id", "turn", "speaker_no")


@query("speaker_stats", f'WITH {TURNS} SELECT conv_id, role, min(start) AS first_start_time, round(sum(greatest(0, "end" - start)), 4) AS cumulative_duration, count(*) AS segment_count FROM u GROUP BY conv_id, role')
def speaker_stats(spark, sf_dir):
    return aggregates.speaker_stats(turns(spark, sf_dir), ["conv_id", "role"]).withColumn("cumulative_duration", F.round("cumulative_duration", 4))


@query("chunk_text", f"""WITH {TURNS}, r AS (SELECT *, coalesce(lag(role) OVER w <> role, false) AS changed, lower(trim(text)) <> '' AND coalesce(lag(lower(trim(text))) OVER w = lower(trim(text)), false) AS repeated FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, string_agg(CASE WHEN changed THEN 'SPEAKER_CHANGE ' ELSE '' END || trim(text), ' ' ORDER BY turn) AS text FROM r WHERE NOT repeated GROUP BY conv_id""")
def chunk_text(spark, sf_dir):
    return windows.tagged_turns(turns(spark, sf_dir), "conv_id", "turn", "role", "text")


@query("ordered_text", "SELECT conv_id, string_agg(role || ':' || length(text), ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def ordered_text(spark, sf_dir):
    return aggregates.ordered_text(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], F.expr("concat(role, ':', length(text))"))


@query("error_summary", "SELECT user_id, string_agg(props, '; ' ORDER BY event_id) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id")
def error_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("error", F.expr("CASE WHEN event_type = 'error' THEN props END"))
    return aggregates.error_summary(e, ["user_id"], "error", "event_id")


@query("word_midpoint_join", f"""WITH {TURNS}, p AS (SELECT event_id, user_id % 100 AS conv_id, ((event_id % 900) / 10::DOUBLE + (event_id % 900) / 10::DOUBLE + 1) / 2 AS mid FROM events)
    SELECT event_id, conv_id, turn FROM p JOIN u USING (conv_id) WHERE mid BETWEEN start AND "end" """)
def word_midpoint_join(spark, sf_dir):
    words = table(spark, sf_dir, "events").selectExpr("event_id", "user_id % 100 AS conv_id", "((event_id % 900) / 10D + (event_id % 900) / 10D + 1) / 2 AS mid")
    return joins.point_in_range(words, turns(spark, sf_dir), "conv_id", "mid", "start", "end").select("event_id", "conv_id", "turn")


@query("cue_overlap_join", f"""WITH {TURNS}, c AS (SELECT event_id, user_id % 100 AS conv_id, (event_id % 97)::DOUBLE AS a, (event_id % 97 + event_id % 5)::DOUBLE AS b FROM events)
    SELECT event_id, conv_id, turn FROM c JOIN u USING (conv_id) WHERE b >= start AND a <= "end" """)
def cue_overlap_join(spark, sf_dir):
    cues = table(spark, sf_dir, "events").selectExpr("event_id", "user_id % 100 AS conv_id", "CAST(event_id % 97 AS DOUBLE) AS a", "CAST(event_id % 97 + event_id % 5 AS DOUBLE) AS b")
    return joins.overlaps(cues, turns(spark, sf_dir), "conv_id", ("a", "b"), ("start", "end")).select("event_id", "conv_id", "turn")


_WORDS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"


@query("cue_merge", f"""WITH c AS (SELECT conv_id, list({_WORDS.format('text')} ORDER BY turn) AS cues FROM conversations GROUP BY conv_id)
    SELECT conv_id, array_to_string(list_reduce(cues, lambda a, w: list_concat(a, w[coalesce(list_max(list_filter(range(1, 31), lambda k: k <= len(a) AND k <= len(w) AND lower(array_to_string(a[len(a) - k + 1:], ' ')) = lower(array_to_string(w[1:k], ' ')))), 0) + 1:]), []::VARCHAR[]), ' ') AS text FROM c""")
def cue_merge(spark, sf_dir):
    rows = turns(spark, sf_dir).groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("cues"))
    return rows.select("conv_id", windows.merge_overlapping(F.col("cues")).alias("text"))


@query("vtt_parse", f"""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS n, (10 * turn)::DOUBLE AS start, (10 * turn + 9)::DOUBLE + 0.5 AS "end", 'turn ' || turn || ' of ' || conv_id AS text FROM conversations""")
def vtt_parse(spark, sf_dir):
    stamp = lambda s, ms: F.format_string("%02d:%02d:%02d." + ms, F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    t = 10 * F.col("turn")
    cue = F.concat(stamp(t, "000"), F.lit(" --> "), stamp(t + 9, "500"), F.lit(" align:start\nturn<00:00:01.000><c> "), F.col("turn"), F.lit("</c>\n"), F.lit("of "), F.col("conv_id"), F.lit("\nof "), F.col("conv_id"))
    files = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cue.alias("cue")))).alias("c"))
    text = F.concat(F.lit("WEBVTT\nKind: captions\n\n"), F.array_join(F.transform("c", lambda s: s["cue"]), "\n\n"))
    cues = files.select("conv_id", F.posexplode(subtitles.parse_cues(text)).alias("n", "cue"))
    return cues.select("conv_id", "n", "cue.start", "cue.end", "cue.text")


@query("sliding_chunks", """WITH w AS (SELECT doc_id, n_chars / 15::DOUBLE AS s, unnest(range(0, greatest(ceil(n_chars / 15::DOUBLE / 20), 1)::BIGINT)) AS i FROM documents)
    SELECT doc_id, i::INT AS idx, round(i * 20::DOUBLE, 4) AS start, round(least(i * 20 + 30, s), 4) AS "end" FROM w WHERE least(i * 20 + 30, s) - i * 20 >= 1.0""")
def sliding_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.inline(windows.sliding_chunks(F.expr("n_chars / 15D"))))
    return rows.select("doc_id", "idx", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"))


@query("tumbling_chunks", """WITH w AS (SELECT doc_id, n_chars / 15::DOUBLE AS s, unnest(range(0, ceil(n_chars / 15::DOUBLE / 30)::BIGINT)) AS i FROM documents)
    SELECT doc_id, (i + 1)::INT AS idx, i * 30::DOUBLE AS start, round(least((i + 1) * 30, s), 4) AS "end" FROM w""")
def tumbling_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.inline(windows.tumbling_chunks(F.expr("n_chars / 15D"))))
    return rows.select("doc_id", "idx", "start", F.round("end", 4).alias("end"))


@query("trim_windows", """WITH m AS (SELECT doc_id, n_chars * 60 AS ms FROM documents), f AS (SELECT doc_id, ms, unnest(CASE WHEN ms <= 30000 THEN [0] ELSE range(0, (ms - 30000) // 20000 + 1) END) AS i FROM m)
    SELECT doc_id, i * 20000 AS start, least(i * 20000 + 30000, ms) AS "end" FROM f UNION ALL SELECT doc_id, ms - 30000, ms FROM m WHERE ms > 30000 AND ms % 20000 > 0""")
def trim_windows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(windows.trim_windows(F.expr("n_chars * 60"))))


@query("wer_micro", f"WITH {UTTERANCES} SELECT role, sum(edits)::BIGINT AS edits, sum(units)::BIGINT AS units, round(sum(edits) / sum(units)::DOUBLE, 6) AS rate FROM e GROUP BY role")
def wer_micro(spark, sf_dir):
    return metrics.error_rate(utterances(spark, sf_dir), "ref", "hyp", ["role"]).withColumn("rate", F.round("rate", 6))


@query("wer_macro", f"WITH {UTTERANCES} SELECT role, round(avg(edits / units::DOUBLE), 6) AS rate, count(*) AS pairs FROM e WHERE units > 0 AND heard > 0 GROUP BY role")
def wer_macro(spark, sf_dir):
    return metrics.macro_rate(utterances(spark, sf_dir), "ref", "hyp", ["role"]).withColumn("rate", F.round("rate", 6))


@query("wer_utterance", f"WITH {UTTERANCES} SELECT ref, edits, units::BIGINT AS units, round(CASE WHEN units > 0 THEN edits / units::DOUBLE END, 6) AS rate FROM e")
def wer_utterance(spark, sf_dir):
    return metrics.utterance_rates(utterances(spark, sf_dir), "ref", "hyp").select("ref", "edits", "units", F.round("rate", 6).alias("rate"))


@query("cer_micro", """SELECT c_mktsegment, sum(levenshtein(c_name, replace(c_name, '0', '')))::BIGINT AS edits, sum(length(c_name))::BIGINT AS units, round(sum(levenshtein(c_name, replace(c_name, '0', ''))) / sum(length(c_name))::DOUBLE, 6) AS rate FROM customer GROUP BY 1""")
def cer_micro(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_mktsegment", "c_name AS ref", "replace(c_name, '0', '') AS hyp")
    return metrics.error_rate(c, "ref", "hyp", ["c_mktsegment"], chars=True).withColumn("rate", F.round("rate", 6))


#: Rows of distances one after the other, each place with the substitutions on the walk back from it.
_ALIGNED = """v AS (SELECT role, r, h, count(*) AS times FROM d GROUP BY ALL),
g AS (SELECT role, times, len(r) AS m, len(h) AS k, list_reduce(r, lambda p, x: list_reduce(range(1, len(h) + 1), lambda a, j: list_append(a,
    {'d': least(p[j].d + (x <> h[j])::BIGINT, p[j + 1].d + 1, a[j].d + 1), 's': CASE WHEN p[j].d + (x <> h[j])::BIGINT <= least(p[j + 1].d + 1, a[j].d + 1) THEN p[j].s + (x <> h[j])::BIGINT WHEN p[j + 1].d <= a[j].d THEN p[j + 1].s ELSE a[j].s END}),
    [{'d': p[1].d + 1, 's': 0::BIGINT}]), list_transform(range(0, len(h) + 1), lambda j: {'d': j::BIGINT, 's': 0::BIGINT}))[-1] AS z FROM v),
n AS (SELECT role, sum(times * (z.d - z.s + k - m) // 2)::BIGINT AS insertions, sum(times * (z.d - z.s - k + m) // 2)::BIGINT AS deletions, sum(times * z.s)::BIGINT AS substitutions, sum(times * m)::BIGINT AS units FROM g GROUP BY role)"""


@query("wer_detail", f"WITH {UTTERANCES}, {_ALIGNED} SELECT role, insertions, deletions, substitutions, units, insertions / units::DOUBLE AS ins_rate, deletions / units::DOUBLE AS del_rate, substitutions / units::DOUBLE AS sub_rate FROM n")
def wer_detail(spark, sf_dir):
    return metrics.error_detail(utterances(spark, sf_dir), "ref", "hyp", ["role"])


_SPANS = """, x AS (SELECT doc_id, side, unnest(regexp_extract_all(side_text, '(ENTITY_[A-Z0-9_]+) ', 1)) AS label, unnest(regexp_extract_all(side_text, 'ENTITY_[A-Z0-9_]+ (.+?) END( |$)', 1)) AS phrase FROM (SELECT doc_id, 'gt' AS side, ref AS side_text FROM p UNION ALL SELECT doc_id, 'pred', hyp FROM p)),
    c AS (SELECT label, coalesce(sum(g), 0)::BIGINT AS gt, coalesce(sum(h), 0)::BIGINT AS pred, coalesce(sum(least(g, h)), 0)::BIGINT AS tp FROM (SELECT doc_id, label, phrase, count(*) FILTER (side = 'gt') AS g, count(*) FILTER (side = 'pred') AS h FROM x GROUP BY ALL) GROUP BY label),
    m AS (SELECT 'overall_micro' AS label, sum(gt)::BIGINT AS gt, sum(pred)::BIGINT AS pred, sum(tp)::BIGINT AS tp FROM c),
    s AS (SELECT *, CASE WHEN pred = 0 THEN 0 ELSE tp / pred::DOUBLE END AS p, CASE WHEN gt = 0 THEN 0 ELSE tp / gt::DOUBLE END AS r FROM (SELECT * FROM c UNION ALL SELECT * FROM m)),
    f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM s)"""


@query("ner_scores", f"""WITH {PAIRS} {_SPANS} SELECT label, gt, pred, tp, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fscore FROM f
    UNION ALL SELECT 'overall_macro', sum(gt)::BIGINT, sum(pred)::BIGINT, sum(tp)::BIGINT, round(avg(p), 6), round(avg(r), 6), round(avg(f), 6) FROM f WHERE label <> 'overall_micro'""")
def ner_scores(spark, sf_dir):
    out = metrics.ner_scores(pairs(spark, sf_dir), "doc_id", "ref", "hyp")
    return out.select("label", "gt", "pred", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fscore")])


_CONFUSED = """, k AS (SELECT unnest(['AGE', 'GER', 'EMOTION', 'INTENT']) AS family), q AS (SELECT family, regexp_extract(ref, '\\b(' || family || '_[A-Z0-9_]+)', 1) AS actual, regexp_extract(hyp, '\\b(' || family || '_[A-Z0-9_]+)', 1) AS predicted FROM p, k),
    z AS (SELECT family, actual, predicted, count(*) AS n FROM q WHERE actual <> '' AND predicted <> '' GROUP BY ALL)"""


@query("confusion_long", f"WITH {PAIRS} {_CONFUSED.replace(chr(92) * 2, chr(92))} SELECT * FROM z")
def confusion_long(spark, sf_dir):
    return metrics.confusion(pairs(spark, sf_dir), "ref", "hyp")


@query("class_report", f"""WITH {PAIRS} {_CONFUSED.replace(chr(92) * 2, chr(92))}, g AS (SELECT family, actual AS label, sum(n) AS support, sum(n) FILTER (actual = predicted) AS tp FROM z GROUP BY 1, 2), h AS (SELECT family, predicted AS label, sum(n) AS pred FROM z GROUP BY 1, 2),
    j AS (SELECT family, label, coalesce(support, 0)::BIGINT AS support, coalesce(pred, 0)::BIGINT AS pred, coalesce(tp, 0)::BIGINT AS tp FROM g FULL JOIN h USING (family, label)),
    s AS (SELECT *, CASE WHEN pred = 0 THEN 0 ELSE tp / pred::DOUBLE END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS r FROM j)
    SELECT family, label, support, pred, tp, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS fscore FROM s""")
def class_report(spark, sf_dir):
    out = metrics.class_report(metrics.confusion(pairs(spark, sf_dir), "ref", "hyp"))
    return out.select("family", "label", "support", "pred", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fscore")])


@query("eval_report", f"""WITH {PAIRS} {_SPANS}, o AS (SELECT CASE WHEN doc_id % 5 = 0 THEN CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END WHEN doc_id % 6 = 1 AND doc_id % 3 = 1 THEN 1 ELSE 0 END AS edits, len(list_filter(regexp_split_to_array(array_to_string(list_filter(string_split(ref, ' '), lambda w: NOT (upper(w) = w AND lower(w) <> w)), ' '), '\\s+'), lambda w: w <> '')) AS units FROM p),
    q AS (SELECT label, p AS precision, r AS recall, f AS fscore FROM f UNION ALL SELECT 'overall_macro', avg(p), avg(r), avg(f) FROM f WHERE label <> 'overall_micro')
    SELECT 'wer' AS metric, round(sum(edits) / sum(units)::DOUBLE, 6) AS value FROM o UNION ALL SELECT label || '.precision', round(precision, 6) FROM q UNION ALL SELECT label || '.recall', round(recall, 6) FROM q UNION ALL SELECT label || '.fscore', round(fscore, 6) FROM q""")
def eval_report(spark, sf_dir):
    return metrics.evaluation(pairs(spark, sf_dir), "doc_id", "ref", "hyp", reset=True).select("metric", F.round("value", 6).alias("value"))


@query("ner_scores_by_label", f"""WITH {PAIRS} {_SPANS.replace("unnest(regexp_extract_all(side_text, 'ENTITY_[A-Z0-9_]+ (.+?) END( |$)', 1)) AS phrase", "'phrase' AS phrase")}
    SELECT label, gt, pred, tp, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fscore FROM f WHERE label <> 'overall_micro' AND label = 'ENTITY_CITY'""")
def ner_scores_by_label(spark, sf_dir):
    out = metrics.ner_scores(pairs(spark, sf_dir), "doc_id", "ref", "hyp", by_label=True, vocabulary=("ENTITY_CITY",)).where("label not like 'overall%'")
    return out.select("label", "gt", "pred", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fscore")])


@query("error_analysis", f"WITH {PAIRS} {_SPANS}, b AS (SELECT DISTINCT doc_id, label FROM x UNION ALL SELECT doc_id, 'all' FROM p) SELECT b.doc_id, b.label, length(p.ref) AS n FROM b JOIN p USING (doc_id)")
def error_analysis(spark, sf_dir):
    return metrics.error_analysis(pairs(spark, sf_dir), "doc_id", "ref", "hyp").select("doc_id", "label", F.length("text").cast("long").alias("n"))


@query("positional_zip", "SELECT doc_id, d.lang, n_chars FROM documents d")
def positional_zip(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return metrics.same_length(d.select("doc_id", "lang"), d.select("doc_id", "n_chars"), "doc_id")


@query("f1_summary", f"""WITH {PAIRS} {_CONFUSED.replace(chr(92) * 2, chr(92))}, g AS (SELECT family, actual AS label, sum(n) AS support, sum(n) FILTER (actual = predicted) AS tp FROM z GROUP BY 1, 2), h AS (SELECT family, predicted AS label, sum(n) AS pred FROM z GROUP BY 1, 2),
    j AS (SELECT family, label, coalesce(support, 0) AS support, coalesce(pred, 0) AS pred, coalesce(tp, 0) AS tp FROM g FULL JOIN h USING (family, label))
    SELECT family, round(avg(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (support + pred)::DOUBLE END), 6) AS macro_f1, round(sum(tp) / sum(support)::DOUBLE, 6) AS micro_f1 FROM j GROUP BY family""")
def f1_summary(spark, sf_dir):
    out = metrics.f1_summary(metrics.class_report(metrics.confusion(pairs(spark, sf_dir), "ref", "hyp")))
    return out.select("family", F.round("macro_f1", 6).alias("macro_f1"), F.round("micro_f1", 6).alias("micro_f1"))


@query("chunk_texts", f"""WITH {TURNS} SELECT conv_id, coalesce(string_agg(trim(text), ' ' ORDER BY turn), '') AS text, trim(coalesce(string_agg(CASE WHEN turn % 2 = 1 THEN role END, ' ' ORDER BY turn), '')) AS odd, round(max("end") - min(start), 4) AS duration FROM u GROUP BY conv_id""")
def chunk_texts(spark, sf_dir):
    t = turns(spark, sf_dir).withColumns({"text": F.trim("text"), "odd": F.expr("CASE WHEN turn % 2 = 1 THEN role ELSE '' END")})
    return aggregates.chunk_texts(t, "conv_id", ["turn"], ["text", "odd"]).withColumn("duration", F.round("duration", 4))


@query("repeat_numbers", "SELECT event_id, array_to_string([props || '#1', event_type || '#1', props || '#2', props || '#3'], ',') AS numbered FROM events")
def repeat_numbers(spark, sf_dir):
    items = F.transform(F.expr("array(props, event_type, props, props)"), lambda x: F.struct(F.lit("L").alias("label"), x.alias("phrase")))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(tags.number_repeats(items), lambda p: F.concat(p["phrase"], F.lit("#"), p["occ"])), ",").alias("numbered"))


@query("union_by_name", "SELECT doc_id AS id, lang, NULL::BIGINT AS turn FROM documents UNION ALL SELECT conv_id, NULL, turn FROM conversations")
def union_by_name(spark, sf_dir):
    return aggregates.union_all(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang"), table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "turn"))


@query("set_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").distinct().exceptAll(table(spark, sf_dir, "labels").select("doc_id").distinct())


@query("set_intersection", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def set_intersection(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").intersect(table(spark, sf_dir, "labels").select("doc_id"))


@query("offset_limit", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 50 OFFSET 25")
def offset_limit(spark, sf_dir):
    return windows.page(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 25, 50)


@query("newest", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 20")
def newest(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(20)


@query("until_unique", """WITH f AS (SELECT word, min(doc_id) AS doc_id FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS word FROM documents) WHERE length(word) >= 3 GROUP BY word), n AS (SELECT doc_id, count(*) AS n FROM f GROUP BY doc_id),
    b AS (SELECT doc_id, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n) SELECT word, doc_id FROM f WHERE doc_id IN (SELECT doc_id FROM b WHERE before < 300)""")
def until_unique(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("length(word) >= 3")
    return windows.until_unique(words, "doc_id", "word", 300)


@query("first_media", "WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 5 = 0 DESC, event_type || event_id) AS n FROM events) SELECT event_id FROM r WHERE n = 1")
def first_media(spark, sf_dir):
    files = table(spark, sf_dir, "events").selectExpr("event_id", "user_id AS folder", "concat(event_type, event_id, CASE WHEN event_id % 5 = 0 THEN '.mp4' ELSE '.wav' END) AS name")
    return manifests.first_media(files).select("event_id")


@query("sidecar_match", "SELECT 'talk ' || page_id AS stem, CASE page_id % 4 WHEN 0 THEN 'talk ' || page_id WHEN 1 THEN 'talk_' || page_id WHEN 2 THEN 'talk ' || page_id || '.en' END AS name FROM pages")
def sidecar_match(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.expr("concat('talk ', page_id)").alias("stem"))
    side = p.selectExpr("CASE page_id % 4 WHEN 0 THEN stem WHEN 1 THEN replace(stem, ' ', '_') WHEN 2 THEN concat(stem, '.en') END AS name").where("name is not null")
    return manifests.match_sidecars(p.select("stem"), side)


@query("removed_log", "SELECT 'audio/' || doc_id AS audio_filepath, substr(text, 1, 100) AS sample FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]')")
def removed_log(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("concat('audio/', doc_id) AS audio_filepath", "text")
    return sinks.removed_rows(docs, filters.ascii_only(F.col("text")))


@query("batch_numbers", "SELECT page_id, (row_number() OVER (ORDER BY page_id) - 1) // 100 + 1 AS batch FROM pages")
def batch_numbers(spark, sf_dir):
    return sinks.batch_numbers(table(spark, sf_dir, "pages").select("page_id"), ["page_id"], 100)


@query("relocate", "SELECT page_id, CASE WHEN page_id IN (SELECT doc_id FROM labels) THEN 'new/' || page_id || '.wav' ELSE 'old/' || page_id || '.wav' END AS new_path FROM pages")
def relocate(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.expr("concat('old/', page_id, '.wav')").alias("audio_filepath"))
    return sinks.relocate(p, table(spark, sf_dir, "labels").select(F.expr("concat('old/', doc_id, '.wav')").alias("path")), "new").select("page_id", "new_path")


@query("metadata_json", """SELECT c_custkey, json_object('c_name', c_name, 'c_nationkey', c_nationkey, 'c_mktsegment', c_mktsegment)::VARCHAR AS metadata FROM customer""")
def metadata_json(spark, sf_dir):
    return sinks.with_metadata_json(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "c_custkey")


@query("transcripts_map", """SELECT 'd' || conv_id || '/' AS folder, string_agg(turn || '=' || text, chr(1) ORDER BY turn) AS texts FROM conversations GROUP BY conv_id""")
def transcripts_map(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").selectExpr("concat('d', conv_id, '/', turn, '.wav') AS file", "text")
    entries = F.array_sort(F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: F.struct(F.regexp_extract(e["key"], r"(\d+)(\.wav)?$", 1).cast("int").alias("turn"), e["value"].alias("text"))))
    return sinks.transcripts_map(c, "file", "text").select("folder", F.array_join(F.transform(entries, lambda e: F.concat(e["turn"], F.lit("="), e["text"])), "\x01").alias("texts"))


@query("common_prefix", "SELECT 'Customer#' || repeat('0', 18 - 9 - length((SELECT max(c_custkey) FROM customer)::VARCHAR)) AS prefix")
def common_prefix(spark, sf_dir):
    return aggregates.common_prefix(table(spark, sf_dir, "customer"), "c_name")


@query("event_windows", """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, sf_dir):
    return ingest.windowed_counts(spark, table(spark, sf_dir, "events"), "1 hour").select("start", "event_type", "n", F.round("total", 4).alias("total"))


_TTL = """WITH t AS (SELECT user_id, list([{'start': ts, 'n': 1::BIGINT}] ORDER BY ts) AS e FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY user_id),
    s AS (SELECT user_id, unnest(list_reduce(e, lambda a, x: CASE WHEN x[1].start >= a[-1].start + INTERVAL 60 MINUTE THEN list_concat(a, x) ELSE list_append(a[:-2], {'start': a[-1].start, 'n': a[-1].n + 1}) END)) AS s FROM t)
    SELECT user_id, s.start AS start, s.n AS n FROM s"""


@query("ttl_sessions", _TTL)
def ttl_sessions(spark, sf_dir):
    return ingest.sessions(table(spark, sf_dir, "events"))


@query("ttl_session_stream", _TTL)
def ttl_session_stream(spark, sf_dir):
    """The same as a stream: the events, and then a late one of nobody, with which the watermark passes every end."""
    src, out, ck = (scratch(spark, x) for x in ("stream-in", "stream-out", "stream-ck"))
    e = table(spark, sf_dir, "events").selectExpr("user_id", "CAST(ts AS TIMESTAMP) AS ts")
    for part in (e, e.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).select(F.lit(-1).cast("long").alias("user_id"), "ts")):
        part.write.mode("append").parquet(src)
        rows = ingest.session_stream(spark.readStream.schema("user_id long, ts timestamp").parquet(src))
        ingest.with_state_store(spark, lambda: rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("user_id long, start timestamp, n long").parquet(out).where("user_id <> -1")


@query("describe_columns", "SELECT 'doc_id' AS \"column\", 'bigint' AS type, count(doc_id) AS \"values\", count(*) AS rows FROM labels UNION ALL SELECT 'quality', 'int', count(quality), count(*) FROM labels UNION ALL SELECT 'toxic', 'int', count(toxic), count(*) FROM labels")
def describe_columns(spark, sf_dir):
    return manifests.describe(table(spark, sf_dir, "labels").selectExpr("doc_id", "CAST(quality AS INT) AS quality", "CAST(toxic AS INT) AS toxic"))
