"""Rules that SQL cannot express, on small fixtures."""

import json
import random
import struct
import time
import wave

import pytest
from pyspark.sql import functions as F

from voxloom.functions import buckets, paths, providers, tags
from voxloom.operators import components, filters, joins, metrics, repair, windows
from voxloom.sources import manifests, sinks, subtitles
from voxloom.streaming import ingest


def apply(spark, rule, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["o"] for r in df.select("i", rule(F.col("t")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("rule, pairs", [
    (tags.fix_end_family_a, [("go ENTITY_CITY paris now AGE_0_18", "go ENTITY_CITY paris now END AGE_0_18"), ("a ENTITY_CITY parisEND END b", "a ENTITY_CITY paris END END b END"), ("x , y", "x, y"), (None, None)]),
    (tags.fix_end_family_b, [("go ENTITY_CITY paris END AGE_0_18", "go ENTITY_CITY paris AGE_0_18"), ("ENTITY_CITY paris END END b", "ENTITY_CITY paris END b"), ("ENDING", "END ING"), ("ENTITY_X a END", "ENTITY_X a")]),
    (tags.fix_end_family_c, [("go ENTITY_CITY paris INTENT_ASK", "go ENTITY_CITY paris INTENT_ASK END"), ("a END END b", "a END b")]),
    (tags.fix_end_of_reply, [("see ENTITY_CITY paris now", "see ENTITY_CITY paris END now"), ("see ENTITY_CITY paris END", "see ENTITY_CITY paris END")]),
    (tags.glue_split_tags, [("ENTITY_CIT Y paris END x END", "ENTITY_CITY paris END x "), ("no END tags", "no  tags"), ("ENTITY_PERSON_NAM E ana END", "ENTITY_PERSON_NAME ana END")]),
    (tags.join_tag_parts(), [("ENTITY_PERSON_NAM E ana END", "ENTITY_PERSON_NAME ana END")]),
    (tags.join_tag_parts("_"), [("ENTITY_PERSON NAME ana END", "ENTITY_PERSON_NAME ana END")]),
    (tags.fix_tag_case, [("see Entity_person_name Ana end", "see ENTITY_PERSON_NAME Ana END"), ("Entity_cityENTITY_CITY x", "ENTITY_CITY x")]),
    (tags.capitalize_entities, [("ENTITY_PERSON_NAME ana roy END", "ENTITY_PERSON_NAME Ana Roy END"), ("ENTITY_DATE may END", "ENTITY_DATE may  END")]),
    (tags.normalize_ner_case, [("Hi ner_city PARIS end AGE_0_18 X", "hi NER_CITY paris END AGE_0_18 x")]),
    (tags.upper_brackets, [("a <b c> [d] {e} (f)", "a B C D E F")]),
    (tags.collapse_repeats, [("no no no no yes yes", "no yes yes"), ("é é é", "é")]),
    (tags.collapse_repeated_spans, [("ENTITY_CITY paris END ENTITY_CITY paris END x", "ENTITY_CITY paris END x")]),
    (tags.collapse_word_runs, [("a a a b END END END a", "a a b END END END a"), ("", "")]),
    (tags.metadata_to_end, [("AGE_0_18 go go go INTENT_ASK", "go AGE_0_18 INTENT_ASK")]),
    (tags.strip_entity_tags, [("a ENTITY_CITY new york END b", "a new york b")]),
    (tags.remove_existing_tags, [("WEEKEND NER_X a END", "WEEK a")]),
    (tags.drop_upper_words, [("I go TO 3D Rome", "go Rome")]),
    (tags.normalize_span_contents(lambda p: "7"), [("ENTITY_PERSON ana roy END NER_CARDINAL seven END", "ENTITY_PERSON Ana Roy END NER_CARDINAL 7 END")]),
    (lambda c: tags.keep_head_of_age(c, providers.inverse_normalize), [("two dogs AGE_0_18 x AGE_1_2 y", "2 dogs AGE_0_18 x "), ("one", "1")]),
])
def test_text_rules(spark, rule, pairs):
    assert apply(spark, rule, [a for a, _ in pairs]) == [b for _, b in pairs]


def test_correct_tags_are_not_split(spark):
    assert apply(spark, tags.fix_end_family_b, ["ENTITY_CITY paris END x"]) == ["ENTITY_CITY paris END x"]
    assert apply(spark, lambda c: tags.fix_end_family_b(c, legacy=True), ["ENTITY_CITY paris END x"]) == ["ENTITY_CIT Y paris END x"]


def test_long_texts_do_not_overflow(spark):
    long = "ENTITY_CITY " + "word " * 60_000
    for rule in (tags.fix_end_family_a, tags.fix_end_family_b, tags.fix_end_family_c, tags.collapse_word_runs, tags.collapse_repeats, tags.strip_inline_tags):
        assert len(apply(spark, rule, [long])) == 1


def test_entity_spans(spark):
    spans = lambda reset: [[tuple(s) for s in r] for r in apply(spark, lambda c: tags.entity_spans(c, reset), ["go ENTITY_CITY new york END", "ENTITY_ORG osi END and ENTITY_ORG osi END", "ENTITY_A x ENTITY_B y END z END", "none", ""])]
    assert spans(True) == [[("ENTITY_CITY", "new york", 1)], [("ENTITY_ORG", "osi", 1), ("ENTITY_ORG", "osi", 2)], [("ENTITY_B", "y", 1)], [], []]
    assert spans(False)[2] == [("ENTITY_B", "y", 1), ("ENTITY_B", "y z", 1)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
    return row[-1]


def test_error_rates(spark):
    rng = random.Random(2)
    pairs = [("a b c d", "a x c"), ("", "x y"), ("", ""), (None, "a"), ("é ß", "é")] + [(" ".join(rng.choice("abcdé") for _ in range(rng.randint(0, 9))), " ".join(rng.choice("abcdé") for _ in range(rng.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, ref string, hyp string")
    want = [distance((r or "").split(), (h or "").split()) for r, h in pairs]
    assert [r["edits"] for r in metrics.with_edits(df, "ref", "hyp").orderBy("i").collect()] == want
    rates = [r["rate"] for r in metrics.utterance_rates(df, "ref", "hyp").orderBy("i").collect()]
    assert rates[:4] == [0.5, float("inf"), None, float("inf")]
    kinds = metrics.edit_kinds(df, "ref", "hyp").orderBy("i").collect()
    assert [sum(tuple(r)[3:6]) for r in kinds] == want
    assert tuple(kinds[0])[3:] == (0, 1, 1, 4)
    total = metrics.error_rate(df, "ref", "hyp").first()
    assert total["rate"] == sum(want) / sum(len((r or "").split()) for r, _ in pairs)
    assert metrics.error_detail(df, "ref", "hyp").first()["del_rate"] > 0


def test_two_key_dedup(spark):
    rows = [(1, "p1", "h1"), (2, "p1", "h2"), (3, "p2", "h2"), (4, "p3", "h1"), (5, "p3", "h3")]
    keep = lambda rs: sorted(r[0] for r in windows.keep_first_of_two_keys(spark.createDataFrame(rs, "pos int, path string, content string"), "path", "content", "pos").collect())
    assert keep(rows) == [1, 3, 5]
    rng = random.Random(1)
    many = [(i, f"p{rng.randrange(12)}", f"h{rng.randrange(12)}") for i in range(80)]
    seen_p, seen_h, want = set(), set(), []
    for i, p, h in many:
        if p not in seen_p and h not in seen_h:
            seen_p.add(p), seen_h.add(h), want.append(i)
    assert keep(many) == want
    assert keep([]) == []


def test_cue_merge(spark):
    df = spark.createDataFrame([(1, ["so today we", "today we will", "Will start", None, "", "new"]), (2, [])], "i int, c array<string>")
    assert [r["t"] for r in df.orderBy("i").select(windows.merge_overlapping(F.col("c")).alias("t")).collect()] == ["so today we will start new", ""]


def test_windows_over_audio(spark):
    df = spark.createDataFrame([(30_000, 61.0), (50_000, 0.5), (70_000, 30.0)], "ms long, s double")
    assert [[w["start"] for w in r["w"]] for r in df.select(windows.trim_windows(F.col("ms")).alias("w")).collect()] == [[0], [0, 20_000, 20_000], [0, 20_000, 40_000, 40_000]]
    assert [[w["start"] for w in r["w"]] for r in df.select(windows.sliding_chunks(F.col("s")).alias("w")).collect()] == [[0, 20, 40, 60], [], [0, 20]]
    assert [[(w["idx"], w["end"]) for w in r["w"]] for r in df.select(windows.tumbling_chunks(F.col("s")).alias("w")).collect()] == [[(1, 30), (2, 60), (3, 61)], [(1, 0.5)], [(1, 30)]]


def test_ranges_join_on_bounds_and_without_copies(spark):
    points = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 70.0), ("z", 3, 5.0)], "key string, id int, at double")
    ranges = spark.createDataFrame([("k", "a", 0.0, 5.0), ("k", "b", 5.0, 100.0)], "key string, r string, s double, e double")
    assert sorted((r["id"], r["r"]) for r in joins.point_in_range(points, ranges, "key", "at", "s", "e").collect()) == [(1, "a"), (1, "b"), (2, "b")]
    other = spark.createDataFrame([("k", "x", 4.0, 90.0), ("k", "y", 100.0, 101.0), ("k", "w", 101.0, 102.0)], "key string, q string, s2 double, e2 double")
    assert sorted((r["r"], r["q"]) for r in joins.overlaps(ranges, other, "key", ("s", "e"), ("s2", "e2")).collect()) == [("a", "x"), ("b", "x"), ("b", "y")]


def test_turns(spark):
    df = spark.createDataFrame([("f", 1, "A", "hi"), ("f", 2, "A", "Hi "), ("f", 3, "B", "hi"), ("f", 4, "B", "x"), ("f", 5, "A", None), ("f", 6, "A", "x")], "f string, pos int, who string, said string")
    assert windows.tagged_turns(df, "f", "pos", "who", "said").first()["text"] == "hi x SPEAKER_CHANGE x"


def test_p_patterns(spark):
    texts = ["P p", "say \"P\"", "(P)", "ends. P", "P", "P is fine", "plan", "p p p", "éP p", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(filters.has_p_pattern(F.col("t"))).collect()] == [True, True, True, True, True, False, False, True, False, False]
    assert df.select(filters.has_p_pattern(F.col("t"), strict=True).alias("x")).collect()[6]["x"]


def test_line_repair(spark):
    lines = ['{"audio_filepath":"a.wav","text":{"sentence":"hello"},"duration":1.5}', '{"audio_filepath":"b.wav","text":{"annotated_sentence":"hi"},"duration":2}', '{"audio_filepath":"c.wav","text":["x"]}', '{"audio_filepath":"d.wav","text":"t"}, "duration": 3.2}', '{"audio_filepath":"e.wav","text":"cut', '{"text":"no path"}', "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line_number int, value string")
    assert [r["route"] for r in repair.route_lines(df).orderBy("line_number").collect()] == ["ok", "ok", "error", "error", "error", "error", "blank", "blank"]
    fixed = [r[0] for r in df.orderBy("line_number").select(repair.repaired(F.col("value"))).collect()]
    assert json.loads(fixed[3]) == {"audio_filepath": "d.wav", "text": "t", "duration": 3.2} and json.loads(fixed[4])["text"] == "cut" and fixed[7] is None
    assert apply(spark, repair.clean_reply, ['```json\n{"a":1}\n```', 'x [{"a":1}}] y', '{"sentences":[{"a":1}]}', "none", None]) == ['[{"a":1}]', '[{"a":1}]', '[{"a":1}]', None, None]
    parts = repair.split_concatenated(spark.createDataFrame([(1, '{"a":1}{"b":2} {"c":3}')], "i int, value string")).orderBy("part").collect()
    assert [r["value"] for r in parts] == ['{"a":1}', '{"b":2}', '{"c":3}']


def test_subtitles(spark, tmp_path):
    (tmp_path / "a.vtt").write_text("﻿WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:03.000\nso today<00:00:01.500><c> we</c>\nso today<00:00:01.500><c> we</c>\n\n00:00:02.500 --> 00:00:05.000 align:start\nwe will start\n\n00:01:00.000 --> 00:01:01.000\n \n")
    cues = subtitles.read_vtt(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["start"], r["end"], r["text"]) for r in cues] == [(1.0, 3.0, "so today we"), (2.5, 5.0, "we will start")]


def test_sources(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"audio_filepath":"a","text":"x","duration":1}\nbad\n\n{"audio_filepath":"b","text":"y"}\n')
    m = str(tmp_path / "m.jsonl")
    assert manifests.read_manifest(spark, m).count() == 2
    assert sum(r["_bad"] is not None for r in manifests.read_manifest(spark, m, "keep").collect()) == 1
    with pytest.raises(Exception):
        manifests.read_manifest(spark, m, "fail").collect()
    (tmp_path / "k.json").write_text('{"id1": {"text": "a"}, "id2": {"text": null}}')
    assert sorted((r["key"], r["text"]) for r in manifests.read_keyed(spark, str(tmp_path / "k.json"), "text:string").collect()) == [("id1", "a"), ("id2", None)]
    (tmp_path / "latin").mkdir()
    (tmp_path / "latin" / "l.txt").write_bytes("caf\xe9\nb".encode("latin-1"))
    assert [r["value"] for r in manifests.read_any_encoding(spark, str(tmp_path / "latin")).orderBy("pos").collect()] == ["café", "b"]
    (tmp_path / "p.txt").write_text("a.wav | x | y\nnone\nb.wav | z\n")
    lines = manifests.read_lines(spark, str(tmp_path / "p.txt"))
    assert [(r[2], r[3]) for r in manifests.split_pair(lines).orderBy("pos").collect()] == [("a.wav", "x | y"), ("b.wav", "z")]
    (tmp_path / "i.txt").write_text("u1 first\nu2\nu1 last words\n")
    assert sorted(map(tuple, manifests.id_text(manifests.read_lines(spark, str(tmp_path / "i.txt"))).collect())) == [("u1", "last words"), ("u2", "")]
    (tmp_path / "v.json").write_text(json.dumps({"state": "S", "gender": "F", "verbatim": [{"start": 0, "end": 1, "text": "a"}, {"start": 1, "end": 2, "text": "b"}]}))
    assert [r["text"] for r in manifests.read_verbatim(spark, str(tmp_path / "v.json")).orderBy("pos").collect()] == ["a", "b"]
    (tmp_path / "au").mkdir()
    (tmp_path / "au" / "x.WAV").write_bytes(b"12")
    (tmp_path / "au" / "y.txt").write_bytes(b"1")
    assert [r["length"] for r in manifests.list_files(spark, str(tmp_path / "au")).collect()] == [2]
    c = manifests.DomainConfig.from_mapping({"domain": "d", "processing": {"chunk_seconds": 20.0}, "other": 1})
    assert (c.domain, c.chunk_seconds, c.overlap_seconds, c.features["other"]) == ("d", 20.0, 10.0, 1)


def test_sinks_resume_and_route(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "ok"), (2, None, "bad")], "id int, text string, route string")
    sinks.append_new(df, str(tmp_path / "s"), "id")
    sinks.append_new(df.unionByName(spark.createDataFrame([(3, "c", "ok")], df.schema)), str(tmp_path / "s"), "id")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [1, 2, 3]
    sinks.write_routed(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "route=ok")).count() == 1
    sinks.write_json_array(df.coalesce(1), str(tmp_path / "j"))
    assert len(json.loads("\n".join(r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()))) == 2
    sinks.write_json_lines(df, str(tmp_path / "l"))
    assert "null" not in "".join(r["value"] for r in spark.read.text(str(tmp_path / "l")).collect())


def test_streaming_ingest_is_incremental(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    (tmp_path / "src").mkdir()
    run = lambda: ingest.ingest(spark, src, out, ck, manifests.MANIFEST, key="audio_filepath").awaitTermination()
    (tmp_path / "src" / "1.json").write_text('{"audio_filepath":"a","text":"x","duration":1}\n')
    run()
    (tmp_path / "src" / "2.json").write_text('{"audio_filepath":"a","text":"again","duration":1}\n{"audio_filepath":"b","text":"y","duration":1}\n')
    run()
    assert sorted(r["audio_filepath"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_progress_is_observed(spark, tmp_path):
    seen = ingest.Progress()
    spark.streams.addListener(seen)
    try:
        (tmp_path / "src").mkdir()
        (tmp_path / "src" / "1.json").write_text('{"audio_filepath":"a"}\n{"audio_filepath":"b"}\n')
        run = ingest.ingest(spark, *(str(tmp_path / x) for x in ("src", "out", "ck")), "audio_filepath string")
        run.awaitTermination()
        for _ in range(100):
            if seen.last.get(str(run.id), {}).get("done"):
                break
            time.sleep(0.1)
        assert seen.last[str(run.id)] == {"rows": 2, "done": True}
    finally:
        spark.streams.removeListener(seen)


def test_session_stream_takes_late_events_and_long_gaps(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    at = lambda u, *ts: [(u, f"2024-01-01 {t}") for t in ts]
    parts = [at(1, "00:00:00", "00:20:00") + at(2, "00:05:00"), at(1, "00:10:00", "01:00:00", "01:59:59", "02:00:00"), at(9, "23:00:00"), at(None, "23:30:00") + at(9, "23:59:00")]
    for part in parts:
        spark.createDataFrame(part, "user_id long, t string").selectExpr("user_id", "CAST(t AS TIMESTAMP) AS ts").coalesce(1).write.mode("append").parquet(src)
        rows = ingest.session_stream(spark.readStream.schema("user_id long, ts timestamp").parquet(src), late="30 minutes")
        ingest.with_state_store(spark, lambda: rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start().awaitTermination())
    got = sorted((r["user_id"], str(r["start"])[11:], r["n"]) for r in spark.read.schema("user_id long, start timestamp, n long").parquet(out).collect())
    assert got == [(1, "00:00:00", 3), (1, "01:00:00", 2), (1, "02:00:00", 1), (2, "00:05:00", 1)]


def test_sessions_end_after_their_time(spark):
    rows = [(1, 1, "2024-01-01 00:00:00"), (2, 1, "2024-01-01 00:59:00"), (3, 1, "2024-01-01 01:00:00"), (4, 2, "2024-01-01 00:30:00")]
    df = spark.createDataFrame(rows, "event_id long, user_id long, t string").withColumn("ts", F.to_timestamp("t"))
    assert sorted((r["user_id"], r["n"]) for r in ingest.sessions(df).collect()) == [(1, 1), (1, 2), (2, 1)]


def test_annotation_falls_back(spark):
    class Flaky:
        def annotate(self, texts):
            if len(texts) > 1:
                return texts[:-1]
            if texts[0] == "bad":
                raise RuntimeError("no")
            return [texts[0].upper()]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "c")], "i int, t string").coalesce(1)
    out = providers.annotate_batches(df, "t", Flaky, batch=2).orderBy("i").collect()
    assert [(r["annotated"], r["error"]) for r in out] == [("A", None), ("bad", "RuntimeError: no"), (None, None), ("C", None)]


def test_audio_is_measured_cut_and_heard(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setparams((2, 2, 100, 0, "NONE", ""))
        w.writeframes(b"".join(struct.pack("<hh", i, i + 2) for i in range(250)))
    data = (tmp_path / "a.wav").read_bytes()
    df = spark.createDataFrame([(1, bytearray(data)), (2, bytearray(b"junk")), (3, None)], "i int, audio binary")
    out = df.select("i", providers.audio_duration(F.col("audio")).alias("d"), providers.transcribe(F.col("audio")).alias("t"), providers.audio_duration(providers.cut_audio(F.col("audio"), F.lit(0.5), F.lit(2.0))).alias("c")).orderBy("i").collect()
    assert [r["d"] for r in out] == [2.5, None, None] and out[0]["c"] == 1.5 and len(out[0]["t"]["words"]) == 2 and out[2]["t"]["error"] == "no audio"
    traits = df.select("i", providers.audio_traits(F.col("audio"), F.lit(0.5)).alias("t")).orderBy("i").collect()
    assert [r["t"]["emotion"] for r in traits] == ["Audio_Too_Short", "Audio_Too_Short", "No_Audio"]


def test_empty_texts_have_an_emotion(spark):
    def classify(text):
        if text == "bad":
            raise RuntimeError("no")
        return "HAP"

    t = F.col("t")
    got = spark.createDataFrame([("",), ("bad",), (None,)], "t string").select(providers.text_emotion(t), providers.text_emotion(t, classify)).collect()
    assert [tuple(r) for r in got] == [("EMOTION_SAD", "EMOTION_HAP"), (got[1][0], "EMOTION_NEU"), ("EMOTION_NEU", "EMOTION_NEU")]


def test_columns_with_nulls(spark):
    df = spark.createDataFrame([(None, None), ("/a/b.tar.gz", "NA"), ("x", " female ")], "p string, g string")
    got = df.select(paths.stem(F.col("p")), paths.dirname(F.col("p")), buckets.gender_or_model(F.col("g"), F.lit("M")), buckets.known_gender(F.col("g")), buckets.timestamp_seconds(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(None, None, "M", "UNKNOWN", 0.0), ("b.tar", "/a", "M", "UNKNOWN", 0.0), ("x", "", "FEMALE", "FEMALE", 0.0)]


def test_prefixes_of_every_length_count(spark):
    from voxloom.operators import joins

    prefixes = spark.createDataFrame([("x" * n + "y",) for n in range(1, 1201)] + [("",), (None,)], "prefix string")
    lines = spark.createDataFrame([("x" * n + "y tail",) for n in range(1, 1201)] + [("x",), ("",), (None,), ("other",)], "value string")
    assert sorted(str(r["value"]) for r in joins.without_prefixes(lines, prefixes).collect()) == ["", "None", "other", "x"]


def test_prefixes_against_every_pair(spark):
    rng = random.Random(3)
    for n in (0, 5, 60):
        prefixes = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(n)]
        lines = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 9))) for _ in range(300)] + [None]
        got = joins.without_prefixes(spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame([(p,) for p in prefixes] + [(None,)], "prefix string"))
        assert sorted(str(r[0]) for r in got.collect()) == sorted(str(x) for x in lines if x is None or not any(p and x.startswith(p) for p in prefixes))


def test_intervals_of_any_length_against_every_pair(spark):
    rng, inf = random.Random(4), float("inf")
    left = [("k", i, a, a + rng.choice([0, 0.5, 20, 200, 5000, 1e6, inf])) for i, a in enumerate(rng.uniform(-500, 500) for _ in range(40))] + [("k", 900, -inf, 3.0), ("k", 901, 5.0, 1.0), ("k", 902, None, 1.0)]
    right = [("k", i, a, a + rng.choice([0, 3, 70, 700, 1e5, inf])) for i, a in enumerate(rng.uniform(-600, 600) for _ in range(40))]
    at = [("k", i, rng.choice([rng.uniform(-600, 6000), rng.uniform(-1e7, 1e7), left[i % 40][2]])) for i in range(90)] + [("k", 900, None), ("k", 901, inf)]
    a, b, p = spark.createDataFrame(left, "key string, r int, s double, e double"), spark.createDataFrame(right, "key string, q int, s2 double, e2 double"), spark.createDataFrame(at, "key string, id int, at double")
    real = [r for r in left if r[2] is not None and r[2] <= r[3]]
    assert sorted((x["id"], x["r"]) for x in joins.point_in_range(p, a, "key", "at", "s", "e").collect()) == sorted((x[1], r[1]) for x in at for r in real if x[2] is not None and r[2] <= x[2] <= r[3])
    assert sorted((x["r"], x["q"]) for x in joins.overlaps(a, b, "key", ("s", "e"), ("s2", "e2")).collect()) == sorted((r[1], q[1]) for r in real for q in right if r[3] >= q[2] and r[2] <= q[3])


def test_chains_of_two_keys(spark):
    rng = random.Random(5)
    rows = [(i, f"p{(i + 1) // 2}", f"c{i // 2}") for i in range(600)] + [(5000 + i, rng.choice([None, *"uvwxyz"]), rng.choice([None, *"rstq"])) for i in range(50)]
    seen_p, seen_c, want = set(), set(), []
    for n, p, c in rows:
        if p not in seen_p and c not in seen_c:
            seen_p.add(p), seen_c.add(c), want.append(n)
    assert sorted(r[0] for r in windows.keep_first_of_two_keys(spark.createDataFrame(rows, "pos int, path string, content string"), "path", "content", "pos").collect()) == want


def test_more_words_than_an_alphabet_has_letters(spark):
    n = 60_000
    a, b = " ".join(f"w{i}" for i in range(n)), " ".join(f"w{i}" for i in range(n) if i % 30_000 != 7)
    known = {}
    r, h = metrics._letters(a.split(), known), metrics._letters(b.split(), known)
    assert len(r) == n and len(set(r)) == n and not any("\ud800" <= c <= "\udfff" for c in r)
    assert metrics.alignment(r[29_000:31_000], h[28_999:30_998]) == (0, 1, 0)
    few = spark.createDataFrame([(" ".join(f"w{i % 40_000}" for i in range(45_000)), "w1")], "ref string, hyp string")
    assert tuple(metrics.with_edits(few, "ref", "hyp").select("edits", "units", "heard").first()) == (44_999, 45_000, 1)


def test_alignments_against_the_whole_matrix():
    rng = random.Random(6)
    for _ in range(500):
        r, h = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        rows = [list(range(len(h) + 1))]
        for i, x in enumerate(r, 1):
            rows.append([i])
            for j, y in enumerate(h, 1):
                rows[i].append(min(rows[i - 1][j - 1] + (x != y), rows[i - 1][j] + 1, rows[i][j - 1] + 1))
        i, j, n = len(r), len(h), [0, 0, 0]
        while i or j:
            if i and j and rows[i][j] == rows[i - 1][j - 1] + (r[i - 1] != h[j - 1]):
                n[2] += r[i - 1] != h[j - 1]
                i, j = i - 1, j - 1
            elif i and rows[i][j] == rows[i - 1][j] + 1:
                n[1], i = n[1] + 1, i - 1
            else:
                n[0], j = n[0] + 1, j - 1
        assert metrics.alignment(r, h) == tuple(n)


def test_evaluation_parts(spark):
    df = spark.createDataFrame([(1, "go ENTITY_CITY new york END", "go ENTITY_CITY york END"), (2, "ENTITY_ORG osi END", None)], "id int, ref string, hyp string")
    got = {r["metric"]: r["value"] for r in metrics.evaluation(df, "id", "ref", "hyp").collect()}
    assert got["wer"] == 0.5 and got["ENTITY_CITY.fscore"] == 0 and got["overall_micro.recall"] == 0
    assert {r["metric"]: r["value"] for r in metrics.evaluation(df, "id", "ref", "hyp", by_label=True, vocabulary=("ENTITY_CITY",)).collect()}["overall_macro.fscore"] == 1
    with pytest.raises(Exception, match="differ in length"):
        metrics.same_length(df.select("id", "ref"), df.select("id", "hyp").where("id = 1"), "id").collect()


def test_providers_that_fail(spark):
    class Broken:
        def reply(self, text):
            raise RuntimeError

        def bio(self, texts):
            return "no json"

        def keywords(self, text, most):
            raise RuntimeError

    df = spark.createDataFrame([(1, "Ana goes"), (2, None), (3, "")], "id int, text string").coalesce(1)
    assert [tuple(r) for r in df.select("id", providers.entities_and_intents(F.col("text"), Broken).alias("e")).select("e.*").collect()] == [([], [])] * 3
    assert [(r["tokens"], r["tags"], r["intent"]) for r in providers.annotate_bio(df, "text", Broken).orderBy("id").collect()] == [(["ana", "goes"], ["PARSE_ERROR"] * 2, "JSON_PARSE_ERROR"), (None, None, None), ([], [], "JSON_PARSE_ERROR")]
    assert providers.rare_keywords(df, "id", "text", spark.createDataFrame([("ana",)], "word string"), Broken).count() == 0
    assert [r["k"] for r in providers.rare_keywords(df, "id", "text", spark.createDataFrame([("ana",)], "word string")).select(F.col("keyword").alias("k")).collect()] == ["Ana"]


def test_listing_in_any_case_and_empty_folders(spark, tmp_path):
    for name in ("a.Wav", "b.WAV", "c.wave", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert manifests.list_files(spark, str(tmp_path)).count() == 2
    with pytest.raises(FileNotFoundError):
        manifests.read_csv_folder(spark, str(tmp_path), "a string")


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from voxloom import staging

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]", "getConf": staticmethod(lambda: type("G", (), {"get": staticmethod(lambda *a: None)}))})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(Cluster)
    table = staging.staged(spark.range(3))
    assert table.count() == 3
    staging.drop(table)
    with pytest.raises(Exception):
        spark.read.parquet(table.staged_at).count()
    way = []

    def make():
        way.append(staging.staged(spark.range(5)))
        return way[0].where("id > 2")

    out = staging.settled(make)
    assert out.count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(way[0].staged_at).count()


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(5, 5), (None, 3), (1, 0)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}
    for a, b in edges:
        if a is not None and a != b:
            x, y = up.setdefault(a, {a}), up.setdefault(b, {b})
            x |= y
            for k in x:
                up[k] = x
    assert got == {k: min(v) for k, v in up.items()}
