"""Queries over readers and writers: the driver's tables are written as the files that a reader takes, in the shared folder, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.catalog import query
from voxloom.operators import aggregates
from voxloom.plans.base import table
from voxloom.sources import archives, keyed, manifests, search, sinks
from voxloom.staging import scratch
from voxloom.streaming import ingest

#: A text on one line, and its SQL twin.
_FLAT = "translate(text, concat(chr(10), chr(13), chr(9)), '   ')"
_FLAT_SQL = "translate(text, chr(10) || chr(13) || chr(9), '   ')"


def _manifest(spark, sf_dir):
    """doc_id as text, a text and a duration."""
    return table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS STRING) AS audio_filepath", "text", "n_chars / 16D AS duration")


def _lines(df, value, label):
    """The path of files with one line for each row."""
    path = scratch(df.sparkSession, label)
    df.select(F.expr(value).alias("value")).write.text(path)
    return path


_GOOD = "SELECT doc_id::VARCHAR AS audio_filepath, text, n_chars / 16::DOUBLE AS duration FROM documents"


@query("src_jsonl_skip", _GOOD + " WHERE doc_id % 10 <> 3")
def src_jsonl_skip(spark, sf_dir):
    rows = _manifest(spark, sf_dir)
    line = "CASE WHEN CAST(audio_filepath AS BIGINT) % 10 = 3 THEN '{\"audio_filepath\": cut' ELSE to_json(struct(*)) END"
    return manifests.read_manifest(spark, _lines(rows, line, "jsonl"))


@query("src_jsonl_keep", "SELECT CASE WHEN doc_id % 10 <> 3 THEN doc_id::VARCHAR END AS audio_filepath, CASE WHEN doc_id % 10 = 3 THEN '{\"audio_filepath\": ' || doc_id || ', cut' END AS bad FROM documents")
def src_jsonl_keep(spark, sf_dir):
    rows = _manifest(spark, sf_dir)
    line = "CASE WHEN CAST(audio_filepath AS BIGINT) % 10 = 3 THEN concat('{\"audio_filepath\": ', audio_filepath, ', cut') ELSE to_json(struct(*)) END"
    out = manifests.read_manifest(spark, _lines(rows, line, "jsonl"), "keep")
    return out.select("audio_filepath", F.col("_bad").alias("bad"))


@query("src_jsonl_fail", _GOOD)
def src_jsonl_fail(spark, sf_dir):
    path = scratch(spark, "jsonl")
    sinks.write_json_lines(_manifest(spark, sf_dir), path)
    return manifests.read_manifest(spark, path, "fail")


@query("src_json_array", _GOOD)
def src_json_array(spark, sf_dir):
    path = scratch(spark, "array")
    sinks.write_json_array(_manifest(spark, sf_dir), path, 300)
    return manifests.read_json_values(spark, path, manifests.MANIFEST)


@query("src_keyed", "SELECT 'd' || doc_id AS key, text, lang FROM documents")
def src_keyed(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 50")).agg(F.to_json(F.map_from_entries(F.collect_list(F.expr("struct(concat('d', doc_id) AS key, struct(text, lang) AS value)")))).alias("value"))
    path = scratch(spark, "keyed")
    rows.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return manifests.read_keyed(spark, path, "text:string,lang:string")


@query("src_any_encoding", f"SELECT doc_id, regexp_replace({_FLAT_SQL}, '[^\\x00-\\x{{FF}}]', '?', 'g') AS text FROM documents")
def src_any_encoding(spark, sf_dir):
    path = scratch(spark, "latin")
    table(spark, sf_dir, "documents").select(F.expr(f"concat(doc_id, chr(9), {_FLAT})").alias("value")).write.options(quote="", encoding="ISO-8859-1", sep="\x01", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    rows = manifests.read_any_encoding(spark, f"{path}/part-*").where("value <> ''").withColumn("p", F.split("value", "\t"))
    return rows.select(F.col("p")[0].cast("long").alias("doc_id"), F.col("p")[1].alias("text"))


@query("src_tsv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_tsv(spark, sf_dir):
    path = scratch(spark, "tsv")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("sep", "\t").option("header", True).csv(path)
    return manifests.read_table(spark, path, schema="c_custkey bigint, c_name string, c_acctbal double")


@query("src_tsv_tolerant", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 7 <> 0")
def src_tsv_tolerant(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'id\tno number' ELSE concat(c_custkey, chr(9), c_name) END").alias("value"))
    path = scratch(spark, "tsv")
    rows.select(F.expr("split(value, chr(9))[0]").alias("c_custkey"), F.expr("split(value, chr(9))[1]").alias("c_name")).write.option("sep", "\t").option("header", True).csv(path)
    return manifests.read_table(spark, path, strict=False, schema="c_custkey bigint, c_name string")


@query("csv_folder", "SELECT doc_id, text, round_even(n_chars / 7::DOUBLE, 2) AS seconds FROM documents")
def csv_folder(spark, sf_dir):
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "n_chars / 7D AS seconds"), path, 2)
    return manifests.read_csv_folder(spark, path, "doc_id bigint, text string, seconds double")


@query("src_pair", f"SELECT 'audio/' || doc_id || '.wav' AS audio_filepath, {_FLAT_SQL} || ' | tail' AS text FROM documents WHERE doc_id % 9 <> 0")
def src_pair(spark, sf_dir):
    path = _lines(table(spark, sf_dir, "documents"), f"CASE WHEN doc_id % 9 = 0 THEN concat('no separator ', doc_id) ELSE concat('audio/', doc_id, '.wav | ', {_FLAT}, ' | tail') END", "pair")
    return manifests.split_pair(manifests.read_lines(spark, path)).select("audio_filepath", "text")


@query("src_id_text", "SELECT 'u' || doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'said by ' || lang END AS text FROM documents")
def src_id_text(spark, sf_dir):
    path = _lines(table(spark, sf_dir, "documents"), "concat('u', doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('   said by ', lang) END)", "ids")
    return manifests.id_text(manifests.read_lines(spark, path))


@query("src_speech_list", "SELECT 'u' || c_custkey || '.wav' AS id, 'wav/u' || c_custkey AS path, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 's' || c_nationkey END AS speaker, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS text, CASE WHEN c_custkey % 5 = 0 OR n_nationkey % 2 = 1 THEN '' ELSE n_nationkey::VARCHAR END AS age, CASE WHEN c_custkey % 5 = 0 OR n_nationkey % 2 = 1 THEN '' ELSE n_name END AS gender FROM customer JOIN nation ON c_nationkey = n_nationkey")
def src_speech_list(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    scp = _lines(c, "concat('u', c_custkey, '.wav', chr(9), 'wav/u', c_custkey)", "scp")
    said = _lines(c.where("c_custkey % 5 <> 0"), "concat('u', c_custkey, '.wav', chr(9), 's', c_nationkey, chr(9), c_name)", "trans")
    who = _lines(n.where("n_nationkey % 2 = 0"), "concat('s', n_nationkey, chr(9), n_nationkey, chr(9), n_name)", "spkinfo")
    return manifests.read_speech_list(spark, scp, said, who)


@query("src_text_files", "SELECT trim(text) AS text, trim(string_split(text, chr(10))[1]) AS first_line FROM benchmark")
def src_text_files(spark, sf_dir):
    path = scratch(spark, "texts")
    table(spark, sf_dir, "benchmark").select("text").write.option("maxRecordsPerFile", 1).option("lineSep", "\x00").text(path)
    whole = manifests.read_text_files(spark, path).select("file", F.replace("text", F.lit("\x00"), F.lit("")).alias("text"))
    first = manifests.read_text_files(spark, path, True).select("file", F.replace("text", F.lit("\x00"), F.lit("")).alias("first_line"))
    return whole.join(first, "file").select("text", "first_line")


@query("src_verbatim", "SELECT 's' || conv_id AS state, 'g' || conv_id % 2 AS gender, (turn - 0)::DOUBLE AS start, turn + 1::DOUBLE AS \"end\", text FROM conversations")
def src_verbatim(spark, sf_dir):
    spans = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.expr("struct(CAST(turn AS DOUBLE) AS start, turn + 1D AS end, text)"))).alias("verbatim"))
    path = scratch(spark, "verbatim")
    sinks.write_json_array(spans.selectExpr("concat('s', conv_id) AS state", "concat('g', conv_id % 2) AS gender", "'x' AS age_group", "'t' AS task_name", "verbatim"), path, 20)
    return manifests.read_verbatim(spark, path).select("state", "gender", "start", "end", "text")


@query("src_listing", """SELECT lang, sum(strlen(doc_id::VARCHAR || ' ' || lang) + 1)::BIGINT AS bytes, 'TXT' AS extension FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def src_listing(spark, sf_dir):
    """The files of one folder for each language, listed with their sizes."""
    path = scratch(spark, "listing")
    rows = table(spark, sf_dir, "documents").where("lang IS NOT NULL").selectExpr("lang AS folder", "concat(doc_id, ' ', lang) AS value")
    rows.write.partitionBy("folder").text(path)
    found = manifests.list_files(spark, path, ("TXT",))
    return found.groupBy(F.regexp_extract("path", "folder=([^/]*)/", 1).alias("lang"), F.upper(F.regexp_extract("path", "[.]([a-z]+)$", 1)).alias("extension")).agg(F.sum("length").alias("bytes"))


@query("src_search", "SELECT n_name AS query, n_name || ' ' || i AS title, 'PT' || (1 + i % 59) || 'M' AS duration FROM nation, range(60) t(i)")
def src_search(spark, sf_dir):
    names = [r["n_name"] for r in table(spark, sf_dir, "nation").select("n_name").collect()]  # a list of queries, 25 at every scale
    return search.search(spark, names, 60).select(F.regexp_extract("title", "^(.*) [0-9]+$", 1).alias("query"), "title", "duration")


@query("src_columns", "SELECT doc_id, lang FROM documents")
def src_columns(spark, sf_dir):
    return manifests.scan_examples(table(spark, sf_dir, "documents"), ["doc_id", "lang", "no_such_column"])


@query("src_config", "SELECT r_name AS domain, 'en' AS language, 20.0::DOUBLE AS chunk_seconds, 10.0::DOUBLE AS overlap_seconds, r_regionkey::VARCHAR AS feature FROM region")
def src_config(spark, sf_dir):
    rows = [manifests.DomainConfig.from_mapping({"domain": r["r_name"], "processing": {"chunk_seconds": 20.0}, "region": str(r["r_regionkey"])}) for r in table(spark, sf_dir, "region").collect()]  # configurations live on the driver, 5 at every scale
    return spark.createDataFrame([(c.domain, c.language, c.chunk_seconds, c.overlap_seconds, c.features["region"]) for c in rows], "domain string, language string, chunk_seconds double, overlap_seconds double, feature string")


@query("src_preview", "SELECT event_id % 3 <> 0 AS valid, CASE WHEN event_id % 3 = 0 THEN '{cut ' || event_id ELSE props END AS value FROM events ORDER BY event_id LIMIT 200")
def src_preview(spark, sf_dir):
    path = _lines(table(spark, sf_dir, "events").orderBy("event_id"), "CASE WHEN event_id % 3 = 0 THEN concat('{cut ', event_id) ELSE props END", "preview")
    return manifests.valid_json_preview(manifests.read_lines(spark, path), 200).select("valid", "value")


@query("sink_json_lines", """SELECT '{"c_custkey":' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',"name":"' || c_name || '"' ELSE '' END || '}' AS value FROM customer""")
def sink_json_lines(spark, sf_dir):
    path = scratch(spark, "lines")
    sinks.write_json_lines(table(spark, sf_dir, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name"), path)
    return spark.read.text(path)


@query("sink_routed", "SELECT doc_id, lang, text FROM documents")
def sink_routed(spark, sf_dir):
    path = scratch(spark, "routed")
    sinks.write_routed(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path, "lang")
    return spark.read.schema("doc_id bigint, text string, lang string").json(path)


@query("sink_batches", "SELECT event_id, user_id, true AS bounded FROM events")
def sink_batches(spark, sf_dir):
    """Every row that the numbered files hold, and whether its file has 100 at most."""
    path = scratch(spark, "batches")
    sinks.write_batches(table(spark, sf_dir, "events").select("event_id", "user_id"), path, 100)
    rows = spark.read.schema("event_id bigint, user_id bigint").json(path).withColumn("file", F.col("_metadata.file_path"))
    small = rows.groupBy("file").agg((F.count("*") <= 100).alias("bounded"))
    return rows.join(small, "file").select("event_id", "user_id", "bounded")


@query("sink_append", "SELECT doc_id, lang FROM documents")
def sink_append(spark, sf_dir):
    path, rows = scratch(spark, "append"), table(spark, sf_dir, "documents").select("doc_id", "lang")
    sinks.append_new(rows.where("doc_id % 2 = 0"), path, "doc_id")
    sinks.append_new(rows, path, "doc_id")
    return spark.read.parquet(path)


@query("sink_predicted", f"SELECT {_FLAT_SQL} AS value FROM documents WHERE doc_id % 3 <> 0 AND trim({_FLAT_SQL}) <> ''")
def sink_predicted(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(f"CASE doc_id % 6 WHEN 0 THEN ' ' WHEN 3 THEN NULL ELSE {_FLAT} END AS predicted_text")
    return sinks.predicted_text_dump(rows)


@query("transcripts", "SELECT 'd' || conv_id || '/' AS folder, turn || '.wav' AS file, text FROM conversations")
def transcripts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").selectExpr("concat('d', conv_id, '/', turn, '.wav') AS file", "text")
    return sinks.transcripts_map(c, "file", "text").select("folder", F.explode(F.from_json("value", "map<string,string>")).alias("file", "text"))


@query("stream_ingest", "SELECT doc_id::VARCHAR AS audio_filepath, lang AS text FROM documents")
def stream_ingest(spark, sf_dir):
    """Two files, of which the second repeats keys of the first; a run of the stream for each."""
    src, out, ck = (scratch(spark, x) for x in ("stream-in", "stream-out", "stream-ck"))
    rows = table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS STRING) AS audio_filepath", "lang AS text")
    for part in (rows.where("doc_id % 2 = 0"), rows):
        part.write.mode("append").json(src)
        ingest.ingest(spark, src, out, ck, "audio_filepath string, text string", key="audio_filepath").awaitTermination()
    return spark.read.schema("audio_filepath string, text string").parquet(out)


@query("stream_progress", "SELECT 'done' AS state, count(*) AS rows FROM documents")
def stream_progress(spark, sf_dir):
    src, out, ck = (scratch(spark, x) for x in ("stream-in", "stream-out", "stream-ck"))
    table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS STRING) AS audio_filepath").write.json(src)
    run = ingest.ingest(spark, src, out, ck, "audio_filepath string")
    run.awaitTermination()
    return spark.createDataFrame([("done" if not run.isActive else "running", sum(p["numInputRows"] for p in run.recentProgress))], "state string, rows long")


@query("unioned_sources", "SELECT 'lines' AS part, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages")
def unioned_sources(spark, sf_dir):
    both = aggregates.union_all(table(spark, sf_dir, "documents").select(F.lit("lines").alias("part"), "doc_id"), table(spark, sf_dir, "pages").select(F.lit("pages").alias("part"), "page_id"))
    return both.groupBy("part").agg(F.count("*").alias("n"))


@query("archive_scan", """SELECT doc_id % 3 AS form, coalesce(lang, 'none') || '/' || doc_id || '.txt' AS member, coalesce(octet_length(encode(text)), 0)::BIGINT AS size, md5(coalesce(text, '')) AS digest, NULL::VARCHAR AS error FROM documents""")
def archive_scan(spark, sf_dir):
    """Documents written as tar, zip and gzipped tar archives and read back."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id % 3 AS form", "concat(coalesce(lang, 'none'), '/', doc_id, '.txt') AS member", "text").repartition(8)
    paths = aggregates.union_all(*[archives.write_archives(rows.where(F.col("form") == i), "member", "text", scratch(spark, "archive"), kind) for i, kind in enumerate(("tar", "zip", "tgz"))])
    form = F.when(F.endswith("path", F.lit("tgz")), 2).when(F.endswith("path", F.lit("zip")), 1).otherwise(0).cast("long")
    return archives.read_archives(paths, range_bytes=1 << 20).select(form.alias("form"), "member", "size", F.md5("content").alias("digest"), "error")


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


@query("keyed_merge", f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'M' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 5 = 0""")
def keyed_merge(spark, sf_dir):
    """Orders of two thirds of the customers are put in; then all others come, some change twice, some go, and some of these come back."""
    o = table(spark, sf_dir, "orders").selectExpr(*_ORDER_COLUMNS.split(", "))
    t = keyed.KeyedTable(spark, scratch(spark, "orders"), ["o_orderkey"], 16)
    t.merge(o.where("o_custkey % 3 <> 0"), "o_totalprice")
    changed = o.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("M"))
    steps = [o.where("o_custkey % 3 = 0").selectExpr("*", "0 AS step", "false AS gone"), changed.withColumn("o_orderstatus", F.lit("?")).selectExpr("*", "1 AS step", "false AS gone"),
        o.where("o_orderkey % 7 = 0").selectExpr("*", "2 AS step", "true AS gone"), changed.selectExpr("*", "3 AS step", "false AS gone")]
    t.merge(aggregates.union_all(*steps), "step", F.col("gone"))
    return t.read()


@query("merge_stream", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def merge_stream(spark, sf_dir):
    """Each user's last event, from a stream that delivers half of the events twice."""
    src, ck = (scratch(spark, x) for x in ("merge-in", "merge-ck"))
    t = keyed.KeyedTable(spark, scratch(spark, "users"), ["user_id"], 8)
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    for part in (e.where("event_id % 2 = 0"), e):
        part.write.mode("append").parquet(src)
        keyed.merge_stream(spark.readStream.schema(e.schema).parquet(src), t, "event_id", "events", ck).awaitTermination()
    return t.read()
