"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, common, langid, licenses, media, minhash, negatives, packing, quality, sharding, suffixes, token_counts, topk, trie


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10, 1024)


def op2_sharding(spark, sf_dir):
    out = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_token_counts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("n", F.coalesce(F.char_length("text"), F.lit(0)))
    edits = F.expr("""array(
        struct(n div 4 AS start, n div 4 AS end, ' a note put in here, ' AS text),
        struct(n div 2 AS start, n div 2 + 20 AS end, '' AS text),
        struct(3 * n div 4 AS start, 3 * n div 4 + 10 AS end, 'changed  words' AS text),
        struct(n + 1000 AS start, n + 1000 AS end, ' the end' AS text))""")
    return token_counts.count_tokens(docs.withColumn("edits", edits), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, edits_col="edits")


def op4_minhash(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), 85)


def op5_media_columns(spark, sf_dir):
    return media.document_media(_table(spark, sf_dir, "documents"))


def media_pages(spark, sf_dir):
    """The pages' own sequences, with one figure put at the end of each article that names the page's address, as a payload of the store, by digest."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    bytes_of = F.col("url").cast("binary")
    payload = F.rpad(bytes_of, F.greatest(F.ceil(F.octet_length("url") / 64), F.lit(1)).cast("int") * 64, F.lit(b"\x00"))
    figure = F.concat(F.lit('<figure><audio src="sha256:'), F.sha2(payload, 256), F.lit('"></audio><figcaption>'), "page_id", F.lit("</figcaption></figure></article>"))
    shown = pages.withColumn("html", F.replace("html", F.lit("</article>"), figure))
    out = media.page_media(shown, media.store_media(pages, "url"))
    at = F.element_at(F.filter("items", lambda i: i["kind"] == "audio"), 1)
    texts = F.transform(F.filter("items", lambda i: i["kind"] == "text"), lambda i: i["text"])
    return out.select("page_id", F.size("items").cast("long").alias("n_items"), at["pos"].cast("long").alias("media_pos"), at["caption"].alias("caption"), at["payload_bytes"].alias("payload_bytes"), at["payload_sha256"].alias("payload_sha256"), F.md5(F.array_join(texts, "|").cast("binary")).alias("texts_md5"))


def op6_byte_bpe(spark, sf_dir):
    return bpe.encode_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


def op7_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).drop("shares")


def op8_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op9_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, keep_ids=False)


def op10_license_scans(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op11_hard_negatives(spark, sf_dir):
    named = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", named), F.col("vec_id") % 50 == 0)


def op12_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), 200)


def op13_prefix_trie(spark, sf_dir):
    arrays = common.staged(trie.turn_arrays(_table(spark, sf_dir, "conversations")), "turns")
    return trie.prefix_trie(trie.share_heads(arrays))


QUERIES = {f.__name__: f for f in (op1_exact_topk, op2_sharding, op3_token_counts, op4_minhash, op5_media_columns, op6_byte_bpe, op7_language_id, op8_quality, op9_packing, op10_license_scans, op11_hard_negatives, op12_suffix_dedup, op13_prefix_trie, media_pages)}
ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score WHERE p.place <= 5)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op12_suffix_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT r, i, hash(substring(h, 2 * i + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
        m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1),
        g AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM m),
        s AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM g) GROUP BY r, run),
        p AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM s),
        t AS (SELECT d.r, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substring(any_value(h), 2 * max(b) + 1) AS kept FROM p JOIN d USING (r) GROUP BY d.r)
        SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN t USING (r)""",
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS units FROM t GROUP BY conv_id),
        h AS (SELECT conv_id, units, conv_id - conv_id % 5 AS base, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substring(conv_id::VARCHAR, i, 1))::BIGINT)),
            lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h FROM c),
        r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(b.units, 1, h.h), []), list_slice(h.units, h.h + 1, len(h.units))) AS units FROM h LEFT JOIN c b ON b.conv_id = h.base),
        p AS (SELECT conv_id, len(units) AS size, d AS depth, list_slice(units, 1, d) AS path FROM r, unnest(range(0, len(units) + 1)) u(d)),
        n AS MATERIALIZED (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256,
                CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(path[depth].text) END AS own
            FROM p GROUP BY path, depth),
        k AS MATERIALIZED (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        s AS (SELECT list_slice(n.path, 1, a) AS path, sum(own) AS saved, count(*) FILTER (WHERE k.path IS NULL) AS leaves FROM n LEFT JOIN k ON k.path = n.path, unnest(range(0, n.depth + 1)) u(a) GROUP BY 1)
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM n LEFT JOIN n up ON n.depth > 0 AND up.depth = n.depth - 1 AND up.path = list_slice(n.path, 1, n.depth - 1) LEFT JOIN k ON k.path = n.path JOIN s ON s.path = n.path""",
    "media_pages": r"""
        WITH b AS (SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)</head>(.*)', 1), '(?s)<nav>.*?</nav>|<!--.*?-->', '', 'g') AS h FROM pages),
        s AS (SELECT page_id, url, regexp_replace(h, '</article>', chr(1) || '</article>') AS h FROM b),
        t AS (SELECT page_id, url, list_transform(regexp_split_to_array(h, '</?(?:p|div|article|section|h1|h2|h3|li|ul|br|footer|header|table|tr|td)(?:\s[^>]*)?>|\x01'),
            lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS texts,
            len(list_filter(regexp_split_to_array(split_part(h, chr(1), 1), '</?(?:p|div|article|section|h1|h2|h3|li|ul|br|footer|header|table|tr|td)(?:\s[^>]*)?>'), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) <> '')) AS before FROM s),
        f AS (SELECT page_id, url, before, list_filter(texts, lambda x: x <> '') AS texts, encode(url) || unhex(repeat('00', (64 * greatest(ceil(strlen(url) / 64.0), 1) - strlen(url))::INT)) AS payload FROM t)
        SELECT page_id, len(texts) + 1 AS n_items, before AS media_pos, page_id::VARCHAR AS caption, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256, md5(array_to_string(texts, '|')) AS texts_md5 FROM f""",
    "op4_minhash": r"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(x) AS h FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS x FROM d)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
        e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
        m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id, least(d.doc_id, coalesce(m.c, d.doc_id)) = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
}
