"""The driver's tables as speech artefacts, in Spark and in DuckDB SQL alike.

documents are transcripts with tags, conversations are diarised turns, events are points in time, labels a lookup table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, audio_filepath, lang, duration and a text with an entity span before and metadata behind it."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "concat('audio/', source, '/', doc_id, '.wav') AS audio_filepath", "lang", "CAST(n_chars AS DOUBLE) / 15 AS duration",
        """concat(CASE doc_id % 3 WHEN 0 THEN 'ENTITY_CITY paris END ' WHEN 1 THEN 'ENTITY_PERSON_NAME Ana Roy END ' ELSE '' END,
            replace(text, chr(10), ' '), element_at(array(' AGE_0_18', ' AGE_18_30', ' AGE_30_45', ' AGE_60PLUS'), CAST(doc_id % 4 AS INT) + 1),
            element_at(array(' GER_MALE', ' GER_FEMALE', ' GER_OTHER'), CAST(doc_id % 3 AS INT) + 1),
            element_at(array(' EMOTION_NEU', ' EMOTION_HAP', ' EMOTION_SAD', ' EMOTION_ANG', ''), CAST(doc_id % 5 AS INT) + 1),
            CASE WHEN doc_id % 2 = 0 THEN ' INTENT_ASK' ELSE ' INTENT_INFORM' END) AS text""",
    )


TAGGED = """t AS (SELECT doc_id, 'audio/' || source || '/' || doc_id || '.wav' AS audio_filepath, lang, n_chars::DOUBLE / 15 AS duration,
    CASE doc_id % 3 WHEN 0 THEN 'ENTITY_CITY paris END ' WHEN 1 THEN 'ENTITY_PERSON_NAME Ana Roy END ' ELSE '' END || replace(text, chr(10), ' ')
    || [' AGE_0_18', ' AGE_18_30', ' AGE_30_45', ' AGE_60PLUS'][doc_id % 4 + 1] || [' GER_MALE', ' GER_FEMALE', ' GER_OTHER'][doc_id % 3 + 1]
    || [' EMOTION_NEU', ' EMOTION_HAP', ' EMOTION_SAD', ' EMOTION_ANG', ''][doc_id % 5 + 1] || CASE WHEN doc_id % 2 = 0 THEN ' INTENT_ASK' ELSE ' INTENT_INFORM' END AS text
    FROM documents)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and hypothesis tags: the hypothesis has another emotion for every fourth document, another intent for every seventh, and no span for every fifth."""
    return tagged(spark, sf_dir).select("doc_id", "lang", F.col("text").alias("ref"), F.expr(HYP_SPARK).alias("hyp"))


HYP_SPARK = """replace(replace(CASE WHEN doc_id % 5 = 0 THEN replace(replace(text, 'ENTITY_CITY paris END ', ''), 'ENTITY_PERSON_NAME Ana Roy END ', '') WHEN doc_id % 6 = 1 THEN replace(text, 'Ana Roy END', 'Ana END') ELSE text END,
    CASE WHEN doc_id % 4 = 0 THEN ' EMOTION_NEU' ELSE chr(1) END, ' EMOTION_HAP'), CASE WHEN doc_id % 7 = 0 THEN ' INTENT_ASK' ELSE chr(1) END, ' INTENT_INFORM')"""
PAIRS = TAGGED + f", p AS (SELECT doc_id, lang, text AS ref, {HYP_SPARK} AS hyp FROM t)"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, role, text, start, end of each turn in seconds."""
    return table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", "text", "CAST(10 * turn AS DOUBLE) AS start", "10 * turn + 10 + length(text) / 100D AS end")


TURNS = "u AS (SELECT conv_id, turn, role, text, (10 * turn)::DOUBLE AS start, 10 * turn + 10 + length(text) / 100::DOUBLE AS \"end\" FROM conversations)"


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of conversation turns as references, and a hypothesis without every seventh word and with every fifth changed: role, ref, hyp."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", "[.\n]")).alias("pos", "s"))
    words = F.filter(F.split("s", " "), lambda w: w != "")
    heard = F.filter(F.transform(words, lambda w, i: F.when(i % 7 == 6, "").when(i % 5 == 4, F.concat(F.lit("x"), w)).otherwise(w)), lambda w: w != "")
    return rows.select("conv_id", "turn", "pos", "role", F.array_join(words, " ").alias("ref"), F.array_join(heard, " ").alias("hyp"))


#: Words of a pair as single ASCII characters, since the distance there counts bytes: up to 94 different words.
UTTERANCES = """s AS (SELECT conv_id, turn, role, unnest(regexp_split_to_array(text, '[.\\n]')) AS s FROM conversations),
w AS (SELECT role, list_filter(string_split(s, ' '), lambda x: x <> '') AS r FROM s),
h AS (SELECT role, r, list_filter(list_transform(r, lambda x, i: CASE WHEN i % 7 = 0 THEN '' WHEN i % 5 = 0 THEN 'x' || x ELSE x END), lambda x: x <> '') AS h FROM w),
d AS (SELECT role, r, h, list_distinct(list_concat(r, h)) AS a FROM h),
e AS (SELECT role, len(r) AS units, len(h) AS heard, levenshtein(array_to_string(list_transform(r, lambda x: chr(32 + list_position(a, x)::INT)), ''), array_to_string(list_transform(h, lambda x: chr(32 + list_position(a, x)::INT)), '')) AS edits, array_to_string(r, ' ') AS ref FROM d)"""
