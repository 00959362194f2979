"""Readers of manifests and their relatives. Every reader returns a DataFrame and reads lazily; order is an explicit column where lines matter."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "audio_filepath string, text string, duration double"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file and pos (their order in the file: rising, not without gaps)."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"), "value")


def read_manifest(spark: SparkSession, path: str, on_error: str = "skip", schema: str = MANIFEST) -> DataFrame:
    """Newline-delimited JSON. on_error: skip bad lines, keep (nulls and the line in _bad), route (as keep, with bad lines alone kept apart by _bad), fail."""
    if on_error == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if on_error == "skip":
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)


def read_json_values(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one array of objects, or one object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_keyed(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Files that hold one object of key to record: key and the record's columns."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,struct<{record}>>")).alias("key", "record")).select("key", "record.*")


def read_any_encoding(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files that are UTF-8, or else Latin-1: file, pos, value."""
    data = spark.read.format("binaryFile").load(path)
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    return data.select(F.col("path").alias("file"), F.posexplode(F.split(text, r"\r?\n")).alias("pos", "value"))


def read_table(spark: SparkSession, path: str, sep: str = "\t", strict: bool = True, schema: str | None = None) -> DataFrame:
    """Delimited text with a header; malformed rows fail, or are dropped if not strict."""
    reader = spark.read.option("sep", sep).option("header", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_csv_folder(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """All CSV files of a folder, with headers; an error if it has none."""
    if spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(path).select("path").isEmpty():
        raise FileNotFoundError(f"no CSV files in {path}")
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", "*.[cC][sS][vV]").csv(path)


def split_pair(lines: DataFrame, separator: str = r" \| ", names: tuple[str, str] = ("audio_filepath", "text"), trim: bool = False, exact: bool = False, header: bool = False) -> DataFrame:
    """Lines of two parts, split once (with exact, lines of exactly two parts only); lines without the separator are left out."""
    parts = F.split("value", separator, -1 if exact else 2)
    rows = lines.withColumn("_parts", parts).where(F.size("_parts") == 2)
    if header:
        rows = rows.join(rows.groupBy("file").agg(F.min("pos").alias("_first")), "file").where("pos <> _first")
    a, b = F.col("_parts")[0], F.col("_parts")[1]
    return rows.select("file", "pos", *[(F.trim(x) if trim else x).alias(n) for x, n in zip((a, b), names)])


def last_of_key(rows: DataFrame, key: str, value: str, order: str = "pos") -> DataFrame:
    """One row per key with its last value."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def id_text(lines: DataFrame, separator: str = r"\s+") -> DataFrame:
    """id and text of lines 'id text'; a line of an id alone has no text, and the last of equal ids wins."""
    parts = F.split(F.trim("value"), separator, 2)
    rows = lines.where(F.trim("value") != "").select("pos", parts[0].alias("id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("text"))
    return last_of_key(rows, "id", "text")


def read_speech_list(spark: SparkSession, scp: str, transcripts: str, speakers: str) -> DataFrame:
    """Three tab-separated files to utterances: id, path, speaker, text, gender, age; missing parts are ''."""
    def table(path, names, fewest):
        rows = spark.read.text(path).withColumn("p", F.split("value", "\t")).where(F.size("p") >= fewest)
        return rows.select(*[F.trim(F.col("p")[i]).alias(n) for i, n in enumerate(names)])

    files = table(scp, ["id", "path"], 2)
    said = table(transcripts, ["id", "speaker", "text"], 3).where("id <> 'UtteranceID'").dropDuplicates(["id"])
    who = table(speakers, ["speaker", "age", "gender"], 3).where("speaker <> 'SPKID'").dropDuplicates(["speaker"])
    out = files.join(said, "id", "left").join(who, "speaker", "left")
    return out.select("id", "path", *[F.coalesce(c, F.lit("")).alias(c) for c in ("speaker", "text", "age", "gender")])


def read_text_files(spark: SparkSession, path: str, first_line: bool = False) -> DataFrame:
    """file and text of one-transcript files: the whole, or the first line alone."""
    rows = spark.read.text(path, wholetext=True)
    text = F.split_part("value", F.lit("\n"), F.lit(1)) if first_line else F.col("value")
    return rows.select(F.col("_metadata.file_path").alias("file"), F.trim(text).alias("text"))


def read_verbatim(spark: SparkSession, path: str) -> DataFrame:
    """Nested files {state, gender, age_group, task_name, verbatim: [{start, end, text}]} to one row per span, pos from 0."""
    schema = "state string, gender string, age_group string, task_name string, verbatim array<struct<start:double,end:double,text:string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select("state", "gender", "age_group", "task_name", F.posexplode("verbatim").alias("pos", "v")).select("state", "gender", "age_group", "task_name", "pos", "v.*")


def list_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("wav", "mp3", "flac", "ogg", "m4a"), recursive: bool = True) -> DataFrame:
    """path and length of files with one of the extensions, in any case; contents are not read. Object stores work by their Hadoop scheme."""
    any_case = ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions)
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{any_case}}}").option("recursiveFileLookup", recursive).load(path).select("path", "length")


def match_sidecars(media: DataFrame, sidecars: DataFrame, key: str = "stem", candidate: str = "name", languages: tuple[str, ...] = ("en",)) -> DataFrame:
    """The best side file of each media stem: the same name, spaces as _, then a language suffix. Three equi-joins, no theta join."""
    forms = [F.col(key), F.replace(F.col(key), F.lit(" "), F.lit("_")), *[F.concat(F.col(key), F.lit("." + x)) for x in languages]]
    ranked = media.select(F.col(key), F.posexplode(F.array(*forms)).alias("priority", candidate))
    best = ranked.join(sidecars.select(candidate).distinct(), candidate).groupBy(key).agg(F.min_by(candidate, "priority").alias(candidate))
    return media.join(best, key, "left")


def first_media(files: DataFrame, folder: str = "folder", name: str = "name") -> DataFrame:
    """One file of each folder: mp4 first, then by name."""
    order = Window.partitionBy(folder).orderBy(F.lower(name).endswith(".mp4").desc(), name)
    return files.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def valid_json_preview(lines: DataFrame, n: int) -> DataFrame:
    """The first n lines and whether each is JSON."""
    return lines.orderBy("file", "pos").limit(n).select("pos", "value", F.try_parse_json("value").isNotNull().alias("valid"))


def describe(df: DataFrame) -> DataFrame:
    """One row per column: name, type, number of values that aren't null, number of rows."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"c{i}").alias("values"), F.col("_n").alias("rows")) for i, (c, t) in enumerate(df.dtypes)]
    return counted.select(F.inline(F.array(*items)))


def scan_examples(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns that exist; nothing else is read."""
    return df.select(*[c for c in columns if c in df.columns])


@dataclass(frozen=True)
class DomainConfig:
    """Settings of one domain, with the defaults of long recordings."""

    domain: str = "generic"
    language: str = "en"
    chunk_seconds: float = 30.0
    overlap_seconds: float = 10.0
    least_chunk: float = 1.0
    least_segment: float = 1.5
    entity_types: tuple[str, ...] = ()
    intents: tuple[str, ...] = ()
    features: dict = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, values: dict) -> DomainConfig:
        """From a parsed configuration file; unknown keys are kept in features."""
        flat = dict(values) | dict(values.get("processing") or {})
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in flat.items() if k in cls.__dataclass_fields__ and v is not None}
        return cls(**{**own, "features": {k: v for k, v in values.items() if k not in cls.__dataclass_fields__}})


def polymorphic_text(value: Column) -> Column:
    """struct(text, error) of a JSON line: text as a string, or an object with sentence, text or annotated_text; the reason if there is none."""
    from voxloom.operators.repair import parsed

    v = parsed(value)
    get = lambda path: F.try_variant_get(v, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(v, "$.text", "variant"))
    text = F.when(kind == "STRING", get("$.text")).when(kind.startswith("OBJECT"), F.coalesce(get("$.text.sentence"), get("$.text.text"), get("$.annotated_text"), get("$.text.annotated_text"), get("$.text.annotated_sentence")))
    error = (F.when(v.isNull(), "JSONDecodeError").when(get("$.audio_filepath").isNull(), "KeyError: audio_filepath").when(F.coalesce(kind, F.lit("VOID")) == "VOID", "KeyError: text").when(text.isNull(), F.concat(F.lit("ValueError: text is "), kind)))
    return F.struct(F.when(error.isNull(), text).alias("text"), error.alias("error"))
