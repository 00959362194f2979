"""Paths, object URIs and file names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Media types by extension (fixed values).
MIME = {"wav": "audio/wav", "mp3": "audio/mpeg", "flac": "audio/flac", "ogg": "audio/ogg", "m4a": "audio/mp4", "opus": "audio/opus", "webm": "audio/webm", "mp4": "video/mp4"}


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def stem(c: Column) -> Column:
    """The file name without its last extension; a leading dot starts none."""
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", "")


def dirname(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"^(.*)/[^/]*$", 1), r"(?<=.)/+$", "")


def extension(c: Column) -> Column:
    return F.lower(F.regexp_extract(basename(c), r".\.([^.]*)$", 1))


def join_path(base: Column | str, c: Column) -> Column:
    """base/c, or c if it is absolute."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(c.startswith("/"), c).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), c))


def relative_to(c: Column, prefix: str) -> Column:
    """c without a prefix that it begins with."""
    at = prefix.rstrip("/") + "/"
    return F.when(c.startswith(at), F.substr(c, F.lit(len(at) + 1))).otherwise(c)


def drop_segment(c: Column, pattern: str) -> Column:
    """c without path segments that match a pattern."""
    return F.regexp_replace(c, rf"/(?:{pattern})(?=/)", "")


def mime_type(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension(c)), F.lit("application/octet-stream"))


def parse_object_uri(c: Column, scheme: str = "gs") -> Column:
    """struct(bucket, blob); null unless both are there."""
    part = lambda i: F.regexp_extract(c, rf"^{scheme}://([^/]+)/(.+)$", i)
    return F.when(part(2) != "", F.struct(part(1).alias("bucket"), part(2).alias("blob")))


def safe_title(c: Column, longest: int = 100) -> Column:
    """A title as a file name: reserved marks out, spaces to _, cut."""
    return F.substring(F.replace(F.regexp_replace(c, r'[\\/*?:"<>|]', ""), F.lit(" "), F.lit("_")), 1, longest)


def safe_name(c: Column, default: str = "audio_segments") -> Column:
    """Only ASCII letters, digits, - and _; the default if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(c, r"[^A-Za-z0-9_-]", ""), F.lit("")), F.lit(default))


def first_present(*columns: Column) -> Column:
    """The first column that is neither null nor ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
