"""A paged search as a data source: newest first, so many a page, until a limit. The client is the caller's; the offline stand-in makes entries from the query."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "video_id string, title string, published_at string, duration string"


def offline_page(query: str, token: int, size: int) -> tuple[list[tuple], int | None]:
    """size entries from a token on, newest first, and the next token; a query has 120 entries."""
    rows = []
    for i in range(token, min(token + size, 120)):
        key = hashlib.sha1(f"{query}/{i}".encode()).hexdigest()
        rows.append((key[:11], f"{query} {i}", f"2024-{12 - i // 10:02d}-{28 - i % 10:02d}T00:00:00Z", f"PT{1 + i % 59}M"))
    return rows, token + size if token + size < 120 else None


def pages(query: str, most: int, fetch: Callable = offline_page, largest_page: int = 50):
    """Entries of all pages up to most."""
    token, left = 0, most
    while token is not None and left > 0:
        rows, token = fetch(query, token, min(largest_page, left))
        yield from rows[:left]
        left -= len(rows)
        if not rows:
            return


class _Query(InputPartition):
    def __init__(self, query: str):
        super().__init__(query)


class SearchReader(DataSourceReader):
    """One partition for each query of a ;-separated list."""

    def __init__(self, options):
        self.queries = [q.strip() for q in options.get("query", "").split(";") if q.strip()]
        self.most = int(options.get("max_results", "50"))

    def partitions(self):
        return [_Query(q) for q in self.queries]

    def read(self, partition):
        yield from pages(partition.value, self.most)


class SearchSource(DataSource):
    @classmethod
    def name(cls):
        return "media_search"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SearchReader(self.options)


def search(spark: SparkSession, queries: list[str], most: int = 50):
    spark.dataSource.register(SearchSource)
    return spark.read.format("media_search").option("query", ";".join(queries)).option("max_results", most).load()
