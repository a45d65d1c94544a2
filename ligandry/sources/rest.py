"""A paged REST endpoint as a Python data source: one polite reader that keeps the rate limit and retries server errors."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import StructType

PAGE, DELAY_S, RETRIES, WAIT_S = 1_000, 1.1, 3, 5.0


def get_json(url: str, retries: int = RETRIES, wait: float = WAIT_S) -> dict:
    for attempt in range(retries):
        try:
            with urllib.request.urlopen(url, timeout=60) as answer:  # noqa: S310
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code != 500 or attempt == retries - 1:
                raise
            time.sleep(wait)
    raise RuntimeError("no attempt was made")


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema = options, schema

    def read(self, partition) -> Iterator[tuple]:
        o = self.options
        page, wanted = min(int(o.get("page", PAGE)), PAGE), int(o["n"]) if o.get("n") else None
        delay, given, at = float(o.get("delay", DELAY_S)), 0, 0
        extra = dict(urllib.parse.parse_qsl(o.get("query", "")))
        while wanted is None or given < wanted:
            url = f"{o['url']}?{urllib.parse.urlencode(extra | {'limit': page, 'offset': at})}"
            answer = get_json(url, int(o.get("retries", RETRIES)), float(o.get("wait", WAIT_S)))
            rows = answer[o["key"]]
            for r in rows[: None if wanted is None else wanted - given]:
                yield tuple(None if r.get(f.name) is None else str(r[f.name]) for f in self.schema.fields)
                given += 1
            at += len(rows)
            if len(rows) < page or at >= answer.get("page_meta", {}).get("total_count", float("inf")):
                return
            time.sleep(delay)


class RestSource(DataSource):
    """Options: url, key (of the list in an answer), query, n, page, delay, retries, wait. Values come as strings."""

    @classmethod
    def name(cls) -> str:
        return "pagedrest"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def read_pages(spark: SparkSession, url: str, key: str, columns: list[str], n: int | None = None, **options) -> DataFrame:
    spark.dataSource.register(RestSource)
    given = {"url": url, "key": key, "columns": ", ".join(f"`{c}` string" for c in columns)} | ({"n": str(n)} if n else {})
    return spark.read.format("pagedrest").options(**given, **{k: str(v) for k, v in options.items()}).load()
