"""Reports over HTTP as a Python data source, for clusters with a network."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortloom.sources.readers import REPORT_COLUMNS


T = TypeVar("T")
#: Seconds before each new try, and before those beyond the schedule.
SCHEDULE, FALLBACK = (1.0, 5.0, 15.0), 30.0


def with_retries(fetch: Callable[[], T], retries: int = 3, schedule: tuple[float, ...] = SCHEDULE, sleep: Callable[[float], None] = time.sleep) -> T:
    """What ``fetch`` gives, tried again after an error of the network at most ``retries`` times; the last error is raised."""
    for n in range(retries + 1):
        try:
            return fetch()
        except OSError:
            if n == retries:
                raise
            sleep(schedule[n] if n < len(schedule) else FALLBACK)
    raise AssertionError("unreachable")


class ReportReader(DataSourceReader):
    """One partition per accession; each asks the service for its rows, again if the network fails (option ``retries``)."""

    def __init__(self, options: dict) -> None:
        self.url = options["url"]
        self.retries = int(options.get("retries", 3))
        self.accessions = [a for a in options.get("accessions", "").split(",") if a]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(a) for a in self.accessions] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        query = urllib.parse.urlencode({"accession": partition.value, "result": "read_run", "format": "json", "fields": ",".join(REPORT_COLUMNS)})

        def fetch() -> list[dict]:
            with urllib.request.urlopen(f"{self.url}?{query}", timeout=60) as reply:
                return json.load(reply)

        for row in with_retries(fetch, self.retries):
            yield tuple(None if row.get(c) is None else str(row[c]) for c in REPORT_COLUMNS)


class ReportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_reports"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in REPORT_COLUMNS)

    def reader(self, schema) -> DataSourceReader:
        return ReportReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("run_reports")`` known."""
    spark.dataSource.register(ReportSource)
