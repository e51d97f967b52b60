"""Run log: runs and their events as two tables that are only appended to."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, pipeline_name string, options string, started_at timestamp"
EVENTS = "event_id string, run_id string, ts timestamp, level string, status string, message string, extra string"
#: Words of option names whose values are not written.
SECRET = ("password", "secret", "token", "url", "key")


class RunLog:
    """Writes the events of runs below a folder; each call appends one row."""

    def __init__(self, spark: SparkSession, root: str, clock=lambda: datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock

    def _append(self, table: str, row: tuple, schema: str) -> None:
        self.spark.createDataFrame([row], schema).write.mode("append").parquet(f"{self.root}/{table}")

    def start(self, pipeline: str, options: Mapping[str, object] | None = None) -> str:
        """A new run; options without secrets are kept as JSON."""
        run, now = uuid.uuid4().hex, self.clock()
        plain = {k: ("***" if any(w in k.lower() for w in SECRET) else v) for k, v in (options or {}).items()}
        self._append("runs", (run, pipeline, json.dumps(plain, default=str), now), RUNS)
        self.event(run, "INFO", "started", "run started")
        return run

    def event(self, run: str, level: str, status: str, message: str, **extra) -> None:
        if level not in ("INFO", "WARNING", "ERROR"):
            raise ValueError(f"unknown level {level}")
        text = json.dumps(extra, default=str) if extra else None
        self._append("events", (uuid.uuid4().hex, run, self.clock(), level, status, message, text), EVENTS)

    def finish(self, run: str, error: str | None = None) -> None:
        """Success, or failure with its message; the duration in seconds is part of the event."""
        started = self.runs().filter(F.col("run_id") == run).first()
        if started is None:
            raise ValueError(f"unknown run {run}")
        seconds = (self.clock() - started["started_at"]).total_seconds()
        self.event(run, "ERROR" if error else "INFO", "failed" if error else "success", error or "run finished", duration_seconds=seconds)

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.root}/runs")

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(f"{self.root}/events")
