import datetime as dt
import json

import pytest

from tidemark.operators import runlog, spatial

RING = "polygon long, name string, ring array<struct<x: double, y: double>>"


def box(key, name, west, east, south, north):
    return key, name, [(west, south), (east, south), (east, north), (west, north), (west, south)]


LAND = [
    box(1, "North", 172.0, 174.0, -43.0, -41.0),
    box(2, "South", 168.0, 169.0, -46.0, -45.0),
    box(3, "East", 174.2, 175.0, -42.0, -41.0),
    box(4, "Near islet", 174.0, 174.1, -41.0, -40.9),
    box(5, "Far islet", 178.0, 178.2, -44.0, -43.9),
    box(6, "Snares rock", 173.9, 174.0, -40.95, -40.9),
    box(7, "Elsewhere", 10.0, 20.0, 40.0, 50.0),
]


def test_load_mainland(spark):
    land = spark.createDataFrame(LAND, RING)
    extent = (160.0, 180.0, -50.0, -30.0)
    got = spatial.load_mainland(land, extent, ["name"], ["snares"])
    assert sorted(r.polygon for r in got.collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="meet the extent"):
        spatial.load_mainland(land, (100.0, 110.0, 0.0, 5.0), ["name"], ["snares"])
    with pytest.raises(ValueError, match="fewer than 3"):
        spatial.load_mainland(land, (5.0, 25.0, 35.0, 55.0), ["name"], ["snares"])
    with pytest.raises(ValueError, match="extent is empty"):
        spatial.load_mainland(land, (180.0, 160.0, -50.0, -30.0), ["name"], ["snares"])


def test_run_log(spark, tmp_path):
    times = iter(dt.datetime(2020, 1, 1, 0, 0, s) for s in range(60))
    log = runlog.RunLog(spark, str(tmp_path), clock=lambda: next(times))
    good = log.start("daily", {"region": "x", "db_password": "p", "API_KEY": "k"})
    log.event(good, "INFO", "step", "rows written", rows=12)
    bad = log.start("daily")
    log.finish(good)
    log.finish(bad, error="no input")

    options = {r.run_id: json.loads(r.options) for r in log.runs().collect()}
    assert options == {good: {"region": "x", "db_password": "***", "API_KEY": "***"}, bad: {}}
    events = [(r.run_id, r.level, r.status, json.loads(r.extra) if r.extra else None) for r in log.events().orderBy("ts").collect()]
    assert events == [
        (good, "INFO", "started", None),
        (good, "INFO", "step", {"rows": 12}),
        (bad, "INFO", "started", None),
        (good, "INFO", "success", {"duration_seconds": 5.0}),
        (bad, "ERROR", "failed", {"duration_seconds": 4.0}),
    ]
    with pytest.raises(ValueError, match="unknown level"):
        log.event(good, "LOUD", "step", "x")
    with pytest.raises(ValueError, match="unknown run"):
        log.finish("none")
