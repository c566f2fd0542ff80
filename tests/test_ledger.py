"""Loads of one day at the same time, compaction of ledgers, and row groups that a lookup does not read."""

import json
import os
import pathlib
import subprocess
import sys
import tempfile

import pytest

from eventmill.errors import ConcurrentLoadError, MissingDayError
from eventmill.plans import load, pipeline
from eventmill.plans.load import load_days
from eventmill.sinks import ledger
from eventmill.sources import raw
from landed import DAY, NEXT, land, event, land_day


def ids(spark, table):
    return sorted(int(r.id) for r in spark.table(table).select("id").collect())


def test_a_load_that_is_overtaken_gives_way(spark, tmp_path, raw_table, prefix, monkeypatch):
    early, late = str(tmp_path / "early"), str(tmp_path / "late")
    land_day(early, DAY, start=1000)
    land_day(early, NEXT, start=2000)
    land_day(late, DAY, per_hour=3)
    load_days(spark, early, [DAY, NEXT], raw_table)
    marts = pipeline.refresh_models(spark, raw_table, prefix=prefix)
    stored, overtaken = load._stored, []

    def overtake(*args):
        if not overtaken:
            overtaken.append(True)
            load_days(spark, late, [DAY], raw_table)
        return stored(*args)

    monkeypatch.setattr(load, "_stored", overtake)
    with pytest.raises(ConcurrentLoadError, match=str(DAY)):
        load_days(spark, early, [DAY, NEXT], raw_table)
    assert ids(spark, raw_table) == sorted([*range(72), *range(2000, 2240)])
    folder = pathlib.Path(spark.sql(f"DESCRIBE TABLE EXTENDED {raw_table}").where("col_name = 'Location'").first().data_type.removeprefix("file:"))
    assert len({p.parts[len(folder.parts)] for p in folder.rglob("*.parquet")}) == 2  # of the first load and of the one that held
    # The marts follow what the table holds, and the load can be asked for again.
    marts = pipeline.refresh_models(spark, raw_table, prefix=prefix)
    assert marts["fct_events"].count() == 72 + 240
    load_days(spark, early, [DAY], raw_table)
    assert ids(spark, raw_table) == sorted([*range(1000, 1240), *range(2000, 2240)])


def test_of_two_claims_at_most_one_goes_on(spark, raw_table):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {raw_table.split('.')[0]}")
    first = ledger.last_entries(spark, raw_table, [DAY])
    second = ledger.last_entries(spark, raw_table, [DAY, NEXT])
    ledger.claim(spark, raw_table, [DAY], first)
    with pytest.raises(ConcurrentLoadError):
        ledger.claim(spark, raw_table, [DAY, NEXT], second)
    ledger.claim(spark, raw_table, [NEXT], ledger.last_entries(spark, raw_table, [NEXT]))


def test_ledgers_are_compacted(spark, raw_table, monkeypatch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {raw_table.split('.')[0]}")
    name = raw_table + ledger.LOADS_SUFFIX
    monkeypatch.setattr(ledger, "MOST_FILES", 4)
    monkeypatch.setattr(ledger, "GRACE_SECONDS", 0)
    for i in range(11):
        ledger.note_load(spark, raw_table, [DAY] if i % 2 else [DAY, NEXT])
        before = ledger.newest(spark, name)
        assert len(spark.table(name).inputFiles()) <= 6
    assert ledger.compact(spark, name, 0) > 1 and ledger.compact(spark, name, 0) == 0
    assert ledger.newest(spark, name) == before and spark.table(name).count() == 2
    monkeypatch.setattr(ledger, "GRACE_SECONDS", 3600)
    for _ in range(6):
        ledger.note_load(spark, raw_table, [DAY])
    assert len(spark.table(name).inputFiles()) == 7


def test_every_scan_asks_the_listing_for_missing_days(spark, scratch, monkeypatch):
    land(scratch, DAY, 1, [event(1)])
    os.makedirs(f"{scratch}/{NEXT:%Y/%m/%d}")
    for read in (raw.read_events, raw.read_light, raw.read_envelopes, raw.landed_size):
        with pytest.raises(MissingDayError, match=str(NEXT)):
            read(spark, scratch, [DAY, NEXT])
    assert raw.landed_size(spark, scratch, [DAY]).files == 1
    monkeypatch.setattr(raw, "_sizes", None)
    assert raw.read_events(spark, scratch, [DAY], listed=True).count() == 1


LOOKUP = """
import sys
from pyspark.sql import functions as F
from eventmill.session import build_session
from eventmill.sinks import tables
root = sys.argv[1]
spark = build_session("lookup", master="local[2]", **{"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": root,
    "spark.eventLog.compress": "false", "spark.sql.warehouse.dir": root + "/warehouse", "spark.hadoop.parquet.block.size": "65536", "spark.hadoop.parquet.filter.dictionary.enabled": "false"})
tables.ensure_database(spark, "m")
# Odd ids only, in no order: no minimum or maximum of a row group leaves an even one out.
rows = spark.range(0, 200_000, 1, 2).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) * 2 + 1).alias("repo_id"), F.lit("2024-01-10").cast("date").alias("event_date"))
tables.replace_table(rows, "m.fact", "event_date", lookups=["repo_id"])
found = spark.table("m.fact").where("repo_id = 1099511627776").count()
spark.conf.set("parquet.filter.bloom.enabled", "false")
also = spark.table("m.fact").where("repo_id = 1099511627776").count()
print("counts", found, also)
spark.stop()
"""


def test_a_lookup_skips_row_groups(scratch):
    """Rows that the two scans read, from the event log: nearly none with the Bloom filters, all without them."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    out = subprocess.run([sys.executable, "-c", LOOKUP, root], env=env, capture_output=True, text=True, timeout=300, check=True)
    assert "counts 0 0" in out.stdout
    names, scanned, logs = {}, [], [p for p in pathlib.Path(root).rglob("*") if p.is_file() and "warehouse" not in str(p)]

    def walk(node):
        if node["nodeName"].startswith("Scan parquet"):
            names.update((m["accumulatorId"], m["name"]) for m in node["metrics"] if m["name"] == "number of output rows")
        for child in node["children"]:
            walk(child)

    read = {}
    for line in (line for log in logs if not log.name.endswith(".crc") for line in log.read_text(errors="replace").splitlines() if line.startswith("{")):
        entry = json.loads(line)
        if "sparkPlanInfo" in entry:
            walk(entry["sparkPlanInfo"])
        if entry["Event"] == "SparkListenerTaskEnd":
            for a in entry["Task Info"]["Accumulables"]:
                read[a["ID"]] = max(read.get(a["ID"], 0), int(a["Value"])) if str(a.get("Value", "")).isdigit() else 0
    scanned = [read.get(i, 0) for i in sorted(names)]
    assert len(scanned) >= 2 and min(scanned) < 20_000 and max(scanned) == 200_000, scanned
