"""Streaming landing ingest: new files only, idempotent epochs, same result as batch runs."""

from __future__ import annotations

import json

from airshed.plans import lakehouse as L
from airshed.streaming import landing_stream

from .conftest import revised_responses, sample_responses


def _land(root: str, name: str, responses, run_id: str, ingested: str):
    folder = L.at(root, "landing")
    import os

    os.makedirs(folder, exist_ok=True)
    recs = [{"run_id": run_id, "ingested_at": ingested, "source": "test", "city_id": c, "window_start": "2026-09-01",
             "window_end": "2026-09-03", "payload": json.dumps(r)} for c, r in zip(["BLR", "DEL"], responses)]
    with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs) + "\n")


def test_stream_processes_new_files_once(spark, tmp_path, dim):
    root = str(tmp_path / "lake")
    log: list = []
    _land(root, "a.jsonl", sample_responses(), "run-1", "2026-09-05T00:00:00+00:00")
    q = landing_stream.start(spark, root, dim, log=log)
    q.awaitTermination(300)
    assert [(e["inserted"], e["updated"]) for e in log] == [(144, 0)]
    assert spark.read.parquet(L.at(root, "gold")).count() == 8
    # nothing new: the next trigger finds no files
    q = landing_stream.start(spark, root, dim, log=log)
    q.awaitTermination(300)
    assert len(log) == 1
    # a revision lands: 24 hours of one site change
    _land(root, "b.jsonl", revised_responses(), "run-2", "2026-09-06T00:00:00+00:00")
    q = landing_stream.start(spark, root, dim, log=log)
    q.awaitTermination(300)
    assert (log[-1]["inserted"], log[-1]["updated"]) == (0, 24)
    assert spark.read.parquet(L.at(root, "bronze")).count() == 4
    assert spark.read.parquet(L.at(root, "silver")).count() == 144
    assert spark.read.parquet(L.at(root, "gold")).count() == 8


def test_replayed_epoch_changes_nothing(spark, tmp_path, dim):
    root = str(tmp_path / "lake")
    _land(root, "a.jsonl", sample_responses(), "run-1", "2026-09-05T00:00:00+00:00")
    batch = landing_stream.landing.read_landing(spark, L.at(root, "landing"))
    first = landing_stream.apply_batch(spark, root, dim, batch, 0)
    again = landing_stream.apply_batch(spark, root, dim, batch, 0)
    assert (first["inserted"], again["inserted"], again["updated"]) == (144, 0, 0)
    assert spark.read.parquet(L.at(root, "bronze")).count() == 2


def test_an_epoch_that_lost_its_publish_is_finished_by_its_replay(spark, tmp_path, dim):
    from unittest import mock

    import pytest

    from airshed.operators.daily import GOLD_COLUMNS, daily_aqi

    root = str(tmp_path / "lake")
    _land(root, "a.jsonl", sample_responses(), "run-1", "2026-09-05T00:00:00+00:00")
    landing_stream.apply_batch(spark, root, dim, landing_stream.landing.read_landing(spark, L.at(root, "landing")), 0)
    _land(root, "b.jsonl", revised_responses(), "run-2", "2026-09-06T00:00:00+00:00")
    batch = landing_stream.landing.read_landing(spark, f"{L.at(root, 'landing')}/b.jsonl")
    with mock.patch.object(L, "write_days", side_effect=ConnectionError("lost")), pytest.raises(ConnectionError):
        landing_stream.apply_batch(spark, root, dim, batch, 1)
    replay = landing_stream.apply_batch(spark, root, dim, batch, 1)
    assert (replay["inserted"], replay["updated"]) == (0, 0) and replay["gold_rows"] > 0
    show = lambda df: sorted(tuple(r) for r in df.select(*GOLD_COLUMNS).collect())
    assert show(spark.read.parquet(L.at(root, "gold"))) == show(daily_aqi(spark.read.parquet(L.at(root, "silver")), audit=False))
