"""A stream merged by the batch rule."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallyspark.plans.layers import SourceSpec
from tallyspark.session import shared_dir
from tallyspark.sources import snapshots
from tallyspark.streaming import ingest, upsert

SPEC = SourceSpec(("order_id", "line"), ("price",))
SCHEMA = "`Order ID` bigint, Line int, Price double, Note string"


def rows_of(spark, root):
    return sorted(tuple(r) for r in upsert.current(spark, root, "lines").collect())


def test_late_and_cheaper_copies_win_whatever_their_batch(spark, tmp_path):
    landing, root = tmp_path / "landing", shared_dir(spark, "t-upsert")
    landing.mkdir()

    def land(name, *rows):
        (landing / name).write_text("".join(json.dumps(dict(zip(
            ("Order ID", "Line", "Price", "Note"), r, strict=True))) + "\n" for r in rows))

    def run():
        stream = ingest.read_files(spark, str(landing), SCHEMA, max_files_per_trigger=1)
        upsert.run_available(stream, upsert.upsert_batches(
            root, "lines", SPEC, F.floor(F.col("order_id") / 10).cast("long")), str(tmp_path / "checkpoint"))
        return rows_of(spark, root)

    land("1.json", (1, 1, 5.0, " a "), (1, 1, 7.0, "b"), (25, 1, 1.0, "far"))
    assert run() == [(1, 1, 5.0, "a"), (25, 1, 1.0, "far")]
    far = {f for p, f in snapshots.latest(spark, root).tables["lines"].folders.items() if p == "2"}
    land("2.json", (1, 1, 3.0, "cheaper"), (2, 1, 9.0, "new"))
    land("3.json", (1, 1, 4.0, "late"), (2, 1, 9.0, "even"))
    assert run() == [(1, 1, 3.0, "cheaper"), (2, 1, 9.0, "even"), (25, 1, 1.0, "far")]
    # the part without new rows was left as it was
    assert far == {f for p, f in snapshots.latest(spark, root).tables["lines"].folders.items() if p == "2"}
    assert run() == [(1, 1, 3.0, "cheaper"), (2, 1, 9.0, "even"), (25, 1, 1.0, "far")]


def test_a_replayed_batch_counts_once_and_a_failed_one_again(spark, monkeypatch):
    root = shared_dir(spark, "t-upsert")
    write = upsert.upsert_batches(root, "lines", SPEC, F.lit(0))
    batch = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    write(batch((1, 1, 5.0, "a")), 0)
    number = snapshots.latest(spark, root).number
    write(batch((1, 1, 5.0, "a")), 0)
    assert snapshots.latest(spark, root).number == number
    commit = snapshots.commit
    monkeypatch.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        write(batch((1, 1, 2.0, "b")), 1)
    assert rows_of(spark, root) == [(1, 1, 5.0, "a")]
    monkeypatch.setattr(snapshots, "commit", commit)
    write(batch((1, 1, 2.0, "b")), 1)
    assert rows_of(spark, root) == [(1, 1, 2.0, "b")]
    write(batch(), 2)
    with pytest.raises(ValueError, match="no part"):
        upsert.upsert_batches(root, "lines", SPEC, F.col("note"), "other")(batch((1, 2, 1.0, None)), 0)
