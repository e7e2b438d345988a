"""What a replay leaves on disk beside its version."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

from fxtape.shared import shared_root
from registry import commits


def test_a_replay_keeps_one_compressed_capture(spark, tmp_path):
    start = datetime(2024, 1, 3, 10)
    rows = [(i, start + timedelta(minutes=7 * i), i, ("view", "click")[i % 2], 1.5 + i) for i in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").coalesce(1).write.parquet(
        str(tmp_path / "events.parquet")
    )
    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    assert commits.replay_publish(spark, str(tmp_path)).count() == 60
    made = {p.name.rsplit("-", 1)[0]: p for p in set(root.iterdir()) - before}
    run = next(p for p in made["replay"].iterdir() if p.name.startswith("run_id="))
    raw = list((run / "raw").glob("batch_id=*/part-*"))
    assert raw and all(p.name.endswith(".json.gz") for p in raw)
    assert not list((run / "decoded").glob("batch_id=*"))
    # The comparisons read a stored relation of the compared fields, and no message beside them.
    assert {"captured", "stored"} <= set(made)
    assert "value_base64" not in spark.read.parquet(str(made["captured"])).columns
