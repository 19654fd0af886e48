import random
import time
from dataclasses import replace

import brute
import pytest
from test_apply import CURRENT, SCHEMA, VERSIONS, random_events

from changefold import apply_changes, read_current, track_current


def write(spark, root, events, files=4):
    for part in range(files):
        spark.createDataFrame(events[part::files], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/changes")


def stream(spark, root):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/changes")


def content(spark, spec, root, **options):
    rows = [tuple(r) for r in read_current(spark, spec, f"{root}/cp", **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_c1_t2_state_after_a_stop_a_restart_and_new_files(spark, tmp_path):
    root = str(tmp_path)
    events = random_events(1, 300, 25, 60, truncates=2)
    random.Random(2).shuffle(events)
    write(spark, root, events[:200] + events[:40])
    first = track_current(stream(spark, root), CURRENT, f"{root}/cp", available_now=False)
    while not first.lastProgress:
        time.sleep(0.1)
    first.stop()
    track_current(stream(spark, root), CURRENT, f"{root}/cp").awaitTermination()
    assert content(spark, CURRENT, root) == brute.current(events[:200])
    earlier = max(int(f.name) for f in (tmp_path / "cp" / "commits").glob("[0-9]*"))
    write(spark, root, events[200:], 2)
    track_current(stream(spark, root), CURRENT, f"{root}/cp").awaitTermination()
    assert content(spark, CURRENT, root) == brute.current(events)
    assert content(spark, CURRENT, root, batch_id=earlier) == brute.current(events[:200])
    # the last batch again, as after a crash between its work and its commit
    last = max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.with_name(f".{last.name}.crc").rename(tmp_path / "checksum_undone")
    last.rename(tmp_path / "commit_undone")
    track_current(stream(spark, root), CURRENT, f"{root}/cp").awaitTermination()
    assert content(spark, CURRENT, root) == brute.current(events)


def test_c11_two_keys_equal_the_batch_form(spark, tmp_path):
    root = str(tmp_path)
    events = random_events(4, 200, 10, 30, truncates=1)
    write(spark, root, events)
    spec = replace(CURRENT, keys=("k", "op2"))
    changes = stream(spark, root).selectExpr("*", "CASE WHEN op <> 't' THEN off % 2 END AS op2")
    track_current(changes, spec, f"{root}/cp").awaitTermination()
    batch = spark.read.schema(SCHEMA).parquet(f"{root}/changes").selectExpr("*", "CASE WHEN op <> 't' THEN off % 2 END AS op2")
    names = ("keys", "sequence_by", "tie_breaker", "delete_when", "truncate_when", "except_columns")
    expected = apply_changes(batch, **{n: getattr(spec, n) for n in names})
    assert content(spark, spec, root) == {tuple(r) for r in expected.collect()}


def test_a_history_is_refused(spark):
    with pytest.raises(ValueError):
        track_current(spark.createDataFrame([], SCHEMA), VERSIONS, "unused")
