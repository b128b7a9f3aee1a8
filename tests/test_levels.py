"""The levelled change log: few runs for many batches, the same table after every compaction, broken runs ignored."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom.session import work_path
from tagloom.streaming.levels import ChangeLog, Run
from tagloom.streaming.upsert import ARRIVAL, merge_log

SCHEMA = "id long, a string, b long"


def write_batch(spark, log, number, rows):
    batch = spark.createDataFrame(rows, SCHEMA).coalesce(1).withColumn(ARRIVAL, F.monotonically_increasing_id())
    batch.write.mode("overwrite").parquet(f"{log}/batch_id={number}")


def plain(base, batches, mode):
    table = {r[0]: list(r) for r in base}
    for rows in batches:
        for row in rows:
            old = table.get(row[0], [row[0], None, None])
            table[row[0]] = list(row) if mode == "replace" else [new if new is not None else was for new, was in zip(row, old)]
    return sorted(map(tuple, table.values()))


def seen(df):
    return sorted(map(tuple, df.select("id", "a", "b").collect()))


@pytest.mark.parametrize("mode", ["update", "replace"])
def test_levels_make_the_same_table(spark, mode):
    pick = random.Random(4)
    base = [(i, f"base{i}", i) for i in range(0, 20, 2)]
    batches = [[(pick.randrange(20), pick.choice([None, f"v{n}"]), pick.choice([None, n])) for _ in range(6)] for n in range(11)]
    stored = spark.createDataFrame(base, SCHEMA)
    log = ChangeLog(spark, work_path(spark, "log"), work_path(spark, "runs"), stored.schema, ["id"], mode=mode)
    assert seen(log.merge(stored)) == sorted(base) and log.compact(3) == []
    for n, rows in enumerate(batches):
        write_batch(spark, log.log, n, rows)
        if n % 5 == 4:
            log.compact(3)
    log.compact(3)
    held = log.held()
    assert held == [Run(0, 8, 2), Run(9, 9, 0), Run(10, 10, 0)]
    wanted = plain(base, batches, mode)
    assert seen(log.merge(stored)) == wanted
    assert seen(merge_log(stored, spark.read.parquet(log.log), ["id"], mode=mode)) == wanted
    assert len(log.vacuum()) == 9 + 3 and log.held() == held and seen(log.merge(stored)) == wanted
    assert log.read().where("batch_id = 8").groupBy("id").count().where("count > 1").isEmpty()


def test_a_broken_run_is_written_again_and_the_newest_batch_stays(spark):
    stored = spark.createDataFrame([], SCHEMA)
    log = ChangeLog(spark, work_path(spark, "log"), work_path(spark, "runs"), stored.schema, ["id"])
    for n in range(3):
        write_batch(spark, log.log, n, [(1, f"v{n}", None), (n, None, n)])
    assert log.compact(2) == [Run(0, 1, 1)]
    Path(f"{log.runs.removeprefix('file:')}/0-1-1/_SUCCESS").unlink()
    assert log.held() == [Run(0, 0, 0), Run(1, 1, 0), Run(2, 2, 0)]
    assert log.compact(2) == [Run(0, 1, 1)] and log.held() == [Run(0, 1, 1), Run(2, 2, 0)]
    write_batch(spark, log.log, 2, [(1, "again", None)])
    assert seen(log.merge(stored)) == [(0, None, 0), (1, "again", 1)]
    with pytest.raises(ValueError):
        log.compact(1)
