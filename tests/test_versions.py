"""Versioned tables: whole versions or none, merges by bucket, conflicts, repeats and what is left behind."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from catalume.operators.check import upsert_latest
from catalume.sources import versions
from catalume.sources.tables import CHECKS

KEYS = ("source_id", "item_id")


def checks(spark, ids, day, score=1):
    return spark.createDataFrame([("s", str(i), score) for i in ids], "source_id string, item_id string, intake_score int").withColumn("check_timestamp", F.lit(f"2001-01-{day:02}").cast("timestamp")).select("source_id", "item_id", "check_timestamp", "intake_score")


def keep(old, new):
    return versions.newest_row(old, new, KEYS, F.col("check_timestamp"), new.columns)


def found(df):
    return sorted(map(tuple, df.select("item_id", F.dayofmonth("check_timestamp"), "intake_score").collect()))


def files(path):
    return {f"{d}/{x}" for d, _, names in os.walk(f"{path}/data") for x in names if x.endswith(".parquet")}


def test_a_merge_equals_an_upsert_and_writes_what_it_touches(spark, tmp_path):
    path = f"{tmp_path}/t"
    old, new = checks(spark, range(500), 1), checks(spark, [3, 7, 900], 2, 5)
    versions.create(old, path, KEYS, 32)
    before = files(path)
    size = sum(map(os.path.getsize, before))
    v = versions.merge(spark, path, new, keep)
    written = files(path) - before
    assert (v.number, v.observed["n_buckets"]) == (1, 3) and len(written) == 3
    assert sum(map(os.path.getsize, written)) < size / 5
    assert found(versions.rows(spark, path)) == found(upsert_latest(new, old, KEYS)) == sorted([(str(i), 1, 1) for i in range(500) if i not in (3, 7)] + [(x, 2, 5) for x in ("3", "7", "900")])
    assert found(versions.rows(spark, path, 0)) == found(old)
    assert os.listdir(f"{path}/staged") == []


def test_a_write_that_dies_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.create(checks(spark, range(100), 1), path, KEYS, 8)
    half = lambda old, new: keep(old, new).withColumn("intake_score", F.when(F.pmod(F.xxhash64("item_id"), F.lit(8)) == 7, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("intake_score")))
    with pytest.raises(Exception, match="lost"):
        versions.merge(spark, path, checks(spark, range(100), 2), half)
    assert versions.numbers(spark, path) == [0] and found(versions.rows(spark, path)) == [(x, 1, 1) for x in sorted(map(str, range(100)))]
    folder = os.listdir(f"{path}/data")[0]
    shutil.copytree(f"{path}/data/{folder}", f"{path}/data/killed")  # what a driver that is killed leaves
    versions.merge(spark, path, checks(spark, range(50), 3), keep)
    assert versions.vacuum(spark, path, keep=1) >= 1 and "killed" not in os.listdir(f"{path}/data")
    assert versions.numbers(spark, path) == [1] and versions.rows(spark, path).where("dayofmonth(check_timestamp) = 3").count() == 50


def test_of_two_writers_one_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    v = versions.create(checks(spark, range(10), 1), path, KEYS, 4)
    with pytest.raises(versions.Conflict):
        versions.create(checks(spark, range(10), 1), path, KEYS, 4)

    def slow(old, new):
        versions.publish(spark, path, v._replace(number=1))
        return keep(old, new)

    with pytest.raises(versions.Conflict):
        versions.merge(spark, path, checks(spark, range(5), 2), slow)
    assert versions.numbers(spark, path) == [0, 1] and versions.rows(spark, path).count() == 10
    assert not [x for x in os.listdir(f"{path}/versions") if x.startswith(".0") and not x.endswith(".crc")]


def test_batches_of_a_stream_count_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.create(spark.createDataFrame([], CHECKS), path, KEYS, 4)
    assert versions.rows(spark, path).count() == 0
    add = lambda n, stream="a": versions.merge(spark, path, checks(spark, [n], 1 + n), keep, stream, n).number
    assert [add(0), add(1), add(1), add(0), add(0, "b")] == [1, 2, 2, 2, 3]
    assert versions.version(spark, path).batches == {"a": 1, "b": 0}


def test_later_checks_win_in_any_order_and_ties_go_to_the_batch(spark, tmp_path):
    for name, order in (("up", (1, 2, 3)), ("down", (3, 2, 1))):
        path = f"{tmp_path}/{name}"
        versions.create(checks(spark, range(3), 2, 7), path, KEYS, 2)
        for day in order:
            versions.merge(spark, path, checks(spark, [0, 1], day, day), keep)
        assert found(versions.rows(spark, path)) == [("0", 3, 3), ("1", 3, 3), ("2", 2, 7)]


def test_rows_with_maps_are_merged(spark, tmp_path):
    rows = lambda n: spark.createDataFrame([("a", {"x": n}), ("b", None)], "item_id string, headers map<string,int>")
    versions.create(rows(1), f"{tmp_path}/t", ("item_id",), 2)
    versions.merge(spark, f"{tmp_path}/t", rows(2), lambda old, new: versions.newest_row(old, new, ("item_id",), F.lit(0), new.columns))
    assert sorted(map(repr, (x.headers for x in versions.rows(spark, f"{tmp_path}/t").collect()))) == ["None", "{'x': 2}"]
