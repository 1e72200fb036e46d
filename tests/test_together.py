import threading
import time

import pytest
from pyspark.sql import functions as F

from pitchvault.sources.tables import export_marts
from pitchvault.sources.together import together


def slow(spark, seconds=1.5):
    nap = F.udf(lambda x: time.sleep(seconds) or x, "long")
    return spark.range(0, 1, 1, 1).select(nap("id").alias("id"))


def test_jobs_overlap_and_inherit(spark):
    most, stop = [0], threading.Event()

    def watch():
        while not stop.is_set():
            most[0] = max(most[0], len(spark.sparkContext.statusTracker().getActiveJobsIds()))
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    spark.sparkContext.setLocalProperty("told", "x")
    jobs = {f"j{i}": lambda i=i: (i, slow(spark).count(), spark.sparkContext.getLocalProperty("told"), spark.sparkContext.getLocalProperty("spark.scheduler.pool")) for i in range(4)}
    try:
        out = together(spark, jobs)
    finally:
        stop.set()
        watcher.join()
        spark.sparkContext.setLocalProperty("told", None)
    assert out == {f"j{i}": (i, 1, "x", f"j{i}") for i in range(4)} and list(out) == list(jobs)
    assert most[0] >= 2
    assert together(spark, {}) == {}


def test_one_failure_stops_the_rest(spark):
    begun, start = [], time.time()

    def job(name):
        begun.append(name)
        if name == "bad":
            raise KeyError("this one")
        return slow(spark, 30).count()

    with pytest.raises(KeyError, match="this one"):
        together(spark, {n: lambda n=n: job(n) for n in ("long", "bad", "later")}, at_once=2)
    assert time.time() - start < 25
    assert spark.range(3).count() == 3 and not spark.getTags()


def test_marts_are_exported_together(spark, tmp_path):
    marts = {f"m{i}": spark.range(i) for i in range(5)}
    assert export_marts(marts, str(tmp_path)) == 10
    assert [spark.read.parquet(str(tmp_path / f"m{i}")).count() for i in range(5)] == list(range(5))
    assert export_marts({}, str(tmp_path)) == 0
