"""Shuffle files of steps that are over are deleted before the job ends."""

import time

from licita.llm import phrases
from licita.session import free_shuffles


def test_plans_that_nobody_holds_lose_their_shuffle_files(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    count = lambda: tracker.shuffleStatuses().size()
    free_shuffles(spark)
    time.sleep(2)
    before = count()
    spark.range(1000).repartition(7).groupBy("id").count().write.format("noop").mode("overwrite").save()
    assert count() > before
    free_shuffles(spark)
    for _ in range(20):
        if count() <= before:
            return
        time.sleep(0.5)
    raise AssertionError(f"{count()} shuffles are left of {before}")


def test_each_step_of_the_scans_frees_its_own(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(phrases, "free_shuffles", lambda s: calls.append(1))
    docs = spark.createDataFrame([("a b c. a b c", "en")] * 4, "text string, lang string")
    found, _ = phrases.frequent_phrases(docs, least=4, shards=2)
    assert found.count() == 6 and len(calls) >= 3
