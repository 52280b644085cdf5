"""Timed state of cached uploads, replayed in batches, against the batch answer."""

import datetime as dt
import random
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from scriptorium.plans import model
from scriptorium.streaming import life

cloudpickle.register_pickle_by_value(sys.modules[__name__])
START = dt.datetime(2024, 1, 1)


def test_replayed_uploads(spark, tmp_path):
    rng = random.Random(4)
    hours = lambda h: START + dt.timedelta(hours=h)
    log = []
    for k in range(80):
        seen = k * 1.5 + rng.random()
        log.append((f"f{rng.randrange(30)}", hours(seen - rng.choice([0, 0, 1, 50, 47, 30])), hours(seen)))
    log += [("late", None, hours(121)), (None, hours(1), hours(121)), ("mid", hours(74.5), hours(121.2)), ("end", hours(121.5), hours(121.5))]
    log.sort(key=lambda r: r[2])
    schema = "hash string, uploaded_at timestamp, seen_at timestamp"
    source, out, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "out", "checkpoint"))

    def run(part):
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = life.cache_changes(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(300)
        assert query.exception() is None

    for at in range(0, len(log), 42):  # each call starts anew from the checkpoint
        run(log[at : at + 42])
    changes = spark.read.parquet(out)
    last = {r["key"]: r["state"] for r in changes.groupBy("key").agg(F.max_by("state", F.struct("uploaded_at", "since")).alias("state")).collect()}
    uploads = spark.createDataFrame(log, schema).where("hash IS NOT NULL AND uploaded_at IS NOT NULL").groupBy("hash").agg(F.max("uploaded_at").alias("u"))
    now = F.lit(max(r[2] for r in log)).cast("timestamp")
    want = {r["hash"]: r["s"] for r in uploads.select("hash", model.cache_state(now, F.col("u")).alias("s")).collect()}
    assert {k: (v, last.get(k)) for k, v in want.items() if last.get(k) != v} == {}
    assert last == want and set(want.values()) == {"fresh", "validate", "expired"}
    # each state of an upload is entered once, in order
    order = {"fresh": 0, "validate": 1, "expired": 2}
    for group in changes.groupBy("key", "uploaded_at").agg(F.collect_list(F.struct("since", "state")).alias("c")).collect():
        states = [order[c["state"]] for c in sorted(group["c"])]
        assert states == sorted(set(states))
