"""ST1 / ST2: progress per consumer group, and a service that flushes when stopped."""

import json
import threading
import time

from pyspark.sql import functions as F

from ledgerlake.streaming import landing


def land(spark, folder, names):
    rows = [(json.dumps({"trans_num": n, "user_id": "7"}),) for n in names]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(folder)


def read(spark, root, group, topic):
    q = landing.start_consumer(spark, landing.read_messages(spark, path=topic), f"{root}/landed-{group}",
                               landing.group_checkpoint(f"{root}/ckpt", group), available_now=True)
    q.awaitTermination()
    return sorted(str(r[0]) for r in landing.read_landing(spark, f"{root}/landed-{group}").select("trans_num").collect())


def progress(spark, root):
    return {r["group"]: (r["batches"], r["offsets"]) for r in landing.group_progress(spark, f"{root}/ckpt").collect()}


def test_two_groups_resume_apart(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    land(spark, topic, ["1", "2"])
    assert read(spark, tmp_path, "a", topic) == ["1", "2"]
    land(spark, topic, ["3"])
    assert read(spark, tmp_path, "b", topic) == ["1", "2", "3"]
    at = progress(spark, tmp_path)
    assert set(at) == {"a", "b"} and at["a"][0] == at["b"][0] == 1 and "logOffset" in at["a"][1]
    assert read(spark, tmp_path, "a", topic) == ["1", "2", "3"]      # goes on where it was
    after = progress(spark, tmp_path)
    assert after["a"][0] == 2 and after["a"][1] != at["a"][1] and after["b"] == at["b"]


def test_a_stopped_service_leaves_nothing_unread(spark, tmp_path):
    topic, stop = f"{tmp_path}/topic", threading.Event()
    land(spark, topic, ["1"])
    run = threading.Thread(target=landing.serve, args=(spark, lambda: landing.read_messages(spark, path=topic), f"{tmp_path}/landed",
                                                       f"{tmp_path}/ckpt", stop), kwargs={"flush_seconds": 3_600, "poll_seconds": 0.2})
    run.start()
    until = time.time() + 30
    landed = lambda: {str(r[0]) for r in landing.read_landing(spark, f"{tmp_path}/landed").select(F.col("trans_num")).collect()}
    while time.time() < until and not (tmp_path / "ckpt" / "commits" / "0").exists():
        time.sleep(0.3)
    land(spark, topic, ["2", "3"])      # the next flush would be in an hour
    assert landed() == {"1"}
    stop.set()
    run.join(60)
    assert not run.is_alive() and landed() == {"1", "2", "3"}
