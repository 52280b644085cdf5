"""Model calls: how many at a time, how often, and until when."""

import os
import sys
import threading
import time
import uuid

from pyspark import cloudpickle

from scriptorium.plans import model

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Counting:
    """Notes each call as a file; fails, or meets a quota, where told; a task dies once where told."""

    def __init__(self, folder, quota_after=10**9):
        self.folder, self.quota_after = str(folder), quota_after

    def generate(self, prompt):
        n = len(os.listdir(self.folder))
        open(f"{self.folder}/{prompt}-{uuid.uuid4().hex}", "w").close()
        if n >= self.quota_after:
            raise model.QuotaExceeded("no more today")
        if prompt == "p7":
            raise RuntimeError("never works")
        return "" if prompt == "p9" else f"answer to {prompt}"


def calls(folder):
    out = {}
    for name in os.listdir(folder):
        out[name.split("-")[0]] = out.get(name.split("-")[0], 0) + 1
    return out


def prompts(spark, n=40):
    return spark.createDataFrame([(k, f"p{k}") for k in range(n)], "id long, prompt string").repartition(3)


def test_answers_are_recorded_and_not_asked_again(spark, tmp_path):
    noted = tmp_path / "calls"
    noted.mkdir()
    run = lambda n: {r["id"]: r["response"] for r in model.answered(prompts(spark, n), Counting(noted), ["id"], f"{tmp_path}/record", rounds=3, attempts=2, first_delay=0.0).collect()}
    first = run(30)
    assert first == {k: f"answer to p{k}" for k in range(30) if k not in (7, 9)}
    assert calls(noted) == {f"p{k}": 2 if k == 7 else 1 for k in range(30)}
    assert run(40) == {k: f"answer to p{k}" for k in range(40) if k not in (7, 9)}
    assert calls(noted) == {f"p{k}": {7: 4, 9: 2}.get(k, 1) for k in range(40)}


def test_a_quota_stops_the_rest_and_the_next_call_goes_on(spark, tmp_path):
    noted = tmp_path / "calls"
    noted.mkdir()
    run = lambda quota: model.answered(prompts(spark), Counting(noted, quota), ["id"], f"{tmp_path}/record", rounds=8, attempts=3, first_delay=0.0, concurrent=2).count()
    some = run(12)
    made = len(os.listdir(noted))
    assert 0 < some <= 14 and made < 12 + 3 * 2 + 8  # a few that were under way; no retries, no further rounds
    assert run(10**9) == 38
    assert all(n == 1 for p, n in calls(noted).items() if p not in ("p7", "p9")) or sum(calls(noted).values()) <= 40 + made - some + 6


def test_a_job_that_dies_keeps_its_rounds(spark, tmp_path, monkeypatch):
    noted = tmp_path / "calls"
    noted.mkdir()
    real, count = model.generated, []

    def dies(*a, **k):
        count.append(1)
        if len(count) == 3:
            raise RuntimeError("the driver is gone")
        return real(*a, **k)

    monkeypatch.setattr(model, "generated", dies)
    run = lambda: model.answered(prompts(spark), Counting(noted), ["id"], f"{tmp_path}/record", rounds=5, attempts=1)
    try:
        run()
        raise AssertionError("it should have died")
    except RuntimeError:
        pass
    before = calls(noted)
    assert 0 < len(before) < 40
    assert run().count() == 38
    assert all(calls(noted)[p] == 1 for p in before if p not in ("p7", "p9")) and len(calls(noted)) == 40


def test_calls_at_a_time():
    now, most, lock = [0], [0], threading.Lock()

    class Slow:
        def generate(self, prompt):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.02)
            with lock:
                now[0] -= 1
            return prompt.upper()

    found = model._answers([f"a{k}" for k in range(20)] + [None], Slow(), 1, 0.0, 4, threading.Event())
    assert found == [(f"A{k}", None) for k in range(20)] + [(None, "no prompt")] and 2 <= most[0] <= 4
    stopped = threading.Event()
    stopped.set()
    assert model._answers(["x"], Slow(), 1, 0.0, 1, stopped) == [(None, model.NOT_ASKED)]
