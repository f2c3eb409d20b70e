import pytest

from strata import schemas
from strata.operators import enrich


def keys(spark, n):
    return spark.createDataFrame([(f"k{i}",) for i in range(n)], "id string")


def run(spark, n, fetch, **options):
    options = {"base_delay": 0.0, "pause": (0, 0), "concurrency": 1} | options
    return enrich.lookup(keys(spark, n), "id", fetch, **options).collect()


def simple():
    return lambda batch: [{"id": k, "size": len(batch)} for k in batch]


def failing(status=None, times=99, retry_after=None):
    """A lookup that fails ``times`` times before it answers, per worker process."""
    calls = []

    def fetch(batch):
        calls.append(1)
        if len(calls) <= times:
            error = RuntimeError("service")
            if status:
                error.http_status = status
                error.headers = {"Retry-After": retry_after} if retry_after is not None else {}
            raise error
        return [{"id": k} for k in batch]

    return fetch


def test_batches_hold_fifty_keys(spark):
    import json

    got = run(spark, 120, simple())
    sizes = sorted(json.loads(r["record"])["size"] for r in got)
    assert len(got) == 120 and sizes == [20] * 20 + [50] * 100


def test_batches_cross_arrow_batches(spark, setting):
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    import json

    got = run(spark, 100, simple())
    assert {json.loads(r["record"])["size"] for r in got} == {50}


def test_rate_limit_is_retried(spark):
    got = run(spark, 3, failing(429, times=2, retry_after=0))
    assert {(r["status"], r["attempts"]) for r in got} == {("found", 3)}


def test_rate_limit_ends_after_the_attempts(spark):
    got = run(spark, 3, failing(429))
    assert {(r["status"], r["attempts"], r["record"]) for r in got} == {("failed", 3, None)}


def test_other_service_errors_skip_the_batch_at_once(spark):
    assert {(r["status"], r["attempts"]) for r in run(spark, 3, failing(500))} == {("refused", 1)}


def test_other_errors_are_retried(spark):
    got = run(spark, 3, failing(times=1), attempts=5)
    assert {(r["status"], r["attempts"]) for r in got} == {("found", 2)}


def test_one_bad_batch_leaves_the_others(spark):
    def fetch(batch):
        if "k0" in batch:
            raise RuntimeError("broken")
        return [{"id": k} for k in batch]

    got = run(spark, 200, fetch, batch_size=10)
    by = {s: sum(r["status"] == s for r in got) for s in ("found", "failed")}
    assert by == {"found": 190, "failed": 10}


def test_null_records_and_short_replies(spark):
    got = run(spark, 4, lambda b: [{"id": k} if k != "k1" else None for k in b])
    assert {r["key"]: r["status"] for r in got} == {"k0": "found", "k1": "absent", "k2": "found", "k3": "found"}
    got = run(spark, 4, lambda b: [{"id": "k2"}])
    assert {r["key"]: r["status"] for r in got} == {"k0": "absent", "k1": "absent", "k2": "found", "k3": "absent"}


def test_odd_retry_after_falls_back(spark):
    got = run(spark, 1, failing(429, times=1, retry_after="Wed, 21 Oct 2015 07:28:00 GMT"))
    assert got[0]["status"] == "found"


def test_null_keys_are_not_asked_for(spark):
    df = spark.createDataFrame([("a",), (None,)], "id string")
    got = enrich.lookup(df, "id", simple(), pause=(0, 0)).collect()
    assert [r["key"] for r in got] == ["a"]


def test_empty_input(spark):
    assert run(spark, 0, simple()) == []


def test_backoff_doubles(spark):
    import time

    began = time.time()
    run(spark, 1, failing(), base_delay=0.5)
    # 0.5 s and 1 s between three attempts, none after the last.
    assert 1.5 <= time.time() - began < 6


def test_distinct_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert [r["id"] for r in enrich.distinct_keys(df, "id").collect()] == ["a"]
    with pytest.raises(ValueError, match="nope"):
        enrich.distinct_keys(df, "nope")


def test_records_parse(spark):
    found = run(spark, 1, lambda b: [{"id": k, "popularity": 5, "extra": {"x": 1}} for k in b])
    df = enrich.parsed(spark.createDataFrame(found, enrich.LOOKUP_SCHEMA), schemas.track_schema())
    assert df.first()["record"]["popularity"] == 5
    assert [tuple(r) for r in enrich.lookup_report(df).collect()] == [("found", 1)]


# --- one budget and one pause for all tasks ---


def limited(spark, n, fetch, **options):
    options = {"base_delay": 0.0, "period": 0.0, "concurrency": 3, "batch_size": 10} | options
    return enrich.lookup_limited(keys(spark, n), "id", fetch, **options)


def logging_fetch(folder, refuse_nth=None, retry_after="2"):
    """Each request leaves a file with when it began; in each worker, one gets status 429."""
    calls = []

    def fetch(batch):
        import os
        import time
        import uuid

        calls.append(1)
        began = time.time()
        time.sleep(0.05)
        refused = len(calls) == refuse_nth and not os.path.exists(f"{folder}/refused")
        if refused:
            with open(f"{folder}/refused", "w") as f:
                f.write(str(time.time()))
        with open(f"{folder}/{uuid.uuid4().hex}.request", "w") as f:
            f.write(str(began))
        if refused:
            error = RuntimeError("too many requests")
            error.http_status, error.headers = 429, {"Retry-After": retry_after}
            raise error
        return [{"id": k} for k in batch]

    return fetch


def test_a_pause_stops_all_tasks(spark, tmp_path):
    got = limited(spark, 120, logging_fetch(str(tmp_path), refuse_nth=2, retry_after="4"), per_period=3).collect()
    assert sorted(r["key"] for r in got) == sorted(f"k{i}" for i in range(120)) and {r["status"] for r in got} == {"found"}
    refused = float((tmp_path / "refused").read_text())
    began = [float(p.read_text()) for p in tmp_path.glob("*.request")]
    assert not [t for t in began if refused + 0.2 < t < refused + 3.95]
    assert sum(t > refused + 3.95 for t in began) >= 5  # the rest came after the pause
    assert max(r["attempts"] for r in got) == 2


@pytest.mark.parametrize("per_period", [2, 7])
def test_one_budget_for_all_tasks(spark, tmp_path, per_period):
    """Fewer requests than tasks in a period, and more."""
    got = limited(spark, 100, logging_fetch(str(tmp_path)), per_period=per_period, period=2.0).collect()
    assert len({r["key"] for r in got}) == 100
    began = sorted(float(p.read_text()) for p in tmp_path.glob("*.request"))
    for t in began:
        assert sum(t <= other < t + 1.5 for other in began) <= per_period


def test_limited_lookup_keeps_every_key(spark):
    statuses = lambda rows: {(r["status"], r["attempts"]) for r in rows}
    assert statuses(limited(spark, 60, failing(404)).collect()) == {("refused", 1)}
    assert statuses(limited(spark, 60, failing(), attempts=2).collect()) == {("failed", 2)}
    rows = limited(spark, 60, lambda batch: [{"id": k} for k in batch if not k.endswith("7")]).collect()
    assert len(rows) == 60 and {r["key"] for r in rows if r["status"] == "absent"} == {f"k{i}" for i in range(7, 60, 10)}
    assert limited(spark, 0, simple()).collect() == []
