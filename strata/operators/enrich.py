"""Batched lookup of keys through a caller's function, with retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUP_SCHEMA = "key string, status string, attempts int, record string"


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Unique, non-NULL keys. A missing key column is an error before anything runs."""
    if key not in df.columns:
        raise ValueError(f"column {key!r} not found, the input has {df.columns}")
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def lookup(
    keys: DataFrame,
    key: str,
    fetch: Callable[[list], list],
    batch_size: int = 50,
    attempts: int = 3,
    base_delay: float = 5.0,
    pause: tuple[float, float] = (0.1, 0.5),
    concurrency: int = 8,
) -> DataFrame:
    """Ask ``fetch`` for the records of distinct ``keys`` and return ``key, status, attempts, record`` (JSON text).

    ``fetch`` takes up to ``batch_size`` keys and returns their records, dicts or None, in the same order; a reply of
    another length is matched by the records' ``id``. An error with ``http_status`` 429 waits as its ``Retry-After``
    header says in seconds, or backs off exponentially, and tries again; another ``http_status`` gives up on the batch
    at once; any other error backs off and tries again. Status is ``found``, ``absent`` (no record), ``refused`` (given up at
    once) or ``failed`` (attempts used up). No key is lost: each one comes back with its status.

    ``concurrency`` is the number of partitions, so the most batches under way at a time; the service sets its limit.
    ``fetch`` must be idempotent, because Spark may run a task twice. Stage the result before reading it more than
    once.
    """
    low, high = pause

    def run(frames):
        # Everything a worker needs is inside this closure, so the package need not be installed there.
        import json
        import random
        import time

        import pandas as pd

        def ask(batch):
            for attempt in range(attempts):
                try:
                    reply = fetch(batch)
                except Exception as e:
                    status = getattr(e, "http_status", None)
                    if status is not None and status != 429:
                        return "refused", attempt + 1, []
                    wait = base_delay * 2**attempt
                    told = (getattr(e, "headers", None) or {}).get("Retry-After") if status == 429 else None
                    if str(told).isdigit():
                        wait = int(told)
                    if attempt + 1 < attempts:
                        time.sleep(wait)
                else:
                    if high > 0:
                        time.sleep(random.uniform(low, high))
                    return "found", attempt + 1, reply
            return "failed", attempts, []

        def answer(batch):
            status, used, reply = ask(batch)
            if status != "found":
                pairs = [(k, status, None) for k in batch]
            elif len(reply) == len(batch):
                pairs = [(k, "found" if r else "absent", r) for k, r in zip(batch, reply)]
            else:
                # A reply of another length is matched by the records' ids; those that nobody asked for are left out.
                got = {str(r["id"]): r for r in reply if r and r.get("id") is not None}
                pairs = [(k, "found" if str(k) in got else "absent", got.get(str(k))) for k in batch]
            rows = [(str(k), s, used, json.dumps(r) if r else None) for k, s, r in pairs]
            return pd.DataFrame(rows, columns=["key", "status", "attempts", "record"])

        waiting = []
        for frame in frames:
            waiting.extend(frame[key].tolist())
            while len(waiting) >= batch_size:
                yield answer(waiting[:batch_size])
                del waiting[:batch_size]
        if waiting:
            yield answer(waiting)

    wanted = keys.select(key).filter(F.col(key).isNotNull())
    return wanted.repartition(concurrency, key).mapInPandas(run, LOOKUP_SCHEMA)


def lookup_limited(
    keys: DataFrame,
    key: str,
    fetch: Callable[[list], list],
    batch_size: int = 50,
    attempts: int = 3,
    base_delay: float = 5.0,
    per_period: int = 8,
    period: float = 1.0,
    concurrency: int = 8,
    skew: float = 1.2,
) -> DataFrame:
    """As :func:`lookup`, with one budget and one pause for all tasks: at most ``per_period`` requests in ``period`` seconds.

    The tasks run as one barrier stage, in rounds. Before each round they tell one another whether they have keys left and until
    when the service wants to be left alone; all of them wait for the latest of these times and for the end of the period, and
    the budget is dealt among those that have keys, in turns if it is smaller than their number. A request that gets status 429
    thus stops the others, too, but for those that are under way in the same round, one a task at a time. Batches that may be
    tried again go first in a later round. ``concurrency`` tasks must find room in the cluster at once; if one is lost, all begin
    again, so ``fetch`` must be idempotent and the result should be staged. NULL keys are left out, no keys give no rows.
    ``skew`` is how long a barrier may take to wake all tasks, and the least length of a round: they begin it together then.
    """

    def run(frames):
        # Everything a worker needs is inside this closure, so the package need not be installed there.
        import json
        import time

        import pandas as pd
        from pyspark import BarrierTaskContext

        def batches():
            waiting = []
            for frame in frames:
                waiting.extend(frame[key].tolist())
                while len(waiting) >= batch_size:
                    yield waiting[:batch_size]
                    del waiting[:batch_size]
            if waiting:
                yield waiting

        def ended(batch, status, used, reply):
            if status != "found":
                pairs = [(k, status, None) for k in batch]
            elif len(reply) == len(batch):
                pairs = [(k, "found" if r else "absent", r) for k, r in zip(batch, reply)]
            else:
                got = {str(r["id"]): r for r in reply if r and r.get("id") is not None}
                pairs = [(k, "found" if str(k) in got else "absent", got.get(str(k))) for k in batch]
            rows = [(str(k), s, used, json.dumps(r) if r else None) for k, s, r in pairs]
            return pd.DataFrame(rows, columns=["key", "status", "attempts", "record"])

        context, source = BarrierTaskContext.get(), batches()
        me, again, turn, quiet = context.partitionId(), [], 0, 0.0
        coming = next(source, None)
        while True:
            told = [json.loads(m) for m in context.allGather(json.dumps([bool(again) or coming is not None, quiet, time.time()]))]
            active = [i for i, (left, _, _) in enumerate(told) if left]
            if not active:
                return
            began = max(max(now for _, _, now in told) + skew, max(until for _, until, _ in told))
            time.sleep(max(0.0, began - time.time()))
            # The turn moves on by the budget, so that with less than one request a task every task gets its own.
            place = (active.index(me) - turn * per_period) % len(active) if me in active else per_period
            share = len(range(place, per_period, len(active)))
            turn, quiet = turn + 1, 0.0
            for _ in range(share):
                if again:
                    batch, used = again.pop(0)
                elif coming is not None:
                    batch, used, coming = coming, 0, next(source, None)
                else:
                    break
                try:
                    reply = fetch(batch)
                except Exception as e:
                    status = getattr(e, "http_status", None)
                    if status is not None and status != 429:
                        yield ended(batch, "refused", used + 1, [])
                    elif used + 1 == attempts:
                        yield ended(batch, "failed", attempts, [])
                    else:
                        again.append((batch, used + 1))
                    if status is None or status == 429:
                        said = (getattr(e, "headers", None) or {}).get("Retry-After") if status == 429 else None
                        quiet = time.time() + (int(said) if str(said).isdigit() else base_delay * 2**used)
                        break
                else:
                    yield ended(batch, "found", used + 1, reply)
            quiet = max(quiet, began + period)

    wanted = keys.select(key).filter(F.col(key).isNotNull())
    return wanted.repartition(concurrency, key).mapInPandas(run, LOOKUP_SCHEMA, barrier=True)


def parsed(found: DataFrame, schema: T.StructType) -> DataFrame:
    """Lookup rows with their record as a typed struct."""
    return found.withColumn("record", F.from_json("record", schema))


def lookup_report(found: DataFrame) -> DataFrame:
    """How many keys ended in which status."""
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
