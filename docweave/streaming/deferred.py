"""F15 as a stream: pages whose host must be left alone for a while come back by themselves.

A host is visited at most once every ``delay``.  Pages of a host queue in the order of
their arrival (then url); each is due when it has arrived and the delay since the visit
before has passed.  The queue is keyed state, a timer wakes it when its first page is
due, and time is the watermark, so visits depend on the arrivals alone, however they
are cut into batches.  A page leaves the queue once the watermark has passed the time
it is due; one that arrives later than the watermark allows is not taken.

A host's visits follow one after the other, so a host is one queue in one task; what a
task holds of it is the pages that wait.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

VISITS = "host string, url string, arrived_us long, visited_us long"
QUEUE = "last_us long, arrived array<long>, urls array<string>"


def settle(last: int | None, queue: list[tuple[int, str]], delay: int, now: int):
    """What of a sorted queue is due before ``now`` (microseconds): (visits, last visit,
    pages left, when the first of them is due)."""
    visits, k = [], 0
    for arrived, url in queue:
        due = arrived if last is None else max(arrived, last + delay)
        if due >= now:
            return visits, last, queue[k:], due
        visits.append((url, arrived, due))
        last = due
        k += 1
    return visits, last, [], None


def _visit(key, frames, state: GroupState):
    # keys and state may come as numpy numbers, which a state does not take back
    host, delay = key[0], int(key[1])
    last, arrived, urls = state.get if state.exists else (None, [], [])
    last, queue = None if last is None else int(last), list(zip(map(int, arrived), urls))
    for frame in frames:
        queue += zip(frame["arrived_us"].tolist(), frame["url"].tolist())
    now = state.getCurrentWatermarkMs()
    visits, last, left, due = settle(last, sorted(queue), delay * 1_000_000, now * 1000)
    state.update((last, [a for a, _ in left], [u for _, u in left]))
    if left:
        state.setTimeoutTimestamp(max(due // 1000, now) + 1)
    yield pd.DataFrame({"host": [host] * len(visits), "url": [u for u, _, _ in visits],
                        "arrived_us": [a for _, a, _ in visits], "visited_us": [v for _, _, v in visits]})


def visits(arrivals: DataFrame, watermark: str) -> DataFrame:
    """A stream ``arrivals(url, host, arrived timestamp, delay_s long)`` -> its visits:
    ``host, url, arrived_us, visited_us``.  Rows without url, host or time are no
    pages; a null delay is 0."""
    rows = (arrivals.where("url is not null and host is not null and arrived is not null").withWatermark("arrived", watermark)
            .select("host", F.coalesce(F.col("delay_s"), F.lit(0)).cast("long").alias("delay_s"), "url", "arrived",
                    F.unix_micros("arrived").alias("arrived_us")))
    return rows.groupBy("host", "delay_s").applyInPandasWithState(_visit, VISITS, QUEUE, "append", GroupStateTimeout.EventTimeTimeout)
