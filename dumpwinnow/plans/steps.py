"""Independent pieces of work side by side, each after those it needs.

Every piece is driver code that starts Spark jobs.  Jobs of several threads share the cluster,
so the tail of one table's last tasks is filled with the tasks of another.  Threads are put into
scheduler pools by name; with ``spark.scheduler.mode=FAIR`` they share evenly, else in order of
their stages.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Pieces that run at once; each keeps the driver busy with planning only.
AT_ONCE = 4

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[str] = Counter()
_before: dict[str, str] = {}
_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files are deleted when the query ends.

    Otherwise they stay until the driver happens to collect its garbage, so the disk has to hold
    those of many steps at once.  For work that writes its results and reads these, as what is
    run again would be shuffled again.  The setting is the session's; the last of several that
    run side by side puts it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _freeing[session]:
            _before[session] = spark.conf.get(FREE_SHUFFLES, "false")
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _freeing[session] -= 1
            if not _freeing[session]:
                spark.conf.set(FREE_SHUFFLES, _before.pop(session))
                del _freeing[session]


def run_steps(
    spark: SparkSession,
    work: Mapping[str, Callable[[], Any]],
    needs: Mapping[str, Iterable[str]] | None = None,
    at_once: int = AT_ONCE,
) -> dict[str, Any]:
    """Results of all pieces by name, in the order of ``work``.

    ``needs`` names the pieces that must be done before one starts; names that are no piece
    are taken as done.  After a failure no further piece starts, running ones are awaited, and
    the first failure in the order of ``work`` is raised.
    """
    needs = {name: {n for n in (needs or {}).get(name, ()) if n in work} for name in work}
    waiting, results, failed = list(work), {}, {}
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running: dict[Any, str] = {}
        while waiting or running:
            ready = [name for name in waiting if needs[name] <= results.keys()]
            if not failed:
                for name in ready:
                    running[pool.submit(_in_pool(spark, name, work[name]))] = name
                    waiting.remove(name)
            if not running:
                if failed:
                    break
                raise ValueError(f"steps need each other: {sorted(waiting)}")
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                if done.exception() is None:
                    results[name] = done.result()
                else:
                    failed[name] = done.exception()
                    for other in [f for f in running if f.cancel()]:
                        running.pop(other)
    for name in work:
        if name in failed:
            raise failed[name]
    return {name: results[name] for name in work}


def _in_pool(spark: SparkSession, name: str, piece: Callable[[], Any]) -> Callable[[], Any]:
    """The piece in a thread that inherits the caller's job settings, under its own pool."""

    def run() -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return piece()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    return inheritable_thread_target(spark)(run)
