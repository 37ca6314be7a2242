"""One build at a time under one name: a lease file with a heartbeat.

The file is created only if it is not there, in one step of the file system.  Its holder renews
its time in the background; a holder that died stops doing so, and after ``seconds`` without a
renewal the next start may take the lease over.  Every holder looks before each step whether the
lease is still its own, so of two that take it over at the same moment one stops.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from dumpwinnow.sources.files import age_seconds, create_new, read_pointer, remove, touch
from dumpwinnow.sources.snapshots import Snapshot

LEASE = "_lease"
SECONDS = 600.0


class LeaseHeld(RuntimeError):
    """Another build holds the name."""


@contextmanager
def exclusive(snapshot: Snapshot, seconds: float = SECONDS) -> Iterator[Callable[[], None]]:
    """Hold the snapshot's lease; yields a check that raises once the lease is lost."""
    spark, path = snapshot.spark, f"{snapshot.path}/{LEASE}"
    mine = uuid.uuid4().hex

    def held() -> None:
        if read_pointer(spark, path) != mine:
            raise LeaseHeld(f"{path} was taken over by another build")

    if not create_new(spark, path, mine):
        age = age_seconds(spark, path)
        if age is not None and age < seconds:
            raise LeaseHeld(f"{path} is held by a running build, renewed {age:.0f} s ago")
        remove(spark, path)
        if not create_new(spark, path, mine):
            raise LeaseHeld(f"{path} was taken by another start")
    ended = threading.Event()

    def renew() -> None:
        while not ended.wait(seconds / 4):
            touch(spark, path)

    beat = threading.Thread(target=renew, daemon=True)
    beat.start()
    try:
        held()
        yield held
    finally:
        ended.set()
        beat.join()
        if read_pointer(spark, path) == mine:
            remove(spark, path)

