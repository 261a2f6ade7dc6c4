"""Leases: one holder at a time, kept by commits to a log, so that a holder that died is followed once its lease has run out."""

from __future__ import annotations

import time
from uuid import uuid4

from pyspark.sql import SparkSession

from placelake.sources.commits import CommitConflict, CommitLog


class LeaseHeld(RuntimeError):
    """Somebody else holds the lease."""


class Lease:
    """A lease over a name in a shared folder, for use in a ``with`` block.

    Every change of hands is a commit of its own number, which only one writer can make. Call :meth:`renew` within
    ``seconds``, before each step that must not run twice; it raises LeaseHeld if another holder took over meanwhile. Machines'
    clocks should agree to much less than ``seconds``.
    """

    def __init__(self, spark: SparkSession, path: str, seconds: float = 6 * 3600, clock=time.time):
        self.log, self.seconds, self.clock = CommitLog(spark, path), seconds, clock
        self.holder, self.number = uuid4().hex, 0

    def __enter__(self) -> Lease:
        number, entry = self.log.latest()
        left = entry.get("until", 0) - self.clock()
        if left > 0:
            raise LeaseHeld(f"{self.log.path} is held for {left:.0f} more seconds by {entry['holder']}")
        self._take(number + 1, self.clock() + self.seconds)
        return self

    def renew(self) -> None:
        self._take(self.number + 1, self.clock() + self.seconds)

    def __exit__(self, *_) -> None:
        try:
            self._take(self.number + 1, 0)
            self.log.prune()
        except LeaseHeld:
            pass  # it ran out and is another holder's now

    def _take(self, number: int, until: float) -> None:
        try:
            self.log.commit(number, {"holder": self.holder, "until": until})
        except CommitConflict:
            raise LeaseHeld(f"{self.log.path} was taken by another holder") from None
        self.number = number
