"""One rate of calls for a whole job, kept without any exchange between its tasks.

The seconds of the clock are cut into slots, one call each, and dealt out to the
tasks in turn: with a rate of ten and four tasks, task 1 may call in slots 1, 5, 9 ...
No second holds more calls than the rate, however many tasks run at a time, and a task
that is run again after its executor was lost uses the same slots. Executors need
clocks that agree to within a slot or so. Slots of tasks that have ended, or wait for
their turn, are not used. Two jobs have a rate each; so do the two copies of a
task that runs speculatively, so leave speculation off for paid calls.
"""

from __future__ import annotations

import math
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame


def paced_tasks(df: DataFrame, calls_per_second: float) -> int:
    """Tasks to share a rate: one per core, but no more than calls in a second."""
    return min(df.sparkSession.sparkContext.defaultParallelism, max(1, math.ceil(calls_per_second)))


class Pace:
    """The slots of one task; threads of the task share it."""

    def __init__(
        self,
        calls_per_second: float | None,
        tasks: int = 1,
        task: int = 0,
        clock: Callable[[], float] = time.time,
        sleep: Callable[[float], None] = time.sleep,
    ):
        self.rate, self.tasks, self.task, self.clock, self.sleep = calls_per_second, tasks, task % tasks, clock, sleep
        self._lock = threading.Lock()
        self._turn, self._held_until = -1, 0.0

    def wait(self) -> None:
        """Return when the next call may start."""
        with self._lock:
            at = max(self.clock(), self._held_until)
            if self.rate:
                # The first own slot not begun yet and not given away.
                self._turn = max(math.ceil((at * self.rate - self.task) / self.tasks), self._turn + 1)
                at = (self._turn * self.tasks + self.task) / self.rate
        while (left := max(at, self._held_until) - self.clock()) > 0:
            self.sleep(left)

    def hold(self, seconds: float) -> None:
        """No call of this task starts for so long: the receiver has asked for it."""
        with self._lock:
            self._held_until = max(self._held_until, self.clock() + seconds)


class PacedClient:
    """A client whose calls keep a pace. The first call of each thread has been waited for by who started the thread."""

    def __init__(self, client, pace: Pace):
        self.client, self.pace, self._own = client, pace, threading.local()

    def call(self, request: dict) -> dict:
        if getattr(self._own, "called", False):
            self.pace.wait()
        self._own.called = True
        try:
            return self.client.call(request)
        except Exception as failure:
            if (asked := getattr(failure, "retry_after", None)) is not None:
                self.pace.hold(asked)
            raise
