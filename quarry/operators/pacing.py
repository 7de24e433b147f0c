"""Calls that keep a service's limits (O-83): deadlines, a rate, a number of calls in flight that gives way, dead letters.

All state is a task's own: with n tasks at work a service meets n times the rate of one, so give each its share.
"""

from __future__ import annotations

import queue
import random
import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.names import unused
from quarry.operators.models import THREADS, Client

#: Fixed value: seconds that one edit may take.
DEADLINE = 300.0


class Throttled(Exception):
    """The service asks for fewer calls."""


def with_deadline(client: Client, seconds: float = DEADLINE) -> Client:
    """A call that has no answer in time is a TimeoutError. Its thread is left behind, as Python can't end it, and ends
    with the task's process; put this around with_retries() to bound all attempts together."""

    def call(*asked) -> str:
        told: queue.SimpleQueue = queue.SimpleQueue()

        def run():
            try:
                told.put((client(*asked), None))
            except Exception as e:
                told.put((None, e))

        threading.Thread(target=run, daemon=True).start()
        try:
            answer, error = told.get(timeout=seconds)
        except queue.Empty:
            raise TimeoutError(f"no answer within {seconds:g} s") from None
        if error is not None:
            raise error
        return answer

    return call


class Pace:
    """At most rate calls a second, after burst at once, and most in flight.

    The number in flight halves when the service throttles a call that began after it was last halved, and grows by one
    for each round of calls that went well.
    """

    def __init__(self, rate: float, burst: int = 1, most: int = THREADS):
        self.rate, self.burst, self.most = rate, burst, most
        self.limit, self.running, self.due, self.halved = float(most), 0, 0.0, 0.0
        self.free = threading.Condition()

    def _begin(self) -> float:
        """Takes a place and a time to start at."""
        with self.free:
            self.free.wait_for(lambda: self.running < int(self.limit))
            self.running += 1
            start = max(time.monotonic(), self.due - (self.burst - 1) / self.rate)
            self.due = max(self.due, start) + 1 / self.rate
            return start

    @contextmanager
    def turn(self):
        start = self._begin()
        try:
            time.sleep(max(0.0, start - time.monotonic()))
            yield
        except Throttled:
            with self.free:
                if start >= self.halved:
                    self.limit, self.halved = max(1.0, self.limit / 2), time.monotonic()
            raise
        else:
            with self.free:
                self.limit = min(float(self.most), self.limit + 1 / self.limit)
        finally:
            with self.free:
                self.running -= 1
                self.free.notify_all()


def paced(client: Client, pace: Pace, attempts: int = 10, least_wait: float = 2.0, most_wait: float = 10.0) -> Client:
    """Calls in turn; throttled ones are tried again after a random part of a wait that doubles. Other errors are raised."""

    def call(*asked) -> str:
        for k in range(attempts):
            try:
                with pace.turn():
                    return client(*asked)
            except Throttled:
                if k + 1 == attempts:
                    raise
                time.sleep(random.uniform(0.5, 1.0) * min(most_wait, least_wait * 2**k))

    return call


def settled(told: DataFrame, sink: str, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(answers, dead letters): rows of model calls are written once, apart by whether they have an error, and read back.

    The folder sink is appended to, so that a later pass over the dead letters adds its answers.
    """
    (failed,) = unused(told, "_failed")
    kind = T.StructType([*told.schema.fields]).add(failed, T.BooleanType())
    told.withColumn(failed, F.col(error).isNotNull()).write.mode("append").partitionBy(failed).parquet(sink)
    rows = told.sparkSession.read.schema(kind).parquet(sink)
    return rows.where(~F.col(failed)).drop(failed), rows.where(F.col(failed)).drop(failed)


_MODELS: dict[str, object] = {}
_MAKING = threading.Lock()


class once_a_worker:  # noqa: N801
    """Calls make() in a Python worker's first task only; later tasks of that worker get the same object. name tells models apart."""

    def __init__(self, name: str, make: Callable):
        self.name, self.make = name, make

    def __call__(self):
        with _MAKING:
            if self.name not in _MODELS:
                _MODELS[self.name] = self.make()
            return _MODELS[self.name]
