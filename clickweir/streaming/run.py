"""Starting, bounding and observing streaming queries."""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Default bounds of a run, in seconds.
POLL_TIMEOUT = 30.0
MAX_DURATION = 300.0


class Observed:
    """Sums over a query's progress, collected while it runs.

    Spark keeps the last 100 progress reports; ``update`` has to be called before more
    have passed. ``complete`` tells whether it was. ``ProgressSums`` does not poll.
    """

    def __init__(self) -> None:
        self.rows = self.late = 0
        self.complete = True
        self._seen: int | None = None

    def update(self, query: StreamingQuery) -> int:
        """Add the reports that are new; returns their input rows."""
        fresh = 0
        for progress in query.recentProgress:
            batch = progress["batchId"]
            if self._seen is not None and batch <= self._seen:
                continue
            if self._seen is not None and batch > self._seen + 1:
                self.complete = False
            self._seen = batch
            fresh += progress["numInputRows"]
            self.late += sum(
                operator.get("numRowsDroppedByWatermark", 0)
                for operator in progress["stateOperators"]
            )
        self.rows += fresh
        return fresh


def run_bounded(
    query: StreamingQuery,
    max_duration: float = MAX_DURATION,
    idle_timeout: float | None = POLL_TIMEOUT,
    max_rows: int | None = None,
    keep_going: Callable[[], bool] | None = None,
    check_every: float = 0.5,
    observed: Observed | None = None,
) -> str:
    """Let ``query`` run until the first bound is met, then stop it.

    Bounds: the time ``max_duration``, no input for ``idle_timeout``, ``max_rows``
    consumed, or ``keep_going()`` false (a lock file that vanished, for example).
    Returns which one it was; ``"finished"`` when the query ended by itself. Stopping
    is safe at any moment: the checkpoint has every batch that was completed. With
    ``max_rows`` 0 nothing is waited for. ``observed`` receives the run's sums.
    """
    began = last_input = time.monotonic()
    observed = Observed() if observed is None else observed
    try:
        while True:
            if query.awaitTermination(check_every):
                observed.update(query)
                return "finished"
            now = time.monotonic()
            if observed.update(query):
                last_input = now
            if keep_going is not None and not keep_going():
                return "released"
            if max_rows is not None and observed.rows >= max_rows:
                return "limit"
            if now - began >= max_duration:
                return "duration"
            if idle_timeout is not None and now - last_input >= idle_timeout:
                return "idle"
    finally:
        query.stop()


class ProgressSums(StreamingQueryListener):
    """Input rows and late rows of queries, counted as their reports come in.

    Nothing is polled, so no report is missed however long a query runs:

        sums = ProgressSums()
        spark.streams.addListener(sums)
        ...
        sums.wait(query); sums.late(query)

    Late rows are those that stateful operators saw after partial aggregation and
    expansion into windows: a late event in five hopping windows counts up to five times.
    ``streaming.late`` lists the events themselves.
    """

    def __init__(self) -> None:
        self._rows: Counter[str] = Counter()
        self._late: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        with self._news:
            self._rows[str(progress.runId)] += progress.numInputRows
            self._late[str(progress.runId)] += late

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def rows(self, query: StreamingQuery) -> int:
        return self._rows[str(query.runId)]

    def late(self, query: StreamingQuery) -> int:
        return self._late[str(query.runId)]

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Whether the last report of a query that has ended has come in."""
        run = str(query.runId)
        with self._news:
            return self._news.wait_for(lambda: run in self._ended, timeout)
