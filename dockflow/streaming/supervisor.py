"""Jobs that go on after a failure."""

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from dockflow.streaming.queries import Chain
from dockflow.streaming.tables import BatchTable

FAILURES_DDL = "attempt bigint, at timestamp, message string"


class Supervisor(StreamingQueryListener):
    """Starts a job and starts it again from its checkpoint when one of its queries fails.

    The wait before a start doubles with each failure up to `longest` seconds, and is the first again once
    a batch has gone through. Every failure is written as a row. After `attempts` failures without a batch between
    them the last one is raised; without that number the job goes on for ever. `sessions` are those that the job's
    queries run in, if not the one given.
    """

    def __init__(self, spark: SparkSession, start: Callable[[], StreamingQuery | Chain], base: str, first: float = 1.0,
                 longest: float = 300.0, attempts: int | None = None, sessions: tuple[SparkSession, ...] = ()):
        self.sessions = sessions or (spark,)
        self.spark, self.start, self.first, self.longest, self.attempts = spark, start, first, longest, attempts
        self.failures = BatchTable(spark, f"{base}/failures", FAILURES_DDL)
        self.in_a_row = 0
        self.stopped = threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.in_a_row = 0

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def wait(self) -> float:
        """Seconds before the next start."""
        return min(self.longest, self.first * 2 ** max(self.in_a_row - 1, 0))

    def run(self) -> None:
        """Until the job ends by itself or `stop` is called."""
        for session in self.sessions:
            session.streams.addListener(self)
        attempt = self.failures.read().select(F.max("batch_id")).first()[0]
        attempt = 0 if attempt is None else attempt + 1
        try:
            while not self.stopped.is_set():
                try:
                    self.start().awaitTermination()
                    return
                except Exception as error:  # noqa: BLE001, a query fails with whatever its handler raised
                    self.in_a_row += 1
                    row = self.spark.createDataFrame([(attempt, str(error)[:4000])], "attempt bigint, message string")
                    self.failures.write(row.select("attempt", F.current_timestamp().alias("at"), "message"), attempt)
                    attempt += 1
                    if self.attempts is not None and self.in_a_row >= self.attempts:
                        raise
                    self.stopped.wait(self.wait())
        finally:
            for session in self.sessions:
                session.streams.removeListener(self)

    def stop(self) -> None:
        self.stopped.set()
