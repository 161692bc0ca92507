"""Life-cycle and per-batch log lines of streaming queries."""

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Logs start, batches and end of every query of a session.

    Row counts come from the sink: those in the progress also count the rows that
    were read to see whether a batch is empty.

    Register it with ``spark.streams.addListener(ProgressLog())``.
    """

    def onQueryStarted(self, event):
        log.info("query %s (%s) started", event.name, event.id)

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if late:
            log.warning("query %s batch %d: %d rows behind the watermark", p.name, p.batchId, late)
        log.info(
            "query %s batch %d took %d ms, %d late rows left out",
            p.name,
            p.batchId,
            p.batchDuration,
            late,
        )

    def onQueryIdle(self, event):
        log.debug("query %s is idle", event.id)

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("query %s ended with an error: %s", event.id, event.exception)
        else:
            log.info("query %s ended", event.id)
