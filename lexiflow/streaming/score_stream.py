"""Scoring arriving text with Structured Streaming.

The reference scores one string per call; here every micro-batch of arriving
rows is scored as a table with the same plan as the batch path.  The model is
static (a checkpointed table), there is no state across batches, and each
batch is written to ``<out>/batch=<id>`` with overwrite, so a replayed batch
after a failure rewrites the same files (idempotent sink).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import examples as EX
from ..operators import score as S
from ..session import scratch


def score_stream(stream: DataFrame, model: DataFrame, num_classes: int, out_path: str,
                 checkpoint: str, key: str = "doc_id", keep: Sequence[str] = ("label_id",),
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 available_now: bool = True, classes: Sequence[str] | None = None,
                 rejected_path: str | None = None) -> StreamingQuery:
    """Start the scoring stream; with ``available_now`` it stops when the input
    present at start has been processed.  ``classes`` adds the label.

    Rows without a token have no prediction; with ``rejected_path`` each batch
    writes ``(key, reason)`` of these there, so that predictions and rejects are
    all rows of the stream."""

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = prepare(df) if prepare else df
        with scratch(df.sparkSession, "blocks") as at:
            preds = S.score(rows, model, num_classes, key=key, keep=keep, classes=classes, at=at)
            preds.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")
        if rejected_path:
            EX.rejects(rows, key=key).write.mode("overwrite").parquet(f"{rejected_path.rstrip('/')}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
