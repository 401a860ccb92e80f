"""A ``foreachBatch`` function around the batch comparator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.linkage import Linkage


def classify_batches(portfolio: DataFrame, aliases: DataFrame, write: Callable[[DataFrame, int], None]):
    """Returns f(batch, batch_id) for ``writeStream.foreachBatch``: every micro-batch of
    programme rows is compared with the portfolio and handed to ``write``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(Linkage(batch, portfolio, aliases).candidates(), batch_id)
    return run
