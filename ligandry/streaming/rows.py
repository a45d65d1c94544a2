"""Row-local stages on streams, and a vocabulary that grows batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import tokenize
from ..operators.assays import AssayParams, assay_filter, standardise
from ..operators.vocabulary import Vocabulary


def standardised(stream: DataFrame, p: AssayParams) -> DataFrame:
    """Filter, label and tokenise; no state, so every record passes at once."""
    return standardise(assay_filter(stream, p), p).withColumn("tokens", tokenize(F.col(p.smiles_column)))


def grow_vocabulary(stream: DataFrame, vocabulary: Vocabulary, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Add the tokens of each micro-batch to vocabulary, in code-point order; then sees the batch. A repeated batch adds nothing."""

    def each(batch: DataFrame, number: int) -> None:
        vocabulary.update(sorted(r.t for r in batch.select(F.explode("tokens").alias("t")).distinct().collect()))
        if then:
            then(batch, number)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
