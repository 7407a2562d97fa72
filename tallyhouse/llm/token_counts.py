"""Token counts: batches of about equal bytes through the encoder, of which only lengths come back.

Spark splits the scan by bytes.  Inside a task the texts of an Arrow batch are cut at safe places into pieces and
the pieces are dealt into encoder batches of about `batch_bytes`, so that one long text costs neither a large
batch nor a large list of ids.  No shuffle is needed, and a lost task is repeated from its own input split.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows; an empty table gives
an empty table; other columns of the input are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import vocabulary
from tallyhouse.llm.texts import whole


def lengths(texts: Iterable[str], ranks: str | None, batch_bytes: int, piece_chars: int) -> list[int]:
    """Tokens of each text."""
    encoder = vocabulary.encoder(ranks)
    totals: list[int] = []
    pieces: list[str] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        for owner, ids in zip(owners, encoder.encode_batch(pieces, num_threads=1, allowed_special="all"), strict=True):
            totals[owner] += len(ids)
        pieces.clear()
        owners.clear()

    for owner, text in enumerate(texts):
        totals.append(0)
        for piece in vocabulary.safe_pieces(text, piece_chars):
            pieces.append(piece)
            owners.append(owner)
            size += len(piece)
            if size >= batch_bytes:
                flush()
                size = 0
    if pieces:
        flush()
    return totals


def count_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks: str | None = None,
    batch_bytes: int = 1 << 19,
    piece_chars: int = 1 << 16,
) -> DataFrame:
    """Key, `n_bytes` and `n_tokens` of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = lengths((text.as_py() for text in batch.column(2)), ranks, batch_bytes, piece_chars)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64())], names=["key", "n_bytes", "n_tokens"]
            )

    texts = docs.select(
        F.col(key).alias("key"), F.octet_length(whole(text)).cast("long").alias("n_bytes"), whole(text).alias("text")
    )
    fields = [texts.schema["key"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return texts.mapInArrow(count, T.StructType(fields)).withColumnRenamed("key", key)
