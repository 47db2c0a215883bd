"""The stateless part of the decode on a stream.

Length checks, lookups and decoding need no state, so the batch operators run
unchanged; forward fill and numbering stay batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from byteloom.operators.catalog import FieldCatalog
from byteloom.operators.decode import decode_long


def decode_stream(messages: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Streaming messages(family, model_year, message, hex, ...) to field rows."""
    return decode_long(messages, catalog)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to Parquet files, exactly once, then stop."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
