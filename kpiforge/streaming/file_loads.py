"""Per-file staging loads as a Structured Streaming job (O-01 + O-05 + O-06).

Source files land in a folder; a file stream picks up each new file exactly
once (the stream's checkpoint records processed files), applies the file's
contract -- columns selected by name, NA tokens to NULL, typed with
``try_cast`` -- stamps lineage (``_source_file`` from the file metadata) and
appends to a parquet staging table partitioned by ``_source_file``.  Running
it again with the same checkpoint adds nothing: the reload is idempotent by
construction, without a delete step.

``trigger(availableNow=True)`` processes what has landed and stops, so the
same code serves scheduled batch loads and a continuously running stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import row_md5
from ..sources.contracts import Contract
from ..sources.staging import _typed


def read_landing(spark: SparkSession, landing_dir: str, contract: Contract,
                 file_columns: Sequence[str], max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of typed contract rows from CSV files with header ``file_columns``.

    A streaming CSV needs its schema up front and binds it by position, so
    the file's full header is given and checked against each file's header
    (``enforceSchema=false``); the contract's columns are then picked by name.
    """
    missing = [c for c in contract.names if c not in file_columns]
    if missing:
        raise ValueError(f"file columns lack contracted columns {missing}")
    schema = ", ".join(f"`{c}` string" for c in file_columns)
    reader = (spark.readStream.schema(schema).option("header", "true")
              .option("enforceSchema", "false").option("escape", '"')
              .option("multiLine", str(contract.multiline).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.csv(landing_dir)
    typed = raw.select(*[_typed(c, t) for c, t in contract.columns],
                       F.col("_metadata.file_name").alias("_source_file"))
    return typed.withColumns({
        "_ingested_at": F.current_timestamp().cast("timestamp_ntz"),
        "_row_md5": row_md5(contract.hash_fields),
    })


def start_staging_stream(spark: SparkSession, landing_dir: str, contract: Contract,
                         file_columns: Sequence[str], table_path: str,
                         checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Append newly landed files to the staging table; returns the query."""
    stream = read_landing(spark, landing_dir, contract, file_columns)
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_location)
         .partitionBy("_source_file"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_path)
