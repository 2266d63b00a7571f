"""Incremental scoring: the prediction sink (A5) over a file stream.

A fitted ``PipelineModel`` is a stateless per-row transform, so it applies
to a streaming DataFrame unchanged. Progress and the exactly-once file sink
log live under the shared checkpoint folder, so a restarted query (or one
that lost executors) resumes where it stopped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hearth.functions.scalar import expm1
from hearth.session import checkpoint_dir


def score_stream(spark: SparkSession, model, source_dir: str, schema: StructType,
                 out_dir: str, *, id_cols: Sequence[str], fmt: str = "parquet",
                 back_transform: bool = True, out_col: str = "prediction",
                 query_name: str = "hearth_scoring", available_now: bool = True,
                 checkpoint: str | None = None,
                 options: dict[str, str] | None = None) -> StreamingQuery:
    """Score every new ``fmt`` file in ``source_dir`` and append the
    predictions to ``out_dir``.

    ``schema`` is required (no inference on a stream); CSV files are read
    with a header row unless ``options`` says otherwise. With
    ``available_now`` the query drains what is present and stops; without
    it the query keeps running until stopped.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    stream = spark.readStream.schema(schema).format(fmt).options(**opts).load(source_dir)
    scored = model.transform(stream)
    pred = expm1("prediction") if back_transform else scored["prediction"]
    out = scored.select(*id_cols, pred.alias(out_col))
    writer = (out.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", ckpt).queryName(query_name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(out_dir)
