"""Streaming change audit (U3): change-event files in, audit-log rows out.

Structured Streaming reads new event files as they arrive; ``foreachBatch``
turns each micro-batch into log rows, using a per-key state (the last
operation and image of every key) for the old image of a key's first change
in the batch.  The log is appended by batch id and replaces what that id has
written before; the state is versioned by batch id and rewrites only the
buckets that the batch touches (``key_state``).  A batch replayed after a
failure therefore has the effect of one, and the stream's own checkpoint lives
in the shared checkpoint folder of the cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import LOG_COLUMNS
from ..operators.sequence import previous_by_key
from ..plans import cdc
from ..session import checkpoint_dir
from ..sources import catalog
from ..sources.catalog import append_log
from .key_state import KeyState


def _batch_log(batch: DataFrame, state: DataFrame | None):
    """Log rows of one micro-batch, and the state rows of its buckets after it
    (``state``: the rows of these buckets before it)."""
    ev = batch.select(cdc.KEY, *cdc.ORDER, cdc.event_op().alias("_op"),
                      cdc.event_image(batch).alias("_image"), F.lit(1).alias("_grp"))
    # Only the state of keys present in this batch takes part in the log.
    touched = None if state is None else state.select(*ev.columns).join(
        ev.select(cdc.KEY).distinct(), cdc.KEY, "left_semi")
    rows = ev if touched is None else touched.unionByName(ev)
    prev = previous_by_key(rows, cdc.KEY, ["_grp", *cdc.ORDER], ["_op", "_image"])
    old = F.when(F.col("prev__op").isNotNull() & (F.col("prev__op") != "D"), F.col("prev__image"))
    log = (prev.filter(F.col("_grp") == 1).select(
        F.lit(cdc.AUDITED_TABLE).alias("tabela_afetada"), F.col("_op").alias("operacao"),
        F.expr("current_user()").alias("usuario_db"), F.current_timestamp().alias("data_hora"),
        F.when(F.col("_op") != "I", old).alias("dados_antigos"),
        F.when(F.col("_op") != "D", F.col("_image")).alias("dados_novos")))
    # New state: each key's latest row; state rows sort before batch rows.
    both = ev if state is None else state.select(*ev.columns).unionByName(ev)
    latest = both.groupBy(cdc.KEY).agg(F.max_by(F.struct(*ev.columns), F.struct("_grp", *cdc.ORDER)).alias("_s"))
    updated = latest.select(*[F.col(f"_s.{c}").alias(c) for c in ev.columns]).withColumn("_grp", F.lit(0))
    return log, updated


def audit_stream(spark: SparkSession, source_dir: str, log_path: str, state_path: str | None = None,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                 glob: str | None = None, available_now: bool = True, buckets: int = 64) -> StreamingQuery:
    """Start the audit stream over the event files in ``source_dir``.

    ``available_now`` processes what is there and stops (batch-like runs and
    tests); otherwise it keeps polling.  ``buckets``: of the key state, fixed by
    the first batch (some MB of state a bucket).  Returns the StreamingQuery."""
    checkpoint = checkpoint or f"{checkpoint_dir(spark)}/streams/audit-{uuid.uuid4().hex[:8]}/checkpoint"
    # The key state belongs to the stream: a restart from the same checkpoint
    # finds it again.
    state_path = state_path or f"{checkpoint.rstrip('/')}-state"
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    schema = reader.parquet(source_dir).schema
    sr = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        sr = sr.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        sr = sr.option("pathGlobFilter", glob)
    stream = sr.parquet(source_dir)

    keys = KeyState(spark, state_path, cdc.KEY, buckets)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # A missing or unreadable manifest fails the batch: old images would be lost.
        touched = keys.touched(batch, batch_id)
        log, state = _batch_log(batch, keys.read(batch_id - 1, touched) if batch_id > 0 else None)
        append_log(log, log_path, batch_id)
        keys.write(state, batch_id, touched)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_log(spark: SparkSession, log_path: str, with_meta: bool = False) -> DataFrame:
    df = catalog.read_log(spark, log_path)
    return df.select(*[c for c in LOG_COLUMNS if with_meta or c not in ("usuario_db", "data_hora")])


def run_in_batches(spark: SparkSession, events: DataFrame, batches: int = 4) -> DataFrame:
    """The log of a stream that is stopped and started again: the events arrive
    in ``batches`` equal spans of time, each delivered (as any number of files)
    and processed before the next, from one checkpoint."""
    base = f"{checkpoint_dir(spark)}/streams/feed-{uuid.uuid4().hex[:8]}"
    at, kind = cdc.ORDER[0], events.schema[cdc.ORDER[0]].dataType
    low, high = events.agg(F.min(at), F.max(at)).first()
    bounds = [low + (high - low) * k / batches for k in range(1, batches)] if low is not None else []
    for after, until in zip([None, *bounds], [*bounds, None]):
        part = events
        if after is not None:
            part = part.filter(F.col(at) > F.lit(str(after)).cast(kind))
        if until is not None:
            part = part.filter(F.col(at) <= F.lit(str(until)).cast(kind))
        part.write.mode("append").parquet(f"{base}/events")
        audit_stream(spark, f"{base}/events", f"{base}/log", checkpoint=f"{base}/checkpoint",
                     max_files_per_trigger=None).awaitTermination()
    return read_log(spark, f"{base}/log")


def run_audit_stream(spark: SparkSession, source_dir: str, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream to completion (available-now) and return its log."""
    log_path = f"{checkpoint_dir(spark)}/streams/log-{uuid.uuid4().hex[:8]}"
    q = audit_stream(spark, source_dir, log_path, glob=glob, max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    return read_log(spark, log_path)
