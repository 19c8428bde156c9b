"""Incremental import as a Structured Streaming job.

A saved import job that remembers its last value becomes a file-source
stream with a checkpoint: each run picks up the files that landed since the
previous run (the checkpoint is the remembered state), writes them once
(the sink's commit log makes the output exactly-once), and stops
(``trigger(availableNow=True)``).  Executor loss is covered by the
checkpoint: a failed batch is re-planned from the same offsets.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_available_now(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_dir: str,
    checkpoint_dir: str,
    *,
    source_format: str = "parquet",
    target_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> int:
    """Process everything new under ``source_dir`` and stop.

    Waits until the last batch is committed, however long that takes.  Returns
    the number of micro-batches committed by this run.
    ``max_files_per_trigger`` bounds the size of one micro-batch when a large
    backlog has landed.
    """
    before = committed_batches(spark, checkpoint_dir)
    reader = spark.readStream.schema(schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (
        reader.load(source_dir)
        .writeStream.format(target_format)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target_dir)
    )
    try:
        query.awaitTermination()  # raises if the query failed
    finally:
        if query.isActive:
            query.stop()
    return committed_batches(spark, checkpoint_dir) - before


def run_remembered(source: DataFrame, target_dir: str, state_dir: str, check_column: str, *, unique: bool = True) -> int:
    """One run of a saved import job that remembers the last value of its check column.

    Appends the rows of ``source`` above the remembered value and remembers their
    largest.  Files may land again, under the same or other names: rows up to the
    remembered value are never taken twice, and the filter reaches the scan, so old
    row groups are skipped by their statistics.  ``unique`` keeps one row per value
    when a value arrives twice within one run.

    Each run has a number.  Its rows replace whatever a broken run of that number
    left in its folder, and only then is its value written, so a run that was
    lost half-way is done again and nothing is imported twice.  Returns how many runs
    the job has behind it.
    """
    spark = source.sparkSession
    kind = source.schema[check_column].dataType.simpleString()
    state = _state(spark, state_dir, kind)
    runs, last = (state["runs"], state["last"]) if state is not None else (0, None)
    rows = source.where(F.col(check_column).isNotNull())
    if last is not None:
        rows = rows.where(F.col(check_column) > F.lit(last))
    if unique:
        rows = rows.dropDuplicates([check_column])
    folder = f"{target_dir}/run={runs}"
    rows.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(source.schema).parquet(folder)
    found = written.agg(F.max(check_column).alias("last"))
    known = F.greatest(F.col("last"), F.lit(last).cast(kind)) if last is not None else F.col("last")
    found.select(F.lit(runs + 1).alias("runs"), known.cast(kind).alias("last")).coalesce(1).write.mode("overwrite").parquet(f"{state_dir}/after={runs}")
    return runs + 1


def _state(spark: SparkSession, state_dir: str, kind: str):
    """The number of runs and the last value, from the newest complete state; None before the first run."""
    try:
        states = spark.read.schema(f"runs int, last {kind}").parquet(state_dir)
        return states.select("runs", "last").orderBy(F.col("runs").desc()).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_remembered(spark: SparkSession, target_dir: str, schema: T.StructType) -> DataFrame:
    """All rows the runs of a saved import have appended."""
    return spark.read.schema(schema).option("basePath", target_dir).option("recursiveFileLookup", "true").parquet(target_dir)


def committed_batches(spark: SparkSession, checkpoint_dir: str) -> int:
    """Micro-batches committed under a checkpoint so far.

    The commit log names each batch by its number from 0.  Spark keeps only
    the latest entries, but the highest number stays among them.
    """
    try:
        log = spark.read.format("binaryFile").load(f"{checkpoint_dir}/commits").select("path")
        number = F.regexp_extract("path", r"/(\d+)$", 1).try_cast("long")
        last = log.agg(F.max(number)).first()[0]
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return 0 if last is None else last + 1


def read_target(spark: SparkSession, target_dir: str, target_format: str = "parquet") -> DataFrame:
    """The imported rows (only files committed by the sink's log)."""
    return spark.read.format(target_format).load(target_dir)
