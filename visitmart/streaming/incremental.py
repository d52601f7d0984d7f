"""Incremental runs: new source files to Bronze, Bronze to Silver, Silver to Gold.

Each is a file stream run until nothing is left (``availableNow``). The checkpoint, which
lists the files already taken, is committed after the batch is written: a crash in
between repeats the batch, and every write here can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators.final import driver_summary, model_dataset, reason_summary
from visitmart.operators.gold import assemble, doctor_mart
from visitmart.operators.shape import ensure_columns, rows_after
from visitmart.operators.silver import latest_silver, to_silver
from visitmart.session import shuffles_dropped
from visitmart.sources import sinks
from visitmart.sources.buckets import BucketStore, touched_buckets
from visitmart.sources.files import number_rows, read_silver, read_silver_tables, read_table, read_visits_csv
from visitmart.sources.paths import PACKED, has_files, remove
from visitmart.streaming.gold_state import apply_changes
from visitmart.streaming.quality_state import add_batch, run_report

# Raw rows of one hash differ in their content only, so its digest makes the order total.
CONTENT = "_content"
SOURCE_ROW = "_source_row"
BRONZE_ORDER = ["_airbyte_emitted_at", CONTENT]


@dataclass(frozen=True)
class Layout:
    """Where the stages live. ``now`` is the ISO time in UTC given to everything written in this run.

    ``max_files`` bounds the source files of one batch, so that a large backlog is worked off in steps; a batch on the way
    to Silver has the Bronze files that such a batch made, however many rows a file holds. ``buckets`` is how many parts by hash Silver and the marts have; choose
    it so that a bucket is about a task's work.
    """

    source: str
    root: str
    now: str
    stream: str = "ehr_visits"
    max_rows: int = 5000
    max_files: int = 10_000
    order: tuple[str, ...] = tuple(BRONZE_ORDER)
    extra: tuple[str, ...] = ()
    required: tuple[str, ...] = tuple(S.QUALITY_COLUMNS)
    buckets: int = 16

    @property
    def silver_order(self) -> list[str]:
        """Order among stored Silver rows of one hash: total, so batch sizes do not matter."""
        return ["processed_at_utc", *self.order]

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.stream}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.stream}"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality/{self.stream}"

    @property
    def quality_state(self) -> str:
        """The counts of a run while it goes on."""
        return f"{self.root}/quality_state/{self.stream}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def mart(self, name: str) -> str:
        return f"{self.gold}/{name}"

    def final(self, name: str) -> str:
        return f"{self.root}/final/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def adaptive(batch: DataFrame) -> None:
    """Turn adaptive execution on for the work on one batch.

    A stream's session has it off; the joins and writes on a batch are queries of their own and need it
    for right-sized partitions and skewed keys.
    """
    batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def batch_step(work: Callable[[DataFrame, int, Layout], None], layout: Layout) -> Callable[[DataFrame, int], None]:
    """``work`` on a batch and its number, for ``foreachBatch``; shuffle files go with each of its queries."""

    def run(batch: DataFrame, number: int) -> None:
        with shuffles_dropped(batch.sparkSession):
            work(batch, number, layout)

    return run


def write_bronze_batch(batch: DataFrame, number: int, layout: Layout) -> None:
    """Wrap the rows of one batch of source files, at most ``max_files`` paths."""
    adaptive(batch)
    paths = [row["path"] for row in batch.select("path").collect()]
    if not paths:
        return
    columns = S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS + list(layout.extra)
    source = read_visits_csv(batch.sparkSession, paths, S.text_schema(columns)).select(columns)
    rows = sinks.to_raw_envelope(source, layout.stream, layout.now)
    day, hour = layout.now[:10], layout.now[11:13]
    (
        rows.write.options(**PACKED)
        .option("maxRecordsPerFile", layout.max_rows)
        .mode("overwrite")
        .parquet(f"{layout.bronze}/load_date={day}/load_hour={hour}/batch={number:06d}")
    )


def sync_new_files(spark: SparkSession, layout: Layout) -> int:
    """Wrap the rows of new source CSV files and append them to Bronze. Returns the rows in Bronze.

    Files may have any header that holds contract columns, each its own: columns are matched by name and absent
    ones added as missing. A batch has a folder of its own, so a repeated batch adds nothing.
    """
    query = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", layout.max_files)
        .load(layout.source)
        .select("path")  # the content is not read here
        .writeStream.foreachBatch(batch_step(write_bronze_batch, layout))
        .option("checkpointLocation", layout.checkpoint("bronze"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_table(spark, layout.bronze).count() if has_files(spark, layout.bronze) else 0


def sync_rows_after(spark: SparkSession, layout: Layout, order: str) -> int:
    """Append the rows of one growing source beyond the last ``order`` number in Bronze. Returns their number.

    Bronze itself is the state, so there is none to fall out of step with it. A source
    cut short has no rows beyond the last number, and gives none.
    """
    schema = S.text_schema(S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS + [order])
    source = read_visits_csv(spark, layout.source, schema).withColumn(order, F.col(order).cast("long"))
    return _append_after(spark, layout, source, order)


def sync_row_offsets(spark: SparkSession, layout: Layout, parts: bool = False) -> int:
    """Append the rows of one growing CSV file beyond those in Bronze, by their place in the file. Returns their number.

    The file needs no order column. The place is kept in Bronze as ``_source_row``, which is the only state: a file
    cut short gives no rows, and a run after a crash takes up where the rows in Bronze end. A file too large for
    one writer may lie in a folder of ``parts``, which follow each other by name.
    """
    schema = S.text_schema(S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS)
    source = number_rows(spark, layout.source, schema, SOURCE_ROW, parts).select(*schema.names, SOURCE_ROW)
    return _append_after(spark, layout, source, SOURCE_ROW)


def _append_after(spark: SparkSession, layout: Layout, source: DataFrame, order: str) -> int:
    last = None
    if has_files(spark, layout.bronze):
        last = read_table(spark, layout.bronze).agg(F.max(order)).first()[0]
    fresh = rows_after(source, order, last)
    count = fresh.count()
    if count:
        rows = sinks.to_raw_envelope(fresh, layout.stream, layout.now)
        sinks.write_bronze(rows, layout.bronze, layout.now, layout.max_rows)
    return count


def write_silver_batch(batch: DataFrame, number: int, layout: Layout) -> None:
    """Silver tables of one batch of Bronze rows, and its share of the run's quality report."""
    adaptive(batch)
    files = batch.select(F.input_file_name().alias("path"))
    add_batch(
        batch.sparkSession, layout.quality_state, to_silver(batch, layout.now), files, number, list(layout.required), layout.buckets
    )
    # Silver takes nothing else from the envelope, whose JSON copy is larger than the row.
    rows = batch.withColumn(CONTENT, F.sha2("_airbyte_data", 256)).drop("_airbyte_ab_id", "_airbyte_stream", "_airbyte_data")
    latest = latest_silver(rows, layout.now, list(layout.order))
    sinks.write_wide_silver(
        latest, layout.silver, layout.now[:10], number, carried=list(layout.order), buckets=layout.buckets
    )


def report_quality(spark: SparkSession, layout: Layout) -> None:
    """Write the report of the batches since the last one, and drop their counts.

    Those are this run's, and any of a run that ended before its report; no batch is in two reports.
    """
    report = run_report(spark, layout.quality_state, list(layout.required), layout.now)
    if report is not None:
        sinks.write_report(report, f"{layout.quality}/run={layout.now.replace(':', '.')}")
        remove(spark, layout.quality_state)


def files_per_step(spark: SparkSession, layout: Layout) -> int:
    """The most Bronze files made of one batch of source files; at least ``max_files``.

    A source file gives a Bronze file for every ``max_rows`` rows. Counted in Bronze files, the number of batches would grow
    with the rows, and every batch has a fixed cost.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(layout.bronze)
    )
    made = files.select(F.regexp_extract("path", r"^(.*/batch=\d+)/", 1).alias("step")).where("step <> ''")
    most = made.groupBy("step").count().agg(F.max("count")).first()[0]
    return max(layout.max_files, most or 0)


def bronze_to_silver(spark: SparkSession, layout: Layout) -> int:
    """Clean and complete the Bronze files not processed yet. Returns the rows of the core table."""
    if not has_files(spark, layout.bronze):
        return 0
    schema = S.bronze_schema(layout.extra)
    query = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_step(spark, layout))
        .parquet(layout.bronze)
        .writeStream.foreachBatch(batch_step(write_silver_batch, layout))
        .option("checkpointLocation", layout.checkpoint("silver"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    report_quality(spark, layout)
    core = f"{layout.silver}/visits_core"
    return read_table(spark, core).count() if has_files(spark, core) else 0


def merge_touched(batch: DataFrame, layout: Layout) -> None:
    """Rebuild the visits whose hash appears in any new file, from all of Silver, and merge them into the marts.

    Taking all of Silver for them means that a part file may come before or after its core file. Only the buckets
    of those hashes are read, in Silver and in the marts. Where there is no mart yet, all of Silver is taken.
    """
    adaptive(batch)
    spark = batch.sparkSession
    touched = batch.select("record_hash").distinct()
    rebuild = not BucketStore(spark, layout.gold).has("doctor")
    if rebuild:
        tables, only = read_silver_tables(spark, layout.silver), None
    else:
        numbers = touched_buckets(touched, ["record_hash"], layout.buckets)
        tables, only = read_silver_tables(spark, layout.silver, (numbers, layout.buckets)), touched
    silver = assemble(tables, layout.silver_order, only)
    if silver is not None:
        apply_changes(spark, layout.gold, doctor_mart(silver), layout.buckets, rebuild)


def silver_to_gold(spark: SparkSession, layout: Layout) -> int:
    """Merge new Silver files into the marts; rebuild from all of Silver if there is no mart. Returns its rows."""
    if not has_files(spark, layout.silver):
        return 0
    query = (
        spark.readStream.schema(S.text_schema(["record_hash"]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(layout.silver)
        .writeStream.foreachBatch(batch_step(lambda batch, _, where: merge_touched(batch, where), layout))
        .option("checkpointLocation", layout.checkpoint("gold"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    mart = sinks.read_mart(spark, layout.mart("doctor"))
    if mart is None:
        silver = read_silver(spark, layout.silver, layout.silver_order)
        if silver is None:
            return 0
        apply_changes(spark, layout.gold, doctor_mart(silver), layout.buckets, rebuild=True)
        mart = sinks.read_mart(spark, layout.mart("doctor"))
    return mart.count() if mart is not None else 0


def export_final(spark: SparkSession, layout: Layout) -> int:
    """Model dataset and both summaries as CSV. The summaries read the dataset as stored."""
    silver = read_silver(spark, layout.silver, layout.silver_order)
    if silver is None:
        return 0
    stored = f"{layout.final('model_dataset')}_parquet"
    with shuffles_dropped(spark):
        model_dataset(silver).write.options(**PACKED).mode("overwrite").parquet(stored)
        model = spark.read.parquet(stored)
        sinks.write_csv(model, layout.final("readmission_model_dataset"))
        sinks.write_csv(reason_summary(model), layout.final("readmission_reason_summary"))
        sinks.write_csv(driver_summary(model), layout.final("readmission_driver_summary"))
        return model.count()


def run_all(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Every stage in order, each with its row count."""
    return {
        "bronze": sync_new_files(spark, layout),
        "silver": bronze_to_silver(spark, layout),
        "gold": silver_to_gold(spark, layout),
        "final": export_final(spark, layout),
    }


def complete_source(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """A source frame with all contract columns, as text and in contract order."""
    columns = S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS + list(extra)
    full = ensure_columns(df, S.text_schema(columns))
    return full.select([F.col(name).cast("string").alias(name) for name in columns])
