"""Readers. A missing optional input is an empty table; a missing source is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitmart import schema as S
from visitmart.operators.gold import assemble
from visitmart.operators.shape import ensure_columns, table_from_path
from visitmart.sources.buckets import bucket_label
from visitmart.sources.paths import children, exists, has_files

# Texts that mean "missing" in a CSV source.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def blank_missing(df: DataFrame) -> DataFrame:
    """Null for every text that means "missing"."""
    listed = ", ".join(f"'{text}'" for text in MISSING_TEXTS)
    return df.selectExpr(*[f"CASE WHEN `{c}` NOT IN ({listed}) THEN `{c}` END AS `{c}`" for c in df.columns])


def header_groups(spark: SparkSession, paths: str | list[str]) -> list[list[str]]:
    """The files below ``paths``, those with the same header line together. One short row per file is collected."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("place"), "value"
    )
    # A file's first line is the first one of its first block.
    starts = lines.where(F.input_file_block_start() == 0).groupBy("path").agg(F.min_by("value", "place").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in starts.orderBy("path").collect():
        groups.setdefault(row["header"], []).append(row["path"])
    return list(groups.values())


def read_visits_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Visit rows of CSV files with a header line each, every column text.

    Files may have different headers: columns are matched by name, and columns of ``schema`` that a file lacks are added.
    """
    for one in [path] if isinstance(path, str) else path:
        if not exists(spark, one):
            raise FileNotFoundError(f"source CSV not found: {one}")
    wanted = schema or S.source_schema()
    reader = spark.read.option("header", True).option("escape", '"')
    groups = [blank_missing(reader.csv(files)) for files in header_groups(spark, path)]
    if not groups:
        return spark.createDataFrame([], wanted)
    rows = groups[0]
    for more in groups[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return ensure_columns(rows, wanted)


def number_rows(spark: SparkSession, path: str, schema: StructType, number: str, parts: bool = False) -> DataFrame:
    """Rows of one CSV file with a header line, all columns text, and their place in the file as ``number`` (from 1).

    Every split counts its rows, and a split's first number follows from the counts before it: no order column
    is needed and no row moves. One short row per split is collected. With ``parts`` the file lies in a folder of part
    files of one header, which follow each other by name; otherwise several files are an error.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"source CSV not found: {path}")
    read = spark.read.option("header", True).option("escape", '"').csv(path)
    if len(read.inputFiles()) > 1 and not parts:
        raise ValueError(f"row numbers need one file, found several: {path}")
    where = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").cast("string").alias("_split")]
    placed = blank_missing(read.select("*", *where)).withColumn("_place", F.monotonically_increasing_id())
    split = F.col("_split").cast("long")
    counts = placed.groupBy("_path", split.alias("start")).agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("first"))
    shifts, before = [], 0
    for row in counts.orderBy("_path", "start").collect():
        shifts.append((row["_path"], row["start"], before + 1 - row["first"]))
        before += row["n"]
    known = F.broadcast(spark.createDataFrame(shifts, "_file string, _start long, _shift long"))  # one row per split
    inside = (F.col("_path") == F.col("_file")) & (split == F.col("_start"))
    numbered = placed.join(known, inside).withColumn(number, F.col("_place") + F.col("_shift"))
    return ensure_columns(numbered.drop("_path", "_split", "_place", "_file", "_start", "_shift"), schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, form: str = "parquet") -> DataFrame:
    """The table at ``path``, or one without rows if there is none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader.option("header", True) if form == "csv" else reader).format(form).load(path)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """All parquet files under ``root``, at any depth, with the union of their columns."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(root)


def silver_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and table of each data file under ``root``; files of no table are left out."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length")
    )
    name = table_from_path(F.col("path"), root, list(S.SILVER_TABLES))
    return files.withColumn("table_name", name).where("table_name IS NOT NULL")


def read_silver_tables(spark: SparkSession, root: str, only: tuple[list[int], int] | None = None) -> dict[str, DataFrame]:
    """The Silver tables that have files.

    With ``only`` (numbers, of how many buckets) just those buckets' folders are listed and read, besides files that lie
    in no bucket or in buckets of another number.
    """
    found = set(children(spark, root))
    tables = {}
    for table in S.SILVER_TABLES:
        path = f"{root}/{table}"
        if table not in found:
            continue
        if only is None:
            folders = [path]
        else:
            numbers, count = only
            labels = {f"bucket={bucket_label(n, count)}" for n in numbers}
            there = [name for name in children(spark, path) if not name.startswith(("_", "."))]
            folders = [f"{path}/{n}" for n in there if n in labels or not n.endswith(f"of{count:05d}")]
        folders = [folder for folder in folders if has_files(spark, folder)]
        if folders:
            reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
            tables[table] = reader.parquet(*folders)
    return tables


def read_silver(spark: SparkSession, root: str, order: list[str] | None = None) -> DataFrame | None:
    """Silver assembled from its tables; any wide parquet under ``root`` if there is no core table; else None.

    Each table keeps its last row per hash (by processing time unless ``order`` is given).
    """
    tables = read_silver_tables(spark, root)
    if "visits_core" in tables:
        return assemble(tables, order or ["processed_at_utc"])
    return read_table(spark, root) if has_files(spark, root) else None


def read_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """The JSON metrics report flattened to one row; None if there is none."""
    if not exists(spark, path):
        return None
    report = spark.read.option("multiLine", True).json(path)
    return report.selectExpr("metrics.*").selectExpr("*", "confusion_matrix.*").drop("confusion_matrix")
