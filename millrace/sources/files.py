"""CSV, JSON-lines, text, image-folder and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | str | None = None,
    encoding: str = "utf-8",
    null_value: str | None = None,
    header: bool = True,
    infer: bool = True,
    **options,
) -> DataFrame:
    """CSV files (plain or gzip) as one frame.

    Give a schema wherever it is known: to infer one Spark reads the files
    twice.  With neither, every column is text.
    ``cp1252`` files are read as Latin-1, which maps every byte, and the 27
    characters in which the two differ are then put right in the text columns.
    """
    cp1252 = encoding.lower().replace("windows-", "cp") == "cp1252"
    reader = (
        spark.read.option("header", header)
        .option("encoding", "iso-8859-1" if cp1252 else encoding)
        .option("escape", '"')
        .options(**options)
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)).csv(paths)
    return fix_cp1252(df) if cp1252 else df


def fix_cp1252(df: DataFrame) -> DataFrame:
    pairs = []
    for code in range(0x80, 0xA0):
        char = bytes([code]).decode("cp1252", errors="ignore")
        if char:
            pairs.append((chr(code), char))
    seen, meant = "".join(a for a, _ in pairs), "".join(b for _, b in pairs)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.translate(F.col(c), seen, meant) for c in text})


def write_csv(df: DataFrame, path: str, encoding: str = "utf-8", null_value: str = "", **options) -> str:
    """One folder per dataset, replaced as a whole."""
    (
        df.write.mode("overwrite").option("header", True).option("encoding", encoding)
        .option("nullValue", null_value).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .options(**options).csv(path)
    )
    return path


def promote_header(spark: SparkSession, path: str, **options) -> DataFrame:
    """A file whose first data row holds the column names.

    Only the first row is fetched to learn the names; the row itself is then
    left out by value.
    """
    raw = read_csv(spark, path, header=False, infer=False, **options)
    return promote_first_row(raw)


def promote_first_row(raw: DataFrame, first=None) -> DataFrame:
    first = first or raw.first()
    names = [str(v) for v in first]
    same = F.lit(True)
    for c, v in zip(raw.columns, first):
        same = same & F.col(c).eqNullSafe(F.lit(v))
    return raw.filter(~same).toDF(*names)


def read_all(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """Frames under each other by column name; a column missing in one is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


#: Splits whose first line numbers (24 bytes each) may be sent to every executor; 128 MB a split.
MOST_SPLITS = 1 << 20


def read_lines(spark: SparkSession, path: str, most_splits: int = MOST_SPLITS) -> DataFrame:
    """One row per line: path, line (from 0 in its file) and text; a long file is read by many tasks.

    A first scan counts the lines of each split and writes how many come before
    it: one small row a split.  The second scan attaches these numbers where it
    reads, so no line is shuffled.  Beyond ``most_splits`` the lines are joined
    to the index instead.  If the second scan is cut into other splits than the
    first (files or the number of cores have changed), it fails, instead of
    giving wrong numbers.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("text"),
    )
    splits = rows.groupBy("path", "_start").agg(F.min("_id").alias("_first"), F.count("text").alias("_n"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    key = F.xxhash64("path", "_start")
    written = scratch_path(spark, "splits")
    splits.select(key.alias("_key"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                  "_first", "_n").write.parquet(written)
    index = spark.read.parquet(written)
    if index.count() <= most_splits:
        index = F.broadcast(index)
    place = F.col("_id") - F.col("_first")
    known = F.coalesce((place >= 0) & (place < F.col("_n")), F.lit(False))
    moved = F.raise_error(F.lit("the files are cut into other splits than when their lines were counted"))
    return rows.join(index, key == F.col("_key"), "left").select(
        "path", F.when(known, F.col("_id") + F.col("_shift")).otherwise(moved.cast("long")).alias("line"), "text")


def read_labelled_folders(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files below ``root``; the folder a file lies in is its label.

    Path and size come from the listing; ``content`` is read only if selected.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(root)
    )
    return files.withColumn("label", F.element_at(F.split("path", "/"), -2))


def with_class_index(files: DataFrame) -> DataFrame:
    """Class number = position of the label among the sorted labels, from 0.

    Labels are folder names of one tree, so their list is short.
    """
    labels = files.agg(F.array_sort(F.collect_set("label"))).scalar()
    return files.withColumn("class_index", (F.array_position(labels, F.col("label")) - 1).cast("int"))


def segment_report(df: DataFrame, column: str) -> DataFrame:
    """Rows, size and value range of one column per data file."""
    return df.groupBy(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )
