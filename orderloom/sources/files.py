"""File and database sources and sinks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions import text
from orderloom.operators import clean as cleaning
from orderloom.operators import eco, messages
from orderloom.session import materialise

# ---- reading ---------------------------------------------------------------


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Nested events, one JSON object per line, with a declared schema (no inference pass)."""
    return spark.read.schema(schemas.RAW).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the file they came from, for tolerant parsing."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_json_tolerant(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """Nested events from the valid lines only; blank and broken lines are skipped.

    ``counts`` receives how many lines were sent, blank and invalid, in the pass that reads them for the first time.
    """
    lines = messages.observe_lines(read_lines(spark, path), counts or Observation())
    good = lines.where((F.length("line") > 0) & F.col("valid"))
    return good.select(F.from_json("line", schemas.RAW).alias("e")).select("e.*")


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """The clean set from CSV: columns matched by header name, cast to their declared types."""
    rows = spark.read.option("header", True).csv(path)
    return cleaning.typed(rows.select(*[f.name for f in schemas.CLEAN.fields if f.name in rows.columns]), schemas.CLEAN)


def read_existing_clean(spark: SparkSession, parquet_path: str, csv_path: str | None = None) -> DataFrame | None:
    """The stored clean set: Parquet if there, else CSV, else None."""
    if exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    if csv_path and exists(spark, csv_path):
        return read_clean_csv(spark, csv_path)
    return None


#: Bytes read from a file at a time until its first line is whole.
HEAD_BYTES = 1 << 16


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """What Python needs to open a file that Spark lists; raises for file systems that only Spark knows."""
    if path.startswith(("file:", "/")):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for path in batch.column("path").to_pylist():
            fs, name = _opened(path)
            data = b""
            with fs.open_input_stream(name) as stream:
                while b"\n" not in data and (more := stream.read(HEAD_BYTES)):
                    data += more
            lines.append(data.partition(b"\n")[0].decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(lines, pa.string())], ["file", "header"])


def file_heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, header)``: the first line of each file, written to the shared folder.

    Tasks open the files and read a piece from their start, so the cost follows the number of files and not their size.  This is the one place
    outside the optional part where rows pass through Python.  Where Python cannot open the file system, Spark's reader finds
    the first lines, which reads the files' first splits.
    """
    Path = spark._jvm.org.apache.hadoop.fs.Path
    named = [(Path(p).toUri().toString(), p) for p in paths]
    try:
        _opened(paths[0])
    except (ValueError, OSError, pa.ArrowException):
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("header")
        )
        first = lines.where(F.col("at") == 0).withColumn("no", F.monotonically_increasing_id())
        heads = first.groupBy("file").agg(F.min_by("header", "no").alias("header"))
    else:
        tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
        heads = spark.createDataFrame(named, "file string, path string").repartition(tasks).mapInArrow(_first_lines, "file string, header string")
    return materialise(heads.select(_plain_uri(F.col("file")).alias("file"), text.strip(F.col("header")).alias("header")), "heads")


def _plain_uri(uri: Column) -> Column:
    """Spark and Hadoop write one location with more or fewer slashes."""
    return F.regexp_replace(uri, ":/+", ":/")


def read_run_logs(spark: SparkSession, pattern: str) -> DataFrame:
    """Run logs whose headers differ from file to file.

    One CSV read over files with different headers would fill columns by position, so each line is parsed by the header of its own file.
    The driver receives the distinct headers (as many as the format had versions), not one per file, and all files are read in one scan.  Files
    without a usable header are skipped; if none is left the call fails.  Lines that repeat the header are no data.
    """
    paths = list_files(spark, pattern)
    if not paths:
        raise FileNotFoundError(f"no files match {pattern}")
    heads = file_heads(spark, paths).where(F.col("header").contains(","))
    kinds = sorted(r["header"] for r in heads.select("header").distinct().collect())
    if not kinds:
        raise ValueError("no readable run log")
    parsed, columns = {}, []
    for header in kinds:
        names = [h.strip().strip('"') for h in header.split(",")]
        schema = ", ".join(f"`{n}` string" for n in names)
        current = {eco.COLUMN_ALIASES.get(n, n): n for n in names}
        parsed[header] = (F.from_csv("value", F.lit(schema)), current)
        columns += [c for c in current if c not in columns]

    def row(header: str) -> Column:
        fields, current = parsed[header]
        value = lambda p, c: p[current[c]] if c in current else F.lit(None).cast("string")
        return F.transform(F.array(fields), lambda p: F.struct(*[value(p, c).alias(c) for c in columns]))

    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("__source_file"), F.monotonically_increasing_id().alias("__line")
    )
    located = lines.withColumn("file", _plain_uri(F.col("__source_file")))
    # Heads are a written table of a row per file: Spark broadcasts it if its true size allows.
    placed = located.join(heads, "file")
    data = placed.where((text.strip(F.col("value")) != F.col("header")) & (F.length(text.strip(F.col("value"))) > 0))
    by_header = reduce(lambda done, h: done.when(F.col("header") == h, row(h)), kinds[1:], F.when(F.col("header") == kinds[0], row(kinds[0])))
    return data.select("__source_file", "__line", F.inline(by_header)).select(*columns, "__source_file", "__line")


#: Rows up to which a database table is read by one task.
SMALL_TABLE = 1_000_000


def require_partitioning(rows: int, table: str, small: int = SMALL_TABLE) -> None:
    if rows > small:
        raise ValueError(f"{table} has {rows} rows; name a partition column and its bounds to read it in parallel")


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """A database table, in parallel range reads over a numeric or time column.

    Without a column and its bounds the table would be one task's work, however large: that is refused above
    ``SMALL_TABLE`` rows, which a count in the database tells (a query in ``table`` counts as its own result).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if not (partition_column and bounds):
        rows = int(spark.read.format("jdbc").option("url", url).option("query", f"SELECT count(*) AS n FROM {table}").options(**options).load().first()[0])
        require_partitioning(rows, table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


# ---- writing ---------------------------------------------------------------


def export_clean(df: DataFrame, root: str) -> dict[str, str]:
    """Copies of the clean set as CSV, Parquet and JSON lines (ISO times) in a new folder.

    The source frame is evaluated once: CSV and JSON are written from the Parquet copy.
    """
    paths = {kind: f"{root}/{kind}" for kind in ("parquet", "csv", "jsonl")}
    df.write.parquet(paths["parquet"])
    stored = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    stored.write.option("header", True).csv(paths["csv"])
    stored.write.json(paths["jsonl"])
    return paths


def write_features(df: DataFrame, root: str, csv: bool = True) -> None:
    """A feature set with its target, as Parquet and optionally CSV."""
    df.write.mode("overwrite").parquet(f"{root}/parquet")
    if csv:
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/parquet")
        stored.write.mode("overwrite").option("header", True).csv(f"{root}/csv")


def write_document(df: DataFrame, path: str) -> None:
    """A one-row report as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small aggregated report as CSV."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_text(spark: SparkSession, content: str, path: str) -> None:
    """A short rendered text."""
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_table_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


def publish(payload: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) rows to a broker topic with full acknowledgement."""
    (
        payload.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .save()
    )


# ---- paths (any file system the cluster can reach) ---------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds, if it is there."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def read_small(spark: SparkSession, path: str) -> str:
    """The whole text of a small file, such as a marker."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, content: str, path: str) -> None:
    """A small file that appears under its name only when it is whole."""
    p, fs = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    stream = fs.create(draft)
    stream.write(bytearray(content.encode()))
    stream.close()
    if not fs.rename(draft, p):
        raise OSError(f"cannot put {path} in place")


def state(spark: SparkSession, path: str) -> tuple:
    """What tells whether anything under a folder changed: its entries with times and sizes, and its size in all."""
    p, fs = _fs(spark, path)
    entries = sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in fs.listStatus(p))
    whole = fs.getContentSummary(p)
    return (*entries, whole.getFileCount(), whole.getLength())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob, sorted by name."""
    p, fs = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return sorted(s.getPath().toString() for s in found if s.isFile())


def list_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

