"""What the operators of this package share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.storage import scratch_path

# A word is a run of bytes other than the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors.

    ``files`` bounds the number of files of a frame that is small by construction.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(names: list[str]) -> list[Column]:
    """Columns by their literal names, which may hold dots."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def as_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows no model may learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, text: str = "text") -> DataFrame:
    """At most ``limit`` training rows ``(_text, _label)``, the same ones each time.

    Only rows outside the held-out third that have a label are eligible, and of
    those the ones whose ids have the smallest hashes. The bound on the ids is
    what allows broadcasting them. Of rows that share an id the one with the
    smallest hash of its text stands for the id.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("hash"), F.col("_text").alias("text"))).alias("row"))
    return texts.select(F.col("row.text").alias("_text"), "_label")


def join_key(*names: str) -> Column:
    """Columns as one join key that no earlier aggregate has partitioned by.

    A side that was aggregated by the plain columns would share its shuffle with
    the join, and adaptive execution does not split hot keys of a shared shuffle.
    """
    return F.struct(*names)


ROW = ("__row_file", "__row_at")


def with_rows(df: DataFrame) -> DataFrame:
    """Name each row by its file and place there (``ROW``); a frame that is no scan is written out first.

    Files never change, so the names survive retries and a second scan.
    """
    try:
        return df.select("*", F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))
    except AnalysisException:
        return with_rows(materialise(df, "rows"))


def n_words(text: str | Column = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, group: str, order: list[str], value: str, name: str = "prefix") -> DataFrame:
    """Add the sum of ``value`` over a row and all rows before it in its group.

    Rows are dealt by range over (group, order), so a group with a third of all
    rows is spread like any other; the sums of whole ranges are then carried
    over to later ranges, one row per range and group. ``order`` should tell
    all rows apart, since equal rows stay in one range. Add exact numbers, not
    floating-point ones, and the result depends on no partitioning.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, group, *order).withColumn("_range", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = dealt.groupBy(F.col(group).alias("_group"), "_range").agg(F.sum(value).alias("_total"))
    carried = carried.select("_group", F.col("_range").alias("_of"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"))
    within = Window.partitionBy(group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("_own", F.sum(value).over(within))
    joined = summed.join(carried, (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(name, F.col("_own") + F.col("_carried")).drop("_range", "_own", "_of", "_group", "_carried")
