"""Helpers that the training-data operators share.

Intermediate tables that are read more than once go to the shared folder named by
``spark.checkpoint.dir``: a lost executor then costs a re-read, never a recomputation of the
whole lineage, and the size of what was written is known to the optimiser when it plans the
next join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightledger.sources.scratch import fresh_path

#: ASCII white space, as the contracts define it.
WHITE = r"[\x20\x09-\x0D]"
#: A-Z to a-z on UTF-8 bytes; every other byte stays.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, *partition_by: str, within: list[str] | None = None) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back from there.

    ``within`` collects the paths of what a stage writes, for ``dropped``.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    if within is not None:
        within.append(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that a finished step no longer needs."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()


def slices(batches, rows: int = 200):
    """Arrow batches in slices of few rows. Spark bounds a batch by its bytes; this bounds what a worker makes of it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_id(rows: DataFrame, ids: DataFrame, how: str, most: int = 2_000_000) -> DataFrame:
    """Semi or anti join of wide rows with a stored table of ``doc_id``s, which is broadcast where its count is small.

    Up to ``most`` ids (16 MB) the rows stay where they are; beyond, both sides meet in a shuffle.
    """
    return rows.join(F.broadcast(ids) if ids.count() <= most else ids, "doc_id", how)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with null texts as empty ones; other columns are left out."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def numbered(df: DataFrame, *order: Column, only: Column, place: str = "place", count: str = "n_placed") -> DataFrame:
    """Adds the place, from 1, of each row that is ``only`` among all such rows in an order, and how many those are; others have null places.

    The rows are dealt by ranges of the order and sorted within, and written so once; a row's place is its number in its
    part and the sizes of the parts before it, one number for each part. Rows that the order leaves equal are dealt over parts by a number of their own.
    """
    row = F.monotonically_increasing_id()
    kept = F.coalesce(only, F.lit(False))
    keys = [F.col("__only").desc(), *order, F.col("__row")]
    # Dealing by ranges looks at all rows twice, so what made them is not to be done again.
    df = stored(df)
    placed = df.withColumn("__only", kept).withColumn("__row", row).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.drop("__row").withColumns({"__part": F.spark_partition_id(), "__at": row.bitwiseAND(F.lit(2**33 - 1))}))
    sizes = placed.groupBy("__part").agg(F.count_if("__only").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    parts = sizes.select("__part", before.alias("__before"), F.sum("__n").over(Window.partitionBy()).alias(count))
    # A row for each part of a shuffle.
    met = placed.join(F.broadcast(parts), "__part")
    return met.withColumn(place, F.when(F.col("__only"), F.col("__before") + F.col("__at") + 1)).drop("__part", "__at", "__only", "__before")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
