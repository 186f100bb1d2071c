"""Reports and stores on disk: reading, writing, versions, backups, summaries.

A store is a folder of versions; each version holds the Parquet tables that it changed, and a manifest of all. A load never
overwrites what it reads: it writes the next version, and readers take the last complete one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightledger.operators.graph import samples
from brightledger.operators.metrics import RunMetrics
from brightledger.sources.merge_table import MergeTable


def raw_reports(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content, year)`` of raw report files; the year is the first four digits of the name."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", "content", F.regexp_extract(name, r"(\d{4})", 1).try_cast("int").alias("year"))


def parsed_reports(spark: SparkSession, path: str, schema: StructType | str, years: Sequence[int] | None = None) -> DataFrame:
    """Parsed reports stored as JSON by year; years that are not there are simply absent."""
    df = spark.read.schema(schema).json(path)
    return df if years is None else df.where(F.col("year").isin(list(years)))


def write_reports(reports: DataFrame, path: str, year: str = "year") -> None:
    """Reports as JSON, a folder per year."""
    reports.write.mode("overwrite").partitionBy(year).json(path)


def report_year(df: DataFrame, declared: str, name: str, default: int = 2014) -> DataFrame:
    """Adds ``report_year``: as declared, else from the file's name, else the default."""
    found = F.regexp_extract(F.col(name), r"(20(?:1[4-9]|2[0-4]))", 1).try_cast("int")
    return df.withColumn("report_year", F.coalesce(F.col(declared), found, F.lit(default)))


def or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON table, empty where the path is missing."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def flattened_sections(reports: DataFrame, key: str, sections: str = "sections", children: str = "subsections") -> DataFrame:
    """Sections and their subsections as rows, in order: ``key, seq, level, title, content``."""
    top = reports.select(key, F.posexplode(sections).alias("i", "s"))
    one = top.select(key, (F.col("i") * 1000).alias("seq"), F.lit(1).alias("level"), "s.title", "s.content")
    low = top.select(key, "i", F.posexplode(f"s.{children}").alias("j", "t"))
    two = low.select(key, (F.col("i") * 1000 + F.col("j") + 1).alias("seq"), F.lit(2).alias("level"), "t.title", "t.content")
    return one.unionByName(two)


class Store:
    """Node and edge tables in numbered versions under one path, for one writer at a time.

    A version's manifest says which version each table was last written in: tables that a load does not touch stay as they are.
    A table that is upserted becomes a merge-on-read table, of which a version of the store names a version.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs = self._fs()
        if not fs.exists(self._path("")):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._path(""))]
        known = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]
        return sorted(v for v in known if fs.exists(self._path(f"v{v}/_COMPLETE")))

    def tables(self, version: int | None = None) -> dict[str, str]:
        """The tables of a version, and where each is: the version that it was written in, or ``folder@version`` of a merge table."""
        known = self.versions()
        if not known:
            return {}
        rows = self.spark.read.text(f"{self.path}/v{version or known[-1]}/_COMPLETE/manifest").collect()
        return dict(r.value.rsplit(" ", 1) for r in rows)

    def write(self, tables: dict[str, DataFrame], replace: bool = False, confirm: bool = False, metrics: RunMetrics | None = None) -> int:
        """Writes the next version, marked complete when all its tables are; starting over needs ``confirm``, and deletes all others.

        ``metrics`` measures the writes.
        """
        if replace and not confirm:
            raise ValueError("starting a store over needs confirm=True")
        fs, known = self._fs(), self.versions()
        version = (known or [0])[-1] + 1
        manifest = ({} if replace else self.tables()) | dict.fromkeys(tables, str(version))
        metrics = metrics or RunMetrics(self.spark)
        for name, df in tables.items():
            metrics.measured(name, df, lambda rows, to=f"{self.path}/v{version}/{name}": rows.write.mode("overwrite").parquet(to))
        self._complete(version, manifest)
        for old in (*(f"v{v}" for v in known), "merge") if replace else ():
            fs.delete(self._path(old), True)
        return version

    def _complete(self, version: int, manifest: dict[str, str]) -> None:
        """The manifest appears whole: it is written aside and moved."""
        fs = self._fs()
        out = fs.create(self._path(f"v{version}/_writing/manifest"))
        out.write(bytearray("".join(f"{name} {at}\n" for name, at in sorted(manifest.items())).encode()))
        out.close()
        fs.rename(self._path(f"v{version}/_writing"), self._path(f"v{version}/_COMPLETE"))

    def merge_table(self, name: str, keys: Sequence[str], seq: str, rule: str = "last") -> tuple[MergeTable, int | None]:
        """The merge table that a table is upserted in, and the version of it that the store names, None before the first."""
        at = self.tables().get(name, "")
        folder, named, version = at.rpartition("@")
        folder = folder if named else f"merge/{name}-{(self.versions() or [0])[-1] + 1}"
        return MergeTable(self.spark, f"{self.path}/{folder}", keys, seq, rule), int(version) if named else None

    def upsert(self, name: str, batch: DataFrame, keys: Sequence[str], seq: str = "seq", rule: str = "last", token: tuple[str, int] | None = None) -> int:
        """The next version, with a batch upserted into a table, at the cost of the batch; a batch whose token is in changes nothing.

        The first upsert of a table that was written whole takes it over as it is.
        """
        table, at = self.merge_table(name, keys, seq, rule)
        if at is None and self.has(name):
            table.upsert(self.read(name))
        merged = table.upsert(batch, token)
        known = self.versions()
        if merged == at:
            return known[-1]
        version = (known or [0])[-1] + 1
        self._complete(version, self.tables() | {name: f"{table.path.removeprefix(self.path + '/')}@{merged}"})
        return version

    def read(self, name: str, version: int | None = None) -> DataFrame:
        at = self.tables(version)[name]
        folder, merged, of = at.rpartition("@")
        if merged:
            # Reading asks for keys and rule only to merge, and those are the table's own.
            return MergeTable.open(self.spark, f"{self.path}/{folder}").read(int(of))
        return self.spark.read.parquet(f"{self.path}/v{at}/{name}")

    def has(self, name: str) -> bool:
        return name in self.tables()


def backup(tables: dict[str, DataFrame], path: str) -> None:
    """All tables as Parquet; ``restored`` reads them back."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def restored(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def write_summary(nodes: DataFrame, path: str, label: str = "label", node_id: str = "id") -> None:
    """Counts and three sample rows per label, as JSON."""
    nodes.groupBy(label).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/counts")
    samples(nodes, label, node_id).write.mode("overwrite").json(f"{path}/samples")


def write_issues(issues: DataFrame, path: str) -> None:
    """Issues as JSON, with their counts by severity."""
    issues.write.mode("overwrite").json(f"{path}/issues")
    issues.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/summary")


def write_statement_index(index: DataFrame, path: str) -> None:
    """Which table of a file holds which statement: ``(file, table_index, section_code)`` in the order ``seq`` of the sections."""
    index.select("file", "table_index", "section_code", "seq").write.mode("overwrite").parquet(path)


def statement_index_map(index: DataFrame) -> DataFrame:
    """``(file, table_index, section_code)``: where sections name the same table, the later one has it."""
    return index.groupBy("file", "table_index").agg(F.max_by("section_code", F.struct("seq", "section_code")).alias("section_code"))


def read_statement_index(spark: SparkSession, path: str) -> DataFrame:
    """The stored index; an empty one where there is none."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        stored = spark.createDataFrame([], "file string, table_index int, section_code string, seq int")
    return statement_index_map(stored)


def write_classified_notes(notes: DataFrame, summary: DataFrame, path: str, year: str = "year") -> None:
    """Classified notes as JSON, a folder per year, and the summary over all of them."""
    notes.write.mode("overwrite").partitionBy(year).json(f"{path}/notes")
    summary.write.mode("overwrite").json(f"{path}/summary")
