"""Exact dedup by content-defined chunk recipes.

Each normalised text is cut into chunks at places that its content alone decides (what stands before a place falls
into fixed classes of characters), so equal texts get equal chunks. A chunk's identifier is its 64-bit hash, verified
by its SHA-256: a hash that stands for two digests is replaced by the digest itself. A document is then its ordered
list of identifiers, made where its text lies, and documents are grouped by that list. Texts and chunks never move;
what moves is some 40 bytes for each chunk, and equal chunks and equal lists are combined before they do.

Only DataFrame functions run here. Defined cases: a null text counts as empty, and empty texts equal
each other; a repeated row is a copy like any other, and of rows with the same doc_id one stays;
a null doc_id sorts before every other; a text of any length and script is cut alike; an empty table gives an empty
result; other columns of the input, whatever their names, do not take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import WHITE, read, stored, texts


def _chunk_end() -> str:
    """Where a chunk may end: behind characters of fixed classes, every 1 to 3 kB of most texts.

    Words in Latin letters end chunks at blanks; digits and codes, and scripts beyond ASCII, have classes of their own.
    """
    words = " (?<=[cgkosw][dhlptx][cgkosw] )"
    codes = "(?<=[A-Z0-9])(?<=[AEIQUY159][CGKOSW048][BFJNRV37][AEIQUY159][CGKOSW048])"
    # 128 of each 1,024 characters are in a class: three in a row make one place in 512.
    one, two = ("".join(rf"\x{{{a:04x}}}-\x{{{a + 127:04x}}}" for a in range(first, 0xD800, 0x400)) for first in (0x400, 0x480))
    return rf"{words}|{codes}|(?<=[^\x00-\x7F])(?<=[{one}][{two}][{one}])"


CHUNK_END = _chunk_end()


def normalised(text):
    """The text with each run of white space as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", " ")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_end: str = CHUNK_END, hash_bits: int = 64) -> DataFrame:
    """``(row_id, doc_id, sha, chunks)``: the digest of the normalised text, and ``(h, digest)`` of its chunks in order."""

    def chunk(text):
        h = F.xxhash64(text)
        return F.struct((F.shiftrightunsigned(h, 64 - hash_bits) if hash_bits < 64 else h).alias("h"), F.unhex(F.sha2(text, 256)).alias("digest"))

    normal = texts(docs, id_col, text_col).select("doc_id", normalised("text").alias("normal"))
    return normal.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.unhex(F.sha2("normal", 256)).alias("sha"),
        F.transform(F.split("normal", chunk_end), chunk).alias("chunks"),
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_end: str = CHUNK_END, hash_bits: int = 64, within: list[str] | None = None
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``hash_bits`` shortens the chunk hash; only tests use it, to see that clashes are resolved.
    """
    rows = stored(recipes(docs, id_col, text_col, chunk_end, hash_bits), within=within)
    chunks = rows.select(F.explode("chunks").alias("c")).select("c.h", "c.digest")
    clashes = chunks.groupBy("h").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("h")
    clashes = stored(clashes, within=within)
    recipe = F.transform("chunks", lambda c: c["h"])
    if clashes.isEmpty():
        lists = rows.select("row_id", "doc_id", "sha", recipe.alias("recipe"))
    else:
        # Rows with a hash that stands for two chunks name their chunks by digest.
        named = rows.select("row_id", F.explode(recipe).alias("h")).join(clashes, "h", "left_semi").select("row_id").distinct()
        named = stored(named.withColumn("clash", F.lit(True)), within=within)
        digests = F.when(F.col("clash"), F.transform("chunks", lambda c: c["digest"]))
        lists = rows.join(named, "row_id", "left").select("row_id", "doc_id", "sha", F.struct(recipe.alias("h"), digests.alias("d")).alias("recipe"))
    groups = lists.groupBy("recipe").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row_id")).alias("first")).where("n > 1")
    joined = lists.join(stored(groups, within=within), "recipe", "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_id") == F.col("first.row_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents
), g AS (
  SELECT normal, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY normal
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.normal) AS text_sha256
FROM t JOIN g ON t.normal = g.normal
"""
