"""Exact deduplication by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved

#: Characters that do not count when texts are compared: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Up to so many (length, prefix hash) keys, 16 bytes each, are sent to every executor.
BROADCAST_KEYS = 1_000_000


def normalised(text) -> F.Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64, digest_all: bool = False, row_col: str | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per input row.

    Refinement: rows are grouped by the length of their normalised text, those that
    share one by a hash of its first ``prefix`` characters too, and groups are formed by
    the digest of the full content among those that still share both. The first two
    steps move counts, never texts. text_sha256 is null for the others unless
    ``digest_all``. Up to BROADCAST_KEYS surviving keys are sent to the scan, which then
    digests their rows only; more of them are joined by a shuffle to the narrow rows,
    with the digest that the scan has made of each.

    Of a group the row with the most code points in the original text stays, then
    the one with the smallest id (null ids last). Null and empty texts are equal.
    Repeated rows (same id and text) form one group with one keep_id, and each of
    them is kept if that is its id; with ``row_col``, a number that differs by row,
    only the one of the smallest number is, and the number is returned too. An empty
    table gives no rows; other columns are ignored, whatever their names.
    """
    text = normalised(F.col(text_col))
    number = F.col(row_col) if row_col else F.lit(0)
    rows = docs.select(F.col(id_col).alias("id"), number.cast("long").alias("row"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"), text.alias("norm"))
    rows = rows.withColumns({"len": F.char_length("norm"), "head": F.xxhash64(F.substring("norm", 1, prefix))})

    lengths = rows.groupBy("len").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("len")
    heads = rows.select("len", "head").groupBy("len", "head").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    survivors = saved(heads.join(lengths, "len", "left_semi").select("len", "head", F.lit(True).alias("found")), "survivors")
    shared = F.coalesce("found", F.lit(False))
    digest = F.sha2(F.col("norm").cast("binary"), 256)
    narrow = ["id", "row", "chars", shared.alias("shared")]
    if survivors.count() <= BROADCAST_KEYS:
        rows = rows.join(F.broadcast(survivors), ["len", "head"], "left").select(*narrow, (digest if digest_all else F.when(shared, digest)).alias("digest"))
    else:
        rows = saved(rows.select("id", "row", "chars", "len", "head", digest.alias("digest")), "all-digests").join(survivors, ["len", "head"], "left")
        rows = rows.select(*narrow, (F.col("digest") if digest_all else F.when(shared, F.col("digest"))).alias("digest"))
    rows = saved(rows, "digests")

    first = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    groups = rows.where("shared").groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    # As a written table the groups are shuffled for the join by themselves: then the rows of a
    # very large group, which are the other side, can be split over tasks.
    groups = saved(groups.select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"), "groups")
    none = F.lit(None)
    out = rows.where("shared").join(groups, "digest", "left").select("id", "row", "digest", "keep_id", "keep_row", "group_size")
    out = out.unionByName(rows.where("not shared").select("id", "row", "digest", none.cast(docs.schema[id_col].dataType).alias("keep_id"), none.cast("long").alias("keep_row"), none.cast("long").alias("group_size")))
    alone = F.col("group_size").isNull()
    return out.select(
        F.col("id").alias(id_col),
        *([F.col("row").alias(row_col)] if row_col else []),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS kept,
       text_sha256
FROM d
"""
