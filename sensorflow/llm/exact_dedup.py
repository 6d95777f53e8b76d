"""Exact deduplication by 128-bit content hash, with bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of white space other than one plain space; replacing them by one space normalises a text.
ODD_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ODD_SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_hex_digits: int = 32) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows group by a 128-bit hash of the normalised text, and the text itself is the second
    grouping key, so texts that share a hash but differ in a byte form groups of their own.
    Both aggregates combine on the map side: a group with a third of all rows leaves one row
    per task.  Rows then meet their group by (hash, SHA-256) in a join whose skewed
    partitions AQE can split.

    NULL text counts as empty.  Rows that repeat the smallest id all stay.  A NULL id never
    is the smallest one unless the group has no other, in which case its rows stay.
    ``hash_hex_digits`` shortens the hash, for tests of collisions.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    rows = rows.withColumn("_h", F.substring(F.md5(F.col("_t").cast("binary")), 1, hash_hex_digits))
    same_bytes = (rows.groupBy("_h", "_t")
                  .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
                  .select("_h", F.sha2(F.col("_t").cast("binary"), 256).alias("_sha"), "_keep", "_n"))
    # The join key is a new expression: both sides get an exchange of their own, so AQE may
    # split a partition that holds one large group.  It is never NULL, which spares both
    # scans an inferred filter that would hash every text again.
    key = F.coalesce(F.unhex(F.concat(F.lpad("_h", 32, "0"), "_sha")),
                     F.lit(b"")).alias("_key")
    groups = same_bytes.select(key, "_keep", "_n")
    keyed = (rows.withColumn("_sha", F.sha2(F.col("_t").cast("binary"), 256))
             .select("_id", "_sha", key))
    return (keyed.join(groups, "_key")
            .select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                    F.col("_n").alias("group_size"),
                    F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
                    F.col("_sha").alias("text_sha256")))
