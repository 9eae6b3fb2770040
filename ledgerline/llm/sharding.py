"""Sharding by byte size: global prefix sums cut at equal targets.

Documents in the order of (doc_id, text checksum, size) get the running sum of
bytes over the whole corpus from per-partition totals; a document goes to the
shard in whose equal share of the bytes its middle byte lies, so shards are
contiguous and their sizes differ by at most about one document.

Native: DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import running_before, stash

#: Bytes that a document takes besides its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard, start_byte.

    Nulls: a null text has 16 bytes and checksum 0; null ids sort first and are
    sharded like any other row.  Repeated rows each get a place of their own.
    An empty table gives no rows.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("__tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("__tie")]
    placed = running_before(keys, order, {"start_byte": F.col("size"), "place": F.lit(1).cast("long")})
    # the middle byte, doubled: integer arithmetic is exact
    shard = F.expr(f"least({n_shards - 1}, ((2 * start_byte + size) * {n_shards}) div (2 * start_byte_total))")
    placed = stash(placed.select("doc_id", "size", "text_crc32", "start_byte", "place",
                                 shard.cast("int").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("place").alias("__first"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("place") - F.col("__first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "start_byte"))
