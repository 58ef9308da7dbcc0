"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a key's hash.  A bucket whose
bytes exceed the limit is split on one more bit, and only such a bucket, until
every shard fits.  Where the bits of the key's hash are used up (equal keys),
the bits of a hash of the row's own number follow, so that one key with any
share of the rows still splits.

Bucket sizes of all depths come from one aggregation of pre-aggregated fine
buckets: a bucket is a shard if it fits and its parent doesn't.  Rows of fine
buckets that are still too large go through another round with more bits.

Defined cases: a null or empty text has 0 bytes and belongs to the shard of its
key; a null key hashes as the word "null"; a row larger than the limit gets a
shard of its own (depth -1); repeated rows are rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, join_checked

#: Bits of each of the two hashes, and bits by which fine buckets outnumber the expected shards.
BITS, EXTRA = 60, 6


def _hash(column):
    """60 bits of MD5 as a BIGINT."""
    return F.conv(F.substring(F.md5(column.cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(first, second, depth):
    """The leading ``depth`` bits of both hashes together, as text of 0 and 1."""
    bits = lambda h: F.lpad(F.conv(h.cast("string"), 10, 2), BITS, "0")
    return F.substring(bits(first), 1, depth) if depth <= BITS else F.concat(bits(first), F.substring(bits(second), 1, depth - BITS))


def shard(docs: DataFrame, limit_bytes: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: key, n_bytes, shard (bits; "big-..." for a row over the limit), depth."""
    narrow = docs.select(F.col(key_col).alias("key"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    narrow = narrow.select("key", "n_bytes", _hash(F.coalesce(F.col("key").cast("string"), F.lit("null"))).alias("h1"), F.monotonically_increasing_id().alias("row"))
    rows = cut(narrow.withColumn("h2", _hash(F.col("row").cast("string"))), "shard-rows")
    big = rows.filter(F.col("n_bytes") > limit_bytes).select(F.col("key"), "n_bytes", F.concat(F.lit("big-"), F.hex("h1"), F.lit("-"), F.hex("row")).alias("shard"), F.lit(-1).alias("depth"))
    todo, done, base = rows.filter(F.col("n_bytes") <= limit_bytes), [big], 0
    while True:
        total = todo.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0
        fine = min(2 * BITS, base + max(1, math.ceil(math.log2(max(1, total / limit_bytes)))) + EXTRA)
        at = todo.withColumn("fine", _prefix(F.col("h1"), F.col("h2"), fine))
        leaves = cut(directory(at.groupBy("fine").agg(F.sum("n_bytes").alias("b")), base, fine, limit_bytes), "shard-directory")
        placed = join_checked(at, leaves, "fine")
        done.append(placed.filter("fits").select("key", "n_bytes", F.substring("fine", 1, F.col("depth")).alias("shard"), "depth"))
        if leaves.filter(~F.col("fits")).isEmpty():
            break
        if fine >= 2 * BITS:
            raise ValueError("rows with equal 120-bit hashes exceed the limit")
        todo, base = cut(placed.filter(~F.col("fits")).select(todo.columns), "shard-rest"), fine
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("key", key_col)


def directory(sizes: DataFrame, base: int, fine: int, limit_bytes: int) -> DataFrame:
    """For each fine bucket (fine, b): the depth of the shard that holds it, and whether it fits.

    Depths run from base (whose buckets are all known to be too large, except
    for the root) to fine.
    """
    first = base if base == 0 else base + 1
    nodes = sizes.select("fine", "b", F.explode(F.sequence(F.lit(first), F.lit(fine))).alias("depth"))
    nodes = nodes.groupBy("depth", F.substring("fine", 1, F.col("depth")).alias("node")).agg(F.sum("b").alias("b"))
    # Sizes fall with depth, so the shallowest bucket that fits is the shard; the deepest stays where none does.
    ours = sizes.select("fine", F.explode(F.sequence(F.lit(first), F.lit(fine))).alias("depth"))
    ours = ours.select("fine", "depth", F.substring("fine", 1, F.col("depth")).alias("node")).join(nodes, ["depth", "node"])
    return ours.groupBy("fine").agg(F.min(F.when(F.col("b") <= limit_bytes, F.col("depth"))).alias("d")).select("fine", F.coalesce("d", F.lit(fine)).alias("depth"), F.col("d").isNotNull().alias("fits"))


def oracle(limit_bytes: int, depths: int = 24, table: str = "documents") -> str:
    """The same in DuckDB for distinct keys, to a given depth."""
    return f"""
WITH t AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    right(repeat('0', {BITS}) || bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT), {BITS}) AS bits FROM {table}),
small AS (SELECT * FROM t WHERE n_bytes <= {limit_bytes}),
a AS (SELECT doc_id, n_bytes, bits, unnest(range(0, {depths} + 1)) AS d FROM small),
s AS (SELECT d, left(bits, d) AS node, sum(n_bytes) AS b FROM a GROUP BY ALL),
m AS (SELECT a.doc_id, min(a.d) AS depth FROM a JOIN s ON s.d = a.d AND s.node = left(a.bits, a.d) WHERE s.b <= {limit_bytes} GROUP BY a.doc_id)
SELECT small.doc_id, n_bytes, left(bits, depth) AS shard, depth::INTEGER AS depth FROM small JOIN m USING (doc_id)"""
