"""Shards of bounded size by extendible hashing, in DataFrame operations only.

A row's bits come from a hash of its key. A directory entry is a prefix of
those bits; only entries over the byte limit are split on one more bit, until
each fits. Sizes are summed once for a fine grid of prefixes, all coarser
sizes come from those sums. Rows whose prefix is still too large at the end of
a grid go through another grid of the next bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.session import materialise

LIMIT = 64 << 20
#: Bits of one grid: at most 2**GRID sums at a time.
GRID = 16


def bits(key: Column) -> Column:
    """128 bits of the key's md5 as text of 0 and 1; a null key hashes as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.concat(
        *(F.lpad(F.conv(F.substring(digest, at, 8), 16, 2), 32, "0") for at in (1, 9, 17, 25))
    )


def directory(sizes: DataFrame, limit: int, depth: int) -> DataFrame:
    """(cell, prefix) for each ``cell`` of a grid (cell text of bits, bytes): its shortest prefix that fits.

    Prefixes have ``depth`` to ``depth + GRID`` bits; prefix is null where even the
    cell is too large.
    """
    lengths = F.explode(F.sequence(F.lit(depth), F.lit(depth + GRID)))
    prefixes = sizes.select("cell", "bytes", lengths.alias("n")).withColumn("prefix", F.expr("substring(cell, 1, n)"))
    fits = prefixes.groupBy("prefix").agg(F.sum("bytes").alias("total")).where(F.col("total") <= limit)
    best = (
        prefixes.select("cell", "prefix", "n")
        .join(fits, "prefix")
        .groupBy("cell")
        .agg(F.min("n").alias("n"))
    )
    return sizes.select("cell").join(best, "cell", "left").select("cell", F.expr("substring(cell, 1, n)").alias("prefix"))


def _directories(rows: DataFrame, limit: int) -> list[DataFrame]:
    """Directories of successive grids over ``rows`` (__llm_bits, __llm_bytes); the last may have cells without prefix."""
    found: list[DataFrame] = []
    while True:
        depth = len(found) * GRID
        grid = rows.withColumn("cell", F.substring("__llm_bits", 1, depth + GRID))
        sizes = materialise(grid.groupBy("cell").agg(F.sum("__llm_bytes").alias("bytes")), "shard-sizes")
        found.append(materialise(directory(sizes, limit, depth), "shard-directory"))
        large = found[-1].where("prefix IS NULL")
        if depth + 2 * GRID > 128 or large.isEmpty():
            return found
        rows = materialise(grid.join(large, "cell", "left_semi").select("__llm_bits", "__llm_bytes"), "shard-rows")


def _placed(rows: DataFrame, directories: list[DataFrame], limit: int) -> DataFrame:
    """``rows`` (__llm_bits, __llm_bytes and others) with __llm_shard; only the directories are joined to them."""
    prefixes = []
    for k, leaf in enumerate(directories):
        prefixes.append(f"__llm_prefix{k}")
        named = leaf.select(F.col("cell").alias("__llm_cell"), F.col("prefix").alias(prefixes[-1]))
        cell = F.substring("__llm_bits", 1, (k + 1) * GRID)
        rows = rows.withColumn("__llm_cell", cell).join(F.broadcast(named) if not k else named, "__llm_cell", "left").drop("__llm_cell")
    rows = rows.withColumn("__llm_shard", F.coalesce(*prefixes)).drop(*prefixes)
    if len(directories) * GRID < 128 or directories[-1].where("prefix IS NULL").isEmpty():
        return rows
    return rows.where("__llm_shard IS NOT NULL").unionByName(_chunks(rows.where("__llm_shard IS NULL"), limit))


def _chunks(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of single keys that are over the limit: rows of one hash and size are numbered, numbers are cut into chunks.

    Rows are numbered within blocks of 2**16, and blocks by their counts, so a key
    with a third of all rows is in many tasks.
    """
    same = ["__llm_bits", "__llm_bytes"]
    rows = materialise(rows.withColumn("__llm_id", F.monotonically_increasing_id()), "shard-rows")
    rows = rows.withColumn("__llm_block", F.shiftright("__llm_id", 16))
    earlier = Window.partitionBy(*same).orderBy("__llm_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*same, "__llm_block")
        .count()
        .select(*same, "__llm_block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__llm_before"))
    )
    within = F.row_number().over(Window.partitionBy(*same, "__llm_block").orderBy("__llm_id")) - 1
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest(F.col("__llm_bytes"), F.lit(1))))
    chunk = F.floor((F.col("__llm_before") + F.col("__llm_within")) / per)
    return (
        rows.withColumn("__llm_within", within)
        .join(before, [*same, "__llm_block"])
        .withColumn("__llm_shard", F.concat_ws(":", *same, chunk))
        .drop("__llm_id", "__llm_block", "__llm_before", "__llm_within")
    )


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs``' key and text size with their shard: (key, n_bytes, shard, depth).

    ``shard`` is the prefix ("" is the only shard of a small table), ``depth`` its
    number of bits. Sizes are UTF-8 bytes, null text counts 0. Rows of one key can't
    be told apart by its hash: where even the whole hash is over the limit, they are
    dealt on in chunks ``<hash>:<size>:<number>``: full chunks of whole rows of the
    same size, so that each holds ``limit`` at most or one longer row.
    """
    rows = docs.select(F.col(key).alias("key"), _size(text).alias("__llm_bytes"))
    rows = materialise(rows.withColumn("__llm_bits", bits(F.col("key"))), "shard-rows")
    return _placed(rows, _directories(rows, limit), limit).select(
        F.col("key").alias(key),
        F.col("__llm_bytes").alias("n_bytes"),
        F.col("__llm_shard").alias("shard"),
        F.length(F.substring_index("__llm_shard", ":", 1)).alias("depth"),
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Writes ``docs`` with all columns and rows as Parquet folders ``shard=b...`` and returns (shard, rows, bytes) of what was written.

    Shards are those of ``shards``: null and repeated keys are allowed. What stood at
    ``path`` is replaced. If ``docs`` has a column ``shard``, the folders' column has
    underscores appended (``shard_=b...``) until no column has its name.
    """
    folder, taken = "shard", {c.lower() for c in docs.columns}
    while folder in taken:
        folder += "_"
    rows = docs.withColumns({"__llm_bytes": _size(text), "__llm_bits": bits(F.col(key))})
    sized = materialise(rows.select("__llm_bits", "__llm_bytes"), "shard-rows")
    placed = _placed(rows, _directories(sized, limit), limit)
    named = placed.withColumn(folder, F.concat(F.lit("b"), "__llm_shard")).drop("__llm_bits", "__llm_bytes", "__llm_shard")
    writer = named.repartition(folder).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(folder).parquet(path)
    return (
        docs.sparkSession.read.schema(named.schema).parquet(path)
        .groupBy(F.expr(f"substring(`{folder}`, 2)").alias("shard"))
        .agg(F.count("*").alias("rows"), F.sum(_size(text)).alias("bytes"))
    )


#: The same for a unique key as SQL over ``documents``: the shortest prefix whose rows fit.
SHARDS_SQL = """
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         array_to_string(list_transform(range(1, 33), lambda i: lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), i::INT, 1))::BIGINT), 4, '0')), '') AS bits
  FROM documents),
p AS (SELECT doc_id, n_bytes, substr(bits, 1, n::INT) AS prefix, n FROM r, range(0, 49) AS t(n)),
f AS (SELECT prefix FROM p GROUP BY prefix HAVING sum(n_bytes) <= {limit})
SELECT doc_id, any_value(n_bytes) AS n_bytes, arg_min(prefix, n) AS shard, min(n)::INT AS depth
FROM p JOIN f USING (prefix) GROUP BY doc_id
"""
