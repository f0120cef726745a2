"""Uniform shuffles into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in partitions, which stretches of neighbouring rows cut into source
parts. Where a uniformly random permutation is cut into shards, the number of rows
that part ``p`` sends to shard ``s`` is multivariate hypergeometric: the matrix is
drawn first, part by part and shard by shard, and written as a table. Then each
part is permuted by itself and dealt out by its row of the matrix, and each shard
is permuted by itself. Only DataFrame functions touch rows; the driver draws the
matrix, whose numbers MATRIX bounds.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.store import Shared

#: Rows of a source part, and numbers of the matrix: beyond those, parts have more rows.
PART_ROWS = 20_000
MATRIX = 1 << 20
#: Rows, about, of the parts of a shard that are ordered by themselves.
SLICE_ROWS = 20_000
#: Bits of a row's number below those of its partition's.
ROW_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows out of ``good + bad`` are good, for numbers of any size.

    Chances follow from the mode outwards by the ratios of neighbours, as far as
    they matter to a double, and a uniform number is looked up in their sums.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    reach = int(10 * np.sqrt(drawn * (good / (good + bad)) * (bad / (good + bad)))) + 50
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=np.float64)
    up = (good - k) * (drawn - k) / ((k + 1) * (bad - drawn + k + 1))
    at = mode - int(max(low, mode - reach))
    chances = np.concatenate([np.cumprod(1 / up[:at][::-1])[::-1], [1.0], np.cumprod(up[at:])])
    sums = np.cumsum(chances)
    return int(max(low, mode - reach)) + int(np.searchsorted(sums, rng.random() * sums[-1], side="right"))


def communication_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Exact counts: rows sum to the parts' sizes, columns to the shards'."""
    rng = np.random.default_rng(seed)
    left, matrix = list(shard_sizes), []
    for size in part_sizes:
        row, rest = [], sum(left)
        for room in left:
            take = hypergeometric(rng, room, rest - room, size)
            row.append(take)
            rest -= room
            size -= take
        left = [a - b for a, b in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def even_sizes(n: int, n_shards: int) -> list[int]:
    return [n // n_shards + (k < n % n_shards) for k in range(n_shards)]


def _random_key(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def _ranked(rows: DataFrame, group: str, order: str, slices: int, name: str) -> DataFrame:
    """Rows with their rank from 0 within ``group`` by the random key ``order``. A group is ordered in slices of the key's range, whose counts give each its first rank."""
    # The top 32 bits of the key, as a number from 0, over equal ranges.
    rows = rows.withColumn("slice", F.shiftright((F.shiftright(F.col(order), 32) + F.lit(1 << 31)) * F.lit(slices), 32).cast("int"))
    sizes = rows.groupBy(group, "slice").agg(F.count(F.lit(1)).alias("in_slice"))
    before = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "slice", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(group, "slice").orderBy(order, "row")
    ranked = rows.withColumn("at", F.row_number().over(within) - 1)
    return ranked.join(sizes, [group, "slice"]).withColumn(name, F.col("first") + F.col("at")).drop("slice", "first", "at")


def shuffle_into_shards(docs: DataFrame, n_shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: a row for each input row, in a uniformly random shard and slot; shards' row counts are at most one apart.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8. Rows are numbered as
    they are first written, so repeated rows and null ids are rows like others
    and spread like them. Other columns are not read. An empty table gives an
    empty one.
    """
    shared = Shared(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    rows = shared.keep(rows, "rows")
    lie = F.shiftright("row", ROW_BITS)
    partitions = sorted((r["p"], r["n"]) for r in rows.groupBy(lie.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(k for _, k in partitions)
    part_rows = max(PART_ROWS, math.ceil(n * n_shards / MATRIX))
    slices = max(1, math.ceil(n / n_shards / SLICE_ROWS))
    stretch = F.floor(F.col("row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) / part_rows)
    parts = [(p << ROW_BITS | k, min(part_rows, size - k * part_rows)) for p, size in partitions for k in range(math.ceil(size / part_rows))]
    matrix = communication_matrix([size for _, size in parts], even_sizes(n, n_shards), seed)
    # Where each shard's rows end in a part's order.
    deal = docs.sparkSession.createDataFrame([(part, list(accumulate(row))) for (part, _), row in zip(parts, matrix, strict=True)], "part long, ends array<long>")
    deal = shared.keep(deal, "matrix")
    rows = rows.select("*", (F.shiftleft(lie, ROW_BITS) + stretch).cast("long").alias("part"), _random_key(seed, "doc_id", "row").alias("key"))
    local = rows.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("key", "row")) - 1)
    # How many ends lie at or below the rank, by halves.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n_shards.bit_length()))])
    passed = lambda at, step: (at + step <= n_shards) & (F.get("ends", at + step - 1) <= F.col("rank"))
    shard = F.aggregate(steps, F.lit(0), lambda at, step: F.when(passed(at, step), at + step).otherwise(at))
    dealt = local.join(deal, "part").withColumn("shard", shard)
    dealt = dealt.select("doc_id", "size", "text_crc32", "shard", "row", _random_key(seed + 2, "key").alias("key"))
    return _ranked(dealt, "shard", "key", slices, "slot").select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
