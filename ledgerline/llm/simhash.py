"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into ``BLOCKS`` blocks. Two fingerprints that differ in at
most ``distance`` bits leave at least ``BLOCKS - distance`` blocks untouched, so
they share at least one choice of that many blocks: every choice is a join key.
Rows that share a key with others are compared bit by bit. A key that many
different fingerprints share is cut again over the bits it leaves open, which
bounds the fingerprints that can share both keys, whatever the input. Copies
are one fingerprint from the start, and no step emits all pairs of a group:
within a key, only links that join two groups found so far go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.components import connected_components
from ledgerline.llm.store import Shared, small_batches

BITS = 64
BLOCKS = 6
DISTANCE = 3
#: Words of a shingle.
WIDTH = 5
#: The hash's seed in the definition of the fingerprint.
SEED = 42
#: Different fingerprints under one key that are compared directly.
DIRECT = 128
#: Shingles that are counted at a time.
CHUNK = 1 << 16


def majority(ones: np.ndarray, n: int) -> int:
    """The fingerprint of ``n`` hashes, ``ones`` of which have each bit, the highest first."""
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """A bit is 1 where over half of the shingles' hashes have it; no words give 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        starts, ends = [0], [len(b" ".join(words))]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
        starts, ends = begin[: len(words) - width + 1].tolist(), (begin + sizes)[width - 1 :].tolist()
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        ones += bit_counts(np.array([hashed(line[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)], ">u8"))
    return majority(ones, len(starts))


FINGERPRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, fp``: each whole text's fingerprint as a signed long; one row for each input row, null ids and repeated rows included; null and wordless texts have 0, long ones count whole; an empty table gives an empty one; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(run, FINGERPRINTS)


def block_masks(n_bits: int, blocks: int, shared: int, bits: list[int] | None = None) -> list[int]:
    """A mask for each choice of ``shared`` of the ``blocks`` blocks of the given bit positions (all, from 0, if none are given)."""
    bits = list(range(n_bits)) if bits is None else bits
    edges = [len(bits) * k // blocks for k in range(blocks + 1)]
    cut = [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:], strict=False)]
    return [sum(cut[k] for k in chosen) for chosen in combinations(range(blocks), shared)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(fp: Column, masks: list[int]) -> Column:
    """One struct (table, key) for each mask."""
    return F.array(*[F.struct(F.lit(k).alias("table"), fp.bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)])


def _linked(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join the different fingerprints' groups, at most one for each fingerprint: those found so far are merged as they are met."""
    n = len(fps)
    group = np.arange(n)
    found = []
    for k in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(fps[k + 1 :] ^ fps[k]) <= distance) + k + 1
        while len(near) and len(near := near[group[near] != group[k]]):
            other = group[near[0]]
            found.append((int(fps[k]), int(fps[near[0]])))
            group[group == other] = group[k]
    return found


def _links_in_runs(keys: list[str], distance: int):
    """For rows sorted by key: the links within each run of a key. A run's rows are kept until it ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            changed = np.flatnonzero((rows[keys].to_numpy()[1:] != rows[keys].to_numpy()[:-1]).any(axis=1)) + 1
            cut = int(changed[-1]) if len(changed) else 0
            rest = rows.iloc[cut:]
            if cut:
                yield _run_links(rows["fp"].to_numpy()[:cut], np.concatenate([[0], changed]), distance)
        if rest is not None and len(rest):
            yield _run_links(rest["fp"].to_numpy(), np.array([0, len(rest)]), distance)

    return run


def _run_links(fps: np.ndarray, edges: np.ndarray, distance: int) -> pd.DataFrame:
    fps = fps.view(np.uint64)
    sizes = np.diff(edges)
    twos = edges[:-1][sizes == 2]
    near = twos[np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= distance]
    links = [np.stack([fps[near], fps[near + 1]], axis=1)]
    for k in np.flatnonzero(sizes > 2):
        if found := _linked(np.unique(fps[edges[k] : edges[k + 1]]), distance):
            links.append(np.array(found, np.uint64))
    out = np.concatenate(links).view(np.int64)
    return pd.DataFrame({"a": out.min(axis=1, initial=2**63 - 1), "b": out.max(axis=1, initial=-(2**63))})


def links(distinct: DataFrame, shared: Shared, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``a, b`` over different fingerprints (column ``fp``, each once): links of at most ``distance`` bits, enough to keep together all that links join.

    A link that joins what other links of the same key already join may be left
    out; every link that is returned holds.
    """
    masks = block_masks(BITS, blocks, blocks - distance)
    keyed = distinct.select("fp", F.explode(_keys(F.col("fp"), masks)).alias("k")).select("fp", "k.table", "k.key")
    same = Window.partitionBy("table", "key")
    keyed = keyed.withColumn("n", F.count(F.lit(1)).over(same)).filter(F.col("n") > 1)
    direct = keyed.filter(F.col("n") <= DIRECT).select("table", "key", "fp")
    direct = direct.sortWithinPartitions("table", "key").mapInPandas(_links_in_runs(["table", "key"], distance), "a long, b long")
    # Under a crowded key, the open bits are cut in turn.
    inner = []
    for mask in masks:
        open_bits = [b for b in range(BITS) if not mask >> b & 1]
        inner.append(block_masks(len(open_bits), 2 * distance, distance, open_bits))
    crowded = keyed.filter(F.col("n") > DIRECT)
    choices = F.element_at(F.array(*[F.array(*[F.lit(_signed(m)) for m in ms]) for ms in inner]), F.col("table") + 1)
    crowded = crowded.select("table", "key", "fp", F.posexplode(choices).alias("inner", "mask"))
    crowded = crowded.select("table", "key", "inner", F.col("fp").bitwiseAND(F.col("mask")).alias("open"), "fp")
    keys = ["table", "key", "inner", "open"]
    crowded = crowded.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter(F.col("n") > 1).drop("n")
    crowded = crowded.sortWithinPartitions(*keys).mapInPandas(_links_in_runs(keys, distance), "a long, b long")
    return shared.keep(direct.unionByName(crowded).distinct(), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, distance: int = DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id``: a row for each input row; ``component_id`` is the smallest id reachable over links.

    Links go by the bits alone; ``near_texts.components`` takes them as
    candidates and has the whole sets of shingles decide.
    Null and wordless texts have fingerprint 0, which links like any other. Rows
    with a null id belong to a component, but name one only where no other id
    is there to do so; repeated rows are copies of each other. Other columns are
    not read; an empty table gives an empty one.
    """
    spark: SparkSession = docs.sparkSession
    shared = Shared(spark)
    rows = shared.keep(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = shared.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    reach = connected_components(links(nodes.select("fp"), shared, distance, blocks), shared)
    labelled = nodes.join(reach, nodes["fp"] == reach["node"], "left").select(nodes["fp"], "first", F.coalesce("component", nodes["fp"]).alias("component"))
    labelled = shared.keep(labelled, "labelled")
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labelled.select("fp", "component").join(least, "component").select("fp", "component_id")
    fp = F.col("fp")
    return rows.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"), "component_id")
