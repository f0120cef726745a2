"""Near-copies by the overlap of word shingles: SimHash blocks and MinHash bands propose pairs, the whole sets decide.

The fingerprint of a text's set of shingles goes through the pigeonhole blocks
of ``simhash``: links of few bits, and texts of one fingerprint, are compared.
Most texts whose sets have a Jaccard overlap of 0.8 differ by more bits than
blocks can reach; such two share one of ``BANDS`` bands of ``ROWS`` MinHash
minima at least with a chance of 0.9998, and with a greater one above. Texts that
share a band are compared by their whole sets. A band that many texts share is
cut into lots, each of which meets the band's first text; then texts of a lot
that aren't yet joined to most of the band meet all of its lots, so that no pair
of a band is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import simhash
from ledgerline.llm.components import connected_components
from ledgerline.llm.store import Shared, small_batches

WIDTH = simhash.WIDTH
OVERLAP = 0.8
BANDS = 16
ROWS = 4
SEED = simhash.SEED
#: Texts, and shingles of all of them, that are compared in one piece.
TOGETHER, SHINGLES = 2048, 4_000_000
#: Shingles whose minima are taken at a time.
CHUNK = 1 << 12

_random = np.random.default_rng(SEED)
_TIMES, _PLUS = _random.integers(0, 2**63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The different hashes of a text's runs of ``width`` words, sorted; a text of fewer words is one run, and one without words has none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashed(r, SEED) for r in runs), np.uint64, len(runs)))


def bands(own: np.ndarray) -> list[int]:
    """A key for each band: a hash of its minima. All empty sets have the same keys."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), CHUNK):
        h = own[at : at + CHUNK, None] * _TIMES + _PLUS
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, h.min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(m.tobytes(), SEED) - (1 << 63) for m in least.reshape(BANDS, ROWS)]


def set_fingerprint(own: np.ndarray) -> int:
    """The SimHash of a set of shingles as a signed long; no shingles give 0."""
    ones = np.zeros(simhash.BITS, np.int64)
    for at in range(0, len(own), CHUNK):
        ones += simhash.bit_counts(own[at : at + CHUNK])
    return int(np.uint64(simhash.majority(ones, len(own))).view(np.int64))


def text_key(text: Column) -> Column:
    """What equal texts share; null is as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _mapped(texts: DataFrame, schema: T.StructType, columns) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = columns([shingles(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary()), *made], names=schema.names)

    return small_batches(texts).mapInArrow(run, schema)


BANDED = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
SETS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("own", T.BinaryType())])


def linked(sets: list[np.ndarray], group: np.ndarray, overlap: float = OVERLAP) -> list[tuple[int, int]]:
    """Pairs that overlap enough and join two groups; groups are merged as they are met, and pairs within one are not looked at."""
    sizes = np.array([len(s) for s in sets])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(len(names), np.int64)
    found = []
    for k in range(len(sets) - 1):
        rest = np.flatnonzero(group[k + 1 :] != group[k]) + k + 1
        rest = rest[np.minimum(sizes[rest], sizes[k]) >= overlap * np.maximum(sizes[rest], sizes[k]) - 1e-9]
        if not len(rest):
            continue
        mark[flat[starts[k] : ends[k]]] = 1
        upto = np.concatenate([[0], np.cumsum(mark[flat])])
        mark[flat[starts[k] : ends[k]]] = 0
        both = upto[ends[rest]] - upto[starts[rest]]
        near = rest[both >= overlap * (sizes[rest] + sizes[k] - both) - 1e-9]
        while len(near) and len(near := near[group[near] != group[k]]):
            found.append((k, int(near[0])))
            group[group == group[near[0]]] = group[k]
    return found


def _pairs(rows: DataFrame, overlap: float) -> DataFrame:
    """``a, b``: links within each ``band, key, lot``. Texts of one ``component`` are joined already."""
    keys = ["band", "key", "lot"]

    def links(run: pd.DataFrame) -> list[tuple[bytes, bytes]]:
        run = run.drop_duplicates("node")
        nodes = [bytes(n) for n in run["node"]]
        group = np.unique([bytes(c).hex() for c in run["component"]], return_inverse=True)[1]
        pairs = linked([np.frombuffer(s, np.uint64) for s in run["own"]], group, overlap)
        return [(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in pairs]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            at = batch[keys].to_numpy()
            edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            out = []
            for a, z in zip(edges, edges[1:], strict=False):
                if held and tuple(at[a]) != last:
                    out += links(pd.concat(held))
                    held = []
                last = tuple(at[a])
                held.append(batch.iloc[a:z])
            yield pd.DataFrame(out, columns=["a", "b"])
        if held:
            yield pd.DataFrame(links(pd.concat(held)), columns=["a", "b"])

    rows = rows.select(*keys, "node", "component", "own").repartition(*keys)
    return rows.sortWithinPartitions(*keys).mapInPandas(run, "a binary, b binary").distinct()


def block_pairs(texts: DataFrame, shared: Shared) -> DataFrame:
    """``key, node``: two rows for each pair that the blocks propose among ``node, fp``: the first text of a fingerprint with each other one, and the first texts of two linked fingerprints."""
    first = texts.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    first = shared.keep(first, "first_of_fingerprint")
    same = texts.join(first.filter("n > 1"), "fp").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    end = lambda side: first.select(F.col("fp").alias(side), F.col("first").alias(f"{side}_first"))
    near = simhash.links(first.select("fp"), shared).join(end("a"), "a").join(end("b"), "b").select(F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    both = same.unionByName(near).withColumn("key", F.xxhash64("a", "b"))
    return both.select("key", F.explode(F.array("a", "b")).alias("node"))


def components(docs: DataFrame, shared: Shared, text_col: str = "text", overlap: float = OVERLAP) -> DataFrame:
    """``node, component`` for each text that is linked to a different one: ``node`` is its ``text_key``, ``component`` the smallest that is reachable."""
    texts = docs.select(text_key(F.col(text_col)).alias("node"), F.col(text_col).cast("string").alias("text"))
    banded = _mapped(texts, BANDED, lambda sets: [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_fingerprint(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64()))])
    banded = shared.keep(banded.distinct(), "bands")
    keyed = banded.select("node", "size", F.posexplode("keys").alias("band", "key"))
    crowd = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"), F.min("node").alias("first")).filter("n > 1")
    crowd = crowd.withColumn("lots", F.ceil(F.greatest(F.col("n") / TOGETHER, F.col("all") / SHINGLES, F.lit(1.0))).cast("int")).drop("n", "all")
    own_lot = F.pmod(F.xxhash64("node", "band"), F.col("lots")).cast("int")
    met = keyed.join(crowd, ["band", "key"]).withColumn("lot", own_lot).select("band", "key", "lot", "lots", "first", "node")
    # Each pair of the blocks is a band of its own.
    proposed = block_pairs(banded.select("node", "fp"), Shared(docs.sparkSession))
    proposed = proposed.select(F.lit(BANDS).alias("band"), "key", F.lit(0).alias("lot"), F.lit(1).alias("lots"), F.lit(None).cast("binary").alias("first"), "node")
    met = shared.keep(met.unionByName(proposed), "met")
    every = F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot")
    # Copies of a text are one row a task before they are dealt out; an inner join, as a semi-join would be moved below the grouping.
    wanted = texts.groupBy("node").agg(F.first("text").alias("text")).join(met.select("node").distinct(), "node")
    sets = shared.keep(_mapped(wanted, SETS, lambda found: [pa.array([s.tobytes() for s in found], pa.binary())]), "sets")
    first = met.filter((F.col("node") == F.col("first")) & (F.col("lots") > 1)).select("band", "key", every, "node")
    rows = met.select("band", "key", "lot", "node").unionByName(first).withColumn("component", F.col("node"))
    links = shared.keep(_pairs(rows.join(sets, "node"), overlap), "links")
    reach = connected_components(links, shared)
    crowded = met.filter("lots > 1")
    if crowded.isEmpty():
        return reach
    # In cut bands, what isn't joined to the band's largest component meets all lots.
    reach = shared.keep(reach, "reach")
    placed = crowded.join(reach, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counted = placed.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("band", "key").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    placed = placed.join(largest, ["band", "key"])
    asking = placed.filter(F.col("component") != F.col("main")).select("band", "key", every, "node", "component")
    rows = placed.select("band", "key", "lot", "node", "component").unionByName(asking)
    more = shared.keep(_pairs(rows.join(sets, "node"), overlap), "more_links")
    if more.isEmpty():
        return reach
    return connected_components(links.unionByName(more).distinct(), Shared(docs.sparkSession))
