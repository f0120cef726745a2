"""Approximate nearest neighbours over shifted Hilbert curves.

Unit vectors are projected at random to a few dimensions, shifted, and put in
the order of a Hilbert curve; several such orders, each with its own projection
and shift, see different neighbours side by side. Spark deals the rows of all
orders out by ranges of their place, and a range is cut into small windows of
neighbouring rows. A query is looked up at several places of the orders: its own,
and those that it would have beyond the nearest borders of the curve's cells.
The likeliest places over all orders are taken. At each of them it meets the
window there and the neighbouring one on the nearer side; what all windows find
is merged, and ranked by the cosine of the original vectors.

Windows have a fixed size. The places that a query is looked up at grow as a
power of the table that is below 1, so a query meets a falling share of a growing
table. The power is that which holds the recall of vectors without any structure,
the hardest; vectors that lie in groups need fewer (``places``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.store import Shared
from ledgerline.llm.training import sampling_number

CURVES = 6
#: Rows of a window; a table of at most SMALL rows is one window.
WINDOW = 128
SMALL = 2048
#: Places that a query is looked up at in a table of REFERENCE rows, and the power of the rows by which they grow.
PLACES, REFERENCE, POWER = 140, 50_000, 0.65
#: Bits of a place's key, below those of the order's number.
KEY_BITS = 57
#: Rows, about, that show where the orders' cells lie and how near a neighbour is at least.
SAMPLE = 4096
#: Rows and looked-up places that are searched in one task, about.
RANGE = 1 << 18
NEAREST = 5
#: Rows beyond the nearest ones that are ranked by the original vectors: what rounding to half floats may misplace.
SPARE = 6
#: How fast a neighbour's chance to lie across a border falls with the distance, for neighbours at about 58 degrees.
CLOSENESS = 0.62


def places_for(n: int) -> int:
    """Places that a query is looked up at in a table of ``n`` rows."""
    return max(16, math.ceil(PLACES * (n / REFERENCE) ** POWER))


def dimensions_for(n: int, width: int) -> int:
    """As many as leave the curve's first cells about a window of rows."""
    return max(1, min(width, 16, round(math.log2(max(4, n / WINDOW)))))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each cell (a row of coordinates below ``2 ** bits``) on the Hilbert curve: Gray-code rotations of the coordinates' bits, then the bits interleaved."""
    x = cells.astype(np.uint64).copy()
    one = np.uint64(1)
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(level)
        low = (one << bit) - one
        for d in range(dims):
            high = (x[:, d] >> bit & one).astype(bool)
            swap = np.where(high, np.uint64(0), (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(n, np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> np.uint64(level) & one, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= flip[:, None]
    key = np.zeros(n, np.uint64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << one | (x[:, d] >> np.uint64(level) & one)
    return key.astype(np.int64)


def half_units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, as half floats."""
    scaled = _scaled(vectors)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float16)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest component near 1: squares neither overflow nor vanish, and cosines stay as they are."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


class Curves:
    """The projections and shifts of all orders. They follow from the sample, whose medians and spread place the curves' cells, and a seed."""

    def __init__(self, sample: np.ndarray, n: int, curves: int = CURVES, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        self.dimensions = dimensions_for(n, width)
        self.bits = max(1, min(12, KEY_BITS // self.dimensions))
        self.curves = curves
        self.axes = np.stack([np.linalg.qr(rng.standard_normal((width, width)))[0][:, : self.dimensions] for _ in range(curves)]).astype(np.float32)
        shifts = rng.uniform(-0.3, 0.3, (curves, self.dimensions))
        seen = np.einsum("nw,cwd->cnd", sample.astype(np.float32), self.axes)
        spread = seen.std(axis=1)
        self.spread = np.where(spread > 0, spread, 1.0).astype(np.float32)
        self.middle = (np.median(seen, axis=1) - shifts * self.spread).astype(np.float32)

    def projected(self, units: np.ndarray, curve: int) -> np.ndarray:
        """Coordinates around 0, the border of the curve's first cells."""
        return (units.astype(np.float32) @ self.axes[curve] - self.middle[curve]) / self.spread[curve]

    def places(self, coordinates: np.ndarray, curve: int) -> np.ndarray:
        """Keys along the curve, under the order's number. Coordinates go through a logistic curve, so that cells hold alike many."""
        even = 1 / (1 + np.exp(-1.7 * np.clip(coordinates, -20, 20)))
        cells = (even * ((1 << self.bits) - 1) + 0.5).astype(np.int64)
        return hilbert_keys(cells, self.bits) | curve << KEY_BITS

    def lookups(self, units: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of ``units`` and the ``places`` likeliest places of each: the mirror images of its coordinates at the nearest borders, by the chance that a neighbour lies there."""
        n, d = len(units), self.dimensions
        flips = min(d, max(6, math.ceil(math.log2(4 * places / self.curves))))
        chosen = np.arange(1 << flips)[:, None] >> np.arange(flips) & 1
        places = min(places, self.curves << flips)
        rows, found = [], []
        step = max(1, (1 << 21) // (self.curves << flips))
        for at in range(0, n, step):
            own = units[at : at + step]
            costs, coordinates, nearest = [], [], []
            for c in range(self.curves):
                x = self.projected(own, c)
                near = np.argsort(np.abs(x), axis=1, kind="stable")[:, :flips]
                # Log odds that a neighbour is on the same side of each border.
                stays = 1 / (1 + np.exp(-1.7 * CLOSENESS * np.abs(x)))
                odds = np.log(stays / (1 - stays))
                costs.append(np.take_along_axis(odds, near, axis=1) @ chosen.T - np.log(stays).sum(axis=1, keepdims=True))
                coordinates.append(x)
                nearest.append(near)
            order = np.argpartition(np.concatenate(costs, axis=1), places - 1, axis=1)[:, :places]
            row = np.repeat(np.arange(len(own)), places)
            curve, subset = np.divmod(order.ravel(), 1 << flips)
            for c in range(self.curves):
                pick = curve == c
                x = coordinates[c][row[pick]]
                sign = np.ones_like(x)
                np.put_along_axis(sign, nearest[c][row[pick]], 1.0 - 2.0 * chosen[subset[pick]], axis=1)
                rows.append(row[pick] + at)
                found.append(self.places(x * sign, c))
        return np.concatenate([*rows, np.zeros(0, np.int64)]), np.concatenate([*found, np.zeros(0, np.int64)])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (doubles), and ``same``, which equal vectors share, of rows with an id and a vector that has no null, no non-finite component and a length."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).filter(F.col("vec_id").isNotNull() & (F.size(v) > 0) & finite)
    digest = F.md5(F.array_join(F.col("vector").cast("array<string>"), ",").cast("binary"))
    return rows.filter(F.exists("vector", lambda x: x != 0)).withColumn("same", digest)


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.flatten().to_numpy(zero_copy_only=False)
    return lists.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _copies_bounded(rows: DataFrame, nearest: int) -> DataFrame:
    """Of rows with the same vector, the ``nearest + 1`` smallest ids: no other copy can be among anyone's nearest."""
    order = Window.partitionBy("same").orderBy("vec_id")
    return rows.withColumn("copy", F.dense_rank().over(order)).filter(F.col("copy") <= nearest + 1).select("vec_id", "vector").distinct()


PLACED = T.StructType([T.StructField("place", T.LongType()), T.StructField("salt", T.LongType()), T.StructField("least", T.FloatType()), T.StructField("vec_id", T.LongType()), T.StructField("unit", T.BinaryType())])
MET = "query_id long, vec_id long, near float"


def _salts(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers that part equal places, so that no crowd of them must be one range."""
    with np.errstate(over="ignore"):
        mixed = (ids ^ places >> np.int64(7)) * np.int64(-7046029254386353131)
        return (mixed ^ mixed >> np.int64(32)) * np.int64(-4658895280553007687) >> np.int64(16)


def _rows_placed(rows: DataFrame, curves: Curves) -> DataFrame:
    """A row for each order; ``least`` is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                ids, units = batch.column(0).to_numpy(), half_units(_matrix(batch.column(1)))
                raw, none = pa.array([u.tobytes() for u in units], pa.binary()), pa.nulls(len(ids), pa.float32())
                for c in range(curves.curves):
                    place = curves.places(curves.projected(units, c), c)
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(_salts(ids, place)), none, batch.column(0), raw], names=PLACED.names)

    return rows.mapInArrow(run, PLACED)


def _queries_placed(queries: DataFrame, curves: Curves, places: int, sample: np.ndarray, nearest: int) -> DataFrame:
    """A row for each place that a query is looked up at; ``least`` is how near its nearest rows are at least, by those of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, units = batch.column(0).to_numpy(), half_units(_matrix(batch.column(1)))
                least = np.full(len(ids), -2, np.float32)
                if len(sample) > nearest + 1:
                    near = units.astype(np.float32) @ sample.astype(np.float32).T
                    # One less for the query itself, and a margin for rounding.
                    least = np.partition(near, -nearest - 2, axis=1)[:, -nearest - 2] - np.float32(1e-3)
                raw = np.array([u.tobytes() for u in units], object)
                row, place = curves.lookups(units, places)
                for k in range(0, len(row), 1 << 14):
                    r, p = row[k : k + (1 << 14)], place[k : k + (1 << 14)]
                    yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(_salts(~ids[r], p)), pa.array(least[r]), pa.array(ids[r]), pa.array(raw[r], pa.binary())], names=PLACED.names)

    return queries.mapInArrow(run, PLACED)


def _windows_met(places: np.ndarray, salts: np.ndarray, at: np.ndarray, at_salts: np.ndarray, who: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of the windows of ordered rows, and the different pairs (window, query) by window: for each place ``at`` that query ``who`` is looked up at, the window there and the one on the nearer side."""
    n = len(places)
    count = max(1, round(n / window))
    edges = np.arange(count + 1) * n // count
    low, high = np.searchsorted(places, at, side="left"), np.searchsorted(places, at, side="right")
    # Among rows at the very place, one that follows from the salt.
    spot = np.minimum(low + ((high - low) * ((at_salts >> 16 & 0xFFFF) / 65536)).astype(np.int64), n - 1)
    own = np.searchsorted(edges, spot, side="right") - 1
    after = spot - edges[own] >= edges[own + 1] - spot
    beside = np.where(after & (own < count - 1) | (own == 0), own + 1, own - 1)
    there = (beside >= 0) & (beside < count)
    queries = int(who.max(initial=0)) + 1
    pairs = np.unique(np.concatenate([own, beside[there]]) * queries + np.concatenate([who, who[there]]))
    return edges, pairs // queries, pairs % queries


def _best(query: np.ndarray, row: np.ndarray, near: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query, the ``keep`` nearest different rows; ties go to the smaller id."""
    order = np.lexsort([row, -near, query])
    query, row, near = query[order], row[order], near[order]
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (row[1:] != row[:-1])
    query, row, near = query[first], row[first], near[first]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < keep
    return query[keep], row[keep], near[keep]


def _search(width: int, window: int, keep: int):
    """Searches a range of the orders: all rows and looked-up places of one task, whose number RANGE bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        place, salt, ids = (table.column(n).to_numpy() for n in ("place", "salt", "vec_id"))
        asked = table.column("least").is_valid().to_numpy()
        least = table.column("least").to_numpy()[asked]
        units = np.concatenate([np.frombuffer(b.column(4).buffers()[2], np.float16)[b.column(4).offset * width : (b.column(4).offset + b.num_rows) * width] for b in parts]).reshape(-1, width)
        rows = np.flatnonzero(~asked)
        rows = rows[np.lexsort([salt[rows], place[rows]])]
        queries = np.flatnonzero(asked)
        if not len(rows) or not len(queries):
            return
        names, first, who = np.unique(ids[queries], return_index=True, return_inverse=True)
        least, queries = least[first], queries[first]
        edges, windows, lookups = _windows_met(place[rows], salt[rows], place[asked], salt[asked], who, window)
        # A window at a time: all that look in there against all its rows.
        starts = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
        found, held = [], 0
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(windows)], strict=True):
            own = rows[edges[windows[a]] : edges[windows[a] + 1]]
            unit = units[own].astype(np.float32)
            for b in range(a, z, 4096):
                who = lookups[b : min(b + 4096, z)]
                near = units[queries[who]].astype(np.float32) @ unit.T
                q, r = np.nonzero(near >= least[who][:, None])
                found.append((names[who[q]], ids[own[r]], near[q, r]))
                held += len(q)
            if held > 1 << 21:
                found = [_best(*map(np.concatenate, zip(*found, strict=True)), keep)]
                held = 0
        best = _best(*map(np.concatenate, zip(*found, strict=True)), keep)
        yield pa.RecordBatch.from_arrays([pa.array(b) for b in best], names=["query_id", "vec_id", "near"])

    return run


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision and in the same order of sums for equal vectors."""
    a, b = _scaled(a), _scaled(b)
    dot = lambda x, y: np.add.reduce(x * y, axis=1)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def _ranked(pairs: DataFrame) -> DataFrame:
    """``query_id, vec_id, score`` of pairs with both vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _cosines(_matrix(batch.column(2)), _matrix(batch.column(3))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_id long, vec_id long, score double")


def _of_width(rows: DataFrame, asked: DataFrame, width: int, nearest: int, curves: int, places: int | None, seed: int, shared: Shared) -> DataFrame:
    """The search among vectors of one length."""
    rows, asked = rows.filter(F.size("vector") == width), asked.filter(F.size("vector") == width)
    # Equal queries are one; whoever asks leaves out its own id among one more than is due.
    one = asked.groupBy("same").agg(F.min("vec_id").alias("vec_id"), F.min("vector").alias("vector"))
    index = shared.keep(_copies_bounded(rows, nearest), f"index{width}")
    n = index.count()
    drawn = index.filter(sampling_number("vec_id", seed) < SAMPLE / max(1, n)).select("vector").collect()
    sample = half_units(np.array(sorted(r[0] for r in drawn), np.float64)) if drawn else np.zeros((0, width), np.float16)
    # A small table is one window.
    curves, places = (curves, places or places_for(n)) if n > SMALL else (1, 1)
    shape = Curves(sample if len(sample) else np.zeros((1, width)), n, curves, seed)
    keep = nearest + 1 + SPARE
    placed = _rows_placed(index, shape).unionByName(_queries_placed(one.select("vec_id", "vector"), shape, places, sample, nearest))
    ranges = math.ceil((n * curves + one.count() * places) / RANGE)
    placed = placed.repartitionByRange(max(1, ranges), "place", "salt") if n > SMALL else placed.coalesce(1)
    met = placed.mapInArrow(_search(width, WINDOW if n > SMALL else SMALL, keep), MET)
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    few = met.withColumn("r", F.dense_rank().over(nearest_first)).filter(F.col("r") <= keep).select("query_id", "vec_id").distinct()
    pairs = few.join(index, "vec_id").join(one.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked")), "query_id").select("query_id", "vec_id", "asked", "vector")
    # An id with several vectors counts by its nearest.
    scored = _ranked(pairs).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = scored.groupBy("query_id").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id")).alias("every"))
    best = best.select("query_id", F.slice(F.array_sort("every"), 1, nearest + 1).alias("every")).join(one.select("same", F.col("vec_id").alias("query_id")), "query_id").drop("query_id")
    each = asked.select(F.col("vec_id").alias("query_id"), "same").join(best, "same")
    others = F.filter("every", lambda x: x["vec_id"] != F.col("query_id"))
    return each.select("query_id", F.explode(others).alias("found")).select("query_id", F.col("found.far").alias("far"), F.col("found.vec_id").alias("vec_id"))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, curves: int = CURVES, places: int | None = None, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``nearest`` rows of ``vectors`` found but its own id, by falling cosine, ties to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no
    part; a query meets vectors of its own length alone, and each length is an
    index of its own. A repeated row counts once; an id with several vectors is
    met, and asks, by each of them and counts by the nearest. Empty tables give an
    empty result. Only ``id_col`` and ``vector_col`` are read. ``curves`` orders
    are made; a query is looked up at ``places`` places, or as ``places_for`` has.
    """
    spark = vectors.sparkSession
    shared = Shared(spark)
    rows = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).distinct()
    widths = sorted(r["width"] for r in asked.select(F.size("vector").alias("width")).distinct().collect())
    found = spark.createDataFrame([], "query_id long, far double, vec_id long")
    for width in widths:
        found = found.unionByName(_of_width(rows, asked, width, nearest, curves, places, seed, shared))
    # Few rows for each query.
    best = found.groupBy("query_id", "vec_id").agg(F.min("far").alias("far")).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("far", "vec_id"))).alias("every"))
    top = best.select("query_id", F.posexplode(F.slice("every", 1, nearest)).alias("at", "found"))
    return top.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"), (-F.col("found.far")).alias("score"))
