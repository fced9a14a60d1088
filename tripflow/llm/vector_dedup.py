"""Near copies among vectors, by counting collisions of one-dimensional projections.

Two vectors whose cosine reaches the threshold are at most a known distance apart once they have
length one, so each of their projections on random directions differs by at most ``window`` such
distances with a known chance. Projections are sorted; around every vector a window is opened in
each of them; and a pair whose windows meet often enough is verified by its cosine in double
precision. How often is often enough follows from the binomial law: a pair exactly at the
threshold is lost with a chance of ``miss`` at most.

Vectors of one label meet in cells. A cell above ``leaf_rows`` is divided along that one of some
sorted projections where it comes apart best: vectors up to ``halo`` distances beyond the cut are
also in the lower part, marked as guests there. A pair belongs to the one cell where, at every
cut, one of the two at least is no guest, so it is counted once and links are never rows. A cell
that no projection divides is a dense group; its members meet block against block, each pair of
blocks by itself, so the work of a dense group is dealt over the cluster. A cell returns, per
vector, the number of its links there and one edge of a spanning forest.

Equal vectors of a label are one class with a number of copies.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links
with nothing, and neither does one without a label. Vectors of different lengths do not link.
Repeated rows are copies. Components without any id are null. An empty table gives no rows. Other
columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import saved
from tripflow.llm.near_dedup import connect

ROW = "vec_id long, key binary, cell string, vector binary"


@dataclass(frozen=True)
class CollisionParams:
    """Distances are in units of the distance of two vectors exactly at the threshold."""

    cosine: float = 0.98
    projections: int = 32
    window: float = 1.5
    miss: float = 1e-4
    halo: float = 3.5
    leaf_rows: int = 1_024
    #: Sorted projections among which each division of a cell chooses.
    axes: int = 4
    #: A cut must leave less than this share of a cell in its larger part.
    least_gain: float = 0.85
    levels: int = 60
    seed: int = 11

    @property
    def distance(self) -> float:
        return math.sqrt(2 - 2 * self.cosine)

    @property
    def enough(self) -> int:
        """Collisions that make a pair worth verifying."""
        chance = math.erf(self.window / math.sqrt(2))
        below = 0.0
        for count in range(self.projections + 1):
            ways = math.comb(self.projections, count)
            below += ways * chance**count * (1 - chance) ** (self.projections - count)
            if below > self.miss:
                return count
        return self.projections


def directions(dimension: int, params: CollisionParams) -> np.ndarray:
    """A seeded random direction per column."""
    random = np.random.default_rng([params.seed, dimension])
    return random.standard_normal((dimension, params.projections))


def units(vectors: np.ndarray) -> np.ndarray:
    # The greatest component goes first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def classified(embeddings: DataFrame) -> DataFrame:
    """``ROW`` per vector; ``key`` is the digest of label and vector, null if it cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = lists.offsets.to_numpy()
            keys, cells, vectors = [], [], []
            for at, label in enumerate(batch.column(2).to_pylist()):
                vector = flat[offsets[at] : offsets[at + 1]] + 0.0  # no negative zero
                valid = lists[at].is_valid and label is not None and len(vector) > 0
                if not (valid and np.isfinite(vector).all() and vector.any()):
                    keys.append(None), cells.append(None), vectors.append(None)
                    continue
                cell = f"{label}/{len(vector)}/"
                data = vector.astype("<f8").tobytes()
                keys.append(hashlib.blake2b(cell.encode() + data, digest_size=16).digest())
                cells.append(cell)
                vectors.append(data)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(keys, pa.binary()),
                    pa.array(cells, pa.string()),
                    pa.array(vectors, pa.binary()),
                ],
                ["vec_id", "key", "cell", "vector"],
            )

    rows = embeddings.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<double>"),
        F.col("label").cast("string"),
    )
    return rows.mapInArrow(run, ROW)


def _projected(classes: DataFrame, params: CollisionParams) -> DataFrame:
    """``node, cell, guest, at``: classes with their projections; nobody is a guest yet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at: list = [None] * len(batch)
            sizes = batch["vector"].map(len).to_numpy()
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                vectors = np.stack([np.frombuffer(batch["vector"].iat[i], "<f8") for i in own])
                found = units(vectors) @ directions(size // 8, params)
                for i, row in zip(own, found, strict=True):
                    at[i] = row
            yield pd.DataFrame({"node": batch["node"], "cell": batch["cell"], "guest": 0, "at": at})

    schema = "node long, cell string, guest long, at array<double>"
    return classes.select("node", "cell", "vector").mapInPandas(run, schema)


def _best_cut(axis: Column, marks: Column, halo: float) -> Column:
    """The cut at one of an axis' twentieths that leaves the least in its larger part."""
    share = 1 / 20

    def cost(cut: Column) -> Column:
        low = F.size(F.filter(marks, lambda x: x <= cut + halo)) * share + share
        high = F.size(F.filter(marks, lambda x: x > cut)) * share + share
        return F.struct(
            F.greatest(low, high).alias("larger"),
            (low + high).alias("both"),
            axis.alias("axis"),
            cut.alias("cut"),
        )

    return F.array_min(F.transform(marks, cost))


def _cuts(held: DataFrame, level: int, params: CollisionParams) -> DataFrame:
    """``cell, members, best`` of the cells that are too large; ``best`` is null if nothing
    divides a cell."""
    own = [(level * params.axes + i) % params.projections for i in range(params.axes)]
    steps = [i / 20 for i in range(1, 20)]
    marks = [F.percentile_approx(F.get("at", F.lit(i)), steps).alias(f"m{i}") for i in own]
    found = held.groupBy("cell").agg(F.count(F.lit(1)).alias("members"), *marks)
    halo = params.halo * params.distance
    best = F.array_min(F.array(*[_best_cut(F.lit(i), F.col(f"m{i}"), halo) for i in own]))
    return found.filter(F.col("members") > params.leaf_rows).select(
        "cell", "members", F.when(best["larger"] < params.least_gain, best).alias("best")
    )


def _cells(rows: DataFrame, params: CollisionParams) -> DataFrame:
    """``node, guest, cell, side``: vectors in the cells where they meet.

    ``side`` is 0 where all meet all, and 1 or 2 where those of one side meet those of the other.
    """
    done: list[DataFrame] = []
    held = saved(rows, "vector-cells")
    tried = 0  # levels in a row in which some cell found no cut
    for level in range(params.levels):
        cuts = saved(_cuts(held, level, params), "vector-cuts")
        done.append(held.join(cuts, "cell", "left_anti").withColumn("side", F.lit(0)))
        sizes = cuts.agg(F.count("cell").alias("all"), F.count("best").alias("cut")).first()
        if not sizes["all"]:
            break
        large = held.join(cuts, "cell")
        # Other axes may still divide what these do not; after all of them the rest is dense.
        tried = 0 if sizes["cut"] else tried + 1
        if tried * params.axes >= params.projections or level + 1 == params.levels:
            done.append(_dense(large, params))
            break
        value = F.get("at", F.col("best.axis"))
        cut, bit = F.col("best.cut"), F.lit(1 << level)
        low = F.struct(
            F.concat("cell", F.lit("l")).alias("cell"),
            F.when(value > cut, F.col("guest").bitwiseOR(bit)).otherwise(F.col("guest")).alias("guest"),
        )
        high = F.struct(F.concat("cell", F.lit("h")).alias("cell"), F.col("guest").alias("guest"))
        as_is = F.struct(F.col("cell").alias("cell"), F.col("guest").alias("guest"))
        halo = params.halo * params.distance
        parts = (
            F.when(F.col("best").isNull(), F.array(as_is))
            .when(value <= cut, F.array(low))
            .when(value <= cut + halo, F.array(low, high))
            .otherwise(F.array(high))
        )
        held = saved(
            large.select("node", "at", F.explode(parts).alias("to")).select(
                "node", "to.cell", "to.guest", "at"
            ),
            "vector-cells",
        )
    names = ("node", "guest", "cell", "side")
    return reduce(DataFrame.unionByName, [part.select(*names) for part in done])


def _dense(large: DataFrame, params: CollisionParams) -> DataFrame:
    """Members of cells that nothing divides, in pairs of blocks."""
    blocks = F.ceil(F.col("members") / F.lit(params.leaf_rows)).cast("long")
    own = large.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node"), blocks)})
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first, second = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(first == second, 0).when(F.col("own") == first, 1).otherwise(2)
    return met.select(
        "node",
        "guest",
        F.concat_ws("#", "cell", first, second).alias("cell"),
        side.cast("int").alias("side"),
    )


def collisions(at: np.ndarray, start: int, stop: int, reach: float) -> np.ndarray:
    """In how many sorted projections each row lies in the windows of rows ``start`` to ``stop``."""
    counts = np.zeros((stop - start, len(at)), dtype=np.uint8)
    for column in range(at.shape[1]):
        own = at[:, column]
        order = np.argsort(own, kind="stable")
        rank = np.empty(len(own), dtype=np.int32)
        rank[order] = np.arange(len(own), dtype=np.int32)
        ranked = own[order]
        low = np.searchsorted(ranked, own[start:stop] - reach, "left").astype(np.int32)
        high = np.searchsorted(ranked, own[start:stop] + reach, "right").astype(np.int32)
        counts += (rank >= low[:, None]) & (rank < high[:, None])
    return counts


def linked_pairs(
    vectors: np.ndarray, guest: np.ndarray, side: np.ndarray, params: CollisionParams
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (earlier, later) of rows that link and belong to this cell."""
    unit = units(vectors)
    at = unit @ directions(vectors.shape[1], params)
    reach = params.window * params.distance
    for start in range(0, len(at), 256):
        stop = min(len(at), start + 256)
        counts = collisions(at, start, stop, reach)
        first, second = np.nonzero(counts >= params.enough)
        first += start
        owned = (first < second) & (guest[first] & guest[second] == 0)
        owned &= (side[first] == 0) | (side[first] != side[second])
        first, second = first[owned], second[owned]
        for here in range(0, len(first), 65_536):
            a, b = first[here : here + 65_536], second[here : here + 65_536]
            cosine = np.einsum("ij,ij->i", unit[a], unit[b])
            yield a[cosine >= params.cosine], b[cosine >= params.cosine]


def roots(count: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least row that each row reaches."""
    root = np.arange(count)
    if not pairs:
        return root
    a, b = (np.concatenate(part) for part in zip(*pairs, strict=True))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _cell_links(params: CollisionParams):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        vectors = np.stack([np.frombuffer(data, "<f8") for data in rows["vector"]])
        guest, side = rows["guest"].to_numpy(np.int64), rows["side"].to_numpy(np.int64)
        times, node = rows["times"].to_numpy(np.int64), rows["node"].to_numpy(np.int64)
        links = np.zeros(len(rows), dtype=np.int64)
        pairs = []
        for a, b in linked_pairs(vectors, guest, side, params):
            np.add.at(links, a, times[b])
            np.add.at(links, b, times[a])
            pairs.append((a, b))
        root = roots(len(rows), pairs)
        linked = links > 0
        return pd.DataFrame({"a": node[linked], "b": node[root[linked]], "links": links[linked]})

    return work


def linked_vectors(embeddings: DataFrame, params: CollisionParams | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector."""
    params = params or CollisionParams()
    rows = classified(embeddings)
    classes = saved(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(
            F.first("cell").alias("cell"),
            F.first("vector").alias("vector"),
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("times"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    cells = _cells(_projected(classes, params), params)
    links = saved(
        cells.join(classes.select("node", "vector", "times"), "node")
        .groupBy("cell")
        .applyInPandas(_cell_links(params), "a long, b long, links long"),
        "vector-links",
    )
    counted = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = connect(links.filter("a <> b").select("a", "b"))
    members = classes.select("node", "least").join(groups, "node")
    named = members.join(members.groupBy("group").agg(F.min("least").alias("root")), "group")
    found = (
        classes.select("key", "node", "least", "times")
        .join(counted, "node", "left")
        .join(named.select("node", "root"), "node", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("root")).alias("component_id"),
        )
    )
    met = rows.select("vec_id", "key").join(found, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return met.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
