"""Near-duplicate groups: MinHash bands, verification by signature and in full, and components.

Texts with the same set of shingles are one class, so exact copies cost one row. Classes that
share a band of minima are in one bucket. A bucket proposes a spanning forest of its members by
their signatures, so a bucket of n copies proposes fewer than n links; links are confirmed on the
full sets, and components follow by large-star and small-star steps. Then the buckets are gone
through once more for pairs that are in different components and whose signatures are not clearly
below the threshold. Those are never rows: the members that have such a pair meet with their
texts, bucket by bucket, and only links that hold come out. A link between two classes that are
connected anyway changes nothing, so this is whole up to the chance that the minima of a linked
pair mislead (below 1e-4 for a link at exactly 80 %, and it must be the only way between the two).

Buckets above ``bucket_rows`` are divided by each later band's minima, twice if need be (once more
would lose links at 80 % more often than the chance above). What is still larger then agrees in
twelve minima. Its forests are made in blocks that all hold the bucket's first member; the second
time, its members outside the bucket's largest component meet all its members, block against
block, so every pair of two components meets. The work grows with the product of these two
numbers. A pair is looked at in one bucket only, that of its first shared bands.

Defined results: a text without words has an empty set and is linked with nothing. Fewer words
than a shingle has are one shingle. Repeated rows and equal texts are one class. Null ids are
never the least id unless a component has no other. Extra columns play no part in components.
``drop_near_copies`` decides by row, whatever rows share an id, and returns rows as they came.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import (
    LOWER_BYTES,
    id_or_none,
    row_identity,
    saved,
    texts_of,
    with_null_ids,
)

_REMEMBERED = 500_000
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64
)


@dataclass(frozen=True)
class NearParams:
    """A link: ``100 * shared >= percent * union`` of two sets of ``width``-word shingles."""

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    bucket_rows: int = 4_096
    #: Equal minima of all that make a pair worth confirming: four deviations below 80 %.
    least_equal: float = 0.66
    #: Members that one task goes through at once; whole buckets, so it may be more.
    chunk_rows: int = 4_096


class Shingles:
    """64-bit shingle hashes of texts, with a bounded memory of words."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        """The distinct shingles of a text, ascending."""
        tokens = text.encode().translate(LOWER_BYTES).split() if text else []
        if not tokens:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        try:
            hashes = [known[token] for token in tokens]
        except KeyError:
            if len(known) > _REMEMBERED:
                known.clear()
            for token in tokens:
                if token not in known:
                    known[token] = xxhash.xxh3_64_intdigest(token)
            hashes = [known[token] for token in tokens]
        each = np.array(hashes, dtype=np.uint64)
        width = min(self.width, len(each))
        # A short text is one sequence; its length keeps it apart from shingles.
        total = np.full(len(each) - width + 1, width, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for at in range(width):
                total = _scramble(total * _MIX[0] + each[at : at + len(total)])
        return np.unique(total)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def hash_functions(count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of universal hash functions."""
    random = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    return (
        random.integers(0, top, count, dtype=np.uint64) | np.uint64(1),
        random.integers(0, top, count, dtype=np.uint64),
    )


def minima(shingles: np.ndarray, factors: np.ndarray, summands: np.ndarray) -> np.ndarray:
    """The least upper 32 bits under every hash function, in blocks of bounded memory."""
    least = np.full(len(factors), np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 2_048):
            block = shingles[start : start + 2_048, None]
            hashed = ((block * factors + summands) >> np.uint64(32)).astype(np.uint32)
            np.minimum(least, hashed.min(axis=0), out=least)
    return least


def _node_of(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def sketches(
    docs: DataFrame, params: NearParams, names: tuple[str, ...] = ("doc_id", "text")
) -> DataFrame:
    """``doc_id, row, n_shingles, node, signature, marks, bands`` per document.

    ``row`` is the identity of the columns ``names``. ``node`` names the set of shingles,
    ``signature`` has one byte per minimum, ``bands`` a hash per band and ``marks`` its lower 32
    bits. Empty sets have none of the four.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingles(params.width)
        factors, summands = hash_functions(params.bands * params.rows)
        for batch in batches:
            for start in range(0, len(batch), 1_000):
                part = batch.iloc[start : start + 1_000]
                out = []
                for text in texts_of(part["text"]):
                    own = shingler.of(text)
                    if not len(own):
                        out.append((0, None, None, None, None))
                        continue
                    least = minima(own, factors, summands)
                    rows = least.reshape(params.bands, params.rows).tobytes()
                    size = 4 * params.rows
                    own_bands = [
                        xxhash.xxh3_64_intdigest(rows[at : at + size], seed=at) - (1 << 63)
                        for at in range(0, len(rows), size)
                    ]
                    marks = (np.array(own_bands, dtype=np.int64) & 0xFFFFFFFF).astype("<u4")
                    out.append((len(own), _node_of(own), (least & 255).astype(np.uint8).tobytes(),
                                marks.tobytes(), own_bands))
                counts, nodes, signs, marks, bands = zip(*out, strict=True)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].array,
                        "row": part["row"].array,
                        "n_shingles": counts,
                        "node": pd.array(nodes, dtype="Int64"),
                        "signature": signs,
                        "marks": marks,
                        "bands": bands,
                    }
                )

    schema = "doc_id long, row long, n_shingles long, node long, signature binary"
    schema += ", marks binary, bands array<long>"
    rows = docs.select(id_or_none(), row_identity(docs, list(names)).alias("row"), "text")
    return with_null_ids(rows.mapInPandas(run, schema))


def _buckets(classes: DataFrame, params: NearParams) -> tuple[DataFrame, DataFrame | None]:
    """``bucket, path, members, first, node`` of buckets with two classes or more.

    ``path`` has the bands that make the bucket. Those of three bands that still exceed
    ``bucket_rows`` come apart from the others, if there are any.
    """
    held = classes.select("node", F.posexplode("bands").alias("band", "bucket")).select(
        "node", "bucket", F.array("band").alias("path")
    )
    done: list[DataFrame] = []
    for depth in range(3):
        counts = (
            held.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("first"))
            .filter("members > 1")
        )
        members = saved(held.join(counts, "bucket"), "near-buckets")
        large = members.filter(F.col("members") > params.bucket_rows)
        if large.isEmpty():
            done.append(members)
            break
        done.append(members.filter(F.col("members") <= params.bucket_rows))
        if depth == 2:
            return reduce(DataFrame.unionByName, done), large
        held = (
            large.select("node", "bucket", "path")
            .join(classes.select("node", "bands"), "node")
            .select("node", "bucket", "path", F.posexplode("bands").alias("band", "more"))
            .filter(F.col("band") > F.element_at("path", -1))
            .select(
                "node",
                F.xxhash64("bucket", "more").alias("bucket"),
                F.concat("path", F.array("band")).alias("path"),
            )
        )
    return reduce(DataFrame.unionByName, done), None


def _blocks(rows: Column, params: NearParams) -> Column:
    return F.ceil(rows / F.lit(params.bucket_rows)).cast("long")


def _forest_blocks(large: DataFrame, params: NearParams) -> DataFrame:
    """The large buckets' members as blocks for forests, each with the bucket's first member."""
    blocks = _blocks(F.col("members"), params)
    own = F.array(F.pmod(F.xxhash64("node"), blocks))
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    block = F.explode(F.when(F.col("node") == F.col("first"), every).otherwise(own))
    return large.withColumn("block", block).select(
        F.xxhash64("bucket", "block").alias("bucket"), "path", "members", "first", "node"
    )


def _block_pairs(large: DataFrame, params: NearParams) -> DataFrame:
    """Members of large buckets, with their groups, as pairs of blocks.

    ``side`` 1 has the members outside the bucket's largest group, ``side`` 2 has all members. Two
    members of different groups meet in one pair of blocks at least.
    """
    sizes = large.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("bucket").agg(
        F.max_by("group", F.struct("size", "group")).alias("main"),
        (F.sum("size") - F.max("size")).alias("others"),
    )
    met = large.join(main.filter("others > 0"), "bucket")
    lefts, rights = _blocks(F.col("others"), params), _blocks(F.col("members"), params)
    key = F.xxhash64("node")
    zero = F.lit(0).cast("long")
    left = met.filter(F.col("group") != F.col("main")).withColumns(
        {"left": F.pmod(key, lefts), "right": F.explode(F.sequence(zero, rights - 1))}
    )
    right = met.withColumns(
        {"left": F.explode(F.sequence(zero, lefts - 1)), "right": F.pmod(key, rights)}
    )
    return (
        left.withColumn("side", F.lit(1))
        .unionByName(right.withColumn("side", F.lit(2)))
        .withColumn("bucket", F.xxhash64("bucket", "left", "right"))
        .select("bucket", "path", "side", "node", "group", "signature", "marks")
    )


def _spans(rows: pd.DataFrame) -> Iterator[np.ndarray]:
    """Places of each bucket's members in sorted rows."""
    buckets = rows["bucket"].to_numpy(np.int64)
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
    for start, end in zip(starts, np.append(starts[1:], len(buckets)), strict=True):
        yield np.arange(start, end)


def _signs(rows: pd.DataFrame, params: NearParams) -> np.ndarray:
    width = params.bands * params.rows
    return np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(-1, width)


def _marks(rows: pd.DataFrame, params: NearParams) -> np.ndarray:
    return np.frombuffer(b"".join(rows["marks"]), "<u4").reshape(-1, params.bands)


def _least_equal(params: NearParams) -> int:
    return int(np.ceil(params.least_equal * params.bands * params.rows))


def _forest(params: NearParams):
    """Spanning forests of a chunk's buckets: each member by its likeliest link (Prim's walk)."""
    least = _least_equal(params)

    def walk(nodes: np.ndarray, signs: np.ndarray) -> Iterator[tuple[int, int]]:
        equal = np.full(len(nodes), -1, dtype=np.int64)
        link = np.zeros(len(nodes), dtype=np.int64)
        waiting = np.ones(len(nodes), dtype=bool)
        at = 0
        for _ in range(len(nodes) - 1):
            waiting[at] = False
            now = (signs == signs[at]).sum(axis=1)
            closer = waiting & (now > equal)
            equal[closer], link[closer] = now[closer], at
            at = int(np.where(waiting, equal, -2).argmax())
            if equal[at] >= least:
                yield nodes[link[at]], nodes[at]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "node"], kind="stable")
        signs, nodes = _signs(rows, params), rows["node"].to_numpy(np.int64)
        pairs = {
            (min(a, b), max(a, b))
            for take in _spans(rows)
            for a, b in walk(nodes[take], signs[take])
        }
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype="int64")

    return work


def _open_pairs(
    groups: np.ndarray,
    signs: np.ndarray,
    marks: np.ndarray,
    sides: np.ndarray,
    path: list[int],
    params: NearParams,
) -> Iterator[tuple[int, np.ndarray]]:
    """(member, later members) of one bucket: other component, alike enough, not met before.

    A pair met before if it shares an earlier band, by ``marks``: the buckets are those of whole
    bands, and a few bytes of the minima would take a pair for met that never was. In a pair of blocks, members of side 1 come first and meet those of side 2 only.
    """
    if (groups == groups[0]).all():
        return
    least = _least_equal(params)
    inside = np.zeros(params.bands, dtype=bool)
    inside[path] = True
    before = ~inside
    before[path[-1] :] = False
    second = int(np.searchsorted(sides, 2))
    for at in range(min(second, len(groups) - 1)):
        start = second if sides[at] == 1 else at + 1
        later = np.flatnonzero(groups[start:] != groups[at]) + start
        if len(later):
            later = later[(signs[later] == signs[at]).sum(axis=1) >= least]
        if len(later) and before.any():
            shared = marks[later][:, before] == marks[at][before]
            later = later[~shared.any(axis=1)]
        if len(later):
            yield at, later


def _members(params: NearParams):
    """Members of a chunk's buckets that have an open pair there."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "side", "node"], kind="stable").reset_index(drop=True)
        signs, marks = _signs(rows, params), _marks(rows, params)
        groups = rows["group"].to_numpy(np.int64)
        sides = rows["side"].to_numpy(np.int64)
        needed = np.zeros(len(rows), dtype=bool)
        for take in _spans(rows):
            path = list(rows["path"].iloc[take[0]])
            for at, later in _open_pairs(
                groups[take], signs[take], marks[take], sides[take], path, params
            ):
                needed[take[at]] = True
                needed[take[later]] = True
        return rows.loc[needed, ["bucket", "path", "side", "node", "group", "signature", "marks"]]

    return work


def _late_links(params: NearParams):
    """Confirmed links between components inside a chunk's buckets, fewer than their members."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "side", "node"], kind="stable").reset_index(drop=True)
        signs, marks = _signs(rows, params), _marks(rows, params)
        groups = rows["group"].to_numpy(np.int64)
        sides = rows["side"].to_numpy(np.int64)
        nodes = rows["node"].to_numpy(np.int64)
        shingler = Shingles(params.width)
        sets: dict[int, np.ndarray] = {}
        links = []
        for take in _spans(rows):
            own = groups[take].copy()
            sets.clear()
            path = list(rows["path"].iloc[take[0]])
            for at, later in _open_pairs(
                groups[take], signs[take], marks[take], sides[take], path, params
            ):
                for other in later:
                    if own[other] == own[at]:
                        continue
                    for each in (at, other):
                        if each not in sets:
                            sets[each] = shingler.of(rows["text"].iat[take[each]])
                    if _similar(sets[at], sets[other], params):
                        links.append((nodes[take[at]], nodes[take[other]]))
                        own[own == own[other]] = own[at]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return work


def _similar(left: np.ndarray, right: np.ndarray, params: NearParams) -> bool:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= params.percent * (len(left) + len(right) - shared)


def _chunked(buckets: DataFrame, params: NearParams) -> DataFrame:
    """Deals whole buckets to chunks of about ``chunk_rows``."""
    chunks = max(1, -(-buckets.count() // params.chunk_rows))
    return buckets.withColumn("chunk", F.pmod(F.xxhash64("bucket"), F.lit(chunks)).cast("int"))


def confirmed(pairs: DataFrame, texts: DataFrame, params: NearParams) -> DataFrame:
    """The pairs whose full sets are similar enough. ``texts`` has ``node, text``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingles(params.width)
        for batch in batches:
            keep = [
                _similar(shingler.of(own), shingler.of(other), params)
                for own, other in zip(batch["own"], batch["other"], strict=True)
            ]
            yield batch.loc[keep, ["a", "b"]]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("own"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def _texts(
    docs: DataFrame,
    classes: DataFrame,
    nodes: DataFrame,
    params: NearParams,
    names: tuple[str, ...],
) -> DataFrame:
    """``node, text`` of some classes, each from one row, whatever rows share its id."""
    wanted = classes.select("node", F.col("best.row").alias("row")).join(nodes, "node", "left_semi")
    own = docs.select(row_identity(docs, list(names)).alias("row"), "text")
    met = own.join(wanted, "row").select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingles(params.width)
        for batch in batches:
            # Another row may have the same hash.
            same = [
                _node_of(shingler.of(text)) == node
                for node, text in zip(batch["node"], texts_of(batch["text"]), strict=True)
            ]
            yield batch[same]

    return met.mapInPandas(run, "node long, text string").groupBy("node").agg(
        F.min("text").alias("text")
    )


def connect(links: DataFrame) -> DataFrame:
    """``node, group`` of the linked nodes by alternating large-star and small-star.

    Every round is written, so lineage stays short; rounds grow with the logarithm of the
    longest path.
    """
    edges = saved(links.select("a", "b"), "near-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("x"), F.col("m").alias("y"))
            .filter("x <> y")
            .distinct()
        )
        low = large.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        parents = low.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            low.join(parents, "a")
            .select(F.col("b").alias("x"), F.col("m").alias("y"))
            .unionByName(parents.select(F.col("a").alias("x"), F.col("m").alias("y")))
            .filter("x <> y")
            .distinct()
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
        )
        small = saved(small, "near-small-star")
        # Done when every node hangs on one other, and that one on none.
        ends = small.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        tops = small.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        roles = ends.unionByName(tops).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if roles.filter("up > 1 or (up = 1 and down = 1)").isEmpty():
            leaves = small.select(F.col("a").alias("node"), F.col("b").alias("group"))
            return leaves.unionByName(leaves.select(F.col("group").alias("node"), "group").distinct())
        edges = small


def _connected(
    docs: DataFrame, params: NearParams, names: tuple[str, ...]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows; classes, with their ``best`` row; ``node, group`` of linked ones."""
    found = saved(sketches(docs, params, names), "near-sketches")
    classes = saved(
        found.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row")).alias("best"),
            F.min("signature").alias("signature"),
            F.min("marks").alias("marks"),
            F.min("bands").alias("bands"),
        ),
        "near-classes",
    )
    buckets, large = _buckets(classes, params)
    walked = buckets if large is None else buckets.unionByName(_forest_blocks(large, params))
    signed = classes.select("node", "signature")
    forest = (
        _chunked(walked, params)
        .join(signed, "node")
        .groupBy("chunk")
        .applyInPandas(_forest(params), "a long, b long")
    )
    first = saved(forest.distinct(), "near-forest")
    # A class with any likely partner in its bucket or block has a link in a forest, so these
    # texts serve twice.
    named = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = saved(_texts(docs, classes, named, params, names), "near-texts")
    links = saved(confirmed(first, texts, params), "near-links")
    groups = saved(connect(links), "near-groups")
    marked = classes.select("node", "signature", "marks")
    grouped = marked.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    likely = grouped.join(named, "node", "left_semi")
    shape = "bucket long, path array<int>, side int, node long, group long, signature binary"
    shape += ", marks binary"
    needed = (
        _chunked(buckets, params)
        .join(likely, "node")
        .withColumn("side", F.lit(0))
        .groupBy("chunk")
        .applyInPandas(_members(params), shape)
    )
    if large is not None:
        # A likely partner may be in another block, so all members of a large bucket take part.
        pairs = saved(_block_pairs(large.join(grouped, "node"), params), "near-blocks")
        across = _chunked(pairs, params).groupBy("chunk").applyInPandas(_members(params), shape)
        needed = saved(needed.unionByName(across), "near-needed")
        more = needed.select("node").distinct().join(named, "node", "left_anti")
        texts = texts.unionByName(saved(_texts(docs, classes, more, params, names), "near-texts"))
    else:
        needed = saved(needed, "near-needed")
    late = saved(
        _chunked(needed, params)
        .join(texts, "node")
        .groupBy("chunk")
        .applyInPandas(_late_links(params), "a long, b long"),
        "near-late",
    )
    if not late.isEmpty():
        # The stars that are known stand for the links they came from.
        stars = groups.filter("node <> group").select(
            F.col("node").alias("a"), F.col("group").alias("b")
        )
        groups = saved(connect(stars.unionByName(late)), "near-groups")
    return found, classes, groups


def components(docs: DataFrame, params: NearParams | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document."""
    found, classes, groups = _connected(docs, params or NearParams(), ("doc_id", "text"))
    # Few classes are in a component; the others stand for themselves.
    members = classes.select("node", "least").join(groups, "node")
    roots = members.groupBy("group").agg(F.min("least").alias("root"))
    named = members.join(roots, "group").select("node", "root")
    owner = classes.select("node", "least").join(named, "node", "left").select(
        "node", F.coalesce("root", "least").alias("component_id")
    )
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    # Copies of one class may be many: the class id is salted on both sides.
    salts = 8
    left = found.select("doc_id", "n_shingles", "node").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    )
    right = owner.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, ["node", "salt"], "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, params: NearParams | None = None) -> DataFrame:
    """One row of each component, in all its columns: that of the least id, null ids last.

    Of several such rows the one with the lowest hash stays. A row without words stays; of equal
    ones, one does.
    """
    found, classes, groups = _connected(docs, params or NearParams(), tuple(docs.columns))
    best = (
        classes.join(groups, "node", "left")
        .groupBy(F.coalesce("group", "node").alias("group"))
        .agg(F.min("best").alias("best"))
        .select("best.row")
    )
    wordless = found.filter("node is null").select("row")
    counts = found.groupBy("row").agg(F.count(F.lit(1)).alias("_rows"))
    kept = best.unionByName(wordless).distinct().join(counts, "row")
    rows = docs.select(F.struct("*").alias("_row"), row_identity(docs, docs.columns).alias("row"))
    met = rows.join(kept, "row")
    several = met.filter("_rows > 1").groupBy("row").agg(F.first("_row").alias("_row"))
    return met.filter("_rows = 1").select("_row.*").unionByName(several.select("_row.*"))
