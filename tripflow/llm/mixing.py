"""Mixing sources to target weights by pivotal dependent rounding.

Sources share all words by weight, none above ``max_repeats`` times its own. Every document then
expects ``target / source size`` copies; the whole part is certain, and the fractions are rounded
together: two documents of one source meet, and words move at random from one's expectation to
the other's until one of the two is a whole number. Expectations and the source's expected words
stay as they are, so a source ends within one document of its target.

The meetings form a tree. Documents are dealt into leaves by a hash of their values, each leaf
leaves at most one open document, and the open ones meet in the next level's nodes. Leaves also
set documents of one chance aside, which go on to their source's last node: there, what the pairs
leave open is rounded against them, so a long document does not miss the target. Dealing and
drawing depend on nothing but the rows and the seed: reruns agree on any partitioning.

Defined results: a null text has no words; documents without words take part with rate 0 copies
if their source has none, and weigh nothing. Null is a source of its own, the last. Equal rows
are one unit that is taken several times, so repeated rows and hot ids cost nothing extra. An
empty table gives no rows. Extra columns only tell rows apart in ``mix``.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import id_or_none, row_identity, saved, with_null_ids

#: Rows of one source that meet in one leaf, and open documents that meet in one node.
LEAF_ROWS = 4_096
#: Documents of one source that are set aside for its last node, or one for each node.
ASIDE_ROWS = 65_536
UNIT = "doc_id long, source string, size long, identity long, times long"


@dataclass(frozen=True)
class Mix:
    """Weights by the source's place in code point order, repeating."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: Fraction = Fraction(1)
    max_repeats: int = 3
    seed: int = 17


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Numbers the distinct sources in code point order, null last, without a one-task window."""
    ordered = saved(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumns(
            {
                "part": F.spark_partition_id(),
                "inside": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
            }
        ),
        "mix-sources",
    )
    # One number per partition of the sort.
    counts = ordered.groupBy("part").count().orderBy("part").collect()
    offsets, total = {}, 0
    for row in counts:
        offsets[row.part] = total
        total += row["count"]
    if not offsets:
        return ordered.withColumn("rank", F.lit(0).cast("long")).drop("part", "inside")
    first = F.element_at(
        F.create_map(*[F.lit(x) for item in offsets.items() for x in item]), F.col("part")
    )
    return ordered.withColumn("rank", (first + F.col("inside")).cast("long")).drop(
        "part", "inside"
    )


def _above(cap: Column, weights: tuple[int, ...], level: Fraction) -> Column:
    """Whether a source's cap is below its weight's share, in whole numbers at every size.

    ``cap < weight * level`` holds for whole caps up to ``ceil(weight * level) - 1``, which is
    worked out here for each of the few weights.
    """
    found = F.lit(False)
    for weight in sorted(set(weights)):
        bound = min(-(-weight * level.numerator // level.denominator), (1 << 63) - 1)
        found = F.when(F.col("weight") == weight, cap < F.lit(bound).cast("long")).otherwise(found)
    return found


def source_targets(units: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_rows, source_size, target`` per source; only sums reach the driver.

    A source at its cap keeps the cap and the others share the rest, until none is above.
    """
    sizes = units.groupBy("source").agg(
        F.sum("times").alias("source_rows"),
        F.sum(F.col("size") * F.col("times")).alias("source_size"),
    )
    weight = F.element_at(
        F.array(*map(F.lit, mix.weights)),
        (F.col("rank") % len(mix.weights) + 1).cast("int"),
    )
    weighed = saved(_ranked(sizes).withColumn("weight", weight), "mix-weights")
    cap = F.col("source_size") * mix.max_repeats
    whole = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("w")).first()
    wanted = Fraction(whole.words or 0) * mix.share
    level = Fraction(wanted, whole.w) if whole.w else Fraction(0)
    free = None
    while whole.w:
        above = _above(cap, mix.weights, level)
        sums = weighed.agg(
            F.sum(F.when(above, cap)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("w"),
            F.count(F.when(~above, True)).alias("free"),
        ).first()
        if not sums.w or sums.free == free:
            break
        free, level = sums.free, Fraction(wanted - (sums.capped or 0), sums.w)
    target = F.least(cap.cast("double"), F.col("weight") * float(level))
    return weighed.select("source", "source_rows", "source_size", target.alias("target"))


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per 64-bit key: the finaliser of SplitMix64."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def round_pivotally(
    chance: np.ndarray, size: np.ndarray, draw: np.ndarray
) -> tuple[np.ndarray, int | None]:
    """Rounds chances in turn; what stays open, if any, is named by its place.

    Words move between the open document and the next one until either is 0 or 1. ``size``
    should fall, so that what stays open is small.
    """
    done = np.zeros(len(chance), dtype=np.int64)
    p, w, u = chance.tolist(), size.tolist(), draw.tolist()
    held: int | None = None
    for at in range(len(p)):
        if p[at] <= 1e-12 or p[at] >= 1 - 1e-12:
            done[at] = p[at] >= 0.5
            continue
        if held is None:
            held = at
            continue
        a, b = p[held] * w[held], p[at] * w[at]
        # Words that can move to the held document, and words that can move to the new one.
        gain = min(w[held] - a, b)
        loss = min(a, w[at] - b)
        moved = gain if u[at] * (gain + loss) < loss else -loss
        a, b = a + moved, b - moved
        p[held], p[at] = a / w[held], b / w[at]
        open_ = []
        for each in (held, at):
            if p[each] <= 1e-9 or p[each] >= 1 - 1e-9:
                done[each] = p[each] >= 0.5
            else:
                open_.append(each)
        held = open_[0] if open_ else None
    if held is not None:
        chance[held] = p[held]
    return done, held


def round_against_rest(
    chance: np.ndarray, size: np.ndarray, draw: np.ndarray, again: np.ndarray
) -> np.ndarray:
    """Rounds documents in turn, each against all later ones together.

    Words move between a document and the rest, which shares them out alike. All but the first
    must have one chance, or sharing would draw their chances together. Where sizes fall, only a
    small document is left to be drawn by itself.
    """
    done = np.zeros(len(chance), dtype=np.int64)
    words = np.append(np.cumsum((chance * size)[::-1])[::-1], 0.0)
    sizes = np.append(np.cumsum(size[::-1])[::-1], 0.0)
    # What was p is now scale * p + shift, for all documents that are still open.
    scale, shift = 1.0, 0.0
    for at in range(len(chance)):
        p, w = min(1.0, max(0.0, scale * chance[at] + shift)), size[at]
        rest = scale * words[at + 1] + shift * sizes[at + 1]
        room = sizes[at + 1] - rest
        gain, loss = min((1 - p) * w, rest), min(p * w, room)
        if gain + loss > 0 and draw[at] * (gain + loss) < loss:
            p += gain / w
            scale, shift = scale * (1 - gain / rest), shift * (1 - gain / rest)
        elif gain + loss > 0:
            p -= loss / w
            grow = loss / room
            scale, shift = scale * (1 - grow), shift * (1 - grow) + grow
        # Open only if the rest was used up, which then is all 0 or all 1.
        taken = p > 0.5 if min(p, 1 - p) < 1e-9 else again[at] < p
        done[at] = taken
    return done


def _node(level: int, seed: int):
    """Rounds one node's documents in pairs; the open one goes on.

    Of the documents of the commonest chance every other one is set aside, or fewer where a
    source has many nodes. In the source's last node what the pairs leave open is rounded against
    those; before, they go on as they are.
    """

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["size", "doc_id", "identity"], ascending=[False, True, True], kind="stable"
        ).reset_index(drop=True)
        chance = rows["chance"].to_numpy(float, copy=True)
        identity = rows["identity"].to_numpy(np.int64)
        draw, again = _uniform(identity, seed + level), _uniform(identity, seed - 1)
        weights = np.maximum(rows["size"].to_numpy(float), 1e-3)
        done = np.zeros(len(rows), dtype=np.int64)
        aside = np.zeros(len(rows), dtype=bool)
        nodes = int(rows["nodes"].iloc[0])
        last = nodes == 1
        values, counts = np.unique(chance, return_counts=True)
        alike = np.flatnonzero(chance == values[counts.argmax()])
        if last:
            aside[alike[1::2]] = True
        else:
            step = max(2, -(-len(alike) // max(1, ASIDE_ROWS // nodes)))
            aside[alike[::-step]] = True
        paired = np.flatnonzero(~aside)
        own = chance[paired]
        done[paired], held = round_pivotally(own, weights[paired], draw[paired])
        rows["open"] = False
        if last:
            rest = np.flatnonzero(aside)
            if held is not None:
                chance[paired[held]] = own[held]
                rest = np.append(paired[held], rest)
            done[rest] = round_against_rest(chance[rest], weights[rest], draw[rest], again[rest])
        else:
            rows["open"] = aside
            if held is not None:
                rows.loc[paired[held], ["open", "chance"]] = [True, own[held]]
        rows["copies"] = rows["copies"] + done
        return rows

    return work


def _with_targets(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Joins a row per source. A hot source is salted on both sides, whatever the sources' number."""
    salts = 16
    few = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = units.withColumn("salt", F.pmod("identity", F.lit(salts)).cast("int"))
    same = salted["source"].eqNullSafe(few["source"]) & (salted["salt"] == few["salt"])
    return salted.join(few, same).select(
        salted["doc_id"], salted["source"], "size", "identity", "times", "source_rows",
        "source_size", "target",
    )


def decide(units: DataFrame, mix: Mix) -> DataFrame:
    """``UNIT`` rows with ``source_size, target, copies``: copies of all equal rows together."""
    units = saved(units, "mix-units")
    joined = _with_targets(units, source_targets(units, mix))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rate = F.coalesce(ratio, F.lit(0.0)) * F.col("times")
    leaves = F.ceil(F.col("source_rows") / LEAF_ROWS)
    rows = joined.select(
        "doc_id", "source", "size", "identity", "times", "source_size", "target",
        F.floor(rate + 1e-9).cast("long").alias("copies"),
        F.greatest(F.lit(0.0), rate - F.floor(rate + 1e-9)).alias("chance"),
        F.pmod("identity", leaves).cast("long").alias("node"),
        leaves.cast("long").alias("nodes"),
    )
    # A source of n rows needs as many levels as it takes to bring n down to one node.
    most = units.groupBy("source").agg(F.sum("times").alias("n")).agg(F.max("n")).first()[0] or 0
    finished: DataFrame | None = None
    level = 0
    while True:
        last = most <= LEAF_ROWS
        shape = f"{UNIT}, source_size long, target double, copies long, chance double, node long"
        shape += ", nodes long, open boolean"
        work = _node(level, mix.seed)
        met = saved(rows.groupBy("source", "node").applyInPandas(work, shape), "mix-level")
        closed = met.filter("not open").drop("chance", "node", "nodes", "open")
        finished = closed if finished is None else finished.unionByName(closed)
        if last:
            return with_null_ids(finished)
        most = -(-most // LEAF_ROWS)
        rows = (
            met.filter("open")
            .drop("open")
            .withColumn("node", F.floor(F.col("node") / LEAF_ROWS))
            .withColumn("nodes", F.ceil(F.col("nodes") / LEAF_ROWS))
        )
        level += 1


def _units(docs: DataFrame, identity: Column) -> DataFrame:
    """Equal rows as one unit. Partial counts are made before the shuffle."""
    return (
        docs.select(
            id_or_none(),
            F.col("source").cast("string"),
            word_count(F.col("text")).alias("size"),
            identity.alias("identity"),
        )
        .groupBy("doc_id", "source", "size", "identity")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def taken_words(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every document.

    Equal ids of one source and size share their copies as evenly as whole numbers allow.
    """
    identity = F.xxhash64("doc_id", "source", word_count(F.col("text")))
    decided = decide(_units(docs, identity), mix or Mix())
    each = decided.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    copies = F.floor(F.col("copies") / F.col("times")) + (
        F.col("number") <= F.col("copies") % F.col("times")
    ).cast("long")
    return each.withColumn("copies", copies.cast("long")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mix_documents(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The mixed documents, a row per copy, in all their columns."""
    identity = row_identity(docs, docs.columns)
    decided = decide(_units(docs, identity), mix or Mix())
    copies = decided.filter("copies > 0").select(
        F.col("doc_id").alias("_doc_id"),
        F.col("identity").alias("_identity"),
        F.col("copies").alias("_copies"),
        F.col("times").alias("_times"),
    )
    rows = docs.select(F.struct("*").alias("_row"), identity.alias("_own"))
    same = (F.col("_own") == F.col("_identity")) & F.col("_row.doc_id").cast("long").eqNullSafe(
        F.col("_doc_id")
    )
    met = rows.join(copies, same)
    once = met.filter("_times = 1")
    # Equal rows share their copies: one of them stands for all.
    shared = (
        met.filter("_times > 1")
        .groupBy("_own", "_doc_id")
        .agg(*[F.first(name).alias(name) for name in ("_row", "_copies")])
    )
    once, shared = (part.select("_row", "_copies") for part in (once, shared))
    return (
        once.unionByName(shared)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select("_row.*")
    )

