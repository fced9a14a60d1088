"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

A text's paragraphs are its lines, long ones in pieces of a few words. Where a long line is cut
depends on the characters before the cut, so a word more or less changes the pieces around it and
no others. Every piece is a 64-bit
digest of its text and of how often it stood before, and each digest is added to one cell in each
of four parts of a table: its count, the xor of the digests and the xor of their checks. Two
tables subtract cell by cell; what both have cancels, and the rest is peeled: a cell with one
digest gives it up, it is taken out of its other cells, and so on. If a table is too small for
the difference, both are made anew at twice the size.

Likeness is shared digests by all digests, both counted from the recovered difference. The
stored fingerprint is the digest count and a table of ``cells`` cells, in base 64; equal texts
have equal ones.

Documents are met with the next one in falling order of id. They are dealt once, by ranges of
the order, and a range also gets the first text of the next one.

Defined results: null and empty texts have no digests; two such are alike (1), one is unlike any
other text (0). Equal ids are ordered by a hash of their text, null ids come last; a single
document is its own next. Extra columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import bucket_of, id_or_none, saved, with_null_ids

PARTS = 4
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


@dataclass(frozen=True)
class SketchParams:
    """``cells`` of the stored table; comparisons start at the size their difference may need.

    Lines of over ``piece_words`` words are cut, on average after as many.
    """

    piece_words: int = 6
    cells: int = 24
    range_rows: int = 32_768
    max_ranges: int = 10_000


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def pieces(text: str, piece_words: int) -> list[bytes]:
    """The lines of a text, those of over ``piece_words`` words cut where their content says so.

    A cut follows a word if a hash of the four bytes up to it says so, once in ``piece_words``
    words. Where no word says so for long, a cut is made every ``4 * piece_words`` words, counted
    from the cut before.
    """
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    marks = np.flatnonzero((data == 32) | (data == 10))
    if not len(marks):
        return [raw] if raw else []
    ends_line = data[marks] == 10
    line = np.cumsum(ends_line) - ends_line
    long = np.bincount(line[~ends_line], minlength=line[-1] + 1)[line] >= piece_words
    padded = np.concatenate([np.zeros(4, dtype=np.uint8), data])
    tail = np.zeros(len(marks), dtype=np.uint64)
    for offset in range(4):
        tail = tail << np.uint64(8) | padded[marks + offset]
    cut = ends_line | (long & (_mixed(tail, 4) % np.uint64(piece_words) == 0))
    at = np.arange(len(marks))
    last = np.maximum.accumulate(np.where(cut, at, -1))
    since = at - np.append(-1, last[:-1])
    cut |= long & (since % (4 * piece_words) == 0)
    ends = marks[cut].tolist()
    return [
        raw[start:end]
        for start, end in zip([0, *(end + 1 for end in ends)], [*ends, len(raw)], strict=True)
    ]


def digests(text: str, piece_words: int) -> np.ndarray:
    """A 64-bit digest per piece; the n-th copy of a piece has a digest of its own."""
    found = [xxhash.xxh3_64_intdigest(piece) for piece in pieces(text, piece_words)]
    if not found:
        return np.zeros(0, dtype=np.uint64)
    each = np.sort(np.array(found, dtype=np.uint64))
    starts = np.flatnonzero(np.append(True, each[1:] != each[:-1]))
    number = np.arange(len(each)) - np.repeat(starts, np.diff(np.append(starts, len(each))))
    return _mixed(each + _mixed(number.astype(np.uint64), 1) * (number > 0), 2)


def table(keys: np.ndarray, cells: int, owner: np.ndarray | None = None, owners: int = 1):
    """Counts, digest xors and check xors of ``owners`` tables of ``cells`` cells, end to end."""
    counts = np.zeros(owners * cells, dtype=np.int64)
    sums = np.zeros(owners * cells, dtype=np.uint64)
    checks = np.zeros(owners * cells, dtype=np.uint64)
    check = _mixed(keys, 3)
    for at in _places(keys, cells, owner):
        np.add.at(counts, at, 1)
        np.bitwise_xor.at(sums, at, keys)
        np.bitwise_xor.at(checks, at, check)
    return counts, sums, checks


def _places(keys: np.ndarray, cells: int, owner: np.ndarray | None) -> Iterator[np.ndarray]:
    size = cells // PARTS
    first = 0 if owner is None else owner * cells
    for part in range(PARTS):
        inside = (_mixed(keys, 10 + part) >> np.uint64(20)) % np.uint64(size)
        yield inside.astype(np.int64) + part * size + first


def peel(difference: tuple, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Takes tables apart: (digests only left, only right, whole) per table.

    All tables of a batch are peeled together, each round all cells that hold one digest.
    """
    counts, sums, checks = difference
    owners = len(counts) // cells
    left = np.zeros(owners, dtype=np.int64)
    right = np.zeros(owners, dtype=np.int64)
    look = np.arange(len(counts))
    while len(look):
        single = look[np.abs(counts[look]) == 1]
        pure = single[checks[single] == _mixed(sums[single], 3)]
        if not len(pure):
            break
        owner, keys, sign = pure // cells, sums[pure], counts[pure]
        # A digest may be alone in several of its cells.
        order = np.lexsort((keys, owner))
        owner, keys, sign = owner[order], keys[order], sign[order]
        new = np.append(
            True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
        )
        owner, keys, sign = owner[new], keys[new], sign[new]
        left += np.bincount(owner[sign > 0], minlength=owners)
        right += np.bincount(owner[sign < 0], minlength=owners)
        check = _mixed(keys, 3)
        touched = []
        for at in _places(keys, cells, owner):
            np.subtract.at(counts, at, sign)
            np.bitwise_xor.at(sums, at, keys)
            np.bitwise_xor.at(checks, at, check)
            touched.append(at)
        look = np.unique(np.concatenate(touched))
    rest = (counts != 0) | (sums != 0) | (checks != 0)
    return left, right, ~rest.reshape(owners, cells).any(axis=1)


def compare(pairs: list[tuple[np.ndarray, np.ndarray]], cells: int) -> np.ndarray:
    """Likeness of each pair of digest arrays; pairs that fail to peel retry at twice the size."""
    out = np.zeros(len(pairs))
    sizes = np.array([cells] * len(pairs))
    for number, (a, b) in enumerate(pairs):
        # Sizes that differ by d leave d digests at the least.
        while sizes[number] < 1.5 * abs(len(a) - len(b)):
            sizes[number] *= 2
    waiting = np.arange(len(pairs))
    while len(waiting):
        again = []
        for size in np.unique(sizes[waiting]):
            own = waiting[sizes[waiting] == size]
            for start in range(0, len(own), max(1, 2_000_000 // int(size))):
                part = own[start : start + max(1, 2_000_000 // int(size))]
                only_left, only_right, whole = _difference([pairs[i] for i in part], int(size))
                for number, a_only, b_only, good in zip(
                    part, only_left, only_right, whole, strict=True
                ):
                    a, b = pairs[number]
                    if good and len(a) - a_only == len(b) - b_only:
                        union = len(a) + b_only
                        out[number] = (len(a) - a_only) / union if union else 1.0
                    else:
                        sizes[number] *= 2
                        again.append(number)
        waiting = np.array(sorted(again), dtype=np.int64)
    return out


def _difference(pairs: list[tuple[np.ndarray, np.ndarray]], cells: int):
    tables = []
    for side in (0, 1):
        keys = np.concatenate([pair[side] for pair in pairs])
        owner = np.repeat(np.arange(len(pairs)), [len(pair[side]) for pair in pairs])
        tables.append(table(keys, cells, owner, len(pairs)))
    (c1, s1, k1), (c2, s2, k2) = tables
    return peel((c1 - c2, s1 ^ s2, k1 ^ k2), cells)


def prints(all_keys: list[np.ndarray], cells: int) -> list[str]:
    """The stored form: count, then per cell count, digest xor and check xor, in base 64."""
    keys = np.concatenate(all_keys) if all_keys else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(all_keys)), [len(each) for each in all_keys])
    counts, sums, checks = table(keys, cells, owner, len(all_keys))
    cell = np.dtype([("count", "<i4"), ("sum", "<u8"), ("check", "<u2")])
    rows = np.empty(len(counts), dtype=cell)
    rows["count"], rows["sum"], rows["check"] = counts, sums, checks
    size = cells * cell.itemsize
    data = rows.tobytes()
    return [
        f"{len(each)}:{base64.b64encode(data[at * size : (at + 1) * size]).decode()}"
        for at, each in enumerate(all_keys)
    ]


def edited(text: str, following: str) -> str:
    """The text with its second half given up for as many characters of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ordered(docs: DataFrame) -> DataFrame:
    """``doc_id, text, key``: keys ascend as ids fall; equal rows differ in their place only."""
    flipped = F.bitwise_not(F.col("doc_id")).bitwiseXOR(F.lit(-(1 << 63)))
    key = F.concat(
        F.when(F.col("doc_id").isNull(), "1").otherwise("0"),
        F.lpad(F.hex(F.coalesce(flipped, F.lit(0))), 16, "0"),
        F.lpad(F.hex(F.xxhash64("text")), 16, "0"),
        F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0"),
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.withColumn("key", key)


def _ranges(rows: DataFrame, params: SketchParams) -> tuple[DataFrame, int]:
    """Deals rows to ranges of the order; a sample of a few keys per range sets the bounds."""
    count = rows.count()
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(params.max_ranges, max(least, -(-count // params.range_rows)))
    share = min(1.0, 20 * ranges / max(1, count))
    keys = sorted(row.key for row in rows.select("key").sample(share, 11).collect())
    picks = [keys[len(keys) * number // ranges] for number in range(1, ranges)] if keys else []
    bounds = sorted(set(picks))
    place = bucket_of(F.col("key"), F.lit(bounds), len(bounds)) if bounds else F.lit(0)
    return rows.withColumn("range", place.cast("int")), len(bounds) + 1


def with_next(docs: DataFrame, params: SketchParams) -> DataFrame:
    """``range, key, doc_id, text, ends``, dealt by range and in order; a row that ``ends`` a
    range is the next range's first text and not a document of its own."""
    rows, count = _ranges(_ordered(docs), params)
    # One row per range; the texts stay in Spark.
    firsts = saved(
        rows.groupBy("range").agg(
            F.min_by("text", "key").alias("text"), F.min("key").alias("first")
        ),
        "print-firsts",
    )
    used = sorted(row["range"] for row in firsts.select("range").collect())
    if not used:
        before = F.lit(0)
    else:
        ends = [used[-1]] * (used[-1] + 1)
        for earlier, later in zip(used, used[1:], strict=False):
            ends[later] = earlier
        before = F.get(F.lit(ends), F.col("range"))
    ghosts = firsts.select(
        F.lit(None).cast("long").alias("doc_id"),
        "text",
        F.lit("2").alias("key"),
        before.cast("int").alias("range"),
        F.lit(True).alias("ends"),
    )
    both = rows.withColumn("ends", F.lit(False)).unionByName(ghosts)
    return both.repartitionById(count, F.col("range")).sortWithinPartitions("range", "key")


def fingerprint_documents(docs: DataFrame, params: SketchParams | None = None) -> DataFrame:
    """``SCHEMA`` for every document."""
    params = params or SketchParams()

    def keys_of(text: str) -> np.ndarray:
        return digests(text, params.piece_words)

    def finish(held: list[tuple], following: tuple) -> pd.DataFrame:
        """Rows of (doc_id, text, digests), each of which is followed by the next of them."""
        after = [*held[1:], following]
        changed = [edited(own[1], other[1]) for own, other in zip(held, after, strict=True)]
        own_keys = [own[2] for own in held]
        changed_keys = [keys_of(text) for text in changed]
        next_keys = [other[2] for other in after]
        return pd.DataFrame(
            {
                "doc_id": [own[0] for own in held],
                "n_chars": [len(own[1]) for own in held],
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": prints(own_keys, params.cells),
                "edited_fingerprint": prints(changed_keys, params.cells),
                "near_edited": compare(
                    list(zip(own_keys, changed_keys, strict=True)), params.cells
                ),
                "near_next": compare(list(zip(own_keys, next_keys, strict=True)), params.cells),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for doc_id, text, ends in batch.itertuples(index=False):
                row = doc_id, text, keys_of(text)
                if held and (ends or len(held) >= 1_000 or chars > 4_000_000):
                    yield finish(held, row)
                    held, chars = [], 0
                if not ends:
                    held.append(row)
                    chars += len(text)

    rows = with_next(docs, params).select(id_or_none(), "text", "ends")
    return with_null_ids(rows.mapInPandas(run, SCHEMA))
