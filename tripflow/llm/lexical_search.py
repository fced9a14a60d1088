"""Ranked lexical search: accumulators from short lists, then skipping over long ones.

Documents are indexed in blocks. A block is one row: its documents, their lengths, its own terms
and a posting list (documents, occurrences) per term. All terms are indexed. Statistics are sums
over the blocks' rows, and a term's weight follows from them.

A query is answered block by block. Its short lists in a block are summed up term at a time into
accumulators, which from then on are one more iterator with a known highest score. The iterator
and the long lists are gone through document at a time in windows. A window whose lists' highest
scores cannot reach the tenth best score so far is skipped. In the others, lists whose highest
scores together cannot reach it propose no documents; they are only looked up for documents that
the other lists propose and that can still reach it. The tenth best score goes along from block
to block of a task, and a task returns its ten best, of which the ten best of all are taken.

Queries go to every block in chunks of ``chunk_terms`` terms, so what a task receives is bounded.

Defined results: documents and queries that are null or without terms match nothing. Repeated
rows are documents, or queries, of their own. Equal scores go by ascending id, null last. Without
documents or queries there are no rows. Very long texts are read whole. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import saved
from tripflow.llm.csr import from_rows, transposed

RESULT = "item_id long, rank int, doc_id long, score long"
BLOCK = (
    "doc_ids array<long>, lengths array<long>, terms array<string>, counts array<int>, "
    "docs binary, occurrences binary"
)
_BLOCK_TYPE = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int32())),
        ("docs", pa.binary()),
        ("occurrences", pa.binary()),
    ]
)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: UTF-8 bytes of terms, lower-cased; all others become spaces.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


@dataclass(frozen=True)
class SearchParams:
    """``norm`` and ``scale`` are the score's constants; the rest bounds work and memory."""

    top: int = 10
    block_docs: int = 4_096
    block_chars: int = 16_000_000
    #: A list is short if it holds at most this share of a block's documents.
    short_share: float = 1 / 32
    window: int = 512
    chunk_terms: int = 100_000
    piece_bytes: int = 4_000_000


# --- the index ---


def terms_of(text: str, piece_bytes: int = 4_000_000) -> Iterator[list[bytes]]:
    """A text's terms, some at a time, so that a very long text is never a list at once."""
    data = text.encode().translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        stop = len(data)
        if start + piece_bytes < stop:
            stop = data.find(b" ", start + piece_bytes)
            stop = stop if stop >= 0 else len(data)
        yield data[start:stop].split()
        start = stop


class _Block:
    def __init__(self, params: SearchParams) -> None:
        self.params = params
        self.place: dict[bytes, int] = {}
        self.doc_ids: list[int | None] = []
        self.rows: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str) -> None:
        place, found = self.place, []
        for terms in terms_of(text, self.params.piece_bytes):
            for term in set(terms).difference(place):
                place[term] = len(place)
            ids = np.fromiter(map(place.__getitem__, terms), np.int64, len(terms))
            found.append(np.unique(ids, return_counts=True))
        if len(found) > 1:
            every = np.concatenate([row for row, _ in found])
            row, inverse = np.unique(every, return_inverse=True)
            times = np.zeros(len(row), dtype=np.int64)
            np.add.at(times, inverse, np.concatenate([times for _, times in found]))
            found = [(row, times)]
        if found and len(found[0][0]):
            self.chars += len(text)
            self.doc_ids.append(doc_id)
            self.rows.append(found[0][0])
            self.times.append(found[0][1])

    def full(self) -> bool:
        return len(self.doc_ids) >= self.params.block_docs or self.chars >= self.params.block_chars

    def batch(self) -> pa.RecordBatch:
        lists = transposed(from_rows(self.rows, self.times, len(self.place)))
        row = {
            "doc_ids": self.doc_ids,
            "lengths": [int(times.sum()) for times in self.times],
            "terms": [term.decode() for term in self.place],
            "counts": np.diff(lists.ptr).tolist(),
            "docs": lists.col.astype("<u4").tobytes(),
            "occurrences": lists.val.astype("<u4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK_TYPE)


def index_documents(docs: DataFrame, params: SearchParams | None = None) -> DataFrame:
    """``BLOCK`` rows of all documents with terms."""
    params = params or SearchParams()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(params)
        for batch in batches:
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                block.add(doc_id, text)
                if block.full():
                    yield block.batch()
                    block = _Block(params)
        if block.doc_ids:
            yield block.batch()

    texts = docs.filter("text is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return texts.mapInArrow(run, BLOCK)


# --- queries ---


def query_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, repeats``: one row per distinct term of a query."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    numbered = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col("item_id").cast("long"),
        F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)).alias("terms"),
    )
    each = numbered.select("item", "item_id", F.explode("terms").alias("term"))
    return each.groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))


def term_weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def length_parts(lengths: list[int], documents: int, total: int) -> np.ndarray:
    """The part of the score that a document's length decides. Python integers do not overflow."""
    parts = [8 * (100 - 75 + 75 * n * documents // total) for n in lengths]
    return np.array(parts, dtype=np.int64)


class _Best:
    """The best documents of one query so far, as ``(-score, id is null, id)``."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.found: list[tuple[int, bool, int]] = []
        self.least = 1

    def offer(self, scores: np.ndarray, docs: np.ndarray, doc_ids: list[int | None]) -> None:
        if len(scores) > self.top:
            bound = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            scores, docs = scores[scores >= bound], docs[scores >= bound]
        new = [
            (-score, doc_ids[doc] is None, doc_ids[doc] or 0)
            for score, doc in zip(scores.tolist(), docs.tolist(), strict=True)
        ]
        self.found = sorted(self.found + new)[: self.top]
        if len(self.found) == self.top:
            self.least = max(1, -self.found[-1][0])


class _Lists:
    """The posting lists of one block that a chunk of queries needs, with windows of highest scores."""

    def __init__(self, block: dict, wanted: list[str], documents: int, total: int, window: int):
        counts = np.array(block["counts"], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(counts)))
        place = {term: at for at, term in enumerate(block["terms"])}
        docs = np.frombuffer(block["docs"], "<u4")
        occurrences = np.frombuffer(block["occurrences"], "<u4")
        parts = length_parts(block["lengths"], documents, total)
        self.doc_ids = block["doc_ids"]
        self.size = len(self.doc_ids)
        self.edges = np.arange(0, self.size + window, window)
        self.docs: dict[int, np.ndarray] = {}
        self.parts: dict[int, np.ndarray] = {}
        self.highest: dict[int, np.ndarray] = {}
        for number, term in enumerate(wanted):
            at = place.get(term)
            if at is None:
                continue
            here = slice(starts[at], starts[at + 1])
            own = docs[here].astype(np.int64)
            times = occurrences[here].astype(np.int64)
            self.docs[number] = own
            self.parts[number] = 1_000_000_000 * times // (1000 * times + parts[own])
            self.highest[number] = window_highest(own, self.parts[number], window, self.edges)


def window_highest(docs, scores, window: int, edges: np.ndarray) -> np.ndarray:
    """The highest score in each window, 0 in those without a document."""
    highest = np.zeros(len(edges) - 1, dtype=np.int64)
    if len(docs):
        own = docs // window
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        highest[own[heads]] = np.maximum.reduceat(scores, heads)
    return highest


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: documents of some lists, ascending, with their summed scores."""
    docs = np.concatenate([docs for docs, _ in lists])
    scores = np.concatenate([scores for _, scores in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    heads = np.flatnonzero(np.append(True, docs[1:] != docs[:-1])[: len(docs)])
    return docs[heads], np.add.reduceat(scores[order], heads) if len(heads) else scores


def search_block(
    lists: _Lists, query: list[tuple[int, int]], best: _Best, params: SearchParams
) -> None:
    """Offers ``best`` all documents of the block that can be among the best.

    ``query`` has (number of the term, weight by repeats).
    """
    held = [(number, weight) for number, weight in query if weight and number in lists.docs]
    if not held:
        return
    bounds = sum(weight * lists.highest[number] for number, weight in held)
    if bounds.max() < best.least:
        return
    limit = max(1, int(params.short_share * lists.size))
    short = [(n, w) for n, w in held if len(lists.docs[n]) <= limit]
    iterators = [
        (lists.docs[n], w * lists.parts[n], w * lists.highest[n])
        for n, w in held
        if len(lists.docs[n]) > limit
    ]
    if short:
        docs, sums = accumulate([(lists.docs[n], w * lists.parts[n]) for n, w in short])
        highest = window_highest(docs, sums, params.window, lists.edges)
        iterators.append((docs, sums, highest))
    bounds = sum(highest for _, _, highest in iterators)
    cuts = [np.searchsorted(docs, lists.edges) for docs, _, _ in iterators]
    for window in range(len(bounds)):
        if bounds[window] >= best.least:
            parts = []
            for (docs, scores, highest), cut in zip(iterators, cuts, strict=True):
                here = slice(cut[window], cut[window + 1])
                if here.stop > here.start:
                    parts.append((int(highest[window]), docs[here], scores[here]))
            _search_window(parts, int(lists.edges[window]), best, lists.doc_ids, params)


def _search_window(parts, base: int, best: _Best, doc_ids, params: SearchParams) -> None:
    parts.sort(key=lambda part: part[0])
    below, asleep = 0, 0
    while asleep < len(parts) and below + parts[asleep][0] < best.least:
        below += parts[asleep][0]
        asleep += 1
    if asleep == len(parts):
        return
    sums = np.zeros(params.window, dtype=np.int64)
    for _, docs, scores in parts[asleep:]:
        sums[docs - base] += scores
    open_docs = np.flatnonzero((sums > 0) & (sums + below >= best.least)) + base
    found = sums[open_docs - base]
    for highest, docs, scores in reversed(parts[:asleep]):
        if not len(open_docs):
            return
        at = np.minimum(np.searchsorted(docs, open_docs), len(docs) - 1)
        found = found + np.where(docs[at] == open_docs, scores[at], 0)
        below -= highest
        stays = found + below >= best.least
        open_docs, found = open_docs[stays], found[stays]
    stays = found >= best.least
    if stays.any():
        best.offer(found[stays], open_docs[stays], doc_ids)


def _statistics(blocks: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms with repeats."""
    zero = F.lit(0).cast("long")
    total = F.aggregate("lengths", zero, lambda sum_, n: sum_ + n)
    row = blocks.select(F.size("doc_ids").alias("n"), total.alias("total")).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    found = row.first()
    return found.n or 0, found.total or 0


def _lane(chunks: int) -> Column:
    return F.pmod(F.xxhash64("item"), F.lit(chunks))


def search(docs: DataFrame, items: DataFrame, params: SearchParams | None = None) -> DataFrame:
    """``RESULT``: each item's best documents."""
    params = params or SearchParams()
    spark = docs.sparkSession
    blocks = saved(index_documents(docs, params), "search-index")
    documents, total = _statistics(blocks)
    if not documents:
        return spark.createDataFrame([], RESULT)
    asked = saved(query_terms(items), "search-queries")
    held = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("held"))
    holders = (
        held.select(F.col("held.terms").alias("term"), F.col("held.counts").alias("count"))
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("count").alias("holders"))
    )
    weighed = saved(asked.join(holders, "term"), "search-weights")
    chunks = max(1, -(-weighed.count() // params.chunk_terms))
    parts = []
    for chunk in range(chunks):
        own = weighed.filter(_lane(chunks) == chunk).collect()
        parts.append(_search_chunk(blocks, own, documents, total, params))
    found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last()
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= params.top)
        .select("item_id", "rank", "doc_id", "score")
    )


def _search_chunk(
    blocks: DataFrame, rows: list, documents: int, total: int, params: SearchParams
) -> DataFrame:
    """``item, item_id, doc_id, score``: a chunk of queries over all blocks, the best per task."""
    wanted = sorted({row.term for row in rows})
    number = {term: at for at, term in enumerate(wanted)}
    queries: dict[int, list[tuple[int, int]]] = {}
    item_ids = {row.item: row.item_id for row in rows}
    for row in rows:
        weight = row.repeats * term_weight(documents, row.holders)
        queries.setdefault(row.item, []).append((number[row.term], weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: _Best(params.top) for item in queries}
        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.slice(at, 1).to_pylist()[0]
                lists = _Lists(block, wanted, documents, total, params.window)
                for item, query in queries.items():
                    search_block(lists, query, best[item], params)
        found = [
            {
                "item": item,
                "item_id": item_ids[item],
                "doc_id": None if null else doc_id,
                "score": -score,
            }
            for item, own in best.items()
            for score, null, doc_id in own.found
        ]
        fields = [(name, pa.int64()) for name in ("item", "item_id", "doc_id", "score")]
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema(fields))

    return blocks.mapInArrow(run, "item long, item_id long, doc_id long, score long")
