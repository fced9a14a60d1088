"""Alignment of two tokenizers over a corpus, by sparse products of incidence matrices.

Texts are encoded whole and laid end to end on one line of bytes. The tokens of A against bytes
and the bytes against tokens of B are matrices in compressed rows; their product has an entry,
the shared bytes, for every pair of tokens that overlap. Tokens of A against groups, times groups
against tokens of B, gives the pairs that share a group.

A very long text is taken in stretches, cut where a single space stands between two characters
that are not white space: no token of either vocabulary spans such a place, so a stretch has the
tokens it has in its text, and every such place is a group boundary.

Documents are rows over the id pairs of their block. Blocks are written once, and how many
documents hold an id pair linked is summed over blocks. Every block gets the counts of just the
pairs it holds, so nothing that grows with the corpus is sent to all tasks.

Defined results: texts that are null or empty, or whose bytes a vocabulary does not keep (one
that replaces U+2581, say), have no tokens: zeros and an empty digest. Repeated rows are documents
of their own. An empty table gives no rows. Very long texts are read whole; one without any
single space is one stretch. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripflow.llm.common import saved
from tripflow.llm.csr import Csr, pointers, product, product_sizes

RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, "
    "count_sum long, groups_sha256 string"
)
BLOCK = (
    "doc_ids array<long>, stats binary, digests array<string>, doc_ptr binary, doc_pair binary, "
    "doc_times binary, pairs array<struct<a:int,b:int,docs:long>>"
)
STATS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
SPACE_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# Fixed value: how byte-level vocabularies split text before merging.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@dataclass(frozen=True)
class AlignParams:
    """Bounds of a block, of the texts aligned at once, and of a long text's stretches."""

    block_docs: int = 2_048
    block_chars: int = 8_000_000
    batch_chars: int = 400_000
    stretch_chars: int = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The byte of each character that a byte-level vocabulary writes in its place."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): b for at, b in enumerate(other)}


def stretches(text: str, chars: int) -> Iterator[str]:
    """Parts of a text that, each after a space, have the tokens they have inside it."""
    start = 0
    while start < len(text):
        stop = text.find(" ", start + chars)
        while 0 <= stop and (
            stop + 1 == len(text) or text[stop - 1].isspace() or text[stop + 1].isspace()
        ):
            stop = text.find(" ", stop + 1)
        if stop < 0:
            yield text[start:]
            return
        yield text[start:stop]
        start = stop + 1


def byte_level_encoder(path: str):
    """``text -> ids`` of a byte-level vocabulary file.

    Where the file's merges are in the order of their ids, ranks alone say the same, and a
    faster library takes them; else the file's own.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_alphabet()
    model, before = spec["model"], spec["pre_tokenizer"]
    vocabulary = {token: i for token, i in model["vocab"].items() if set(token) <= set(alphabet)}
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    made = [model["vocab"].get("".join(pair), -1) for pair in pairs]
    if (
        spec["normalizer"] is None
        and before == before | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        and len(vocabulary) == len(made) + 256
        and all(a < b for a, b in zip([255, *made], made, strict=False))
    ):
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}
        own = tiktoken.Encoding(
            path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        return own.encode_ordinary
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    whole.no_truncation()
    whole.no_padding()
    return lambda text: whole.encode(text, add_special_tokens=False).ids


class _Bytes:
    """The bytes of every token, end to end."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens], dtype=np.int64)
        self.starts = pointers(self.sizes)[:-1]

    def line(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        first = self.starts[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(first, sizes) + np.arange(sizes.sum())]


class Aligner:
    """Two vocabularies."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.encode_first = byte_level_encoder(byte_path)
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        tokenizer = Tokenizer.from_file(byte_path)
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        names = [tokenizer.id_to_token(i) or "" for i in range(size)]
        alphabet = byte_alphabet()
        self.a_bytes = _Bytes([bytes(alphabet.get(c, 63) for c in name) for name in names])
        pieces = [self.second.id_to_piece(i) for i in range(self.second.vocab_size())]
        self.b_bytes = _Bytes([self._piece_bytes(piece) for piece in pieces])
        self.n_a, self.n_b = size, len(pieces)
        # A token's text in a digest: inside its side of a group, and at that side's end.
        self.marks = [f"{i}{end}" for i in range(self.n_a) for end in ",|"]
        self.marks += [f"{i}{end}" for i in range(self.n_b) for end in ",;"]

    @staticmethod
    def _piece_bytes(name: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(name)
        return bytes([int(byte[1], 16)]) if byte else name.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> Encoded:
        """Tokens of ``texts``, a space before each. Texts whose bytes are not kept have none."""
        raw = [(" " + text).encode() for text in texts]
        a = [self.encode_first(" " + text) for text in texts]
        b = self.second.encode(texts, num_threads=1)
        sizes = np.array([len(data) for data in raw], dtype=np.int64)
        kept = np.ones(len(texts), dtype=bool)
        for lists, table in ((a, self.a_bytes), (b, self.b_bytes)):
            counts = np.array([len(ids) for ids in lists], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(lists), np.int64, counts.sum())
            total = np.concatenate(([0], np.cumsum(table.sizes[flat])))
            ends = np.cumsum(counts)
            kept &= total[ends] - total[ends - counts] == sizes
        if kept.any():
            own = np.flatnonzero(kept)
            line = np.frombuffer(b"".join([raw[i] for i in own]), np.uint8)
            starts = pointers(sizes[own])[:-1]
            for lists, table in ((a, self.a_bytes), (b, self.b_bytes)):
                flat = np.array([i for at in own for i in lists[at]], dtype=np.int64)
                wrong = np.add.reduceat((table.line(flat) != line).astype(np.int64), starts)
                kept[own[wrong > 0]] = False
        none: list[int] = []
        a = [ids if keep else none for ids, keep in zip(a, kept, strict=True)]
        b = [ids if keep else none for ids, keep in zip(b, kept, strict=True)]
        return Encoded(self, a, b, kept)


class Encoded:
    """Some texts' tokens on one line of bytes, and what the products make of them."""

    def __init__(self, own: Aligner, a: list[list[int]], b: list[list[int]], kept: np.ndarray):
        self.own, self.kept = own, kept
        self.a_of_text = pointers(np.array([len(ids) for ids in a], dtype=np.int64))
        self.b_of_text = pointers(np.array([len(ids) for ids in b], dtype=np.int64))
        self.a = np.fromiter(chain.from_iterable(a), np.int64, self.a_of_text[-1])
        self.b = np.fromiter(chain.from_iterable(b), np.int64, self.b_of_text[-1])
        self.a_ends = np.cumsum(own.a_bytes.sizes[self.a])
        self.b_ends = np.cumsum(own.b_bytes.sizes[self.b])
        total = int(self.a_ends[-1]) if len(self.a) else 0
        both = np.zeros(total + 1, dtype=bool)
        both[self.a_ends] = True
        other = np.zeros(total + 1, dtype=bool)
        other[self.b_ends] = True
        both &= other
        closed = np.cumsum(both)
        self.groups = int(closed[-1])
        self.a_closes, self.b_closes = both[self.a_ends], both[self.b_ends]
        self.a_group = closed[self.a_ends] - self.a_closes
        self.b_group = closed[self.b_ends] - self.b_closes

    def stats(self, links: Csr) -> np.ndarray:
        """``STATS`` per text."""
        shared = pointers(shared_group_counts(self.a_group, self.b_group, self.groups))
        groups = pointers(self.a_closes.astype(np.int64))
        columns = (self.a_of_text, self.b_of_text, groups[self.a_of_text],
                   links.ptr[self.a_of_text], shared[self.a_of_text])
        return np.stack([np.diff(column) for column in columns], axis=1)

    def pairs(self, links: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, ``a * n_b + b``, links) of every id pair that a text holds linked."""
        text = np.repeat(np.arange(len(self.kept)), np.diff(links.ptr[self.a_of_text]))
        code = self.a[links.rows] * self.own.n_b + self.b[links.col]
        every = self.own.n_a * self.own.n_b
        key = np.sort(text * every + code)
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        times = np.diff(np.append(heads, len(key)))
        return key[heads] // every, key[heads] % every, times

    def group_texts(self) -> Iterator[str]:
        """``a1,a2|b1;a3|b2`` per text."""
        groups = np.arange(self.groups + 1)
        a_first = np.searchsorted(self.a_group, groups)
        b_first = np.searchsorted(self.b_group, groups)
        marks = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        marks[np.arange(len(self.a)) + b_first[self.a_group]] = 2 * self.a + self.a_closes
        marks[np.arange(len(self.b)) + a_first[self.b_group + 1]] = (
            2 * (self.own.n_a + self.b) + self.b_closes
        )
        ends = (self.a_of_text + self.b_of_text).tolist()
        listed = marks.tolist()
        for start, stop in zip(ends, ends[1:], strict=False):
            yield "".join([self.own.marks[i] for i in listed[start:stop]])[:-1]


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Csr:
    """Tokens of A by tokens of B, with the bytes they share: ``A · Bᵀ``.

    Both are given by where their tokens end on the same line of bytes.
    """
    total = int(a_ends[-1]) if len(a_ends) else 0
    ones = np.ones(total, dtype=np.int64)
    a = Csr(np.concatenate(([0], a_ends)), np.arange(total), ones, total)
    of_byte = np.repeat(np.arange(len(b_ends)), np.diff(b_ends, prepend=0))
    return product(a, Csr(np.arange(total + 1), of_byte, ones, len(b_ends)))


def _group_matrices(a_groups: np.ndarray, b_groups: np.ndarray, count: int) -> tuple[Csr, Csr]:
    ones_a, ones_b = (np.ones(len(groups), dtype=np.int64) for groups in (a_groups, b_groups))
    a = Csr(np.arange(len(a_groups) + 1), a_groups, ones_a, count)
    sizes = np.bincount(b_groups, minlength=count)
    return a, Csr(pointers(sizes), np.arange(len(b_groups)), ones_b, len(b_groups))


def group_links(a_groups: np.ndarray, b_groups: np.ndarray, count: int) -> Csr:
    """Tokens of A by tokens of B that are in the same group, each given by its group."""
    return product(*_group_matrices(a_groups, b_groups, count))


def shared_group_counts(a_groups: np.ndarray, b_groups: np.ndarray, count: int) -> np.ndarray:
    """Entries per row of ``group_links``, which may be many more than there are tokens."""
    return product_sizes(*_group_matrices(a_groups, b_groups, count))


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One aligner per worker process."""
    return Aligner(byte_path, piece_path)


class _Block:
    """Documents on their way into one row."""

    def __init__(self, own: Aligner, params: AlignParams) -> None:
        self.own, self.params = own, params
        self.doc_ids: list[int | None] = []
        self.stats: list[np.ndarray] = []
        self.digests: list = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting: list[tuple[int, str]] = []
        self.chars = self.waiting_chars = 0
        self.bad: set[int] = set()

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.doc_ids.append(doc_id)
        self.stats.append(np.zeros(len(STATS), dtype=np.int64))
        self.digests.append(None)
        for part in stretches(text or "", self.params.stretch_chars):
            self.waiting.append((len(self.doc_ids) - 1, part))
            self.chars += len(part)
            self.waiting_chars += len(part)
            if self.waiting_chars >= self.params.batch_chars:
                self._align()

    def full(self) -> bool:
        return len(self.doc_ids) >= self.params.block_docs or self.chars >= self.params.block_chars

    def _align(self) -> None:
        if not self.waiting:
            return
        docs = np.array([doc for doc, _ in self.waiting], dtype=np.int64)
        encoded = self.own.encode([text for _, text in self.waiting])
        self.waiting, self.waiting_chars = [], 0
        self.bad.update(docs[~encoded.kept].tolist())
        links = overlap_links(encoded.a_ends, encoded.b_ends)
        for doc, stats in zip(docs.tolist(), encoded.stats(links), strict=True):
            self.stats[doc] += stats
        for doc, text in zip(docs.tolist(), encoded.group_texts(), strict=True):
            if self.digests[doc] is None:
                self.digests[doc] = hashlib.sha256(text.encode())
            else:
                self.digests[doc].update(b";" + text.encode())
        text, code, times = encoded.pairs(links)
        self.found.append((docs[text], code, times))

    def row(self) -> dict:
        self._align()
        none = np.zeros(0, dtype=np.int64)
        parts = list(zip(*self.found, strict=True)) or [[none]] * 3
        doc, code, times = (np.concatenate(part) for part in parts)
        if self.bad:
            keep = ~np.isin(doc, list(self.bad))
            doc, code, times = doc[keep], code[keep], times[keep]
        pairs, place = np.unique(code, return_inverse=True)
        # Stretches of one text may hold the same pair.
        every = max(1, len(pairs))
        key = doc * every + place
        if len(key) and (key[1:] <= key[:-1]).any():
            key, again = np.unique(key, return_inverse=True)
            times = np.bincount(again, weights=times).astype(np.int64)
            doc, place = key // every, key % every
        stats = np.stack(self.stats) if self.stats else np.zeros((0, len(STATS)), np.int64)
        stats[list(self.bad)] = 0
        digests = [
            "" if digest is None or at in self.bad else digest.hexdigest()
            for at, digest in enumerate(self.digests)
        ]
        a, b = np.divmod(pairs, self.own.n_b)
        holders = np.bincount(place, minlength=len(pairs))
        listed = zip(a.tolist(), b.tolist(), holders.tolist(), strict=True)
        return {
            "doc_ids": self.doc_ids,
            "stats": stats.tobytes(),
            "digests": digests,
            "doc_ptr": _packed(pointers(np.bincount(doc, minlength=len(self.doc_ids)))),
            "doc_pair": _packed(place),
            "doc_times": _packed(times),
            "pairs": [{"a": x, "b": y, "docs": n} for x, y, n in listed],
        }


_WIDTHS = {size: np.dtype(f"<u{size}") for size in (1, 2, 4, 8)}


def _packed(values: np.ndarray) -> bytes:
    """The narrowest width that holds all values, then the values."""
    top = int(values.max()) if len(values) else 0
    size = next(size for size in _WIDTHS if top < 1 << 8 * size)
    return bytes([size]) + values.astype(_WIDTHS[size]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _WIDTHS[data[0]], offset=1).astype(np.int64)


_BLOCK_TYPE = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("stats", pa.binary()),
        ("digests", pa.list_(pa.string())),
        *[(name, pa.binary()) for name in ("doc_ptr", "doc_pair", "doc_times")],
        ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())]))),
    ]
)


def encoded_blocks(
    docs: DataFrame, byte_path: str, piece_path: str, params: AlignParams
) -> DataFrame:
    """``BLOCK`` rows: documents over id pairs, and the documents that hold each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_path, piece_path)
        block = _Block(own, params)
        for batch in batches:
            for at in range(batch.num_rows):
                block.add(batch.column(0)[at].as_py(), batch.column(1)[at].as_py())
                if block.full():
                    yield pa.RecordBatch.from_pylist([block.row()], schema=_BLOCK_TYPE)
                    block = _Block(own, params)
        if block.doc_ids:
            yield pa.RecordBatch.from_pylist([block.row()], schema=_BLOCK_TYPE)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``a, b, n, best``: documents that hold an id pair linked; whether none of A's has more."""
    held = blocks.select(F.inline("pairs"))
    counts = saved(held.groupBy("a", "b").agg(F.sum("docs").alias("n")), "align-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, params: AlignParams | None = None
) -> DataFrame:
    """``RESULT`` for every document.

    ``n_links`` counts token pairs that overlap, ``n_shared`` those in the same group; ``n_best``
    and ``count_sum`` look links up in the counts of the whole corpus.
    """
    found = encoded_blocks(docs, byte_path, piece_path, params or AlignParams())
    numbered = found.withColumn("block", F.monotonically_increasing_id())
    blocks = saved(numbered, "align-blocks")
    places = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    looked_up = (
        places.select("block", "at", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"))
        .join(pair_counts(blocks), ["a", "b"])
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "n", "best")).alias("counts"))
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _document_rows(batch.slice(at, 1))

    return blocks.drop("pairs").join(looked_up, "block", "left").mapInArrow(finish, RESULT)


def _document_rows(block: pa.RecordBatch) -> pa.RecordBatch:
    row = {name: block.column(name)[0] for name in block.schema.names}
    ptr, pair, times = (_unpacked(row[f"doc_{name}"].as_py()) for name in ("ptr", "pair", "times"))
    counts = row["counts"].values
    size = len(counts) if counts is not None else 0
    n, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    if size:
        at = counts.field("at").to_numpy()
        n[at] = counts.field("n").to_numpy()
        best[at] = counts.field("best").to_numpy(zero_copy_only=False)
    stats = np.frombuffer(row["stats"].as_py(), np.int64).reshape(-1, len(STATS))
    columns = [
        row["doc_ids"].values,
        *[pa.array(stats[:, at]) for at in range(len(STATS))],
        pa.array(_row_sums(ptr, times * best[pair])),
        pa.array(_row_sums(ptr, times * n[pair])),
        row["digests"].values,
    ]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in RESULT.split(", ")])


def _row_sums(ptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ptr[1:]] - total[ptr[:-1]]
