"""BPE encoding and decoding with a given vocabulary; long unsplit text by tree concatenation.

White space ends every merge of this tokenizer, so the runs between ASCII white space are encoded
one by one and remembered; equal runs are encoded once per worker. A run or word that is long is
cut in halves down to leaves, the leaves are encoded by themselves, and neighbours are joined by
encoding a window of tokens around the join anew. The window grows until its outermost token on
either side is the one that was there before. Two adjacent tokens that the merges leave side by
side when alone stay side by side in any text, so agreement at both ends makes the join exact.

Documents above ``long_chars`` code points do not go through one task: their pieces are dealt
over the cluster, encoded there, and put together per document.

Defined results: null and empty texts have no tokens and decode to the empty text. Repeated rows
give repeated results. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripflow.llm.common import ASCII_SPACE, id_or_none, map_batches, texts_of, with_null_ids

RESULT = "doc_id long, n_tokens long, ids binary, decoded string"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ID = np.dtype("<u4")
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
LONG_CHARS = 32_768
LEAF = 1_024
#: About how many bytes of runs a worker remembers, and what each costs besides its text and ids.
REMEMBERED = 100_000_000
RUN_BYTES = 200
#: Lower-case letters that merges, normalisation and the word pattern treat one by one.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_MARKS = ".,;:!?*$%&#"
#: The byte-level alphabet: bytes without a printable Latin-1 character are moved past 255.
_SYMBOLS = dict(
    zip([*range(33), *range(127, 161), 173], range(256, 256 + 68), strict=True)
)
_SPACES = re.compile(f"[{ASCII_SPACE}]+")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, dtype=ID).tobytes()


def join(
    left: list[int],
    right: list[int],
    encode: Callable[[str], list[int]],
    text_of: Callable[[list[int]], str],
) -> list[int]:
    """Concatenates the encodings of two halves of one word."""
    size = 1
    while left and right:
        a, b = left[-size:], right[:size]
        window = encode(text_of(a) + text_of(b))
        whole_left, whole_right = len(a) == len(left), len(b) == len(right)
        if (whole_left or window[0] == a[0]) and (whole_right or window[-1] == b[-1]):
            # One token cannot stand for the unchanged end on both sides at once.
            if len(window) > 1 or whole_left or whole_right:
                return left[: len(left) - len(a)] + window + right[len(b) :]
        size *= 2
    return left + right


class Codec:
    """A tokenizer file, with a memory of runs, and tree concatenation for long words."""

    def __init__(self, path: str, leaf: int = LEAF, remembered: int = REMEMBERED) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        spec["model"]["end_of_word_suffix"] = None
        self.inner = Tokenizer.from_str(json.dumps(spec))
        self.models = (self.inner.model, self.tokenizer.model)
        self.added = {token["content"] for token in spec["added_tokens"]}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.leaf = leaf
        self.remembered = remembered
        self.memory: dict[str, bytes] = {}
        self.held = 0

    # --- encoding ---

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        runs = text.replace("\n", " ").split(" ")
        memory = self.memory
        try:
            return b"".join([memory[run] for run in runs])
        except KeyError:
            fresh = [run for run in dict.fromkeys(runs) if run not in memory]
            self._learn(fresh)
        found = b"".join([memory[run] for run in runs])
        # Texts take up to four bytes a character.
        self.held += sum([RUN_BYTES + 4 * len(run) + len(memory[run]) for run in fresh])
        if self.held > self.remembered:
            self.memory, self.held = {}, 0
        return found

    def _learn(self, runs: list[str]) -> None:
        """Encodes runs that are not known; plain words without their end marks, by the merges."""
        memory = self.memory
        for run in runs:
            core = run.rstrip(_MARKS)
            end, core = run[len(core) :], core.lower()
            if len(run) > self.leaf:
                memory[run] = self._encode_long(run)
            elif _PLAIN.fullmatch(core):
                found = memory.get(core)
                if found is None:
                    symbols = core
                    if not core.isascii():
                        symbols = core.encode().decode("latin-1").translate(_SYMBOLS)
                    found = memory[core] = _packed(self._merge(symbols, True))
                memory[run] = found + self._by_library(end) if end else found
            else:
                memory[run] = self._by_library(run)

    def _by_library(self, run: str) -> bytes:
        found = self.memory.get(run)
        if found is None:
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
            found = self.memory[run] = _packed(ids)
        return found

    def pieces(self, run: str) -> Iterator[tuple[str, bool]]:
        """A run as (text, is a word by itself): words by the tokenizer's own rules."""
        for part in self._around_added(run):
            if part in self.added:
                yield part, False
                continue
            normal = self.tokenizer.normalizer.normalize_str(part)
            for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                yield word, True

    def _around_added(self, run: str) -> list[str]:
        if not self.added:
            return [run]
        pattern = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        return [part for part in re.split(f"({pattern})", run) if part]

    def _encode_long(self, run: str) -> bytes:
        ids: list[int] = []
        for word, merges in self.pieces(run):
            if merges:
                ids += self.encode_word(word)
            else:
                ids.append(self.tokenizer.token_to_id(word))
        return _packed(ids)

    def encode_word(self, word: str, ends: bool = True) -> list[int]:
        """Ids of a word of byte-level symbols; ``ends`` if its last symbol ends the word."""
        if len(word) <= self.leaf:
            return self._merge(word, ends)
        middle = len(word) // 2
        left = self.encode_word(word[:middle], ends=False)
        return self.join(left, self.encode_word(word[middle:], ends))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        def again(text: str) -> list[int]:
            ends = bool(self.suffix) and text.endswith(self.suffix)
            return self._merge(text.removesuffix(self.suffix) if ends else text, ends)

        return join(left, right, again, lambda ids: "".join([self.tokens[i] for i in ids]))

    def _merge(self, word: str, ends: bool) -> list[int]:
        return [token.id for token in self.models[ends].tokenize(word)]

    # --- decoding ---

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces, as the library does for a vocabulary without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, ID).tolist()])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def _digests(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].array,
            "n_tokens": rows["n_tokens"].array,
            "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in rows["ids"]],
            "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in rows["decoded"]],
        }
    )


def _results(doc_ids: list, ids: list[bytes], own: Codec) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc_id": doc_ids,
            "n_tokens": [len(each) // ID.itemsize for each in ids],
            "ids": ids,
            "decoded": [own.decode(each) for each in ids],
        }
    )


def _cut(text: str, size: int, own: Codec) -> Iterator[tuple[int, int, bool, str]]:
    """(number, leaf, ends, text) of a long text's pieces.

    Leaf -1 is a stretch of whole runs. Runs longer than a stretch are given word by word; a word
    longer than a leaf comes in leaves, numbered from 0, the last of which ends it.
    """
    number = start = 0
    while start < len(text):
        stop = start + size
        if stop < len(text):
            stop = text.rfind(" ", start, stop) + 1 or text.find(" ", stop) + 1 or len(text)
        stretch = text[start:stop]
        start = stop
        if len(stretch) <= size:
            yield number, -1, True, stretch
            number += 1
            continue
        for run in filter(None, _SPACES.split(stretch)):
            for word, merges in own.pieces(run):
                if not merges:
                    yield number, -1, True, word
                else:
                    leaves = range(0, max(1, len(word)), own.leaf)
                    for leaf, at in enumerate(leaves):
                        yield number, leaf, leaf + 1 == len(leaves), word[at : at + own.leaf]
                number += 1


def _joined(own: Codec, leaves: list[list[int]]) -> list[int]:
    """A tree of joins, neighbours first."""
    while len(leaves) > 1:
        pairs = [own.join(a, b) for a, b in zip(leaves[::2], leaves[1::2], strict=False)]
        leaves = pairs + ([leaves[-1]] if len(leaves) % 2 else [])
    return leaves[0]


def encode_documents(
    docs: DataFrame, path: str, long_chars: int = LONG_CHARS, digests: bool = False
) -> DataFrame:
    """``RESULT`` for every document, or ``DIGEST`` in place of ids and decoded text."""
    schema = DIGEST if digests else RESULT
    finish = _digests if digests else (lambda rows: rows)
    texts = docs.select(id_or_none(), "text")
    is_long = F.coalesce(F.length("text") > long_chars, F.lit(False))

    def whole(batch: pd.DataFrame) -> pd.DataFrame:
        own = codec(path)
        ids = [own.encode(text) for text in texts_of(batch["text"])]
        return finish(_results(batch["doc_id"].array, ids, own))

    short = map_batches(texts.filter(~is_long), whole, schema)

    # Equal long rows are one document that counts several times.
    long = texts.filter(is_long).groupBy("doc_id", "text").agg(F.count("*").alias("times"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        names = ["doc_id", "times", "document", "number", "leaf", "ends", "text"]
        for batch in batches:
            for doc_id, text, times in batch.itertuples(index=False):
                document = hashlib.sha256(text.encode()).hexdigest()
                rows = [
                    (doc_id, times, document, *piece) for piece in _cut(text, long_chars // 2, own)
                ]
                yield pd.DataFrame(rows, columns=names)

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        own = codec(path)
        ids = [
            own.encode(text)
            if leaf < 0
            else _packed(own._merge(text, ends))
            for leaf, ends, text in zip(batch["leaf"], batch["ends"], batch["text"], strict=True)
        ]
        return batch.drop(columns=["ends", "text"]).assign(ids=ids)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        own = codec(path)
        rows = rows.sort_values(["number", "leaf"], kind="stable")
        ids: list[bytes] = []
        for _, word in rows.groupby("number", sort=True):
            if word["leaf"].iloc[0] < 0:
                ids += list(word["ids"])
            else:
                leaves = [np.frombuffer(part, ID).tolist() for part in word["ids"]]
                ids.append(_packed(_joined(own, leaves)))
        times = int(rows["times"].iloc[0])
        doc_id = rows["doc_id"].iloc[0]
        return finish(_results([doc_id] * times, [b"".join(ids)] * times, own))

    key = "doc_id long, times long, document string, number long, leaf int"
    pieces = long.mapInPandas(cut, f"{key}, ends boolean, text string")
    spread = pieces.repartition("document", "number", "leaf")
    gathered = (
        map_batches(spread, encode, f"{key}, ids binary")
        .groupBy("doc_id", "document")
        .applyInPandas(gather, schema)
    )
    return with_null_ids(short.unionByName(gathered))
