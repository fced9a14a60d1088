"""Token alignment against whole texts encoded by the libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import cases
from tripflow.llm import alignment as al
from tripflow.llm.csr import Csr, from_rows, product, product_sizes, transposed
from tripflow.llm.queries import ALIGNED, importable, tokenizer_path

PATHS = [tokenizer_path(name) for name in ALIGNED]


class Plain:
    """Whole texts, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.byte = al.byte_alphabet()

    def tokens(self, text):
        """[(id, start, end)] of both, or nothing."""
        if not text:
            return [], []
        raw = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a = [(i, bytes(self.byte.get(c, 0) for c in self.a.id_to_token(i))) for i in a]
        pieces = [(i, self.b.id_to_piece(i)) for i in b]
        b = [
            (i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
            for i, p in pieces
        ]
        if any(b"".join(x for _, x in side) != raw for side in (a, b)):
            return [], []
        out = []
        for side in (a, b):
            at, own = 0, []
            for i, data in side:
                own.append((i, at, at + len(data)))
                at += len(data)
            out.append(own)
        return tuple(out)

    def rows(self, docs):
        each, holders = [], Counter()
        for doc_id, text in docs:
            a, b = self.tokens(text)
            links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
            holders.update(set(links))
            ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, start = [], 0
            for end in ends:
                groups.append([[i for i, _, e in side if start < e <= end] for side in (a, b)])
                start = end
            text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
            each.append((doc_id, len(a), len(b), groups, links, text))
        most = defaultdict(int)
        for (i, _), n in holders.items():
            most[i] = max(most[i], n)
        return Counter(
            (
                doc_id, n_a, n_b, len(groups), len(links),
                sum(len(x) * len(y) for x, y in groups),
                sum(holders[link] == most[link[0]] for link in links),
                sum(holders[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links, text in each
        )


TEXTS = [
    " leading", "trailing ", "two  spaces", "a \n b", "tab\there it's", "\n\n", " ", "   ",
    "naïve café 日本語 emoji 🙂🙂 x", "mark ▁ here", "▁", "<|endoftext|> </s> <s> <unk> <0x0A>",
    "don't we'll 12345 67 $5.00", "é ́x  y 　z  q", "x" * 700, "nul\x00byte",
    "A" * 3 + " " * 40 + "b", "﻿bom", "１２ ﬁ Å",
]


def test_alignment_by_whole_texts(spark):
    importable(spark)
    rows = [row[:2] for row in cases.rows() if len(row[1] or "") < 3000]
    rows += [(100 + i, text) for i, text in enumerate(TEXTS)] + [(100, "again"), (None, "two  spaces")]
    wide = [(*row, "n", 1, 2) for row in rows]
    schema = "doc_id long, text string, counts string, block long, a int"
    table = spark.createDataFrame(wide, schema).repartition(3)
    want = Plain().rows(rows)
    for params in (al.AlignParams(), al.AlignParams(block_docs=4, batch_chars=40, stretch_chars=5)):
        found = al.align_documents(table, *PATHS, params).collect()
        assert Counter(map(tuple, found)) == want
    assert al.align_documents(table.limit(0), *PATHS).count() == 0


def test_a_very_long_text(spark):
    importable(spark)
    text = cases.prose(4, 60_000) + "y" * 20_000
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = al.align_documents(table, *PATHS).collect()
    a, b = Plain().tokens(text)
    assert (row.n_a, row.n_b) == (len(a), len(b))
    assert row.n_groups == len({e for _, _, e in a} & {e for _, _, e in b})


ODD = st.text(
    st.sampled_from(list("ab Z9é日́\n\t \u0085​᠎\u001c▁'s.") + ["🙂"]), max_size=30
)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_pieces_have_the_tokens_of_their_text(text):
    plain, fast = _plain()
    pieces = [" " + part for part in al.stretches(text, 2)]
    assert "".join(pieces) == (" " + text if text else "")
    if not text:
        return
    whole = plain.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for p in pieces for i in plain.a.encode(p, add_special_tokens=False).ids] == whole
    assert fast(" " + text) == whole
    assert [i for p in pieces for i in plain.b.encode(p[1:])] == plain.b.encode(text)


_KEPT = []


def _plain():
    if not _KEPT:
        _KEPT.extend([Plain(), al.byte_level_encoder(PATHS[0])])
    return _KEPT


@pytest.mark.parametrize("step", [1, 7, 10_000])
def test_products_are_matrix_products(step):
    draw = np.random.default_rng(0)
    left = draw.integers(0, 3, (9, 12)) * (draw.random((9, 12)) < 0.3)
    right = draw.integers(0, 3, (12, 5)) * (draw.random((12, 5)) < 0.4)

    def sparse(dense):
        rows = [np.flatnonzero(row) for row in dense]
        return from_rows(rows, [row[own] for row, own in zip(dense, rows, strict=True)], dense.shape[1])

    def dense(matrix: Csr):
        out = np.zeros((len(matrix.ptr) - 1, matrix.width), dtype=np.int64)
        np.add.at(out, (matrix.rows, matrix.col), matrix.val)
        return out

    found = product(sparse(left), sparse(right), step)
    assert (dense(found) == left @ right).all()
    assert (product_sizes(sparse(left), sparse(right), step) == (left @ right != 0).sum(axis=1)).all()
    assert len(found.col) == (left @ right != 0).sum()
    assert (dense(transposed(sparse(left))) == left.T).all()


def test_links_of_overlapping_and_grouped_tokens():
    # A: |ab|c|de|  B: |a|bc|de|
    a_ends, b_ends = np.array([2, 3, 5]), np.array([1, 3, 5])
    links = al.overlap_links(a_ends, b_ends)
    assert list(zip(links.rows.tolist(), links.col.tolist(), links.val.tolist(), strict=True)) == [
        (0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 2, 2)
    ]
    shared = al.group_links(np.array([0, 0, 1]), np.array([0, 0, 1]), 2)
    assert list(zip(shared.rows.tolist(), shared.col.tolist(), strict=True)) == [
        (0, 0), (0, 1), (1, 0), (1, 1), (2, 2)
    ]


def test_both_engines_agree_on_every_code_point():
    """Each code point beside letters, digits, spaces and itself."""
    plain, fast = _plain()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"x{c}1{c}  {c}{c}.{c} y" for c in points[:0x3200] + points[0x3200::40]]
    for text, encoded in zip(texts, plain.a.encode_batch(texts, add_special_tokens=False), strict=True):
        assert fast(text) == encoded.ids
