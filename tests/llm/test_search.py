"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tripflow.llm import lexical_search as s
from tripflow.llm.queries import importable

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}
ITEM = "item_id long, text string, doc_id long, score string"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def scored(docs, items, top=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [(doc_id, tf, tf.total()) for doc_id, tf in held if tf]
    count, total = len(held), sum(n for _, _, n in held)
    holders = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, tf, n in held:
            m = 25 + 75 * n * count // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * holders[t] + 1)))
                * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in terms(text)
                if tf[t]
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, at + 1, f[2], -f[0]) for at, f in enumerate(found[:top])]
    return Counter(out)


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    draw = random.Random(3)
    pool = [f"w{i}" for i in range(60)] + ["É", "日本", "x_y", "Z9"]
    texts = [" ".join(draw.choices(pool, [1 / (i + 1) for i in range(64)], k=draw.randrange(1, 90)))
             for _ in range(700)]
    rows = [row[:2] for row in cases.rows()] + [(1000 + i, text) for i, text in enumerate(texts)]
    rows += rows[-30:] + [(None, texts[0]), (5000, "w59 " * 3000), (5001, "?! \x00\x7f")]
    return rows


ITEMS = [
    (1, "w1 w2 W2 w40, w55"), (2, None), (3, ""), (4, "no-such term here"), (5, "w0"),
    (5, "w0"), (None, "日本 é É z9"), (6, " ".join(f"w{i}" for i in range(60))), (7, "MIT license"),
    (8, "w59 w59 w59 w58"),
]


def frames(spark, docs):
    wide = [(*row, 1, "k", 2.5) for row in docs]
    schema = "doc_id long, text string, item long, term string, score double"
    items = [(*item, 7, "s") for item in ITEMS]
    return (
        spark.createDataFrame(wide, schema).repartition(4),
        spark.createDataFrame(items, ITEM),
    )


@pytest.mark.parametrize(
    "params",
    [
        s.SearchParams(),
        s.SearchParams(block_docs=60, window=16, chunk_terms=20, piece_bytes=50),
        s.SearchParams(block_docs=150, window=32, short_share=0.5),
        s.SearchParams(block_docs=150, window=8, short_share=0.0, block_chars=9_000),
    ],
)
def test_search_finds_what_scoring_all_finds(spark, docs, params):
    found = s.search(*frames(spark, docs), params).collect()
    assert Counter(map(tuple, found)) == scored(docs, ITEMS)


def test_search_of_nothing(spark, docs):
    table, items = frames(spark, docs)
    assert s.search(table.limit(0), items).count() == 0
    assert s.search(table, items.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, " ?")], "doc_id long, text string")
    assert s.search(nothing, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert s.search(nothing, items).count() == 0


def test_accumulators_are_one_iterator():
    lists = [
        (np.array([1, 5, 9]), np.array([10, 20, 30])),
        (np.array([5, 6]), np.array([7, 8])),
        (np.array([0, 9]), np.array([1, 1])),
    ]
    docs, sums = s.accumulate(lists)
    assert docs.tolist() == [0, 1, 5, 6, 9]
    assert sums.tolist() == [1, 10, 27, 8, 31]
    assert s.window_highest(docs, sums, 4, np.arange(0, 13, 4)).tolist() == [10, 27, 31]


def test_windows_out_of_reach_are_skipped(monkeypatch):
    """Once ten documents are known, windows whose highest scores fall short are not opened."""
    opened = []
    plain = s._search_window
    monkeypatch.setattr(s, "_search_window", lambda *a: (opened.append(a[1]), plain(*a)))
    params = s.SearchParams(window=10, short_share=0.0)
    occurrences = np.ones(100, dtype="<u4")
    occurrences[:10] = 9
    block = {
        "doc_ids": list(range(100)), "lengths": [10] * 100, "terms": ["t"], "counts": [100],
        "docs": np.arange(100, dtype="<u4").tobytes(), "occurrences": occurrences.tobytes(),
    }
    best = s._Best(10)
    s.search_block(s._Lists(block, ["t"], 100, 1000, 10), [(0, 5)], best, params)
    assert opened == [0]
    assert [doc for _, _, doc in best.found] == list(range(10))


def test_lengths_beyond_64_bits():
    assert s.length_parts([10**9], 10**12, 10**15).tolist() == [8 * (25 + 75 * 10**6)]
