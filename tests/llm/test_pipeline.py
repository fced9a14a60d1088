"""The corpus pipeline stage by stage, against plain versions and on awkward rows."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import cases
from tripflow.llm import line_quality, mixing, near_dedup, quality_classifier
from tripflow.llm.queries import importable, tokenizer_path

LONG = (1 << 53) + 1
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "counts map<string, long>, key string"
)


def rows():
    plain = [cases.prose(seed, 60) for seed in range(100, 130)]
    found = [(LONG + 2 * i, text, "en", "ab"[i % 2], len(text), {"k": i}, "x") for i, text in enumerate(plain)]
    copy = plain[3].replace("river", "lake", 1)
    found += [
        (None, plain[0] + " more words of its own.", "en", None, 1, None, None),
        (LONG + 1000, copy, "en", "a", len(copy), {"k": 1}, None),
        (LONG + 1001, plain[5] + "\\nmenu | home | about |", None, "b", 7, {}, "y"),
        (LONG + 1002, "go! " * 40, "en", "a", 160, None, "z"),
        (LONG + 1003, None, "en", "a", None, None, "z"),
        (LONG + 1004, "", None, None, 0, None, None),
    ]
    return [(r[0], r[1].replace("\\n", "\n") if r[1] else r[1], *r[2:]) for r in found]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def as_rows(frame):
    return Counter(
        tuple(tuple(sorted(v.items())) if isinstance(v, dict) else v for v in row)
        for row in frame.collect()
    )


def test_filters_leave_every_other_column_as_it_is(spark, docs):
    """Ids above 2^53 beside a null id, maps and nulls come out as they went in."""
    rules = line_quality.LineRules()
    want = Counter()
    for row in rows():
        if line_quality.judge(row[1], rules)[-1]:
            text = line_quality.clean_text(row[1], rules)
            counts = row[5] and tuple(sorted(row[5].items()))
            counts = () if row[5] == {} else counts
            want[(row[0], text, row[2], row[3], len(text), counts, row[6])] += 1
    assert as_rows(line_quality.clean(docs)) == want
    labels = spark.createDataFrame([(LONG, 1), (LONG + 2, 1), (LONG + 1002, 0)], "doc_id long, quality int")
    forest = quality_classifier.train(docs, labels)
    kept = as_rows(quality_classifier.keep_good(docs, forest, 0.0))
    assert kept == as_rows(docs)
    none = quality_classifier.train(docs, labels.limit(0))
    assert as_rows(quality_classifier.keep_good(docs, none)) == as_rows(docs)


def test_rows_that_differ_only_in_where_a_null_is(spark):
    text = cases.prose(7, 50)
    two = [(1, text, "en", "a", 1, {"k": 1}, None), (1, text, None, "a", 1, {"k": 1}, "en")]
    table = spark.createDataFrame(two, SCHEMA)
    found = as_rows(mixing.mix_documents(table, mixing.Mix(share=2)))
    assert found.total() == 4 and set(found) <= set(as_rows(table))
    assert len(near_dedup.drop_near_copies(table).collect()) == 1


def test_pipeline_by_plain_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(LONG + 2 * i, 1) for i in range(30)] + [(LONG + 1002, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()

    # Quality rules; no label of what is left is bad, so the classifier keeps all.
    rules = line_quality.LineRules()
    cleaned = [
        (row[0], line_quality.clean_text(row[1], rules), row[3])
        for row in rows()
        if line_quality.judge(row[1], rules)[-1]
    ]
    roots = cases.near_components([text for _, text, _ in cleaned], 5)
    groups = defaultdict(list)
    for place, root in enumerate(roots):
        groups[root].append(cleaned[place])
    kept = [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in groups.values()]
    assert 0 < len(kept) < len(cleaned)
    # The mix draws copies of these documents, as many words as there are.
    texts = {doc_id: text for doc_id, text, _ in kept}
    assert {row.doc_id for row in found} <= set(texts)
    words = {doc_id: len(cases.words(text)) for doc_id, text in texts.items()}
    taken = sum(words[row.doc_id] for row in found)
    assert abs(taken - sum(words.values())) <= 2 * max(words.values())
    assert max(Counter(row.doc_id for row in found).values()) <= 3
    reference = Tokenizer.from_file(tokenizer_path())
    for row in found:
        ids = reference.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids and row.n_tokens == len(ids)


def test_pipeline_of_an_empty_table(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
