"""Operators over documents: awkward rows, empty tables, and brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from tripflow.llm import (
    bpe,
    fingerprints,
    licenses,
    line_quality,
    mixing,
    near_dedup,
    quality_classifier,
    sharding,
    training_order,
)
from tripflow.llm.queries import importable, queries, tokenizer_path

ROWS = cases.rows()


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, cases.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], cases.SCHEMA)


def ids(found):
    return Counter(row.doc_id for row in found)


ALL_IDS = Counter(row[0] for row in ROWS)


def test_mix_meets_targets_and_agrees_on_rerun(spark, docs, empty):
    found = mixing.taken_words(docs).collect()
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert ids(found) == ALL_IDS
    sizes = Counter()
    for row in ROWS:
        sizes[row[3]] += len(cases.words(row[1]))
    assert sum(r["size"] for r in found) == sum(
        sizes.values()
    )
    assert all(r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in found)
    assert all(r.target <= 3 * r.source_size for r in found)
    assert mixing.taken_words(empty).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert set(map(tuple, mixed.collect())) <= set(ROWS)
    assert mixing.mix_documents(empty).count() == 0


def test_mix_targets_share_what_capped_sources_leave(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate("a" * 2 + "b" * 50 + "c" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {
        r.source_size: r.target for r in mixing.taken_words(docs).select("source_size", "target").distinct().collect()
    }
    # Weights 5, 2, 1: the first source stops at three times its size.
    assert targets[20] == 60.0
    taken = defaultdict(int)
    for r in mixing.taken_words(docs).collect():
        taken[r.target] += r.taken
    assert all(abs(words - target) <= 10 for target, words in taken.items())


def test_mix_meets_targets_with_long_documents_beside_a_large_source(spark):
    small = [(i, "w " * 10, "b") for i in range(300)] + [(300, "w " * 1000, "b")]
    large = [(1000 + i, "w " * 10, "a") for i in range(4200)] + [(999, "w " * 2000, "a")]
    docs = spark.createDataFrame(small + large, "doc_id long, text string, source string")
    for seed in (17, 18):
        mix = mixing.Mix(weights=(12, 1), share=Fraction(1, 2), seed=seed)
        taken = defaultdict(int)
        for r in mixing.taken_words(docs, mix).collect():
            taken[r.target] += r.taken
        assert len(taken) == 2
        assert all(abs(words - target) <= 10 for target, words in taken.items())


def test_rounding_keeps_expectations():
    size = np.array([50.0, 40, 30, 20, 10, 5, 5, 2])
    chance = np.array([0.9, *[0.35] * 7])
    draws = np.random.default_rng(1).random((4000, 2, len(size)))
    got = np.mean([mixing.round_against_rest(chance, size, *d) for d in draws], axis=0)
    assert np.abs(got - chance).max() < 0.05


def test_fingerprints_by_plain_text(docs, empty):
    found = fingerprints.fingerprint_documents(docs).collect()
    assert ids(found) == ALL_IDS
    known = sorted((r[:2] for r in ROWS if r[0] not in (None, 15)), reverse=True)
    order = dict(known)
    following = {a[0]: b[1] or "" for a, b in zip(known, known[1:], strict=False)}
    by_text = {}
    for row in found:
        if row.doc_id in following and row.doc_id not in (1, 17):
            text = order[row.doc_id] or ""
            half = len(text) // 2
            other = following[row.doc_id] if row.doc_id != 16 else ""
            changed = text[: len(text) - half] + other[:half]
            assert row.n_chars == len(text)
            assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            by_text.setdefault(text, set()).add(row.fingerprint)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert all(len(prints) == 1 for prints in by_text.values())
    near = {row.doc_id: row for row in found}
    assert near[2].near_next == 1.0 and near[9].near_edited > near[9].near_next
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_sketch_likeness_is_exact():
    draw = np.random.default_rng(2)
    pairs = []
    for size in (0, 1, 3, 50, 400):
        shared = draw.integers(0, 2**63, size, dtype=np.uint64)
        for extra in (0, 1, 7, 300):
            own = draw.integers(0, 2**63, 2 * extra, dtype=np.uint64)
            pairs.append(
                (np.append(shared, own[:extra]), np.append(shared, own[extra:]), size, extra)
            )
    likeness = fingerprints.compare([p[:2] for p in pairs], 24)
    for got, (_, _, size, extra) in zip(likeness, pairs, strict=True):
        assert got == (size / (size + 2 * extra) if size + extra else 1.0)


def test_lines(docs, empty):
    found = line_quality.verdicts(docs).collect()
    assert ids(found) == ALL_IDS
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].kept and not by_id[14].kept and not by_id[15].kept
    assert by_id[4].n_words == 0 and by_id[4].base_failed and by_id[13].n_dup_lines == 3
    for doc_id, text, *_ in ROWS:
        if doc_id is not None:
            tokens = cases.words(text)
            spots = set()
            seen = defaultdict(list)
            for i in range(len(tokens) - 4):
                seen[tuple(tokens[i : i + 5])].append(i)
            for places in seen.values():
                if len(places) > 1:
                    spots.update(p + k for p in places for k in range(5))
            assert by_id[doc_id].n_words == len(tokens)
            assert by_id[doc_id].word_chars == sum(map(len, tokens))
            assert by_id[doc_id].n_repeat_words == len(spots)
    cleaned = line_quality.clean(docs)
    assert cleaned.columns == docs.columns
    assert ids(cleaned.collect()) == Counter(r.doc_id for r in found if r.kept)
    assert line_quality.verdicts(empty).count() == 0 and line_quality.clean(empty).count() == 0


def test_bpe_is_the_library(docs, empty):
    path = tokenizer_path()
    reference = Tokenizer.from_file(path)
    for limit in (32_768, 500):
        found = bpe.encode_documents(docs, path, long_chars=limit).collect()
        assert ids(found) == ALL_IDS
        want = Counter()
        for doc_id, text, *_ in ROWS:
            own = reference.encode(text or "", add_special_tokens=False).ids
            shown = reference.decode(own, skip_special_tokens=False)
            want[doc_id, len(own), np.array(own, "<u4").tobytes(), shown] += 1
        assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in found) == want
    assert bpe.encode_documents(empty, path).count() == 0


@pytest.mark.parametrize("letters", ["a", "ab", "thein", "é日x", "!?*"])
def test_long_words_by_tree_concatenation(letters):
    import random

    path = tokenizer_path()
    own, reference = bpe.Codec(path, leaf=8), Tokenizer.from_file(path)
    draw = random.Random(3)
    for size in (7, 8, 9, 100, 777):
        text = "".join(draw.choice(letters) for _ in range(size))
        want = np.array(reference.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode(text) == want


def test_shards(docs, empty):
    params = sharding.ShardParams(shards=3)
    found = sharding.assign_shards(docs, params).collect()
    assert ids(found) == ALL_IDS
    sizes, slots = Counter(), defaultdict(list)
    for row in found:
        sizes[row.shard] += row["size"]
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    checks = {r[0]: zlib.crc32((r[1] or "").encode()) for r in ROWS if r[0]}
    assert all(row.text_crc32 == checks[row.doc_id] for row in found if row.doc_id)
    assert sharding.assign_shards(empty, params).count() == 0


def test_shards_are_even_and_cut_hot_groups(spark):
    rows = [(i, "same" * 20 if i % 3 == 0 else f"text {i} " * 10) for i in range(3000)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 24 and sizes.max() - sizes.min() < 0.05 * sizes.mean() + 300


def test_groups_stay_whole_however_many_ranges_a_shard_has(spark):
    """A group is far larger than a range's tolerance and less than a shard's."""
    rows = spark.range(12_000).selectExpr("id doc_id", "concat('text ', id div 16) text")
    params = sharding.ShardParams(shards=3, tolerance=0.005, range_rows=200)
    found = sharding.assign_shards(rows, params).toPandas()
    assert (found.groupby("text_crc32")["shard"].nunique() == 1).all()
    sizes = found.groupby("shard")["size"].sum()
    assert abs(sizes - sizes.mean()).max() <= 2 * 0.005 * sizes.mean()
    for _, shard in found.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    ordered = found.sort_values(["shard", "slot"])["text_crc32"].to_numpy()
    assert (ordered[1:] != ordered[:-1]).sum() == 12_000 // 16 - 1


def test_licenses(docs, empty):
    found = licenses.scan_licenses(docs).collect()
    assert ids(found) == ALL_IDS
    phrases = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
    for row in found:
        text = next(r[1] for r in ROWS if r[0] == row.doc_id) if row.doc_id else None
        if row.doc_id is None:
            continue
        tokens = [w.decode() for w in licenses.license_words(text)]
        places = [
            (i, label)
            for label, phrase in phrases.items()
            for i in range(len(tokens))
            if tokens[i : i + len(phrase.split())] == phrase.split()
        ]
        assert row.n_words == len(tokens) and row.n_base == len(places)
        assert row.first_word == min((p[0] for p in places), default=None)
        assert row.last_word == max((p[0] for p in places), default=None)
        assert row.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1
    assert licenses.scan_licenses(empty).count() == 0


def test_license_notices_and_scores(spark):
    notices = {t.label: t for t in licenses.STATEMENTS}
    mit, apache = notices["mit-text"].text, notices["apache-2.0-notice"].text
    texts = {
        "whole": f"x. {mit.replace('software', 'Software,')}! y",
        "all of it": apache.upper(),
        "most": " ".join(apache.replace("writing", "print").split()[:-2]),
        "no key phrase": apache.replace("compliance", "line").replace("apache", "a"),
        "mention": "we like the MIT License and others",
        "statement": "Released under the MIT license.",
        "nearly": "is under the MIT license",
        "gpl": f"{notices['gpl-2.0-notice'].text} {notices['bsd-text'].text}",
        "none": "licensed software without a key",
    }
    rows = list(enumerate(texts.values()))
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    seen = dict(zip(texts, sorted(found.collect()), strict=True))
    labels = {name: set(filter(None, row.labels.split(","))) for name, row in seen.items()}
    score = {name: row.score for name, row in seen.items()}
    assert labels["whole"] == {"mit-text"} and seen["whole"].n_base == 0
    assert labels["all of it"] == {"apache", "apache-2.0", "apache-2.0-notice"}
    assert labels["most"] == labels["all of it"]
    assert labels["no key phrase"] == labels["none"] == set()
    assert labels["mention"] == {"mit"}
    assert labels["statement"] == labels["nearly"] == {"mit", "mit-notice"}
    assert labels["gpl"] == {"gpl", "gpl-2.0-notice", "bsd-text"}
    assert score["whole"] == score["all of it"] == score["statement"] == score["gpl"] == 1
    assert 0 == score["none"] == score["no key phrase"]
    assert 0.3 < score["mention"] < score["nearly"] < 1

    mentions = found.selectExpr("doc_id", "'mit license' text")
    phrases_only = licenses.scan_licenses(mentions, ())
    assert {row.score for row in phrases_only.collect()} == {1.0}


def test_classifier(spark, docs, empty):
    labels = spark.createDataFrame([(14, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    forest = quality_classifier.train(docs, labels)
    found = quality_classifier.score_documents(docs, forest)
    assert ids(found.collect()) == ALL_IDS
    nothing = quality_classifier.train(empty, labels.limit(0))
    assert {r.score for r in quality_classifier.score_documents(docs, nothing).collect()} == {0.5}
    assert quality_classifier.keep_good(docs, nothing).columns == docs.columns
    assert quality_classifier.score_documents(empty, forest).count() == 0


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    forest = quality_classifier.train(docs, labels)
    found = quality_classifier.score_documents(docs, forest).join(labels, "doc_id")
    held = found.filter("held_out").toPandas()
    assert len(held) > 50
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    assert all(
        row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in held.itertuples()
    )


def test_slots_are_a_permutation():
    params = training_order.OrderParams()
    for total in (1, 2, 3, 100, 1025):
        numbers = np.arange(total)
        at = training_order.slots(numbers, total, params)
        assert sorted(at) == list(range(total))
        assert (training_order.numbers_of(at, total, params) == numbers).all()


def test_training_order_round_trip(spark, docs, empty, tmp_path):
    params = training_order.OrderParams(length=64, stride=16)
    found = training_order.materialise(docs, folder=str(tmp_path / "o"), params=params).collect()
    assert sorted(r.slot for r in found) == list(range(len(found)))
    assert all(r.shard == r.slot // 16 and len(r.ids) == 64 for r in found)
    texts = defaultdict(list)
    for row in sorted(found, key=lambda r: r.number):
        texts[row.doc_id].append(bytes(row.ids)[: row.n_tokens])
    for doc_id, text, *_ in ROWS:
        if doc_id not in (None, 15):
            assert b"".join(texts[doc_id]).decode() == (text or "")
    assert training_order.read_slots(spark, str(tmp_path / "o"), 20, params).count() == len(found) - 20
    assert training_order.materialise(empty).count() == 0


def test_training_order_of_vocabulary_ids(spark, docs, tmp_path):
    path = tokenizer_path()
    reference = Tokenizer.from_file(path)
    params = training_order.OrderParams(length=64, stride=16)
    records = training_order.materialise(docs, path, str(tmp_path / "v"), params).collect()
    assert sorted(r.slot for r in records) == list(range(len(records)))
    assert all(len(r.ids) == 4 * 64 for r in records)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    registered = queries()["op9_training_order"](spark, str(tmp_path)).collect()
    tokens = {r[0]: reference.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS}
    made, counts = defaultdict(list), Counter()
    for row in sorted(records, key=lambda r: r.number):
        made[row.doc_id] += np.frombuffer(row.ids, "<u4")[: row.n_tokens].tolist()
    for row in registered:
        counts[row.doc_id] += row.n_tokens
    for doc_id, own in tokens.items():
        if doc_id not in (None, 15):
            assert made[doc_id] == own * (len(made[doc_id]) // max(1, len(own)))
            assert counts[doc_id] == len(made[doc_id]) == len(own) * ALL_IDS[doc_id]


@pytest.mark.parametrize("width", [4, 5])
def test_near_copies_by_brute_force(docs, empty, width):
    params = near_dedup.NearParams(width=width)
    found = near_dedup.components(docs, params).collect()
    assert ids(found) == ALL_IDS
    known = sorted({r[:2] for r in ROWS if r[0] is not None}, key=lambda r: r[0])
    roots = near_dedup_roots = cases.near_components([r[1] for r in known], width)
    want = {known[i][0]: known[root][0] for i, root in enumerate(near_dedup_roots)}
    assert roots and all(
        row.component_id == want[row.doc_id] for row in found if row.doc_id is not None
    )
    kept = near_dedup.drop_near_copies(docs, params)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None}
    assert max(ids(r for r in kept.collect() if r.doc_id).values()) == 1
    assert near_dedup.components(empty, params).count() == 0


def test_near_copies_in_crowded_buckets(spark):
    """Chains of near copies, in buckets that are divided and gone through in blocks."""
    base = cases.prose(9, 60).split(" ")
    texts = []
    for i in range(90):
        own = list(base)
        own[i % 60] = f"new{i}"
        own[(i * 7) % 60] = f"more{i % 5}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = cases.near_components(texts, 4)
    for limit in (4096, 16):
        params = near_dedup.NearParams(width=4, bucket_rows=limit, chunk_rows=64)
        found = near_dedup.components(docs, params).collect()
        assert {r.doc_id: r.component_id for r in found} == dict(enumerate(want))


def test_near_copies_in_a_star_of_several_blocks(spark):
    """Edits of one text that are near to it alone, in buckets of many blocks."""
    draw = np.random.default_rng(4)
    base = cases.prose(9, 200).split(" ")
    texts = [" ".join(base)]
    for i in range(150):
        own = list(base)
        for spot in draw.choice(np.arange(4, 196, 4), 5, replace=False):
            own[spot] = f"edit{i}x{spot}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(cases.near_components(texts, 4)) == {0}
    assert len(set(cases.near_components(texts[1:], 4))) > 100
    # With three bands there is one bucket that no further band divides.
    params = near_dedup.NearParams(width=4, bands=3, rows=1, bucket_rows=8, chunk_rows=8)
    bands = {r.doc_id: tuple(r.bands) for r in near_dedup.sketches(docs, params).collect()}
    crowd = {doc_id for doc_id, own in bands.items() if own == bands[0]}
    assert len(crowd) > 5 * params.bucket_rows
    found = near_dedup.components(docs, params).collect()
    assert {r.component_id for r in found if r.doc_id in crowd} == {0}


def test_near_copies_are_dropped_by_row(spark):
    """Rows that share an id, or have none, are copies only if their texts are."""
    first, second, third = (cases.prose(seed, 60) for seed in (21, 22, 23))
    near = first.replace(first.split(" ")[30], "changed", 1)
    rows = [
        (3, first, "a"), (7, near, "b"), (7, second, "b"), (7, second, "b"), (7, "", "b"),
        (None, near, "a"), (None, third, "a"), (None, third, "c"), (None, second, None),
        (None, None, "x"), (None, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = [tuple(r) for r in near_dedup.drop_near_copies(docs, near_dedup.NearParams(width=4)).collect()]
    one = [row for row in kept if row[1] == third]
    assert len(one) == 1 and one[0][0] is None
    want = [(3, first, "a"), (7, second, "b"), (7, "", "b"), (None, None, "x"), (None, "", "x")]
    assert Counter(kept) == Counter([*want, *one])


def test_a_resumed_order_replaces_incomplete_shards(spark, docs, tmp_path):
    params = training_order.OrderParams(length=64, stride=16)
    folder = str(tmp_path / "o")
    whole = training_order.materialise(docs, folder=folder, params=params).collect()
    shard = training_order.read_slots(spark, folder).filter("shard = 0").limit(10).collect()
    cut = spark.createDataFrame(shard, training_order.RECORD).drop("shard")
    cut.write.mode("overwrite").parquet(f"{folder}/shard=0")
    double = training_order.read_slots(spark, folder).filter("shard = 1").collect()
    again = spark.createDataFrame(double, training_order.RECORD).drop("shard")
    again.write.mode("append").parquet(f"{folder}/shard=1")
    assert training_order.read_slots(spark, folder).count() == len(whole) + 10
    found = training_order.materialise(docs, folder=folder, params=params).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, whole))


def test_remembered_runs_are_bounded_in_bytes():
    own = bpe.Codec(tokenizer_path(), remembered=20_000)
    reference = Tokenizer.from_file(tokenizer_path())
    for seed in range(20):
        text = cases.prose(seed, 60) + "\n" + "x" * 900
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids
        assert own.held <= 20_000


def test_pairs_that_share_one_whole_band_late_stay_open():
    """A band with three equal minima and one equal byte is no bucket in which a pair met."""
    params = near_dedup.NearParams()
    signs = np.zeros((2, params.bands * params.rows), dtype=np.uint8)
    marks = np.arange(2 * params.bands, dtype="<u4").reshape(2, -1)
    marks[1, 7] = marks[0, 7]
    groups, sides = np.array([1, 2]), np.zeros(2, dtype=np.int64)
    found = list(near_dedup._open_pairs(groups, signs, marks, sides, [7], params))
    assert [(at, later.tolist()) for at, later in found] == [(0, [1])]
    marks[1, 3] = marks[0, 3]
    assert not list(near_dedup._open_pairs(groups, signs, marks, sides, [7], params))
    assert list(near_dedup._open_pairs(groups, signs, marks, sides, [3], params))


def test_hardly_any_linked_pair_is_open_in_no_bucket():
    params = near_dedup.NearParams()
    draw = np.random.default_rng(3)
    pairs = 20_000
    minima = draw.integers(0, 1 << 32, (2, pairs, params.bands * params.rows), dtype=np.uint64)
    same = draw.random(minima.shape[1:]) < 0.8
    minima[1][same] = minima[0][same]
    by_band = minima.reshape(2, pairs, params.bands, params.rows)
    met = (by_band[0] == by_band[1]).all(axis=2)
    signs = (minima & 255).astype(np.uint8)
    groups, sides = np.array([1, 2]), np.zeros(2, dtype=np.int64)
    lost = 0
    for at in range(pairs):
        marks = np.arange(2 * params.bands).reshape(2, -1)
        marks[1][met[at]] = marks[0][met[at]]
        shared = np.flatnonzero(met[at])
        lost += not any(
            list(near_dedup._open_pairs(groups, signs[:, at], marks, sides, [band], params))
            for band in shared[:1]
        )
    assert lost <= pairs * 4e-4


def counted(found: list[bytes]) -> set:
    """The n-th copy of a piece is a piece of its own."""
    seen = Counter()
    out = set()
    for piece in found:
        out.add((piece, seen[piece]))
        seen[piece] += 1
    return out


def test_pieces_are_the_text_cut():
    texts = [r[1] or "" for r in ROWS] + ["\n", " \n ", "a\n" + "b " * 40, " " * 100]
    for text in texts:
        found = fingerprints.pieces(text, 6)
        joined = b" ".join(found)
        # Cuts stand at spaces and line ends only.
        assert joined.replace(b"\n", b" ") == text.encode().replace(b"\n", b" ")
        assert all(piece.count(b" ") < 24 and b"\n" not in piece for piece in found)
        assert len(found) >= len(text.split("\n")) if text else not found


def test_an_added_word_changes_the_pieces_around_it_only():
    words = cases.prose(11, 3000).split(" ")
    whole = counted(fingerprints.pieces(" ".join(words), 6))
    assert 300 < len(whole) < 1000
    for at in (0, 7, 1500, 2990):
        longer = [*words[:at], "added", *words[at:]]
        assert len(whole ^ counted(fingerprints.pieces(" ".join(longer), 6))) <= 6


def test_likeness_of_texts_is_that_of_their_pieces(spark):
    texts = [cases.prose(20, 400)]
    for seed in range(1, 8):
        words = texts[-1].split(" ")
        words[10 * seed : 30 * seed] = cases.prose(seed, 5 * seed).split(" ")
        texts.append(" ".join(words))
    texts += ["", "menu " * 300, "menu " * 301]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}

    def likeness(one, other):
        a, b = (counted(fingerprints.pieces(text, 6)) for text in (one, other))
        return len(a & b) / len(a | b) if a | b else 1.0

    for at, text in enumerate(texts):
        following = texts[at - 1]
        assert found[at].near_next == likeness(text, following)
        changed = fingerprints.edited(text, following)
        assert found[at].near_edited == likeness(text, changed)
    assert 0.5 < found[2].near_next < 1


def test_stored_counts_hold_texts_of_many_pieces():
    import base64

    keys = np.random.default_rng(5).integers(0, 2**63, 400_000, dtype=np.uint64)
    (stored,) = fingerprints.prints([keys], 4)
    count, _, data = stored.partition(":")
    cells = np.frombuffer(base64.b64decode(data), "<i4,<u8,<u2")
    assert int(count) == 400_000 and cells["f0"].tolist() == [400_000] * 4


def test_shard_boundaries_by_summing_all_rows(spark):
    """Each boundary stands between two texts within tolerance of its goal, or next to it."""
    sizes = np.random.default_rng(4).integers(1, 60, 2000)
    rows = [(i, "hot " * 30 if i % 3 == 0 else f"{i} " * int(n)) for i, n in enumerate(sizes)]
    params = sharding.ShardParams(shards=7, tolerance=0.01)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.assign_shards(docs, params).collect()
    texts = dict(rows)
    order = sorted(found, key=lambda row: (row.shard, row.slot))
    digests = [hashlib.md5(texts[row.doc_id].encode()).hexdigest()[:16] for row in order]
    assert digests == sorted(digests)
    assert all(row["size"] == len(texts[row.doc_id].encode()) + 8 for row in order)
    total = sum(row["size"] for row in order)
    slack = params.tolerance * total / params.shards
    below = 0
    for at, (row, after) in enumerate(zip(order, order[1:], strict=False)):
        below += row["size"]
        if row.shard == after.shard:
            continue
        assert after.shard == row.shard + 1
        off = abs(below - total * after.shard // params.shards)
        if digests[at] == digests[at + 1]:
            # A group is cut only if neither of its ends is near the goal, and then as near as can be.
            assert off <= row["size"]
        else:
            assert off <= max(slack, row["size"], after["size"])
    assert {row.shard for row in order} == set(range(7))


def naive_tree(values, gradient, weight, edges, depth, params):
    """The best split over all features and edges by summing rows, then the same on both sides."""
    if depth == 0:
        return params.rate * sum(gradient) / (sum(weight) + params.leaf_weight)

    def worth(rows):
        return sum(gradient[rows]) ** 2 / (sum(weight[rows]) + params.leaf_weight)

    best, cut = 1e-9, None
    everything = np.ones(len(values), dtype=bool)
    for feature, own in enumerate(edges):
        for edge in own:
            right = values[:, feature] > edge
            gain = worth(right) + worth(~right) - worth(everything)
            if gain > best + 1e-9:
                best, cut = gain, (feature, edge)
    right = values[:, cut[0]] > cut[1] if cut else ~everything
    sides = [
        naive_tree(values[side], gradient[side], weight[side], edges, depth - 1, params)
        for side in (~right, right)
    ]
    return (cut, *sides)


def test_forest_by_naive_split_search_and_walk():
    draw = np.random.default_rng(9)
    values = np.round(draw.random((150, 4)), 2)
    labels = ((values[:, 1] > 0.4) & (values[:, 3] < 0.7) | (draw.random(150) < 0.1)).astype(int)
    params = quality_classifier.BoostParams(trees=4, depth=2, bins=8)
    forest = quality_classifier.fit_forest(values, labels, params)
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, 9)[1:-1])) for f in range(4)]

    def walk(tree, row):
        while isinstance(tree, tuple):
            cut, left, right = tree
            tree = right if cut and row[cut[0]] > cut[1] else left
        return tree

    margin = np.full(150, np.log(labels.mean() / (1 - labels.mean())))
    for _ in range(params.trees):
        chance = 1 / (1 + np.exp(-margin))
        tree = naive_tree(values, labels - chance, chance * (1 - chance), edges, 2, params)
        margin += [walk(tree, row) for row in values]
    assert np.abs(forest.score(values) - 1 / (1 + np.exp(-margin))).max() < 1e-6
