"""License scans through a positional index of rare words.

Templates are licence statements and notices with the phrases that must stand in them. Every one
is posted under its rarest words, by inverse document frequency over the whole corpus; a file's
words are looked up there, each hit votes for the place where its template would begin, and a
place counts with half of all votes, if every mandatory phrase stands at its relative position.
A template that is one phrase needs only its rarest word looked up, so none of its places is lost.

The score is the best place's share of its statement's words, weighed by frequency. A base phrase
is part of longer statements: it scores as the share of the one that fits best around it, so a bare
mention scores low and a whole notice 1. Without a statement that holds it, it is whole by itself.

Defined results: null and empty texts have no words, no places, empty labels and score 0.
Repeated rows give repeated results; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import id_or_none, map_batches, texts_of, with_null_ids

COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)
#: 0-9 and non-ASCII bytes stay, A-Z become a-z, all else separates.
_WORD_BYTES = bytes(
    code + 32
    if 65 <= code <= 90
    else code
    if 48 <= code <= 57 or 97 <= code <= 122 or code > 127
    else 32
    for code in range(256)
)


@dataclass(frozen=True)
class Template:
    """A statement, the phrases it must contain, and whether it is one of the base phrases."""

    label: str
    text: str
    mandatory: tuple[str, ...]
    base: bool = False


#: The base phrases and their labels, then this operator's own statements.
BASE = (
    Template("mit", "mit license", ("mit license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("gpl", "general public license", ("general public license",), True),
)
STATEMENTS = (
    Template("mit-notice", "released under the mit license", ("mit license",)),
    Template(
        "apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")
    ),
    Template(
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("general public license", "3"),
    ),
    Template(
        "gpl-2.0",
        "this work is licensed under the gnu general public license version 2",
        ("general public license", "2"),
    ),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
        (
            "permission is hereby granted free of charge",
            "to deal in the software without restriction",
            "this permission notice shall be included",
        ),
    ),
    Template(
        "apache-2.0-notice",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without "
        "warranties or conditions of any kind either express or implied",
        (
            "apache license version 2 0",
            "you may not use this file except in compliance with the license",
            "without warranties or conditions of any kind",
        ),
    ),
    *(
        Template(
            f"gpl-{version}.0-notice",
            "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software foundation "
            f"either version {version} of the license or at your option any later version",
            (
                "gnu general public license",
                "free software foundation",
                f"either version {version} of the license",
            ),
        )
        for version in (2, 3)
    ),
    Template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        (
            "redistribution and use in source and binary forms",
            "permitted provided that the following conditions are met",
        ),
    ),
)


def license_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of a small vocabulary stands: one count per word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch["text"]):
                found.update(vocabulary.intersection(license_words(text)))
        yield pd.DataFrame(
            {
                "word": pd.Series([word.decode() for word in found], dtype=object),
                "docs": pd.Series(list(found.values()), dtype="int64"),
            }
        )

    counted = docs.select("text").mapInPandas(count, "word string, docs long")
    # At most one row per word of the templates.
    rows = counted.groupBy("word").agg(F.sum("docs").alias("docs")).collect()
    return {row.word.encode(): row.docs for row in rows}


class Index:
    """Postings (template, position) of each template's rarest words."""

    def __init__(
        self,
        templates: tuple[Template, ...],
        frequencies: dict[bytes, int],
        rare_words: int = 3,
        rare_share: float = 1 / 8,
    ) -> None:
        """Posts each template's ``rare_words``, or ``rare_share`` of its words if that is more."""
        self.templates = templates
        self.words = [license_words(template.text) for template in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.votes_needed: list[int] = []
        self.phrases: list[list[tuple[int, list[bytes]]]] = []
        self.idf = [
            {word: 1 / math.log(2 + frequencies.get(word, 0)) for word in tokens}
            for tokens in self.words
        ]
        for number, (template, tokens) in enumerate(zip(templates, self.words, strict=True)):
            whole = template.mandatory == (template.text,)
            order = sorted(set(tokens), key=lambda word: (frequencies.get(word, 0), word))
            chosen = set(order[: 1 if whole else max(rare_words, int(rare_share * len(tokens)))])
            posted = [at for at, word in enumerate(tokens) if word in chosen]
            if whole:
                posted = posted[:1]
            for at in posted:
                self.postings[tokens[at]].append((number, at))
            self.votes_needed.append((len(posted) + 1) // 2)
            self.phrases.append(
                [(_place(tokens, license_words(p)), license_words(p)) for p in template.mandatory]
            )
        self.keys = frozenset(self.postings)
        # Where each base phrase stands in the other statements.
        self.around = {
            number: [
                (other, at)
                for other, tokens in enumerate(self.words)
                if not templates[other].base
                for at in range(len(tokens))
                if tokens[at : at + len(phrase)] == phrase
            ]
            for number, phrase in enumerate(self.words)
            if templates[number].base
        }

    def places(self, tokens: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """(template, first word, share of its IDF weight found there), each place once."""
        if self.keys.isdisjoint(tokens):
            return
        votes: Counter[tuple[int, int]] = Counter()
        for at, word in enumerate(tokens):
            for number, inside in self.postings.get(word, ()):
                votes[number, at - inside] += 1
        for (number, start), count in sorted(votes.items()):
            if count < self.votes_needed[number]:
                continue
            phrases = self.phrases[number]
            # A statement may begin before the text does, but its mandatory phrases may not.
            if all(
                start + at >= 0 and tokens[start + at : start + at + len(phrase)] == phrase
                for at, phrase in phrases
            ):
                yield number, start, self._share(number, start, tokens)

    def _share(self, number: int, start: int, tokens: list[bytes]) -> float:
        weights = self.idf[number]
        got = total = 0.0
        for at, word in enumerate(self.words[number]):
            total += weights[word]
            if 0 <= start + at < len(tokens) and tokens[start + at] == word:
                got += weights[word]
        return got / total

    def scan(self, text: str | None) -> tuple:
        """The values of ``COLUMNS`` for one text."""
        tokens = license_words(text)
        base: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        score = 0.0
        for number, start, share in self.places(tokens):
            template = self.templates[number]
            labels.add(template.label)
            if template.base:
                base.append(start)
                base_labels.add(template.label)
                around = self.around[number]
                share = max(
                    (self._share(other, start - at, tokens) for other, at in around), default=share
                )
            score = max(score, share)
        return (
            len(tokens),
            len(base),
            min(base, default=None),
            max(base, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            score,
        )


def _place(tokens: list[bytes], phrase: list[bytes]) -> int:
    for at in range(len(tokens) - len(phrase) + 1):
        if tokens[at : at + len(phrase)] == phrase:
            return at
    raise ValueError("a mandatory phrase must stand in its template")


def scan_licenses(docs: DataFrame, statements: tuple[Template, ...] = STATEMENTS) -> DataFrame:
    """``doc_id`` and ``COLUMNS`` for every document. Counts the templates' words first (a job)."""
    templates = BASE + statements
    vocabulary = {word for template in templates for word in license_words(template.text)}
    index = Index(templates, document_frequencies(docs, vocabulary))
    names = [part.split()[0] for part in COLUMNS.split(", ")]

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        found = [index.scan(text) for text in texts_of(batch["text"])]
        columns = dict(zip(names, zip(*found, strict=True), strict=True)) if found else {}
        for name in ("first_word", "last_word"):
            columns[name] = pd.array(columns.get(name, []), dtype="Int64")
        for name in ("base_labels", "labels"):
            columns[name] = pd.Series(columns.get(name, []), dtype=object)
        return pd.DataFrame(columns, columns=names).assign(doc_id=batch["doc_id"].array)

    ids = docs.select(id_or_none(), "text")
    return with_null_ids(map_batches(ids, work, f"doc_id long, {COLUMNS}"))
