"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too
much of its text goes with them.

A line with no word is neither judged nor counted. The rules, in order:

* ``navigation``: bars, angle brackets and the like stand alone as words (menus, tables);
* ``symbols``: many of ``#*$%&|<>`` for its words;
* ``shouting``: most words end in an exclamation mark;
* ``stutter``: many words equal the one before;
* ``boilerplate``: a licence, copyright or cookie notice of at most ``boilerplate_words`` words;
* ``repeated``: equal to an earlier line of the document;
* ``unpunctuated``: many words, yet no sentence mark anywhere.

Defined results: a null or empty text has no words and fails the base rules. Repeated rows are
judged alike. Other columns, whatever their names, play no part and ``clean`` returns them as
they came.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from tripflow.llm.common import (
    ASCII_SPACE,
    id_or_none,
    keep_rows,
    map_batches,
    texts_of,
    with_null_ids,
    words,
)

SYMBOLS = "#*$%&|<>"
#: Phrases that mark a notice. Compared in lower case.
NOTICES = (
    "all rights reserved",
    "mit license",
    "apache license",
    "general public license",
    "accept cookies",
    "privacy policy",
    "terms of use",
    "click here",
)
_LONE_SYMBOLS = re.compile(rb"[#*$%&|<>]+")

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lost_words long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds; percentages are of a line's or a document's words."""

    min_words: int = 10
    max_repeat_percent: int = 20
    navigation_percent: int = 20
    symbols_percent: int = 50
    shouting_percent: int = 50
    stutter_percent: int = 40
    boilerplate_words: int = 20
    unpunctuated_words: int = 60
    max_lost_percent: int = 60


def line_failure(line: str, rules: LineRules, seen: bool) -> str | None:
    """The first rule that a line fails, if any."""
    tokens = words(line)
    count = len(tokens)
    alone = sum(1 for token in tokens if _LONE_SYMBOLS.fullmatch(token))
    if 100 * alone > rules.navigation_percent * count:
        return "navigation"
    if 100 * sum(map(line.count, SYMBOLS)) > rules.symbols_percent * count:
        return "symbols"
    loud = sum(1 for token in tokens if token.endswith(b"!"))
    if 100 * loud > rules.shouting_percent * count:
        return "shouting"
    if 100 * sum(map(bytes.__eq__, tokens, tokens[1:])) > rules.stutter_percent * count:
        return "stutter"
    if count <= rules.boilerplate_words:
        lowered = line.lower()
        if any(notice in lowered for notice in NOTICES):
            return "boilerplate"
    if seen:
        return "repeated"
    if count > rules.unpunctuated_words and not any(mark in line for mark in ".!?…;:"):
        return "unpunctuated"
    return None


def repeated_words(tokens: list[bytes], width: int = 5) -> int:
    """Words inside a window of ``width`` words that the text has twice or more."""
    count = len(tokens) - width + 1
    if count < 2:
        return 0
    windows = list(zip(*(tokens[i : i + count] for i in range(width)), strict=True))
    if len(set(windows)) == count:
        return 0
    often = Counter(windows)
    covered = end = 0
    for start, window in enumerate(windows):
        if often[window] > 1:
            covered += start + width - max(start, end)
            end = start + width
    return covered


def judge(text: str | None, rules: LineRules, passed: list[str] | None = None) -> tuple:
    """The values of ``COLUMNS`` for one text.

    ``passed`` gets the lines that pass, those without a word included.
    """
    text = text or ""
    tokens = words(text)
    seen: set[str] = set()
    duplicates = lost = 0
    passed = [] if passed is None else passed
    for line in text.split("\n"):
        own = len(words(line))
        if not own:
            passed.append(line)
            continue
        again = line in seen
        seen.add(line)
        duplicates += again
        if line_failure(line, rules, again):
            lost += own
        else:
            passed.append(line)
    repeats = repeated_words(tokens)
    failed = len(tokens) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(tokens)
    return (
        len(tokens),
        len(text) - sum(map(text.count, ASCII_SPACE)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeats,
        lost,
        failed,
        not failed and 100 * lost <= rules.max_lost_percent * len(tokens),
    )


def verdicts(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """``doc_id`` and ``COLUMNS`` for every document."""
    rules = rules or LineRules()
    names = [part.split()[0] for part in COLUMNS.split(", ")]

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        found = [judge(text, rules) for text in texts_of(batch["text"])]
        return pd.DataFrame(found, columns=names).assign(doc_id=batch["doc_id"].array)

    ids = docs.select(id_or_none(), "text")
    return with_null_ids(map_batches(ids, work, f"doc_id long, {COLUMNS}"))


def clean_text(text: str | None, rules: LineRules | None = None) -> str:
    """The lines that pass, with lines that have no word as they are."""
    passed: list[str] = []
    judge(text, rules or LineRules(), passed)
    return "\n".join(passed)


def clean(docs: DataFrame, rules: LineRules | None = None, strip_lines: bool = True) -> DataFrame:
    """The documents that pass, in all their columns; failing lines removed from their text.

    ``strip_lines=False`` leaves the text of documents that pass untouched. A column ``n_chars``
    follows the text.
    """
    rules = rules or LineRules()

    def work(texts: list[str]) -> tuple[list[bool], list[str] | None]:
        kept, cleaned = [], []
        for text in texts:
            passed: list[str] = []
            kept.append(judge(text, rules, passed)[-1])
            cleaned.append("\n".join(passed))
        return kept, cleaned if strip_lines else None

    return keep_rows(docs, work, "n_chars")
