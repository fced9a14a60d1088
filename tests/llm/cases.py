"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    pool = ["that", "é tait", "und", "casa", "license", "river", "stone", "<b>", "1984", "日本"]
    out = []
    for _ in range(words):
        out.append(draw.choice(pool) + str(draw.randrange(900)))
    return " ".join(out) + "."


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        (1, base, "a"),
        (2, base, "a"),
        (3, " ".join(near), "b"),
        (4, None, "b"),
        (5, "", None),
        (6, "  \n\t ", None),
        (7, "one", "c"),
        (8, "one", "c"),
        (9, prose(2, 4000), "a"),
        (10, "x" * 6000 + "日" * 3000, "c"),
        (11, "Released under the MIT License.\n" + prose(3, 60), "c"),
        (12, "mit license MIT LICENSE apache license", "d"),
        (13, "\n".join([prose(4, 20)] * 4), "d"),
        (14, "go! " * 40, "d"),
        (15, "menu | " * 40, "d"),
        (15, "menu | " * 40, "d"),
        (None, prose(5, 30), "a"),
        (None, prose(6, 30), None),
        (17, prose(7, 50) + " <|endoftext|> " + prose(8, 9), "ß"),
    ]
    return [
        (doc_id, text, "en", source, len(text or ""), 7, "k") for doc_id, text, source in texts
    ]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, width: int) -> set:
    tokens = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not tokens:
        return set()
    if len(tokens) < width:
        return {tuple(tokens)}
    return {tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)}


def near_components(texts: list, width: int, percent: int = 80) -> list[int]:
    """The first member's place, for each text."""
    sets = [shingles(text, width) for text in texts]
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(texts)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))]
