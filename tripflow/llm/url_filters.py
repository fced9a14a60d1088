"""URL rules looked up in a Bloom filter cascade: exact membership without joins.

A rule is a host with all its subdomains and the start of a path; the longest that fits wins. Of
every url the few host endings and path starts that could be a rule are keys, and the keys of all
urls are the cascade's universe. Its first level encodes the listed keys, the next the keys of
the universe that the first lets through wrongly, the third the listed keys that the second lets
through wrongly, and so on until nothing wrong is left. Within its universe a cascade makes no
mistakes: a key is listed exactly if it fails first at an even level (counted from one), or
passes all of an odd number.

The listed keys are the rules, plus names of query parameters that mark a url as a tracked
variant of another. A url that no rule fits is blocked if it carries such a parameter.

All of it is column expressions. A level's bits are one binary constant, made by one aggregation
and in the plan once. They are bounded by the list, not by the corpus: the first level gets
``log2(universe / list)`` bits a key, later ones encode about as many keys as the list has, and
``max_listed`` bounds the list. Levels of few keys take more bits a key, so that few levels follow.

Defined results: a null url, or one without ``://``, has an empty host and path, and no rule.
Repeated urls are judged alike. Other columns play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import saved

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = CAPITALS.lower()


@dataclass(frozen=True)
class Rules:
    """Rules as host followed by path, with their verdicts; ``host/`` is a whole host."""

    verdicts: tuple[tuple[str, str], ...]
    tracking: tuple[str, ...] = ()
    max_listed: int = 1_000_000

    def listed(self) -> list[str]:
        keys = [rule for rule, _ in self.verdicts] + [f"?{name}" for name in self.tracking]
        if len(keys) > self.max_listed:
            raise ValueError("the list is longer than its bound; split it into several filters")
        return keys


#: The rules that every corpus is judged by, and common tracking parameters.
DEFAULT = Rules(
    verdicts=(
        ("org/", "allow"),
        ("example.org/es/", "block"),
        ("example.org/en/1", "block"),
        ("com/fr/", "allow"),
        ("com/de/", "block"),
    ),
    tracking=("fbclid", "gclid", "ref", "utm_campaign", "utm_medium", "utm_source"),
)


def _before(text: Column, marks: str) -> Column:
    """The text up to the first of some characters."""
    return reduce(lambda rest, mark: F.substring_index(rest, mark, 1), marks, text)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty if it has none."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = _before(rest, "/?#")
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, CAPITALS, SMALL), _before(after, "?#")


def parameter_names(url: Column) -> Column:
    """Names of a url's query parameters, each with ``?`` in front."""
    query = _before(
        F.coalesce(F.substring(url, F.locate("?", url) + 1, F.length(url)), F.lit("")), "#"
    )
    has = F.coalesce(F.locate("?", _before(url, "#")) > 0, F.lit(False))
    names = F.transform(
        F.split(query, "&"), lambda part: F.concat(F.lit("?"), F.substring_index(part, "=", 1))
    )
    return F.when(has, F.array_distinct(names)).otherwise(F.array().cast("array<string>"))


def candidate_keys(host: Column, path: Column, url: Column, rules: Rules) -> Column:
    """All keys of a url that could be on the list.

    Only endings of as many labels, and path starts of as many characters, as some rule has.
    """
    shapes = set()
    for rule, _ in rules.verdicts:
        name, _, start = rule.partition("/")
        shapes.add((name.count(".") + 1, len(start) + 1))
    keys = [
        F.when(
            F.length(path) >= length,
            F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)),
        )
        for labels, length in sorted(shapes)
    ]
    own = F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.array().cast(
        "array<string>"
    )
    return F.concat(own, parameter_names(url)) if rules.tracking else own


#: Seven bits a byte: each byte is a character that ``ascii`` reads. Nine bytes are a long's bits.
BYTE_BITS = 7
WORD_BITS = 63
#: Later levels let through half of the wrong keys, those of few keys hardly any.
FEW_KEYS = 10_000
WRONG_OF_MANY, WRONG_OF_FEW = 0.5, 2.0**-8


@dataclass(frozen=True)
class Level:
    """A Bloom filter: ``hashes`` bits per key in one string of bytes."""

    data: bytes
    hashes: int
    salt: int

    def has(self, key: Column) -> Column:
        data = F.lit(bytearray(self.data))

        def is_set(at: Column) -> Column:
            byte = F.substring(data, F.floor(at / BYTE_BITS).cast("int") + 1, F.lit(1))
            return F.getbit(F.ascii(byte.cast("string")), (at % BYTE_BITS).cast("int")) == 1

        bits = len(self.data) * BYTE_BITS
        return F.forall(bit_positions(key, bits, self.hashes, self.salt), is_set)


def bit_positions(key: Column, bits: int, hashes: int, salt: int) -> Column:
    """``hashes`` positions below ``bits``: multiples of one hash, from another one on."""
    first, step = (F.pmod(F.xxhash64(key, F.lit(salt), F.lit(i)), F.lit(bits)) for i in (0, 1))
    return F.array(*[F.pmod(first + step * i, F.lit(bits)) for i in range(hashes)])


def bloom_level(keys: DataFrame, count: int, wrong: float, salt: int) -> Level:
    """A level over ``count`` keys that lets through about ``wrong`` of all others."""
    hashes = max(1, round(-math.log2(wrong)))
    size = max(1, math.ceil(count * hashes / math.log(2) / WORD_BITS))
    positions = bit_positions(F.col("key"), size * WORD_BITS, hashes, salt)
    rows = (
        keys.select(F.explode(positions).alias("at"))
        .groupBy(F.floor(F.col("at") / WORD_BITS).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(at % {WORD_BITS} as int))")).alias("bits"))
        .collect()
    )
    per_word = WORD_BITS // BYTE_BITS
    data = bytearray(size * per_word)
    for word, bits in rows:
        for number in range(per_word):
            data[word * per_word + number] = bits >> (BYTE_BITS * number) & 127
    return Level(bytes(data), hashes, salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            answer = F.when(~self.levels[number - 1].has(key), F.lit(number % 2 == 0)).otherwise(
                answer
            )
        return answer


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """A cascade for the keys (column ``key``) of ``listed`` among those of ``universe``.

    Listed keys that the universe lacks are not encoded: nobody will ask for them.
    """
    marked = universe.select("key", F.lit(0).alias("on")).unionByName(
        listed.select("key", F.lit(1).alias("on"))
    )
    # One row per key of the corpus; whether it is in the universe and on the list.
    every = saved(
        marked.groupBy("key")
        .agg(F.max("on").alias("listed"), F.min("on").alias("absent"))
        .filter("absent = 0")
        .select("key", "listed"),
        "url-universe",
    )
    sizes = every.agg(
        F.count(F.lit(1)).alias("all"), F.coalesce(F.sum("listed"), F.lit(0)).alias("listed")
    ).first()
    levels: list[Level] = []
    inside = every.filter("listed = 1").select("key")
    outside = every.filter("listed = 0").select("key")
    count = sizes.listed
    if not count:
        return Cascade(())
    wrong = min(WRONG_OF_MANY, math.sqrt(0.5) * count / max(1, sizes["all"] - count))
    while count:
        level = bloom_level(inside, count, wrong, len(levels))
        levels.append(level)
        # What this level lets through wrongly is what the next one encodes.
        passed = saved(outside.filter(level.has(F.col("key"))), "url-passed")
        count = passed.count()
        wrong = WRONG_OF_MANY if count > FEW_KEYS else WRONG_OF_FEW
        inside, outside = passed, inside
    return Cascade(tuple(levels))


def judge_urls(pages: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; reads no other column than the url."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    keyed = urls.withColumn(
        "keys", candidate_keys(F.col("host"), F.col("path"), F.col("url"), rules)
    )
    universe = keyed.select(F.explode("keys").alias("key")).distinct()
    listed = spark.createDataFrame([(key,) for key in rules.listed()], "key string")
    on_list = build_cascade(universe, listed)
    # A second, small cascade tells blocking keys among the listed ones.
    blocking = [(rule,) for rule, verdict in rules.verdicts if verdict == "block"]
    blocks = build_cascade(listed, spark.createDataFrame(blocking, "key string"))

    hits = F.filter("keys", on_list.lists)
    rule_hits = F.filter("hits", lambda key: ~key.startswith("?"))
    longest = F.element_at(
        F.array_sort(F.transform(rule_hits, lambda key: F.struct(F.length(key).alias("n"), key.alias("key")))), -1
    )
    found = keyed.withColumn("hits", hits).withColumn(
        "rule", F.when(F.size(rule_hits) > 0, longest["key"])
    )
    tracked = F.exists("hits", lambda key: key.startswith("?"))
    verdict = (
        F.when(F.col("rule").isNotNull(), blocks.lists(F.col("rule"))).otherwise(tracked)
    )
    return found.select(
        F.col("page_id").cast("long"),
        "host",
        "path",
        "rule",
        F.when(verdict, "block").otherwise("allow").alias("verdict"),
    )
