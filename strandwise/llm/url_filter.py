"""URL rules by a cascade of Bloom filters.

Level 0 encodes the listed keys, level 1 the keys of the corpus that level 0 takes for listed ones, level 2 the listed
keys that level 1 takes for those, and so on until a level has no false positives in the corpus's complete key
universe. A key of the universe is then listed exactly if the first level that rejects it is an odd one. The universe
is every (host suffix, path prefix) of a url that a rule's shape could match, so the test is exact and needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  #: allow or block

    @property
    def key(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


@dataclass(frozen=True)
class CascadeParams:
    default: str = "allow"  #: the verdict on urls that no rule fits: they aren't on the list
    hashes: int = 3
    max_words: int = 1 << 20  #: of 64 bits, in all levels together: 8 MB in the plan


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    bits: int
    hashes: int
    seed: int

    def test(self, key: Column, table: Column) -> Column:
        """Whether the level takes `key` for one of its own; `table` holds the words."""
        hit = None
        for at in positions(key, self.bits, self.hashes, self.seed):
            word = F.element_at(table, (F.shiftright(at, 6) + 1).cast("int"))
            # a Java shift takes its distance modulo 64
            one = F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
            hit = one if hit is None else hit & one
        return hit

    def table(self) -> Column:
        return F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one constant


def positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _encode(keys: DataFrame, n: int, seed: int, per_key: float, hashes: int, budget: int) -> Level:
    bits = max(64, 64 * math.ceil(n * per_key / 64))
    if bits // 64 > budget:
        raise ValueError(f"{n} keys need {bits // 64} words; raise CascadeParams.max_words or split the list")
    at = keys.select(F.explode(F.array(*positions(F.col("key"), bits, hashes, seed))).alias("at"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    found = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(mask).alias("mask")).collect()  # at most bits / 64
    words = [0] * (bits // 64)
    for r in found:
        words[r["word"]] = r["mask"]
    return Level(tuple(words), bits, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe that the cascade was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for k, level in reversed(list(enumerate(self.levels))):
            out = F.when(level.test(key, level.table()), out).otherwise(F.lit(k % 2 == 1))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, seed: int, params: CascadeParams = CascadeParams()) -> Cascade:
    """A cascade for the column `key` of `listed` over that of `universe`.

    Level 0 gets as many bits a key as leave about as many false positives as there are listed keys, so all levels
    together grow with the list and the logarithm of the universe, never with the corpus; `max_words` bounds them.
    """
    inside = staged(listed.select("key").where("key IS NOT NULL").distinct(), "listed")
    outside = staged(universe.select("key").where("key IS NOT NULL").distinct().join(inside, "key", "left_anti"), "unlisted")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    own, other, n_own, n_other = inside, outside, n_in, n_out
    budget = params.max_words
    while n_own:
        share = max(2.0, n_other / n_own)
        per_key = 1.5 * math.log2(share) + 2
        level = _encode(own, n_own, seed + len(levels), per_key, params.hashes, budget)
        budget -= len(level.words)
        levels.append(level)
        wrong = staged(other.where(level.test(F.col("key"), level.table())), "false-positives")
        own, other, n_own, n_other = wrong, own, wrong.count(), n_own
        if len(levels) > 64:
            raise RuntimeError("the cascade did not settle")
    return Cascade(tuple(levels))


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where `://` is missing."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    rest = F.coalesce(F.regexp_replace(rest, r"(?s)[?#].*$", ""), F.lit(""))
    cut = F.instr(rest, "/")
    host = F.when(cut > 0, F.substring(rest, F.lit(1), cut - 1)).otherwise(rest)
    path = F.when(cut > 0, F.substring(rest, cut, F.length(rest))).otherwise(F.lit(""))
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys of a url: its last `labels` host labels with the first `chars` of its path, by shape.

    Longest first; of equally long ones, in the order of `shapes`.
    """
    dots = F.length(host) - F.length(F.translate(host, ".", ""))
    keys = [
        F.when(
            (dots >= labels - 1) & (F.length(path) >= chars) & (F.length(host) > 0),
            F.concat(F.substring_index(host, ".", -labels), F.substring(path, F.lit(1), F.lit(chars))),
        )
        for labels, chars in shapes
    ]
    return F.array_sort(F.array_compact(F.array(*keys)), lambda a, b: F.length(b) - F.length(a))


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    params: CascadeParams = CascadeParams(),
) -> DataFrame:
    """id_col, host, path, rule, verdict of every row of `pages`.

    The longest rule that fits wins; without one, `rule` is null and the verdict is `params.default`. A null url has an
    empty host and path and fits no rule. Repeated rows stay; extra columns are ignored; no rows give no rows.
    """
    spark = pages.sparkSession
    host, path = parse_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules}, reverse=True)  # longer hosts win ties
    keyed = rows.withColumn("keys", candidates(F.col("host"), F.col("path"), shapes)) if shapes else rows.withColumn("keys", F.array().cast("array<string>"))
    universe = staged(keyed.select(F.explode("keys").alias("key")).distinct(), "universe")
    built = {}
    for seed, verdict in enumerate(("allow", "block")):
        listed = spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string")
        built[verdict] = build_cascade(listed, universe, 1000 * (seed + 1), params)
    fits = F.transform(
        "keys",
        lambda k: F.struct(
            k.alias("rule"),
            F.when(built["allow"].contains(k), F.lit("allow")).when(built["block"].contains(k), F.lit("block")).alias("verdict"),
        ),
    )
    best = F.get(F.filter(fits, lambda x: x["verdict"].isNotNull()), F.lit(0))
    return keyed.withColumn("best", best).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(params.default)).alias("verdict"),
    )


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP3_SQL = r"""
WITH u AS (
    SELECT page_id,
           CASE WHEN strpos(url, '://') > 0
                THEN regexp_replace(substr(url, strpos(url, '://') + 3), '[?#](.|\n)*$', '') ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id,
           translate(CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
    FROM (SELECT page_id, coalesce(rest, '') AS rest FROM u)),
r(rhost, rpath, rverdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
    SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS nth
    FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM f WHERE nth = 1
"""
