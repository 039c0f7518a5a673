"""URL filters by a cascade of Bloom filters: exact membership without joins.

Level 0 encodes the listed keys. Scanning the corpus's complete key universe gives the keys
level 0 lets through wrongly; level 1 encodes those, level 2 the listed keys that level 1 lets
through, and so on until a level is wrong about nothing. A key's answer is the parity of the
first level that refuses it. Over the universe the answers are exact.

A url is judged by rules of a host and a path prefix. Its candidate keys are the host's
suffixes with the path's prefixes of the lengths that occur in rules; a candidate that the
cascade of a list holds is a rule that fits, and the longest decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import map_arrow, mix64

#: Bound on one level's bits, which are broadcast; a longer list goes through a join instead.
MAX_BITS = 1 << 28
MAX_LEVELS = 64
_DOWN = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass
class Level:
    seed: int
    hashes: int
    words: np.ndarray

    def positions(self, keys: list[str]) -> np.ndarray:
        return bit_positions(keys, self.seed, self.hashes, 64 * len(self.words))

    def holds(self, keys: list[str]) -> np.ndarray:
        at = self.positions(keys)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def bit_positions(keys: list[str], seed: int, hashes: int, bits: int) -> np.ndarray:
    """[key, hash] bit numbers by double hashing; ``bits`` is a power of two."""
    first = np.array([xxhash.xxh64_intdigest(k, seed) for k in keys], np.uint64)
    step = mix64(first) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (first[:, None] + np.arange(hashes, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def holds(self, keys: list[str]) -> np.ndarray:
        """Membership of keys, exact for every key of the universe the cascade was built over."""
        out = np.full(len(keys), len(self.levels) % 2 == 1)
        at = np.arange(len(keys))
        for depth, level in enumerate(self.levels):
            if not len(at):
                break
            passed = level.holds([keys[i] for i in at.tolist()])
            out[at[~passed]] = depth % 2 == 1
            at = at[passed]
        return out


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A level over ``keys``; tasks set bits, words are or-ed before and after the shuffle."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 1 << (math.ceil(n * hashes / math.log(2)) - 1).bit_length())
    if bits > MAX_BITS:
        raise OverflowError(f"a level of {bits} bits is above the bound of {MAX_BITS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            at = bit_positions(batch.column(0).to_pylist(), seed, hashes, bits).ravel()
            yield {"word": (at >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)}

    words = np.zeros(bits // 64, np.uint64)
    for word, mask in map_arrow(keys.select("key"), run, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).collect():
        words[word] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return Level(seed, hashes, words)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of ``listed`` keys over ``universe``, both with a string column ``key``.

    Null keys are ignored and repeats count once. An empty list gives a cascade that holds nothing.
    """
    inside = materialize(listed.where("key is not null").select("key").distinct(), "listed-keys")
    others = universe.where("key is not null").select("key").distinct().join(inside, "key", "left_anti")
    outside = materialize(others, "other-keys")
    n, s = inside.count(), outside.count()
    levels: list[Level] = []
    rate = min(0.5, max(1e-9, math.sqrt(0.5) * n / max(1, s)))
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError(f"the cascade did not end in {MAX_LEVELS} levels")
        level = _level(inside, n, rate, len(levels))
        levels.append(level)
        wrong = materialize(_passing(outside, level), "wrongly-held")
        inside, outside, rate = wrong, inside, 0.5
        n = wrong.count()
    return Cascade(levels)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"key": batch.column(0).filter(pa.array(shared.value.holds(batch.column(0).to_pylist())))}

    return map_arrow(keys.select("key"), run, "key string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


@dataclass
class RuleShape:
    """What limits a url's candidates: labels in the longest rule host, lengths of rule paths."""

    labels: int
    path_lengths: list[int]

    @classmethod
    def of(cls, rules: list[str]) -> RuleShape:
        hosts, paths = zip(*[split_rule(r) for r in rules], strict=True) if rules else ((), ())
        return cls(max((h.count(".") + 1 for h in hosts), default=0), sorted({len(p) for p in paths}))


def split_rule(rule: str) -> tuple[str, str]:
    at = rule.find("/")
    return (rule.translate(_DOWN), "") if at < 0 else (rule[:at].translate(_DOWN), rule[at:])


def candidate_keys(host: str, path: str, shape: RuleShape) -> list[str]:
    """Possible rules of a url, longest first (of equal length, the longer host first)."""
    labels = host.rsplit(".", shape.labels)[-shape.labels:] if shape.labels else []
    suffixes = [".".join(labels[i:]) for i in range(len(labels))]
    found = [(s, path[:n]) for s in suffixes for n in shape.path_lengths if len(path) >= n]
    return [s + p for s, p in sorted(found, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))]


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` are (verdict, host/path). The longest fitting rule decides and is returned; a url no
    list holds a key of gets ``default`` and a null rule. A rule on two lists is refused. Rows
    are judged one by one, so repeats stay; other columns are ignored.
    """
    spark = pages.sparkSession
    listed: dict[str, str] = {}
    for verdict, rule in rules:
        host, path = split_rule(rule)
        if listed.setdefault(host + path, verdict) != verdict:
            raise ValueError(f"rule {rule} is on two lists")
    shape = RuleShape.of(list(listed))
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            pairs = set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            yield {"key": list({k for h, p in pairs for k in candidate_keys(h, p, shape)})}

    universe = materialize(map_arrow(parts.select("host", "path"), keys, "key string").distinct(), "url-keys")
    cascades = {
        verdict: build_cascade(spark.createDataFrame([(k,) for k, v in listed.items() if v == verdict], "key string"), universe)
        for verdict in sorted(set(listed.values()))
    }
    shared = spark.sparkContext.broadcast(cascades)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            candidates = [candidate_keys(h, p, shape) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            distinct = list({k for found in candidates for k in found})
            held = {k: verdict for verdict, cascade in shared.value.items() for k, h in zip(distinct, cascade.holds(distinct).tolist(), strict=True) if h}
            rule = [next((k for k in found if k in held), None) for found in candidates]
            yield {
                "page_id": batch.column(0), "host": batch.column(1), "path": batch.column(2), "rule": rule,
                "verdict": [held[r] if r is not None else default for r in rule],
            }

    return map_arrow(parts, judge, "page_id bigint, host string, path string, rule string, verdict string")


def listed_keys(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose ``key`` is on the list: by a cascade, or by a join where it outgrows the bound."""
    try:
        cascade = build_cascade(listed, keys)
    except OverflowError:
        return keys.join(listed.select("key").distinct(), "key", "left_semi")
    shared = keys.sparkSession.sparkContext.broadcast(cascade)
    at = keys.columns.index("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = shared.value.holds([k or "" for k in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(held & ~np.array(batch.column(at).is_null())))

    return keys.mapInArrow(run, keys.schema)
