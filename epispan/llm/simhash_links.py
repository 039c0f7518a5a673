"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight bytes at eight positions. Fingerprints at most two bits apart
differ in at most two bytes, so they share at least six positional bytes; and of their four
double bytes at least two are untouched. The index therefore posts each fingerprint under its
six pairs of positional double bytes (a single positional byte would be shared by one row in
256, and tallying such lists costs the square of the table). For rows that meet in a posting
list the shared positional bytes are tallied, pairs below six are dropped, the rest verified.

Equal fingerprints are one node from the start. A posting list longer than ``LIST_LIMIT`` is
not paired up: its fingerprints are grouped under every value one bit away or equal, since two
fingerprints are at most two bits apart exactly if they have such a value in common. Each value
has at most 65 of them, which hang under the smallest, so no link is lost and no group squared.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import ascii_lower_bytes, map_arrow
from .components import connected_components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Shared positional bytes that a pair within ``MAX_BITS`` is sure to have.
LEAST_BYTES = 8 - MAX_BITS
LIST_LIMIT = 48
#: Shingles whose bits are counted at once.
COUNTED_TOGETHER = 1 << 16


def simhash(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a text; words are runs free of blanks and of the controls 9 to 13."""
    words = ascii_lower_bytes(text).split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(size))))
    n = len(words) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, COUNTED_TOGETHER):
        block = hashes[start:start + COUNTED_TOGETHER].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and its fingerprint as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = np.array([simhash(t.as_py()) for t in batch.column(1)], np.uint64)
            yield {"doc_id": batch.column(0), "text_hash": batch.column(2), "fp": pa.array(values.view(np.int64))}

    return map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run, "doc_id bigint, text_hash bigint, fp bigint")


def _postings(nodes: DataFrame) -> DataFrame:
    double = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = [
        F.lit(n << 32) + F.shiftleft(double[i], 16) + double[j]
        for n, (i, j) in enumerate(itertools.combinations(range(4), 2))
    ]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key"))


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally: positions at which two fingerprints have the same byte."""
    differ = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(differ, 8 * i).bitwiseAND(255) == 0).cast("int") for i in range(8))


def fingerprint_links(nodes: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose transitive closure is that of all pairs within two bits."""
    postings = materialize(_postings(nodes), "postings")
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    listed = materialize(postings.join(sizes, "key"), "posting-lists")
    short = listed.where(F.col("n") <= list_limit)
    left, right = short.select("key", F.col("fp").alias("a")), short.select("key", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    paired = left.join(right, (left["key"] == right["key"]) & (a < b) & (shared_bytes(a, b) >= LEAST_BYTES) & (F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS))
    crowded = listed.where(F.col("n") > list_limit).select("fp").distinct()
    near = crowded.select("fp", F.explode(F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -1 << 63) for i in range(64)])).alias("flip"))
    near = materialize(near.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")), "one-bit-away")
    heads = near.groupBy("value").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    hung = near.join(heads, "value").where("fp <> head").select(F.col("fp").alias("a"), F.col("head").alias("b"))
    return paired.select("a", "b").unionAll(hung).distinct()


def _placed(docs: DataFrame, list_limit: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and the root of each distinct fingerprint with its smallest doc_id."""
    prints = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(nodes, list_limit)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    return prints, materialize(placed, "fingerprint-roots")


def near_duplicates(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Fingerprints at most two bits apart are linked. A text without words has fingerprint zero
    and is linked like any other. Repeated rows come back each; a null doc_id takes part but
    never names a component, which is null only if no member has an id. Other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    prints, placed = _placed(docs, list_limit)
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = placed.join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def keep_one_of_each(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """One document of each component: the smallest id, and of its texts in the component one; all columns are kept.

    The decision is about rows, not ids: an id that occurs with several texts may keep one of them
    and lose another. Of rows that repeat both, the first in order of their columns stays. Rows
    without an id name no component and stay. Texts are shuffled once, by id and hash.
    """
    prints, placed = _placed(docs, list_limit)
    known = prints.where("doc_id IS NOT NULL").join(placed.select("fp", "root"), "fp")
    first = known.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("_kept_id"), F.col("first.text_hash").alias("_kept_hash"))
    hashed = docs.where(F.col("doc_id").isNotNull()).withColumn("_text_hash", F.xxhash64("text"))
    chosen = hashed.join(kept, (F.col("doc_id") == F.col("_kept_id")) & (F.col("_text_hash") == F.col("_kept_hash")), "left_semi")
    order = Window.partitionBy("doc_id", "_text_hash").orderBy(*[c for c in docs.columns if c != "doc_id"])
    single = chosen.withColumn("_rank_in_text", F.row_number().over(order)).where("_rank_in_text = 1").select(*docs.columns)
    return single.unionAll(docs.where(F.col("doc_id").isNull()))
