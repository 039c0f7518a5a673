"""Repeated byte strings found by a distributed suffix sort and cut out of every text.

A string of ``LENGTH`` bytes holds ``LENGTH - LEAD + 1`` strings of ``LEAD`` bytes; the one of
least hash (the leftmost of equals) is its anchor. The anchor depends on the string's
content alone, so equal strings have equal anchors at equal offsets. Neighbouring strings of a
text mostly share their anchor and form a *run*: one stretch of bytes around one anchor, about
one for every eighty bytes of text. The suffixes that are sorted are those that begin at anchors.

1. Anchors are counted over the corpus, combined before the shuffle. A string whose anchor occurs
   once is unique; all others go on. Where all runs of an anchor are equal, each of their strings
   repeats: equal runs are one suffix with a count.
2. The remaining distinct runs are dealt by range of their leading bytes, which Spark's sampled
   splitters cut (``repartitionByRange``), so all runs of an anchor meet in one bucket.
3. A bucket sorts the suffixes right of the anchors, and the reversed prefixes left of them, by
   multikey quicksort over eight-byte tokens. Common prefix lengths of neighbours split either
   order into classes; two strings at the same offset are equal exactly if their left parts and
   their right parts are in the same class.
4. An anchor with more than ``GROUP_LIMIT`` distinct runs (a passage within very many different
   texts) reaches over bucket boundaries. Its strings are compared across them by 128-bit digests,
   counted before the shuffle, so that no bucket holds them all.

Texts travel by a 64-bit key that only routes: each worker finds the runs of a text anew and looks
them up by anchor and content, so a clash of keys adds entries that nothing asks for.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import map_arrow, mix64

LENGTH = 200
LEAD = 40
#: Strings of a text whose anchors are sought at once.
BLOCK_STRINGS = 1 << 20
#: Runs a bucket sorts at once (some megabytes), complete groups; the last group may be as large again.
SORTED_TOGETHER = 8192
#: Distinct runs of an anchor that one bucket compares; cutting runs into strings costs twenty times their bytes.
GROUP_LIMIT = SORTED_TOGETHER
#: Texts handled at once inside a task, in bytes.
SLICE_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = 22


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled = 1
    with np.errstate(over="ignore"):
        while filled < n:
            more = min(filled, n - filled)
            out[filled:filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
            filled += more
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scrambled bytes, powers of the base and of its inverse, at least ``n`` of them."""
    if len(_TABLES.get("up", ())) < n:
        _TABLES["byte"] = mix64(np.arange(1, 257, dtype=np.uint64))
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    return _TABLES["byte"], _TABLES["up"], _TABLES["down"]


def lead_hashes(text: np.ndarray, lead: int) -> np.ndarray:
    """A 64-bit hash of each string of ``lead`` bytes (powers of one base, added up and scrambled)."""
    scrambled, up, down = _tables(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(scrambled[text] * up[:len(text)], out=sums[1:])
        return mix64((sums[lead:] - sums[:-lead]) * down[:len(text) - lead + 1])


class Runs:
    """The runs of a text: hash and place of the anchor, first string, and the one behind the last."""

    def __init__(self, text: bytes, length: int = LENGTH, lead: int = LEAD):
        anchors, places, starts, stops = [], [], [], []
        raw = np.frombuffer(text, np.uint8)
        for begun in range(0, len(text) - length + 1, BLOCK_STRINGS):
            hashes = lead_hashes(raw[begun:begun + BLOCK_STRINGS + length - 1], lead)
            width = length - lead + 1
            # The place in the low bits makes the leftmost of equal hashes the least.
            keys = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
            rows = -(-len(keys) // width)
            grid = np.full(rows * width, np.uint64(2**64 - 1))
            grid[:len(keys)] = keys
            grid = grid.reshape(rows, width)
            ahead = np.minimum.accumulate(grid, axis=1).ravel()
            behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            n = len(keys) - width + 1
            least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
            first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            place = (least[first] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
            anchors.append(hashes[place].view(np.int64))
            places.append(place + begun)
            starts.append(first + begun)
            stops.append(np.append(first[1:], n) + begun)
        self.anchor, self.place, self.start, self.stop = (
            np.concatenate(x) if x else np.zeros(0, np.int64) for x in (anchors, places, starts, stops)
        )
        self.text, self.length = text, length

    def body(self, i: int) -> bytes:
        return self.text[self.start[i]:self.stop[i] + self.length - 1]

    def contents(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of the bytes of each run, or of the chosen ones."""
        start, stop = (self.start, self.stop) if chosen is None else (self.start[chosen], self.stop[chosen])
        digest, text, more = xxhash.xxh64_intdigest, self.text, self.length - 1
        return np.fromiter((digest(text[a:b + more]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)), np.uint64, len(start)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of a bounded number of bytes in the column ``text``; a longer text comes alone."""
    rows, held = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            rows.append({n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)})
            held += len(rows[-1]["text"] or b"")
            if held >= SLICE_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _once(rows: list[dict]) -> list[tuple[dict, int]]:
    """Each distinct text of a slice with its number of rows."""
    seen = Counter(xxhash.xxh128_digest(r["text"]) for r in rows)
    return [(r, n) for r in rows if (n := seen.pop(xxhash.xxh128_digest(r["text"]), 0))]


def _gathered(columns: dict[str, list]) -> dict[str, np.ndarray]:
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in columns.items()}


def suffix_order(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``strings`` sorted within their groups, and the bytes each shares with the one before (-1 at a group's first).

    Multikey quicksort with tokens of eight bytes: strings that tie so far are sorted by their next
    token and split where it changes; only ties of more than one string go on to the token after.
    """
    n = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    width = max(8, -(-int(lengths.max(initial=0)) // 8) * 8)
    grid = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(n, width)
    tokens = grid.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    ties = groups[order]
    ties = np.concatenate([[0], np.cumsum(ties[1:] != ties[:-1])])
    first_of_group = np.concatenate([[True], ties[1:] != ties[:-1]])
    for depth in range(tokens.shape[1] + 1):
        shared = np.concatenate([[False], ties[1:] == ties[:-1]])
        shared[:-1] |= shared[1:]
        open_ = np.flatnonzero(shared)
        if not len(open_):
            break
        # Padded strings that tie to the end are told apart by length.
        key = tokens[order[open_], depth] if depth < tokens.shape[1] else lengths[order[open_]].astype(np.uint64)
        sorted_ = np.lexsort((key, ties[open_]))
        order[open_], key = order[open_][sorted_], key[sorted_]
        split = np.concatenate([[True], (key[1:] != key[:-1]) | (ties[open_][1:] != ties[open_][:-1])])
        new = np.concatenate([[True], ties[1:] != ties[:-1]])
        new[open_] |= split
        ties = np.cumsum(new) - 1
    here = grid[order]
    differ = here[1:] != here[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.concatenate([[-1], np.minimum(common, np.minimum(lengths[order][1:], lengths[order][:-1]))])
    common[first_of_group] = -1
    return order, common


def repeated_strings(bodies: list[bytes], offsets: np.ndarray, counts: np.ndarray, groups: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each run, which of its strings occur elsewhere; ``offsets`` are the anchors' places in the runs."""
    n = len(bodies)
    strings = np.fromiter(map(len, bodies), np.int64, n) - length + 1
    right, right_common = suffix_order([b[o:] for b, o in zip(bodies, offsets.tolist(), strict=True)], groups)
    left, left_common = suffix_order([b[:o][::-1] for b, o in zip(bodies, offsets.tolist(), strict=True)], groups)
    found = np.zeros((n, int(strings.max(initial=0))), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(int((offsets - strings + 1).min(initial=0)), int(offsets.max(initial=0)) + 1):
        at = offsets - before
        rows = np.flatnonzero((at >= 0) & (at < strings))
        right_class[right] = np.cumsum(right_common < length - before)
        left_class[left] = np.cumsum(left_common < before)
        same = right_class[rows] * (n + 1) + left_class[rows]
        _, inverse, n_same = np.unique(same, return_inverse=True, return_counts=True)
        found[rows, at[rows]] = n_same[inverse] > 1
    found[counts > 1] = True
    return [found[i, :strings[i]] for i in range(n)]


def _packed(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _bucket_masks(runs: DataFrame, length: int) -> DataFrame:
    """(anchor, run, mask) of runs whose anchors have few of them; every anchor lies in one bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            if len(held) >= SORTED_TOGETHER:
                last = held[-1]["lead"]
                whole = [r for r in held if r["lead"] != last]
                if whole:
                    yield judged(whole)
                    held = held[len(whole):]
        if held:
            yield judged(held)

    def judged(rows: list[dict]) -> dict:
        leads = [r["lead"] for r in rows]
        groups = np.cumsum([0] + [a != b for a, b in zip(leads[1:], leads, strict=False)])
        masks = repeated_strings(
            [r["body"] for r in rows], np.array([r["place"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64), groups, length,
        )
        return {"anchor": [r["anchor"] for r in rows], "run": [r["run"] for r in rows], "mask": [_packed(m) if m.any() else None for m in masks]}

    dealt = runs.repartitionByRange("lead").sortWithinPartitions("lead")
    return map_arrow(dealt, run, "anchor bigint, run bigint, mask binary")


def _boundary_masks(runs: DataFrame, length: int) -> DataFrame:
    """(anchor, run, mask) of runs whose anchors reach over buckets, string by string."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                body, strings = r["body"], len(r["body"]) - length + 1
                yield {
                    "anchor": [r["anchor"]] * strings, "run": [r["run"]] * strings, "at": list(range(strings)), "n": [r["n"]] * strings,
                    "digest": [xxhash.xxh128_digest(body[i:i + length]) for i in range(strings)],
                }

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = batch.to_pylist()
            masks = []
            for r in rows:
                mask = np.ones(r["strings"], bool)
                mask[r["single"] or []] = False
                masks.append(_packed(mask) if mask.any() else None)
            yield {"anchor": [r["anchor"] for r in rows], "run": [r["run"] for r in rows], "mask": masks}

    each = map_arrow(runs, cut, "anchor bigint, run bigint, at int, n bigint, digest binary")
    counted = each.groupBy("digest").agg(F.sum("n").alias("n"), F.min("anchor").alias("anchor"), F.min("run").alias("run"), F.min("at").alias("at"))
    single = counted.where("n = 1").groupBy("anchor", "run").agg(F.collect_list("at").alias("single"))
    joined = runs.select("anchor", "run", (F.octet_length("body") - length + 1).alias("strings")).join(single, ["anchor", "run"], "left")
    return map_arrow(joined, mark, "anchor bigint, run bigint, mask binary")


def _covered(runs: Runs, whole: set[int], masks: dict[tuple[int, int], bytes]) -> list[tuple[int, int]]:
    """Removed stretches of a text as (start, end), in order and apart."""
    strings = np.zeros(len(runs.text) - runs.length + 1, bool)
    part = {a for a, _ in masks}
    for i, anchor in enumerate(runs.anchor.tolist()):
        if anchor in whole:
            strings[runs.start[i]:runs.stop[i]] = True
        elif anchor in part:
            mask = masks.get((anchor, int(runs.contents(np.array([i]))[0])))
            if mask:
                n = int(runs.stop[i] - runs.start[i])
                strings[runs.start[i]:runs.stop[i]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
    edges = np.flatnonzero(np.diff(strings.view(np.int8), prepend=0, append=0))
    spans: list[tuple[int, int]] = []
    for start, stop in zip(edges[::2].tolist(), (edges[1::2] + runs.length - 1).tolist(), strict=True):
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], stop
        else:
            spans.append((start, stop))
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, lead: int = LEAD, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end) and kept bytes of each document.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in
    ``docs``, in the same text too, overlapping or not; strings never reach over texts and are
    judged on the texts as they came. A null text is empty. Every row comes back; of repeated
    rows all bytes go if they are long enough. Null and repeated ids are kept as they are, other
    columns are ignored, and an empty table gives an empty result. A text is handled in one task,
    in blocks of ``BLOCK_STRINGS``.
    """
    if not 8 <= lead <= length:
        raise ValueError("lead must have from 8 to length bytes")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    long = keyed.where(F.octet_length("text") >= length).select("key", "text")

    def run_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _slices(batches):
            found: dict[str, list] = {"anchor": [], "run": [], "n": []}
            for r, n in _once(rows):
                runs = Runs(r["text"], length, lead)
                found["anchor"].append(runs.anchor)
                found["run"].append(runs.contents())
                found["n"].append(np.full(len(runs.anchor), n))
            yield _gathered(found)

    def text_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _slices(batches):
            found: dict[str, list] = {"anchor": [], "key": []}
            for r, _ in _once(rows):
                anchors = np.unique(Runs(r["text"], length, lead).anchor)
                found["anchor"].append(anchors)
                found["key"].append(np.full(len(anchors), r["key"]))
            yield _gathered(found)

    def edge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _slices(batches):
            found: dict[str, list] = {c: [] for c in ("key", "anchor", "run", "n", "place", "body")}
            for r, n in _once(rows):
                runs = Runs(r["text"], length, lead)
                chosen = np.flatnonzero(np.isin(runs.anchor, np.array(r["part"], np.int64)))
                for i, run in zip(chosen.tolist(), runs.contents(chosen).tolist(), strict=True):
                    for column, value in zip(found, (r["key"], int(runs.anchor[i]), run, n, int(runs.place[i] - runs.start[i]), runs.body(i)), strict=True):
                        found[column].append(value)
            yield found

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _slices(batches):
            all_spans, kept = [], []
            for r in rows:
                text, spans = r["text"], []
                if r["whole"] or r["masks"]:
                    masks = {(m["anchor"], m["run"]): m["mask"] for m in r["masks"] or []}
                    spans = _covered(Runs(text, length, lead), set(r["whole"] or []), masks) if len(text) >= length else []
                all_spans.append([{"start": a, "end": b} for a, b in spans])
                stops = [0, *(x for s in spans for x in s), len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(stops[::2], stops[1::2], strict=True)]) if spans else text)
            yield {
                "doc_id": [r["doc_id"] for r in rows], "n_bytes": [len(r["text"]) for r in rows],
                "n_removed": [len(r["text"]) - len(k) for r, k in zip(rows, kept, strict=True)], "spans": all_spans, "kept": kept,
            }

    counted = map_arrow(long, run_keys, "anchor bigint, run bigint, n bigint").groupBy("anchor").agg(
        F.sum("n").alias("n"), F.min("run").alias("low"), F.max("run").alias("high"),
    )
    repeated = materialize(counted.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("whole")), "repeated-anchors")
    met = map_arrow(long, text_anchors, "anchor bigint, key bigint").join(repeated, "anchor")
    marks = met.groupBy("key").agg(
        F.collect_set(F.when(F.col("whole"), F.col("anchor"))).alias("whole"), F.collect_set(F.when(~F.col("whole"), F.col("anchor"))).alias("part"),
    )
    marks = materialize(marks, "text-anchors")

    parts = long.join(marks.where(F.size("part") > 0).select("key", "part"), "key")
    edges = materialize(map_arrow(parts, edge_runs, "key bigint, anchor bigint, run bigint, n bigint, place int, body binary"), "edge-runs")
    distinct = edges.groupBy("anchor", "run").agg(F.sum("n").alias("n"), F.first("place").alias("place"), F.first("body").alias("body"))
    distinct = materialize(distinct.withColumn("lead", F.expr(f"substring(body, place + 1, {lead})")), "distinct-runs")
    crowded = distinct.groupBy("anchor").agg(F.count("*").alias("runs")).where(F.col("runs") > group_limit).select("anchor")
    crowded = materialize(crowded, "crowded-anchors")
    masks = _bucket_masks(distinct.join(crowded, "anchor", "left_anti"), length).unionAll(
        _boundary_masks(distinct.join(crowded, "anchor", "left_semi"), length)
    )
    masks = materialize(masks.where("mask IS NOT NULL"), "run-masks")
    told = edges.select("key", "anchor", "run").distinct().join(masks, ["anchor", "run"])
    told = told.groupBy("key").agg(F.collect_list(F.struct("anchor", "run", "mask")).alias("masks"))
    removed = marks.select("key", "whole").join(told, "key", "left").where((F.size("whole") > 0) | F.col("masks").isNotNull())
    joined = keyed.join(removed, "key", "left").drop("key")
    return map_arrow(joined, cut, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
