"""Two tokenizers aligned byte by byte, with corpus-wide counts of the ids that end together.

Tokens of both sides are intervals of bytes. All intervals, lexsorted by start, are coalesced:
where a start reaches the running maximum of the ends (``maximum.accumulate``), a group ends.
Inside a group overlapping tokens of the two sides are expanded to pairs; the pairs that end at
the same byte are links.

A text is cut before a blank that stands between letters or marks; neither tokenizer
has tokens across such a place, so the pieces are encoded and aligned on their own and each
worker keeps those it met. Texts are handled in chunks. A chunk carries its links as positions
in its list of distinct pairs, so counts are added up, and sent back, once per chunk and pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import secrets
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import map_arrow, text_slices

#: Characters of text in a chunk (a longer text is a chunk of its own).
CHUNK_CHARS = 2_000_000
#: Pieces a worker keeps, none longer than ``MEMO_CHARS``.
MEMO_PIECES, MEMO_CHARS = 250_000, 40
#: New pieces aligned at once.
TOGETHER = 20_000
_LETTERS = "A-Za-zÀ-ɏ"
_CUT = re.compile(f"(?<=[!-~À-ɏ])(?= [{_LETTERS}])")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Aligned(NamedTuple):
    """A piece's tokens: how many of each side, its groups as text, its links as pairs of ids, its bytes on side B if they differ."""
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes
    odd: bytes | None


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule.

    Bytes that print as themselves keep their character; the others, in order, take those from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number (from 0, in order of place) of each interval; groups part where a start reaches all ends before it."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    first = np.ones(len(order), bool)
    first[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(first) - 1
    return groups


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all pairs that share a byte; each side's intervals are in order and do not overlap."""
    low = np.searchsorted(b_ends, a_starts, "right")
    n = np.maximum(np.searchsorted(b_starts, a_ends, "left") - low, 0)
    a = np.repeat(np.arange(len(a_starts)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


_NOTHING = Aligned(0, 0, 0, "", b"", None)


class Aligner:
    """Encodes with a byte-level vocabulary file (A) and a piece model with byte fallback (B) and aligns the tokens."""

    def __init__(self, path_a: str, path_b: str, memo_pieces: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(alphabet[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Pieces may be handled apart only if neither side has tokens that go on over a blank behind other characters.
        cutter = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        across = any("▁" in p.lstrip("▁") for i, p in enumerate(pieces) if not self.b.is_control(i))
        self.cuts = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space") and not across
        self.memo: dict[str, Aligned] = {}
        self.memo_pieces = memo_pieces

    def _new(self, pieces: list[str]) -> list[Aligned]:
        a_ids = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b_ids = self.b.encode([p[1:] for p in pieces], num_threads=1)
        raw = [p.encode() for p in pieces]
        b_raw = [b"".join([self.b_bytes[i] for i in own]) for own in b_ids]
        fine = [k for k, r in enumerate(raw) if b_raw[k] == r and b"".join([self.a_bytes[i] for i in a_ids[k]]) == r]
        out = [Aligned(len(a), len(b), 0, "", b"", other) for a, b, other in zip(a_ids, b_ids, b_raw, strict=True)]
        if not fine:
            return out
        a = np.array([i for k in fine for i in a_ids[k]], np.int64)
        b = np.array([i for k in fine for i in b_ids[k]], np.int64)
        # The pieces lie one behind the other, so one coalescing serves them all.
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_starts, b_starts = a_ends - self.a_sizes[a], b_ends - self.b_sizes[b]
        groups = coalesce(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]))
        a_cuts = np.flatnonzero(np.diff(groups[:len(a)], append=-1)) + 1
        b_cuts = np.flatnonzero(np.diff(groups[len(a):], append=-1)) + 1
        x, y = overlaps(a_starts, a_ends, b_starts, b_ends)
        together = a_ends[x] == b_ends[y]
        x, y = x[together], y[together]
        links = (a[x] << 32) | b[y]
        a_text, b_text = a.tolist(), b.tolist()
        texts, a_from, b_from = [], 0, 0
        for a_to, b_to in zip(a_cuts.tolist(), b_cuts.tolist(), strict=True):
            texts.append(f"{','.join(map(str, a_text[a_from:a_to]))}|{','.join(map(str, b_text[b_from:b_to]))}")
            a_from, b_from = a_to, b_to
        stops = np.cumsum([len(raw[k]) for k in fine])
        group_stops = np.searchsorted(a_ends[a_cuts - 1], stops, "right").tolist()
        link_stops = np.searchsorted(a_ends[x], stops, "right").tolist()
        g, s = 0, 0
        for k, g_to, s_to in zip(fine, group_stops, link_stops, strict=True):
            out[k] = Aligned(len(a_ids[k]), len(b_ids[k]), g_to - g, ";".join(texts[g:g_to]), links[s:s_to].tobytes(), None)
            g, s = g_to, s_to
        return out

    def _joined(self, pieces: list[str], aligned: list[Aligned]) -> Aligned:
        if any(x.odd is not None for x in aligned):
            # Pieces that differ may still join to the same bytes; then the text is one piece.
            same = b"".join([p.encode() if x.odd is None else x.odd for p, x in zip(pieces, aligned, strict=True)]) == "".join(pieces).encode()
            aligned = self._new(["".join(pieces)]) if same and len(pieces) > 1 else aligned
        if not aligned or any(x.odd is not None for x in aligned):
            return _NOTHING
        n_a, n_b, n_groups, groups, links, _ = zip(*aligned, strict=True)
        return Aligned(sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links), None)

    def align(self, texts: list[str | None]) -> Iterator[Aligned]:
        """Each text as one ``Aligned``; texts null, empty or odd have no tokens, groups or links."""
        parts = [(_CUT.split(f" {t}") if self.cuts else [f" {t}"]) if t else [] for t in texts]
        known = self.memo
        new = list(dict.fromkeys(p for own in parts for p in own if p not in known))
        found: dict[str, Aligned] = {}
        for i in range(0, len(new), TOGETHER):
            run = new[i:i + TOGETHER]
            found.update(zip(run, self._new(run), strict=True))
        for own in parts:
            yield self._joined(own, [known[p] if p in known else found[p] for p in own])
        for piece, aligned in found.items():
            if len(known) >= self.memo_pieces:
                break
            if len(piece) <= MEMO_CHARS:
                known[piece] = aligned


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner for two files, loaded once."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_CHUNK = (
    "chunk bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups array<string>, links binary, pairs array<bigint>, counts array<bigint>"
)


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = CHUNK_CHARS, with_groups: bool = False) -> DataFrame:
    """Chunks of documents: token, group and link numbers, groups (their text, or its sha256), links and distinct pairs.

    ``chunk`` is drawn at random, so the table must be written before it is joined with itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = aligner(path_a, path_b)
        for ids, texts in text_slices(batches, chunk_chars):
            numbers, groups, links = [], [], []
            for x in own.align(texts):
                numbers.append((x.n_a, x.n_b, x.n_groups, len(x.links) // 8))
                groups.append(x.groups if with_groups or not x.n_a else hashlib.sha256(x.groups.encode()).hexdigest())
                links.append(x.links)
            pairs, places, counts = np.unique(np.frombuffer(b"".join(links), np.int64), return_inverse=True, return_counts=True)
            narrow = "<u2" if len(pairs) <= 1 << 16 else "<u4"
            n_a, n_b, n_groups, n_links = ([list(c)] for c in zip(*numbers, strict=True))
            yield {
                "chunk": [secrets.randbits(63)], "doc_ids": [ids], "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups": [groups], "links": [places.astype(narrow).tobytes()], "pairs": [pairs.tolist()], "counts": [counts.tolist()],
            }

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair (A id times 2^32 plus B id), n (links that hold it in all documents), best (no pair of this B id has more)."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = each.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    totals = materialize(totals, "pair-counts")
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = CHUNK_CHARS, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document (``groups`` itself on request).

    A text that is null, empty, or whose joined bytes differ on a side has no tokens: zeros and an
    empty groups column. Every row comes back, repeated ids too, and repeated rows all count;
    other columns are ignored and an empty table gives an empty result. A very long text is a
    chunk of its own.
    """
    chunks = materialize(aligned_chunks(docs, path_a, path_b, chunk_chars, with_groups), "aligned-chunks")
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(pair_counts(chunks), "pair").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("told"))
    told = told.select("chunk", F.col("told.n").alias("totals"), F.col("told.best").alias("best"))
    groups = "groups" if with_groups else "groups_sha256"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                totals, best = np.array(row["totals"] or [], np.int64), np.array(row["best"] or [], np.int64)
                links = np.frombuffer(row["links"], "<u2" if len(totals) <= 1 << 16 else "<u4")
                stops = np.cumsum(row["n_links"])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x[links])])[np.concatenate([[0], stops])]) for x in (totals, best)]
                yield {
                    "doc_id": row["doc_ids"], "n_a": row["n_a"], "n_b": row["n_b"], "n_groups": row["n_groups"], "n_links": row["n_links"],
                    "n_best": sums[1], "count_sum": sums[0], groups: row["groups"],
                }

    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    joined = chunks.select("chunk", "doc_ids", *numbers, "groups", "links").join(told, "chunk", "left").drop("chunk")
    return map_arrow(joined, run, f"doc_id bigint, {', '.join(f'{c} bigint' for c in [*numbers, 'n_best', 'count_sum'])}, {groups} string")
