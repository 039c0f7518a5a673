"""Benchmark decontamination: one automaton over all item windows, each text scanned once.

Texts are lower-cased (A-Z) and cut into words. An item contributes every run of ``window``
consecutive words, a shorter item its whole word sequence. The windows of all items form a
single Aho-Corasick automaton whose letters are word numbers, so a match is a match of whole
words and one pass over a text finds every window, overlapping ones included. Matches come
back as word positions and, on request, as character offsets into the untouched text.

A benchmark larger than one automaton may be is dealt into groups with an automaton each. A run
of documents is scanned with one after the other, and what they hit is united before it is
counted, so the groups change nothing in the result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_bytes, bound_batches, map_arrow

#: Words of lower-cased UTF-8: digits, a-z and every byte of a character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW_WORDS = 10
#: Benchmark characters in one automaton, which takes a worker about 90 bytes each; a worker holds one automaton at a time.
MAX_AUTOMATON_CHARS = 4_000_000
#: Document bytes scanned with one automaton before the next one of several is built.
RUN_BYTES = 64 << 20


class WindowAutomaton:
    """The automaton with its word numbers; built once per Python worker from the broadcast items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], list[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in WORD.findall(ascii_lower_bytes(text))]
            for start in range(max(1, len(words) - window + 1)) if words else ():
                held = owners.setdefault(tuple(words[start:start + window]), [])
                if item not in held:
                    held.append(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, held in owners.items():
            self.automaton.add_word(key, (len(key), held))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def matches(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, word after the last, item ids) of every occurrence of a window."""
        if self.empty or not words:
            return []
        find = self.numbers.get
        numbered = tuple([find(w, 0) for w in words])
        return [(end + 1 - size, end + 1, held) for end, (size, held) in self.automaton.iter(numbered)]


def hit_words(matches: list[tuple[int, int, list[str]]], n: int) -> np.ndarray:
    """Which of n words lie inside any occurrence."""
    edges = np.zeros(n + 1, np.int32)
    for start, end, _ in matches:
        edges[start] += 1
        edges[end] -= 1
    return np.cumsum(edges[:n]) > 0


def character_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as half-open character offsets into the original text."""
    raw = ascii_lower_bytes(text)
    bounds = [(m.start(), m.end()) for m in WORD.finditer(raw)]
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    spans = [(bounds[a][0], bounds[b - 1][1]) for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]
    # A byte begins a character unless it continues one.
    first = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]) if raw else np.zeros(1, np.int64)
    return [(int(first[a]), int(first[b])) for a, b in spans]


def benchmark_items(benchmark: DataFrame, max_chars: int | None = MAX_AUTOMATON_CHARS) -> list[tuple[str, str | None]]:
    """The benchmark's (id, text) pairs, refused above a bound. Rows with a null id or text have no window."""
    known = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    if max_chars is not None:
        size = known.agg(F.sum(F.length("text"))).first()[0] or 0
        if size > max_chars:
            raise ValueError(f"the benchmark has {size} characters; one automaton is bounded at {max_chars}")
    return sorted((r["item_id"], r["text"]) for r in known.collect())


def item_pieces(item: str, text: str, window: int, max_chars: int) -> Iterator[tuple[str, str]]:
    """An item as pieces that have its windows, each in one piece; only an item above the bound has several.

    A piece begins ``window - 1`` words before the end of the last one and is above the bound
    only where a single window is.
    """
    if len(text) <= max_chars:
        yield item, text
        return
    words = [w.decode("utf-8", "surrogatepass") for w in WORD.findall(ascii_lower_bytes(text))]
    start, size = 0, 0
    for end, word in enumerate(words):
        if size + len(word) + 1 > max_chars and end - start >= window:
            yield item, " ".join(words[start:end])
            start = end - window + 1
            size = sum(len(w) + 1 for w in words[start:end])
        size += len(word) + 1
    if words:
        yield item, " ".join(words[start:])


def benchmark_groups(benchmark: DataFrame, window: int = WINDOW_WORDS, max_chars: int = MAX_AUTOMATON_CHARS) -> list[list[tuple[str, str]]]:
    """The whole benchmark in groups of bounded text, one where it fits."""
    groups: list[list[tuple[str, str]]] = [[]]
    size = 0
    for item, text in benchmark_items(benchmark, None):
        for piece in item_pieces(item, text, window, max_chars):
            if groups[-1] and size + len(piece[1]) > max_chars:
                groups.append([])
                size = 0
            groups[-1].append(piece)
            size += len(piece[1])
    return groups


#: The automaton this Python worker built last, under the run and the group it belongs to.
_BUILT: dict[tuple[str, int], WindowAutomaton] = {}


def _automaton(run: str, group: int, items: list[tuple[str, str]], window: int) -> WindowAutomaton:
    if (run, group) not in _BUILT:
        _BUILT.clear()
        _BUILT[run, group] = WindowAutomaton(items, window)
    return _BUILT[run, group]


@dataclass
class Passages:
    """What was found in one text: its number of words, which of them were hit (None: none) and the items."""

    n_words: int = 0
    hit: np.ndarray | None = None
    items: set[str] = field(default_factory=set)


def _scan(automaton: WindowAutomaton, texts: list[pa.Array], found: list[list[Passages]]) -> None:
    for column, passages in zip(texts, found, strict=True):
        for value, passage in zip(column, passages, strict=True):
            words = WORD.findall(ascii_lower_bytes(value.as_py()))
            passage.n_words = len(words)
            matches = automaton.matches(words)
            if matches:
                hit = hit_words(matches, len(words))
                passage.hit = hit if passage.hit is None else passage.hit | hit
                passage.items.update(i for _, _, held in matches for i in held)


def scan_batches(
    batches: Iterator[pa.RecordBatch], column: int, run: str, groups: list[list[tuple[str, str]]], window: int,
) -> Iterator[tuple[pa.RecordBatch, list[Passages]]]:
    """Every batch with the passages of its texts; with several groups, batches are read ahead so that each automaton serves many texts."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Passages]]]:
        texts = [batch.column(column) for batch in held]
        found = [[Passages() for _ in range(batch.num_rows)] for batch in held]
        # The automaton built last goes first.
        for group in sorted(range(len(groups)), key=lambda g: (run, g) not in _BUILT):
            _scan(_automaton(run, group, groups[group], window), texts, found)
        yield from zip(held, found, strict=True)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if len(groups) == 1 or sum(b.nbytes for b in held) >= RUN_BYTES:
            yield from flush(held)
            held = []
    if held:
        yield from flush(held)


def find_benchmark_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, spans: bool = True, max_chars: int = MAX_AUTOMATON_CHARS,
) -> DataFrame:
    """One row per document: word counts, items found and the character spans of benchmark text.

    Columns: doc_id, n_words, n_hit, items (array of ids sorted as strings), spans (array of
    start, end into the original text), contaminated. A null or empty text has no words; an
    empty benchmark hits nothing; repeated rows are judged one by one; other columns are ignored.
    """
    groups, run = docs.sparkSession.sparkContext.broadcast(benchmark_groups(benchmark, window, max_chars)), uuid.uuid4().hex

    def scan(batches: Iterator) -> Iterator[dict]:
        for batch, passages in scan_batches(batches, 1, run, groups.value, window):
            out: dict[str, list] = {"doc_id": batch.column(0), "n_words": [], "n_hit": [], "items": [], "spans": [], "contaminated": []}
            for value, p in zip(batch.column(1), passages, strict=True):
                found = p.hit is not None
                out["n_words"].append(p.n_words)
                out["n_hit"].append(int(p.hit.sum()) if found else 0)
                out["items"].append(sorted(p.items))
                out["spans"].append([{"start": a, "end": b} for a, b in character_spans(value.as_py(), p.hit)] if found and spans else [])
                out["contaminated"].append(found)
            yield out

    return map_arrow(
        docs.select("doc_id", "text"), scan,
        "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: bigint, end: bigint>>, contaminated boolean",
    )


def with_digest(found: DataFrame) -> DataFrame:
    """The digest form: number of items and SHA-256 of their comma-joined ids."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, max_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """Documents without any benchmark window, untouched and with all their columns."""
    bound_batches(docs.sparkSession)
    groups, run = docs.sparkSession.sparkContext.broadcast(benchmark_groups(benchmark, window, max_chars)), uuid.uuid4().hex
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, passages in scan_batches(batches, at, run, groups.value, window):
            yield batch.filter(pa.array([p.hit is None for p in passages], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def cut_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, max_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """Documents with every passage of the benchmark cut out of their texts.

    Only the hit characters go, the rest of the text stays as it was; a document nothing was
    found in is unchanged. A document whose every word was hit goes altogether. All columns of
    ``docs`` are kept; ``n_chars``, where it exists, follows the new text.
    """
    bound_batches(docs.sparkSession)
    groups, run = docs.sparkSession.sparkContext.broadcast(benchmark_groups(benchmark, window, max_chars)), uuid.uuid4().hex
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, passages in scan_batches(batches, at, run, groups.value, window):
            texts, keep = [], []
            for value, p in zip(batch.column(at), passages, strict=True):
                text = value.as_py()
                if p.hit is not None:
                    keep.append(not p.hit.all())
                    pieces, last = [], 0
                    for a, b in character_spans(text, p.hit):
                        pieces.append(text[last:a])
                        last = b
                    text = "".join([*pieces, text[last:]])
                else:
                    keep.append(True)
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                columns[n] = pa.array([None if t is None else len(t) for t in texts]).cast(batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


