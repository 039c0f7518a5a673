"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus's frequent words and their ids are compiled into a minimal acyclic automaton
(shared prefixes and shared suffixes). Numbers on the arcs add up to a word's place in the
sorted lexicon, and that place points to its ids. The automaton is one flat file which every
worker maps into memory, so the workers of a machine share its pages. A slice of texts is cut
into words, its distinct words walk the automaton together, one byte per step, and words the
lexicon lacks are merged exactly, again all words together. The lexicon decides speed only:
ids are those of the tokenizer file whatever it holds.

Supported are tokenizer files with NFC, white-space folding and lower-casing, a split
pattern whose white space is dropped, byte-level letters and merges with a word-end suffix.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epispan.session import materialize

from .common import map_arrow, mix64, text_slices
from .public_bpe import WHITE, chunks_of

#: Words the lexicon holds; the most frequent of the whole corpus.
LEXICON_WORDS = 65_536
#: Longer words are left to merging.
LEXICON_WORD_BYTES = 48
#: Words the corpus holds less often are no candidates for the lexicon.
COUNTED_FROM = 4
#: Below this many occurrences words are told apart by their exact count.
EXACT_COUNTS = 4096
#: Chunks whose forms a worker keeps from one slice to the next.
MEMO_CHUNKS = 150_000
#: Words merged in step.
MERGED_WORDS = 16_384
#: Longer words are merged with a heap, shorter ones many at a time.
TOGETHER_BYTES = 64
#: Marks that end a chunk of letters as a word of their own (an apostrophe could begin a contraction).
POINTS = frozenset(".,;:?!()\"-#$%&*")
#: Texts whose distinct words are encoded together; their forms are what a worker needs most memory for.
TOGETHER_CHARS = 5_000_000
#: Texts whose distinct words are counted together before Spark adds the counts up; a bound on a worker's memory only.
COUNTED_CHARS = 1_500_000
#: Up to here Unicode has long been settled; beyond, a character may be newer than Python's tables.
STABLE_TO = "\u052f"
_NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where visible, else the next from 256 up."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    moved = {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [chr(b) if b in visible else moved[b] for b in range(256)]


class HashTable:
    """Open addressing from 64-bit keys to a row number, looked up for whole vectors."""

    @staticmethod
    def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << max(4, int(2.5 * len(keys)).bit_length())
        slots, rows = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        at = (mix64(keys) & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            spot = at[todo]
            free = slots[spot] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(spot, return_index=True)[1]] = True
            placed = free & first
            slots[spot[placed]] = keys[todo[placed]]
            rows[spot[placed]] = todo[placed]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & (size - 1)
        return slots, rows

    @staticmethod
    def find(slots: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Row numbers, -1 where a key is missing."""
        mask = len(slots) - 1
        at = (mix64(keys) & np.uint64(mask)).astype(np.int64)
        held = slots[at]
        out = np.where(held == keys, rows[at], -1).astype(np.int64)
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & mask
            spot = at[todo]
            held = slots[spot]
            hit = held == keys[todo]
            out[todo[hit]] = rows[spot[hit]]
            todo = todo[~hit & (held >= 0)]
        return out


class TokenizerFile:
    """What a tokenizer file says: how texts are cut, the letters, the merges, the token strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        model = spec["model"]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], np.int64)
        self.keys = (pairs[:, 0] << 20) | pairs[:, 1]
        self.merged = pairs[:, 2]
        self.slots, self.rows = HashTable.build(self.keys)
        self.ranks = dict(zip(self.keys.tolist(), range(len(self.keys)), strict=True))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t.encode() for t, i in [*vocab.items(), *self.special.items()]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space is spelt out: the libraries disagree on the four separator controls.
        self.words = regex.compile(pattern.replace(r"\s", WHITE)).findall
        self.path, self.library, self.shown_parts = path, None, None
        self.byte_of = {c: b for b, c in enumerate(letters)}

    def cut_by_library(self, part: str) -> list[str]:
        """Words as the tokenizers library cuts them, for characters newer than this Python's tables."""
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        folded = self.library.normalizer.normalize_str(part)
        return [bytes(self.byte_of[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(folded)]

    def cut(self, chunk: str) -> list[str | int]:
        """A white-space-free chunk as words and, for special tokens, their ids."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            if chunk[:-1].isalpha() and chunk[-1] in POINTS:
                return [chunk[:-1].lower(), chunk[-1]]
        elif chunk.isalpha() and unicodedata.is_normalized("NFC", chunk):
            folded = chunk.replace("Σ", "σ").lower()
            if folded.isalpha():
                return [folded]
        out: list[str | int] = []
        for part in self.special_pattern.split(chunk):
            if part in self.special:
                out.append(self.special[part])
            elif part and max(part) > STABLE_TO and any(unicodedata.category(c) == "Cn" for c in part):
                out += self.cut_by_library(part)
            elif part:
                # Lower-casing letter by letter: a word-final capital sigma becomes the ordinary one.
                folded = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += self.words(folded)
        return out

    def decoded(self, ids: Iterable[int]) -> bytes:
        """The text of ids: their token strings with one blank between; unknown ids give nothing."""
        return b" ".join([self.token[i] for i in ids if i in self.token])

    def shown(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Token strings of known ids, each with a blank behind it, and where each begins (one more entry than ids)."""
        if self.shown_parts is None:
            size = max(self.token) + 1
            parts = [self.token.get(i, b"") + b" " for i in range(size)]
            lengths = np.array([len(p) for p in parts])
            self.shown_parts = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths
        letters, starts, lengths = self.shown_parts
        counts = lengths[ids]
        return letters[_runs(starts[ids], counts)].tobytes(), np.concatenate([[0], np.cumsum(counts)])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = HashTable.find(self.slots, self.rows, np.where((left < 0) | (right < 0), 0, (left << 20) | right))
        return np.where((found < 0) | (left < 0) | (right < 0), _NONE, found)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words by their merges: lowest rank first, leftmost among equals."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        sizes = np.array([len(w) for w in words])
        for i in np.flatnonzero(sizes > TOGETHER_BYTES).tolist():
            out[i] = self._merge_long(words[i])
        classes = np.where((sizes > 0) & (sizes <= TOGETHER_BYTES), np.ceil(np.log2(np.maximum(sizes, 4))), -1)
        for kind in np.unique(classes[classes >= 0]).tolist():
            members = np.flatnonzero(classes == kind)
            for start in range(0, len(members), MERGED_WORDS):
                chosen = members[start:start + MERGED_WORDS]
                ids, lengths = self._merge_together([words[i] for i in chosen.tolist()], sizes[chosen], 1 << int(kind))
                for i, row, n in zip(chosen.tolist(), ids.astype(np.int32), lengths.tolist(), strict=True):
                    out[i] = row[:n]
        return out

    def _merge_together(self, words: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        raw = np.array(words, f"S{width}").view(np.uint8).reshape(n, width)
        column = np.arange(width)
        symbols = np.where(column < sizes[:, None], self.inner[raw], -1)
        rows = np.arange(n)
        symbols[rows, sizes - 1] = self.final[raw[rows, sizes - 1]]
        symbols = np.concatenate([symbols, np.full((n, 1), -1)], axis=1)
        ranks = self._ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width)
        lengths = sizes.copy()
        done_symbols = np.full((n, width), -1, np.int64)
        live = rows
        while len(live):
            at = ranks.argmin(axis=1)
            here = np.arange(len(live))
            best = ranks[here, at]
            going = best < _NONE
            if not going.all():
                stopped = ~going
                done_symbols[live[stopped]] = symbols[stopped, :width]
                live, symbols, ranks, at, best = live[going], symbols[going], ranks[going], at[going], best[going]
                here = np.arange(len(live))
                if not len(live):
                    break
            symbols[here, at] = self.merged[best]
            # Close the gap the right-hand symbol leaves.
            source = np.minimum(np.arange(width + 1) + (np.arange(width + 1) > at[:, None]), width)
            symbols = np.take_along_axis(symbols, source, 1)
            symbols[:, width] = -1
            ranks = np.take_along_axis(ranks, np.minimum(source[:, :width], width - 1), 1)
            lengths[live] -= 1
            ranks[here, at] = self._ranks(symbols[here, at], symbols[here, at + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self._ranks(symbols[before, at[before] - 1], symbols[before, at[before]])
            ranks[:, width - 1] = _NONE
        return done_symbols, lengths

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word with a heap over a linked list, so a huge word costs n log n."""
        import heapq

        symbols = [int(self.inner[b]) for b in word]
        symbols[-1] = int(self.final[word[-1]])
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        heap = [(self.ranks[k], i, k) for i in range(len(symbols) - 1) if (k := symbols[i] << 20 | symbols[i + 1]) in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j < 0 or symbols[i] << 20 | symbols[j] != key:
                continue
            symbols[i], symbols[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (k := symbols[a] << 20 | symbols[after[a]]) in self.ranks:
                    heapq.heappush(heap, (self.ranks[k], a, k))
        return np.array([s for s in symbols if s >= 0], np.int64)


_TOKENIZERS: dict[str, TokenizerFile] = {}


def tokenizer_file(path: str) -> TokenizerFile:
    """This process's reading of a tokenizer file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TokenizerFile(path)
    return _TOKENIZERS[path]




def compile_lexicon(entries: dict[bytes, np.ndarray]) -> bytes:
    """The automaton file of words with their ids.

    Words are added in order; once a branch is finished its states are replaced by equal ones
    seen before, so no two states of the result accept the same endings.
    """
    words = sorted(entries)
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    register: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}

    def settled(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        found = register.get(key)
        if found is None:
            found = register[key] = len(states)
            states.append(key)
        return found

    # The open branch: per depth, [is a word, finished arcs, letter leading here].
    branch: list[list] = [[False, [], -1]]

    def close(depth: int) -> None:
        while len(branch) > depth + 1:
            final, arcs, letter = branch.pop()
            branch[-1][1].append((letter, settled(final, arcs)))

    previous = b""
    for word in words:
        shared = len(os.path.commonprefix([previous, word]))
        close(shared)
        branch += [[False, [], letter] for letter in word[shared:]]
        branch[-1][0] = True
        previous = word
    close(0)
    root = settled(branch[0][0], branch[0][1])

    below = [0] * len(states)
    keys, targets, adds = [], [], []
    for state, (final, arcs) in enumerate(states):  # targets are settled before their sources
        total = int(final)
        for letter, target in arcs:
            keys.append(state << 8 | letter)
            targets.append(target)
            adds.append(total)
            total += below[target]
        below[state] = total
    slots, rows = HashTable.build(np.array(keys, np.int64))
    ids = [entries[w] for w in words]
    parts = [
        slots, rows, np.array(targets, np.int32), np.array(adds, np.int32), np.array([f for f, _ in states], np.int8),
        np.cumsum([0, *map(len, ids)]).astype(np.int32), np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int32),
    ]
    padded = [p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts]
    return b"MAT1" + struct.pack("<q7q", root, *(len(p) for p in parts)) + b"\0" * 4 + b"".join(padded)


class Lexicon:
    """A compiled lexicon mapped into memory."""

    KINDS = (np.int64, np.int32, np.int32, np.int32, np.int8, np.int32, np.int32)

    def __init__(self, path: str):
        with open(path, "rb") as handle:
            head = handle.read(72)
        if head[:4] != b"MAT1":
            raise ValueError("not a lexicon file")
        self.root, *counts = struct.unpack("<q7q", head[4:68])
        at, parts = 72, []
        for kind, count in zip(self.KINDS, counts, strict=True):
            parts.append(np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind))
            at += count * np.dtype(kind).itemsize
            at += -at % 8
        self.slots, self.rows, self.targets, self.adds, self.final, self.offsets, self.ids = parts

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the sorted lexicon, -1 for a word it lacks."""
        n = len(words)
        sizes = np.array([len(w) for w in words])
        out = np.full(n, -1, np.int64)
        live = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_WORD_BYTES))
        if not len(live) or not len(self.targets):
            return out
        raw = np.array([words[i] for i in live.tolist()], f"S{LEXICON_WORD_BYTES}").view(np.uint8).reshape(len(live), -1)
        state, place = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64)
        sizes = sizes[live]
        for step in range(int(sizes.max())):
            arc = HashTable.find(self.slots, self.rows, state << 8 | raw[:, step])
            on = arc >= 0
            if not on.all():
                live, raw, place, sizes, arc = live[on], raw[on], place[on], sizes[on], arc[on]
            state = self.targets[arc].astype(np.int64)
            place = place + self.adds[arc]
            ended = sizes == step + 1
            if ended.any():
                word = ended & (self.final[state] == 1)
                out[live[word]] = place[word]
                on = ~ended
                live, raw, place, sizes, state = live[on], raw[on], place[on], sizes[on], state[on]
            if not len(live):
                break
        return out


class LexiconEncoder:
    """Encodes texts with a lexicon; keeps the forms of chunks it met more than once, up to a bound."""

    def __init__(self, tokenizer: TokenizerFile, lexicon: Lexicon | None, memo_chunks: int = MEMO_CHUNKS):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.memo: dict[str, tuple[bytes, bytes]] = {}
        self.memo_chunks = memo_chunks

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one row, and where each word's begin (one more entry than words)."""
        places = self.lexicon.places(words) if self.lexicon else np.full(len(words), -1, np.int64)
        missing = np.flatnonzero(places < 0)
        merged = self.tokenizer.merge([words[i] for i in missing.tolist()])
        counts = np.zeros(len(words), np.int64)
        counts[missing] = [len(m) for m in merged]
        known = np.flatnonzero(places >= 0)
        if len(known):
            starts = self.lexicon.offsets[places[known]].astype(np.int64)
            counts[known] = self.lexicon.offsets[places[known] + 1] - starts
        begins = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(begins[-1], np.int64)
        if len(missing):
            flat[_runs(begins[missing], counts[missing])] = np.concatenate(merged)
        if len(known):
            flat[_runs(begins[known], counts[known])] = self.lexicon.ids[_runs(starts, counts[known])]
        return flat, begins

    def _forms(self, chunks: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded text of distinct chunks."""
        plain = {c: c.lower() for c in chunks if c.isascii() and c.isalpha()}
        cut = {c: self.tokenizer.cut(c) for c in chunks if c not in plain}
        words = list({*plain.values(), *(w for parts in cut.values() for w in parts if isinstance(w, str))})
        flat, begins = self.word_ids([w.encode() for w in words])
        raw = flat.astype("<u4").tobytes()
        shown, shown_at = self.tokenizer.shown(flat)
        ends, shown_ends = (4 * begins).tolist(), shown_at[begins].tolist()
        forms: dict[str | int, tuple[bytes, bytes]] = {
            w: (raw[a:b], shown[x:y - 1]) for w, a, b, x, y in zip(words, ends, ends[1:], shown_ends, shown_ends[1:])
        }
        for token in self.tokenizer.special.values():
            forms[token] = np.array([token], "<u4").tobytes(), self.tokenizer.decoded([token])
        out = {c: forms[w] for c, w in plain.items()}
        for chunk, parts in cut.items():
            pairs = [forms[p] for p in parts]
            out[chunk] = b"".join([p[0] for p in pairs]), b" ".join([p[1] for p in pairs])
        return out

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Per text its ids as little-endian 32-bit integers and its decoded text in UTF-8.

        A chunk is looked up once: one that is not known yet stands in for its forms until they are.
        """
        known = self.memo.get
        parts = [[known(c, c) for c in chunks_of(t)] for t in texts]
        seen = Counter(p for own in parts for p in own if type(p) is str)
        found = self._forms(list(seen))
        ids, shown = [], []
        for i, own in enumerate(parts):
            pairs = [found[p] if type(p) is str else p for p in own]
            ids.append(b"".join([p[0] for p in pairs]))
            shown.append(b" ".join([p[1] for p in pairs]))
            parts[i] = []
        room = max(0, self.memo_chunks - len(self.memo))
        self.memo.update(islice(((c, found[c]) for c, n in seen.items() if n > 1), room))
        return ids, shown


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def frequent_words(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, slice_chars: int = COUNTED_CHARS) -> list[str]:
    """The corpus's most frequent words, at most ``words`` of them (a bound on what reaches the driver).

    Words are counted over the whole corpus; how many words there are of each count tells where to
    cut, so only the words chosen are sent. Of the words at the cut, those with the smallest hashes
    are taken; counts from ``EXACT_COUNTS`` on are told apart to one per cent.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut = tokenizer_file(tokenizer).cut
        for _, texts in text_slices(batches, slice_chars):
            chunks: Counter = Counter()
            for text in texts:
                chunks.update(chunks_of(text))
            counts: Counter = Counter()
            for chunk, n in chunks.items():
                for word in cut(chunk):
                    if isinstance(word, str) and len(word) <= LEXICON_WORD_BYTES:
                        counts[word] += n
            yield {"word": list(counts), "n": list(counts.values())}

    counted = map_arrow(docs.select("doc_id", "text"), count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    common = materialize(counted.where((F.col("n") >= COUNTED_FROM) & (F.octet_length("word") <= LEXICON_WORD_BYTES)), "word-counts")
    level = F.when(F.col("n") < EXACT_COUNTS, F.col("n")).otherwise(EXACT_COUNTS + F.floor(64 * F.log2(F.col("n") / EXACT_COUNTS))).cast("long")
    above, cut, share = 0, 0, 1.0
    for at, size in sorted(common.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect(), reverse=True):
        if above + size > words:
            wanted = words - above
            cut, share = at, min(1.0, (1.05 * wanted + 6 * wanted**0.5 + 20) / size)
            break
        above += size
    place = F.pmod(F.xxhash64("word"), F.lit(1 << 40))
    # A little more than the share wanted, of which the smallest hashes are kept.
    at_cut = common.where((level == cut) & (place < int(share * (1 << 40)))) if cut else common.limit(0)
    chosen = common.where(level > cut).select("word").collect()
    return [r["word"] for r in chosen + at_cut.orderBy(place, "word").limit(words - above).select("word").collect()]


def ship_lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of ``docs`` and hand its file to every executor; returns the file's name there.

    The driver's copy is only what Spark ships from: each executor gets a file of its own, and
    none reads another machine's folder.
    """
    frequent = [w.encode() for w in frequent_words(docs, tokenizer, words)]
    data = compile_lexicon(dict(zip(frequent, tokenizer_file(tokenizer).merge(frequent), strict=True)))
    name = f"lexicon-{uuid.uuid4().hex}.mat"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as handle:
        handle.write(data)
    docs.sparkSession.sparkContext.addFile(path)
    return name


_ENCODERS: dict[str, LexiconEncoder] = {}


def _encoder(tokenizer: str, lexicon: str) -> LexiconEncoder:
    """This worker's encoder; the lexicon file of another run is let go."""
    if lexicon not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[lexicon] = LexiconEncoder(tokenizer_file(tokenizer), Lexicon(SparkFiles.get(lexicon)))
    return _ENCODERS[lexicon]


def encode_documents(docs: DataFrame, tokenizer: str, with_ids: bool = True, words: int = LEXICON_WORDS) -> DataFrame:
    """Ids of every whole text, and digests of them and of the text they decode to.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256 and, on request, ids. A null text is
    empty: no ids, and the digest of nothing. Repeated rows are encoded each, an empty table
    gives an empty result, other columns are ignored.
    """
    lexicon = ship_lexicon(docs, tokenizer, words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        worker = _encoder(tokenizer, lexicon)
        for keys, texts in text_slices(batches, TOGETHER_CHARS):
            ids, shown = worker.encode(texts)
            out = {
                "doc_id": keys, "n_tokens": [len(b) // 4 for b in ids],
                "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids], "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in shown],
            }
            if with_ids:
                ends = np.cumsum([0, *(len(b) // 4 for b in ids)]).astype(np.int32)
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
            yield out

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_arrow(docs.select("doc_id", "text"), encode, schema)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the text its ``ids`` decode to; null ids decode to nothing."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            decoded = tokenizer_file(tokenizer).decoded
            yield {"doc_id": batch.column(0), "text": [decoded(v.as_py() or ()).decode() for v in batch.column(1)]}

    return map_arrow(encoded.select("doc_id", "ids"), decode, "doc_id bigint, text string")
