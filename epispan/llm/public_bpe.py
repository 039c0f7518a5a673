"""Whole texts through a public tokenizer file with the tokenizers library, distinct chunks once.

The tokenizer drops white space and never joins across it, so a text's ids are the ids of its
white-space-separated chunks in order. Each worker keeps the ids of the words and
chunks it met, up to a bound; others are encoded once for each slice of texts they occur in.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks and words whose ids a worker keeps.
MEMO_CHUNKS = 600_000
#: Marks whose runs are words of their own beside letters (an apostrophe could begin a contraction).
_MARKS = ".,;:?!()\"-#$%&*"
MARKS = frozenset(_MARKS)
#: Letters, as a regular expression's class, that make words: none changes or joins under NFC, and each has one lower-case
#: letter whatever stands beside it (Latin, Greek without the sigma, Cyrillic, kana, Han, Hangul syllables).
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0386\u0388-\u038a\u038c\u038e-\u03a1\u03a4-\u03ce\u0400-\u0481\u048a-\u052f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
#: Simple words encoded in one call.
JOINED_WORDS = 512
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Unicode white space; str.split() also splits at the four separators above, the tokenizer does not.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = re.compile(f"[{WHITE}]+")


def chunks_of(text: str | None) -> list[str]:
    """White-space-separated chunks of a text; a null text has none."""
    if not text:
        return []
    return text.split() if not _SEPARATORS.search(text) else [c for c in _WHITE.split(text) if c]


class ChunkEncoder:
    """Ids of texts by the tokenizers library, as little-endian unsigned 32-bit integers.

    What was encoded before lies in one array of ids; ``place`` tells a word's or a chunk's entry.
    """

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ends = [i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[ends] = True
        #: A special token's text: the library cuts it out of a text before all else, so what stands on its sides is encoded alone.
        plain = (t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special and not (t[1].normalized or t[1].single_word or t[1].lstrip or t[1].rstrip))
        self.between_id, token = next(plain, (-1, None))
        self.between = token.content if token else ""
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, "<u4")
        self.ends = np.zeros(2, np.int64)
        self.memo_chunks = memo_chunks

    def _ids_of(self, words: list[str], others: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of words of letters, cut at word ends, then of other chunks, cut at an added token between them; and each one's number of ids."""
        parts, lengths = [np.zeros(0, "<u4")], []
        runs = [words[i:i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        for run, encoded in zip(runs, self.tokenizer.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(run):
                raise ValueError("the tokenizer cut a word of letters in two")
            parts.append(ids)
            lengths += np.diff(ends, prepend=0).tolist()
        runs = [others[i:i + JOINED_WORDS] for i in range(0, len(others), JOINED_WORDS)]
        joined = [self.between.join(r) for r in runs] if self.between else [""] * len(runs)
        for run, encoded in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, "<u4")
            cuts = np.flatnonzero(ids == self.between_id)
            if self.between and len(cuts) == len(run) - 1:
                parts.append(np.delete(ids, cuts))
                lengths += (np.diff(cuts, prepend=-1, append=len(ids)) - 1).tolist()
                continue
            # A chunk of this run holds the token itself.
            for alone in self.tokenizer.encode_batch_fast(run, add_special_tokens=False):
                parts.append(np.array(alone.ids, "<u4"))
                lengths.append(len(alone.ids))
        return np.concatenate(parts), lengths

    def _encode(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and where each one's begin and the last one's end.

        A word of letters, alone or among marks, has the ids of the marks before it, of its lower-case form and of the marks behind it.
        """
        ahead = pc.utf8_rtrim(chunks, _MARKS)
        body = pc.utf8_ltrim(ahead, _MARKS)
        simple = pc.match_substring_regex(body, f"^[{LETTERS}]+$")
        words = pc.utf8_lower(body.filter(simple)).dictionary_encode()
        simple = simple.to_numpy(zero_copy_only=False)
        size, size_ahead, size_body = (pc.binary_length(x).to_numpy() for x in (chunks, ahead, body))
        before, behind = np.flatnonzero(simple & (size_ahead > size_body)), np.flatnonzero(simple & (size > size_ahead))
        heads = pa.array([c[:n] for c, n in zip(_listed(chunks.take(pa.array(before))), (size_ahead - size_body)[before].tolist(), strict=True)], pa.string())
        tails = pa.array([c[-n:] for c, n in zip(_listed(chunks.take(pa.array(behind))), (size - size_ahead)[behind].tolist(), strict=True)], pa.string())
        marks = pa.concat_arrays([heads, tails]).dictionary_encode()
        keys, others = _listed(words.dictionary), _listed(chunks.filter(pa.array(~simple)))
        wanted = keys + others + _listed(marks.dictionary)
        places = np.fromiter(map(self.place.get, wanted, repeat(-1)), np.int64, len(wanted))
        late = np.flatnonzero(places < 0)
        new, cut = [wanted[i] for i in late.tolist()], int(np.searchsorted(late, len(keys)))
        found, lengths = self._ids_of(new[:cut], new[cut:])
        # Entry 0 has no ids.
        first = len(self.ends) - 1
        places[late] = np.arange(first, first + len(new))
        flat, ends = np.concatenate([self.flat, found]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths, dtype=np.int64)])
        if kept := min(len(new), max(0, self.memo_chunks - first)):
            self.place.update(zip(new[:kept], range(first, first + kept), strict=True))
            self.ends = ends[:first + kept + 1].copy()
            self.flat = flat[:self.ends[-1]].copy()
        entry = np.zeros((len(chunks), 3), np.int64)
        entry[simple, 1] = places[:len(keys)].take(words.indices.to_numpy())
        entry[~simple, 1] = places[len(keys):len(keys) + len(others)]
        of_marks = places[len(keys) + len(others):].take(marks.indices.to_numpy())
        entry[before, 0], entry[behind, 2] = of_marks[:len(before)], of_marks[len(before):]
        entry = entry.ravel()
        ids, after = _gathered(flat, ends.take(entry), np.diff(ends).take(entry))
        return ids, after[::3]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Texts are split and their chunks made distinct by Arrow; each distinct chunk's ids are looked up once a call."""
        column = pa.array([t or "" for t in texts], pa.large_string())
        if pc.any(pc.match_substring_regex(column, _SEPARATORS.pattern)).as_py():
            chunks = pc.split_pattern_regex(column, _WHITE.pattern)
        else:
            chunks = pc.utf8_split_whitespace(column)
        # An empty text, or white space at either end, gives an empty chunk, which has no ids.
        distinct = chunks.flatten().dictionary_encode()
        ids, ends = self._encode(distinct.dictionary)
        which = distinct.indices.to_numpy()
        ids, after = _gathered(ids, ends.take(which), np.diff(ends).take(which))
        raw, cuts = ids.tobytes(), (after.take(chunks.offsets.to_numpy() - chunks.offsets[0].as_py()) * 4).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an array one after the other, and where each begins and the last one ends."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    where = np.arange(ends[-1])
    where += np.repeat(starts - ends[:-1], lengths)
    return flat.take(where), ends


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
