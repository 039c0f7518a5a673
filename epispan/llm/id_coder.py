"""Token-id files: an adaptive context-mixing range coder over independently reset blocks.

A segment is the unit of the file format: whole documents in order, their ids cut into blocks
of ``BLOCK_IDS``. Every block starts from the same state, has its own byte range and checksum,
and can be decoded alone. Within a block three models predict the next id:

* order 0: the segment's id frequencies (in its header), times weights of ``CELLS`` frequency
  ranges that adapt to the ids the block has shown so far;
* order 1 and 2: the id last seen after the same one or two ids, with a confidence count.

The mixture gives order 0 its whole frequency scale ``B`` and adds to a predicted id the
odds its model has earned at that confidence within the block. Ids that models agree on add
up. The sum drives a carry-propagating range coder with 16-bit output words.

All blocks of a segment advance together, one id each per step, so the arithmetic runs over
vectors as long as the number of blocks. Coder state stays below 2**53 and is held in doubles,
where every product and floored quotient used here is exact.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epispan.session import fresh_path

from .common import map_arrow, text_slices
from .public_bpe import encoder

MAGIC, VERSION = b"IDMX", 1
BLOCK_IDS = 2048
#: So many that a task's blocks mostly advance in one run of long vectors.
SEGMENT_IDS = 8_000_000
END_ID = 1
CELLS = 32
ADAPT_EVERY = 16
SLOTS = 1024
#: Distinct ids of a segment, up to which all sums of a step stay below 2**31.
MAX_DISTINCT = 1 << 20
_HEAD = struct.Struct("<4sBIQIIIIIII")
_START = np.array([2_000, 16_000, 32_000, 48_000], np.int32)
#: Mass of a predicted id in 64ths of the order-0 scale, by its learned probability in 1024ths; at most 3.5 scales.
_ODDS = np.minimum(64 * np.arange(1024) / (1024 - np.arange(1024)), 224).astype(np.int32)


@dataclass
class Prior:
    """Order-0 frequencies of a segment's distinct ids, as slots of a power of two."""

    symbols: np.ndarray
    slots: np.ndarray

    def __post_init__(self) -> None:
        self.total = int(self.slots.sum())
        self.first = np.concatenate([[0], np.cumsum(self.slots)[:-1]])
        self.cell = self.first * CELLS // self.total
        self.width = np.bincount(self.cell, self.slots, CELLS).astype(np.int64)
        self.cell_first = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        self.within = (self.first - self.cell_first[self.cell]).astype(np.int32)
        self.slots = self.slots.astype(np.int32)

    @classmethod
    def of(cls, symbols: np.ndarray, counts: np.ndarray) -> Prior:
        total = 1 << max(16, int(2 * len(symbols) - 1).bit_length())
        slots = 1 + counts.astype(np.int64) * (total - len(symbols)) // int(counts.sum())
        slots[int(np.argmax(slots))] += total - int(slots.sum())
        return cls(symbols, slots)


class Mixer:
    """The models of all blocks of a segment at one position; encoder and decoder call it alike.

    What orders 1 and 2 keep lies side by side in one array, so a step handles both at once.
    What belongs to a slot, a confidence or a cell lies side by side for all blocks: sums over cells
    run along whole vectors, and blocks that meet the same frequent contexts share cache lines.
    """

    def __init__(self, prior: Prior, lanes: int):
        self.p, self.lanes = prior, lanes
        self.lane = np.arange(lanes)
        self.row = np.arange(2 * lanes)
        self.cell_at = prior.cell * lanes
        self.factor = (64.0 * prior.total / np.maximum(prior.width, 1))[:, None]
        self.at = np.empty(2 * lanes, np.int64)
        #: Per slot the id seen last, times four, plus the confidence in it.
        self.table = np.zeros(2 * lanes * SLOTS, np.int32)
        self.weights = np.repeat(_START, 2 * lanes)
        self.seen = np.repeat(np.maximum(1.0, prior.width * 64 // prior.total), lanes).reshape(CELLS, lanes)
        self.new: list[np.ndarray] = []
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.step = 0

    def adapt(self) -> None:
        """Weigh the cells by the ids seen since the block's start."""
        n, p, seen = self.lanes, self.p, self.seen
        if self.new:
            counts = np.bincount(np.concatenate(self.new), minlength=CELLS * n).reshape(CELLS, n)
            counts *= 4
            seen += counts
            self.new = []
        share = seen / seen.sum(axis=0)
        share *= self.factor
        times = share.astype(np.int32)
        times += 1
        mass = times * p.width.astype(np.int32)[:, None]
        self.starts2 = np.zeros((CELLS, n), np.int32)
        for i in range(1, CELLS):
            np.add(self.starts2[i - 1], mass[i - 1], out=self.starts2[i])
        self.scale = self.starts2[-1] + mass[-1]
        self.starts, self.times = self.starts2.ravel(), times.ravel()
        self.sixty_fourth = np.tile(self.scale >> 6, 2)

    def predict(self) -> None:
        n = self.lanes
        if self.step % ADAPT_EVERY == 0:
            self.adapt()
        self.step += 1
        hashed = self.last * 40503
        at = self.at
        np.right_shift(hashed, 4, out=at[:n])
        hashed += self.before * 60493
        np.right_shift(hashed, 5, out=at[n:])
        at &= SLOTS - 1
        at *= 2 * n
        at += self.row
        self.entry = self.table.take(at, mode="clip")
        self.held = self.entry & 3
        self.guess = (self.entry >> 2).reshape(2, n)
        self.weight_at = self.held * np.int64(2 * n)
        self.weight_at += self.row
        self.weight = self.weights.take(self.weight_at, mode="clip")
        self.mass = (self.sixty_fourth * _ODDS.take(self.weight >> 6, mode="clip")).reshape(2, n)
        self.sum = (self.scale + self.mass[0] + self.mass[1]).astype(np.float64)

    def base(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the cells of symbols lie, and the symbols' order-0 start and size; valid until the next adaptation."""
        where = self.cell_at.take(s, mode="clip")
        where += self.lane
        times = self.times.take(where, mode="clip")
        start = self.p.within.take(s, mode="clip")
        start *= times
        start += self.starts.take(where, mode="clip")
        times *= self.p.slots.take(s, mode="clip")
        return where, start, times

    def interval(self, s: np.ndarray, base: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        self.where, start, size = base
        narrow = s.astype(np.int32)
        self.hit = (self.guess == narrow).astype(np.int32)
        before, same = (self.guess < narrow).astype(np.int32), self.mass * self.hit
        before *= self.mass
        before[0] += before[1]
        same[0] += same[1]
        return np.add(start, before[0], dtype=np.float64), np.add(size, same[0], dtype=np.float64)

    def find(self, t: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The symbols whose intervals hold t."""
        (g0, g1), (m0, m1) = self.guess, self.mass
        guess = self.guess.astype(np.int64)
        where = self.cell_at.take(guess, mode="clip")
        where += self.lane
        front = self.p.within.take(guess, mode="clip")
        front *= self.times.take(where, mode="clip")
        front += self.starts.take(where, mode="clip")
        # Masses lie in front of their symbols, behind those of smaller guesses; equal guesses' one behind the other.
        second = g1 < g0
        front[0] += m1 * second.astype(np.int32)
        front[1] += m0 * (~second).astype(np.int32)
        past = t - front
        beyond = (past >= self.mass).astype(np.int32)
        hit = (past >= 0) & (past < self.mass)
        beyond *= self.mass
        rest = t - beyond[0]
        rest -= beyond[1]
        cell = np.add.reduce((self.starts2[1:] <= rest).view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        where = cell * self.lanes
        where += self.lane
        # Both operands are far below 2**53, so the floored double quotient is the integer one.
        slot = ((rest - self.starts.take(where, mode="clip")) / self.times.take(where, mode="clip")).astype(np.int64)
        slot += self.p.cell_first.take(cell, mode="clip")
        # Where a guess hits, what is left of t is no place in the table.
        s = table.take(slot, mode="clip")
        return np.where(hit[0], g0, np.where(hit[1], g1, s)).astype(np.int64)

    def learn(self, s: np.ndarray) -> None:
        """Take in the symbols whose intervals were asked for last."""
        n = self.lanes
        hit = self.hit.ravel()
        aim = hit * 65_000
        aim -= self.weight
        aim >>= 4
        aim += self.weight
        self.weights[self.weight_at] = aim
        # A hit adds confidence, a miss takes some; the id itself is replaced where there is none left.
        state = self.held + (hit << 2)
        new = _CHANGE.take(state, mode="clip")
        new += self.entry
        fresh = np.empty(2 * n, np.int32)
        np.left_shift(s, 2, out=fresh[:n], casting="unsafe")
        fresh[n:] = fresh[:n]
        self.table[self.at] = np.where(state > 0, new, fresh)
        self.new.append(self.where)
        self.before, self.last = self.last, s


#: Change of a slot by its confidence, plus four at a hit.
_CHANGE = np.array([0, -1, -1, -1, 1, 1, 1, 0], np.int32)
_LOW, _WORD, _HIGH = 2.0**32, 2.0**16, 2.0**48


def _encode_blocks(lanes: np.ndarray, prior: Prior) -> tuple[np.ndarray, np.ndarray]:
    """Words [block, position] and the number of words of each block; ``lanes`` is [position, block]."""
    length, n = lanes.shape
    mixer = Mixer(prior, n)
    words = np.zeros((n, length * 2 + 8), np.uint32)
    flat = words.ravel()
    at = np.zeros(n, np.int64)
    low, span = np.zeros(n), np.full(n, _HIGH)
    rows = np.arange(n) * words.shape[1]
    for t in range(length):
        s = lanes[t].astype(np.int64)
        mixer.predict()
        start, size = mixer.interval(s, mixer.base(s))
        r = span
        r /= mixer.sum
        np.floor(r, out=r)
        start *= r
        low += start
        span = r * size
        idx = np.flatnonzero(span < _LOW)
        while idx.size:
            part, own, narrow = low.take(idx, mode="clip"), at.take(idx, mode="clip"), span.take(idx, mode="clip")
            top = np.floor(part / _LOW)
            flat[rows.take(idx, mode="clip") + own] = top
            top *= _LOW
            part -= top
            part *= _WORD
            narrow *= _WORD
            own += 1
            low[idx], span[idx], at[idx] = part, narrow, own
            idx = idx[narrow < _LOW]
        mixer.learn(s)
    for _ in range(3):
        top = np.floor(low / _LOW)
        flat[rows + at] = top
        low = (low - top * _LOW) * _WORD
        at += 1
    words = words[:, :int(at.max())].copy()
    # A pass moves every carry one word on; few go further.
    while (carry := words[:, 1:] >> 16).any():
        words[:, 1:] &= 0xFFFF
        words[:, :-1] += carry
    return words.astype("<u2"), at


def _decode_blocks(words: np.ndarray, length: int, prior: Prior) -> np.ndarray:
    """Symbols [position, block] from words [block, position], zero-padded at the end."""
    n = len(words)
    mixer = Mixer(prior, n)
    table = np.repeat(np.arange(len(prior.symbols), dtype=np.int32), prior.slots)
    words = np.concatenate([words, np.zeros((n, 4), words.dtype)], axis=1)
    flat, last = words.ravel(), words.shape[1] - 1
    rows = np.arange(n) * words.shape[1]
    code = words[:, 0] * _LOW + words[:, 1] * _WORD + words[:, 2]
    at = np.full(n, 3, np.int64)
    span = np.full(n, _HIGH)
    out = np.empty((length, n), np.int32)
    for t in range(length):
        mixer.predict()
        r = np.floor(span / mixer.sum)
        s = mixer.find(np.minimum(code / r, mixer.sum - 1).astype(np.int32), table)
        start, size = mixer.interval(s, mixer.base(s))
        start *= r
        code -= start
        span = r * size
        idx = np.flatnonzero(span < _LOW)
        while idx.size:
            own, narrow, part = at.take(idx, mode="clip"), span.take(idx, mode="clip"), code.take(idx, mode="clip")
            part *= _WORD
            part += flat.take(rows.take(idx, mode="clip") + np.minimum(own, last), mode="clip")
            narrow *= _WORD
            own += 1
            code[idx], span[idx], at[idx] = part, narrow, own
            idx = idx[narrow < _LOW]
        mixer.learn(s)
        out[t] = s
    return out


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, each id's place among them, and their counts; by counting where ids are small."""
    if not len(ids) or int(ids.max()) >= 1 << 22:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    places = np.zeros(len(counts), np.int32)
    places[symbols] = np.arange(len(symbols))
    return symbols, places.take(ids), counts[symbols]


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def encode_segment(ids: np.ndarray, docs: np.ndarray, lengths: np.ndarray, known: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """The bytes of one segment. ``docs`` are integer ids, ``known`` marks those that are not null."""
    symbols, dense, counts = _distinct(ids)
    if len(symbols) > MAX_DISTINCT:
        raise ValueError(f"a segment holds {len(symbols)} distinct ids; the order-0 table has room for {MAX_DISTINCT}")
    blocks = -(-len(ids) // block)
    table, payload, slots = b"", b"", b""
    if blocks:
        prior = Prior.of(symbols, counts)
        slots = _packed(prior.slots.astype("<u4"))
        size = block if blocks > 1 else len(ids)
        lanes = np.zeros(blocks * size, np.int32)
        lanes[:len(ids)] = dense
        del dense
        lanes = np.ascontiguousarray(lanes.reshape(blocks, size).T)
        words, used = _encode_blocks(lanes, prior)
        parts = [words[i, :n].tobytes() for i, n in enumerate(used.tolist())]
        raw = ids.astype("<u4", copy=False)
        sums = [(zlib.crc32(p), zlib.crc32(raw[i * block:(i + 1) * block].tobytes())) for i, p in enumerate(parts)]
        table = _packed(np.column_stack([used, np.array(sums)]).astype("<u4"))
        payload = b"".join(parts)
    symbol_part = _packed(np.diff(symbols.astype(np.int64), prepend=0).astype("<u4"))
    doc_part = _packed(np.concatenate([docs.astype("<i8"), lengths.astype("<i8"), known.astype("<i8")]))
    body = symbol_part + slots + table + doc_part
    head = _HEAD.pack(MAGIC, VERSION, block, len(ids), len(docs), len(symbol_part), len(slots), len(table), len(doc_part), blocks, zlib.crc32(body))
    return head + body + payload


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, document ids, ids of each document, and which document ids are not null."""
    magic, version, block, n, n_docs, a, b, c, d, blocks, crc = _HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token-id segment")
    body = data[_HEAD.size:_HEAD.size + a + b + c + d]
    if zlib.crc32(body) != crc:
        raise ValueError("segment header: checksum mismatch")
    read = lambda start, size, kind: np.frombuffer(zlib.decompress(body[start:start + size]), kind)
    docs, lengths, known = read(a + b + c, d, "<i8").reshape(3, n_docs)
    if not blocks:
        return np.zeros(0, "<u4"), docs, lengths, known.astype(bool)
    symbols = np.cumsum(read(0, a, "<u4").astype(np.int64))
    prior = Prior(symbols, read(a, b, "<u4").astype(np.int64))
    used, packed, plain = read(a + b, c, "<u4").reshape(blocks, 3).astype(np.int64).T
    words = np.zeros((blocks, int(used.max())), np.uint16)
    at = _HEAD.size + len(body)
    for i, count in enumerate(used.tolist()):
        part = data[at:at + 2 * count]
        if zlib.crc32(part) != packed[i]:
            raise ValueError(f"block {i}: checksum mismatch")
        words[i, :count] = np.frombuffer(part, "<u2")
        at += 2 * count
    dense = _decode_blocks(words, block if blocks > 1 else n, prior)
    ids = symbols.astype("<u4").take(dense.T.ravel()[:n])
    for i in range(blocks):
        if zlib.crc32(ids[i * block:(i + 1) * block].tobytes()) != plain[i]:
            raise ValueError(f"block {i}: decoded ids do not match their checksum")
    return ids, docs, lengths, known.astype(bool)


def _segments(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, segment_ids: int) -> Iterator[dict]:
    from pyspark import TaskContext

    file_no = TaskContext.get().partitionId()
    end = np.array([end_id], "<u4").tobytes()
    keys: list[int | None] = []
    parts: list[bytes] = []
    held, number = 0, 0

    def close() -> Iterator[dict]:
        nonlocal number
        for own_keys, own_parts in _within_table(keys, parts):
            ids = np.frombuffer(b"".join(own_parts), "<u4")
            data = encode_segment(
                ids, np.array([k or 0 for k in own_keys], np.int64), np.array([len(p) // 4 for p in own_parts], np.int64), np.array([k is not None for k in own_keys]),
            )
            yield {"file_no": [file_no], "segment_no": [number], "n_ids": [len(ids)], "data": [data]}
            number += 1

    for ids, texts in text_slices(batches):
        for key, raw in zip(ids, encoder(tokenizer).encode(texts), strict=True):
            keys.append(key)
            parts.append(raw + end)
            held += len(raw) // 4 + 1
            if held >= segment_ids:
                yield from close()
                keys, parts, held = [], [], 0
    if keys:
        yield from close()


def _within_table(keys: list, parts: list[bytes], limit: int | None = None) -> Iterator[tuple[list, list[bytes]]]:
    """The documents in one run, or in halves of it until each has no more distinct ids than a segment takes."""
    limit = limit or MAX_DISTINCT
    if len(keys) > 1 and sum(map(len, parts)) // 4 > limit and len(_distinct(np.frombuffer(b"".join(parts), "<u4"))[0]) > limit:
        middle = len(keys) // 2
        yield from _within_table(keys[:middle], parts[:middle], limit)
        yield from _within_table(keys[middle:], parts[middle:], limit)
    else:
        yield keys, parts


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and store their segments under ``path``, ascending by doc_id.

    Rows are range-partitioned by doc_id; file ``file_no`` holds one range, its segments follow
    each other by ``segment_no``. Spark's committer makes the files appear whole or not at all,
    so a lost executor costs a repeat of its ranges. A null id sorts first, a null text is
    empty (its end id alone), repeated rows are stored each; other columns are ignored.
    """
    # The text's hash is part of the range, so rows of one repeated or null id need not meet in one task.
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    map_arrow(
        ordered, lambda b: _segments(b, tokenizer, end_id, segment_ids), "file_no int, segment_no int, n_ids bigint, data binary",
    ).write.parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """Documents of stored segments: doc_id, start, n_tokens, ids (array), in no particular row order.

    ``start`` counts the ids of all documents before this one. Checksums are verified.
    """
    stored = spark.read.schema("file_no int, segment_no int, n_ids bigint, data binary").parquet(path)
    return _with_starts(stored, map_arrow(stored, lambda b: _documents(b, False), _DOC_SCHEMA + ", ids array<bigint>"), ["ids"])


def read_digests(spark, path: str) -> DataFrame:
    """As ``read_ids``, with the CRC-32 of each document's ids as little-endian 32-bit integers in place of the ids."""
    stored = spark.read.schema("file_no int, segment_no int, n_ids bigint, data binary").parquet(path)
    return _with_starts(stored, map_arrow(stored, lambda b: _documents(b, True), _DOC_SCHEMA + ", ids_crc32 bigint"), ["ids_crc32"])


_DOC_SCHEMA = "file_no int, segment_no int, doc_id bigint, offset bigint, n_tokens bigint"


def _documents(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[dict]:
    for batch in batches:
        for file_no, segment_no, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(3), strict=True):
            ids, docs, lengths, known = decode_segment(data.as_py())
            ends = np.cumsum(lengths)
            parts = [ids[b - n:b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            out = {
                "file_no": pa.array(np.full(len(docs), file_no, np.int32)), "segment_no": pa.array(np.full(len(docs), segment_no, np.int32)),
                "doc_id": pa.array(docs, mask=~known), "offset": pa.array(ends - lengths), "n_tokens": pa.array(lengths),
            }
            if digest:
                out["ids_crc32"] = [zlib.crc32(p.tobytes()) for p in parts]
            else:
                out["ids"] = [p.tolist() for p in parts]
            yield out


def _with_starts(stored: DataFrame, docs: DataFrame, kept: list[str]) -> DataFrame:
    """Add to each document the ids in earlier segments of its file and in earlier files (one row per file)."""
    sizes = stored.select("file_no", "segment_no", "n_ids")
    within = Window.partitionBy("file_no").orderBy("segment_no").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy("file_no").agg(F.sum("n_ids").alias("file_ids")).select("file_no", F.coalesce(F.sum("file_ids").over(across), F.lit(0)).alias("file_start"))
    segments = sizes.select("file_no", "segment_no", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("segment_start")).join(files, "file_no")
    return docs.join(segments, ["file_no", "segment_no"]).select(
        "doc_id", (F.col("offset") + F.col("segment_start") + F.col("file_start")).alias("start"), "n_tokens", *kept,
    )


def store_and_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents' ids below the shared folder and return what reading them back gives."""
    path = fresh_path(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer, path)
    return read_digests(docs.sparkSession, path)
