"""Language-model scoring: a Katz backoff model of any order from two up over the whole corpus.

P(w | h) is the Good-Turing discounted share of w after the history h where both were seen in
training, else the backoff weight of h times P(w | h without its first word); P(w) is the
discounted share of w, and what the discounts free belongs to one unknown word. Weights make
every distribution sum to exactly one: alpha(h) = (1 - sum of discounted shares) / (1 - sum of
the next lower P over the words seen after h). A history none of whose counts is discounted gets
one count more in its total, so it can still back off; one that was never seen is passed over. A
text's first word follows a start mark that is itself never predicted and ends every history.

The corpus passes as chunks of a bounded number of tokens. A chunk asks for each of its distinct
words and word sequences once; keys are 64-bit hashes, dealt to buckets by their upper bits. A
bucket adds up the training counts, keeps them as its part of the model table and answers every
chunk in the order it asked. So a key as frequent as a third of all tokens costs one entry a
chunk, and nothing but per-order counts of counts reaches the driver. The chunk that asked
first for a sequence is its owner and contributes it to the sums behind alpha, which go through
buckets of histories the same way. A word seen after h was seen after the shorter history too,
so its lower P is a discounted count over one total per history: one round of sums serves all
orders. Chunks then score their tokens, backing off recursively.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epispan.session import fresh_path, materialize

from .common import ascii_lower_bytes, map_arrow, mix64

CHUNK_TOKENS = 1 << 20
#: Chunks whose keys a bucket holds between them (about a million keys each).
CHUNKS_PER_BUCKET = 3
DISCOUNTED_TO = 5
ADDED = 0.1
_START_KEY = np.uint64(0x51A7E0F7E47B0051)
_END_KEY = np.uint64(0xE4D0F7E47E4D0F01)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_MESSAGE = "kind string, bucket int, chunk bigint, payload binary, stats array<bigint>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: byte planes, compressed, so small or slowly changing numbers take little."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T) if len(a) else np.zeros(0, np.uint8)
        body = zstandard.compress(planes.tobytes(), 1)
        out.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(body)) + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n, size = struct.unpack_from("<2sqq", data, at)
        at += 18
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(zstandard.decompress(data[at:at + size]), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel() if n else np.zeros(0, dtype))
        at += size
    return out


def deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def undelta(steps: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(steps, dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted keys pass from one bucket to the next."""
    lowest = [(b << 64) // buckets + (1 if (b << 64) % buckets else 0) for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(lowest, np.uint64)), [len(keys)]]).astype(np.int64)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(before * _PAIR + mix64(word))


def _message(kind: str, bucket: int = -1, chunk: int = -1, payload: bytes = b"", stats: list[int] | None = None) -> dict:
    return {"kind": kind, "bucket": bucket, "chunk": chunk, "payload": payload, "stats": stats}


def _columns(rows: list[dict]) -> dict[str, list]:
    return {name: [r[name] for r in rows] for name in ("kind", "bucket", "chunk", "payload", "stats")}


# ---- chunks ----------------------------------------------------------------------------------

def chunk_documents(docs: DataFrame) -> DataFrame:
    """Token chunks of ``docs`` (doc_id, text, train, held_out): one row per chunk.

    The payload holds document ids, whether they are known, train and held-out marks, token
    counts, the word keys of the chunk (most frequent first) and every token's word number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        words: list[bytes] = []
        rows: list[tuple] = []

        def close() -> dict:
            numbers, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
            keys = np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)
            sizes = np.array([n for *_, n in rows])
            # An end after each document; it is the word with number len(distinct).
            tokens = np.insert(numbers, np.cumsum(sizes), len(distinct))
            keys = np.append(keys, _END_KEY)
            order = np.argsort(-np.bincount(tokens, minlength=len(keys)), kind="stable")
            place = np.empty(len(keys), np.int64)
            place[order] = np.arange(len(keys))
            ids, train, held = (np.array(c) for c in list(zip(*rows, strict=True))[:3])
            known = np.array([i is not None for i in ids.tolist()])
            payload = pack(
                np.array([i or 0 for i in ids.tolist()], np.int64), known.astype(np.int8), train.astype(np.int8), held.astype(np.int8),
                (sizes + 1).astype(np.int64), keys[order], place[tokens].astype(np.uint32),
            )
            return {"chunk": [part << 24 | number], "payload": [payload]}

        for batch in batches:
            for doc, text, train, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own = ascii_lower_bytes(text.as_py()).split()
                words += own
                rows.append((doc, train, held, len(own)))
                if len(words) + len(rows) >= CHUNK_TOKENS:
                    yield close()
                    words, rows, number = [], [], number + 1
        if rows:
            yield close()

    return map_arrow(docs.select("doc_id", "text", "train", "held_out"), run, "chunk bigint, payload binary")


class Chunk:
    """A chunk's tokens with the sorted distinct keys of its words and of its sequences of two words and more.

    ``keys[k]`` are those of k words, ``of[k]`` the number of the one each token ends (-1 where the
    text is too short for it), ``histories[k]`` the numbers of their first k - 1 words among the
    sequences a word shorter, ``lower[k]`` those of their last k - 1 words.
    """

    def __init__(self, payload: bytes, order: int = 2):
        self.ids, known, train, held, self.lengths, self.words, tokens = unpack(payload)
        self.known, self.train, self.held = known == 1, train == 1, held == 1
        self.tokens = tokens.astype(np.int64)
        ends = np.cumsum(self.lengths)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        # The start mark is one more word, known as a context only.
        self.contexts = np.append(self.words, _START_KEY)
        self.before = np.concatenate([[len(self.words)], self.tokens[:-1]])
        self.before[(ends - self.lengths)] = len(self.words)
        self.token_train = self.train[self.doc]
        self.context_order = np.argsort(self.contexts)
        sequence = pair_keys(self.contexts[self.before], self.words[self.tokens])
        self.keys, first, of = np.unique(sequence, return_index=True, return_inverse=True)
        self.keys, self.of = {2: self.keys}, {2: of}
        self.histories, self.lower = {2: self.before[first]}, {2: self.tokens[first]}
        place = np.arange(len(self.tokens)) - np.repeat(ends - self.lengths, self.lengths)
        for k in range(3, order + 1):
            at = np.flatnonzero(place >= k - 2)
            longer = np.zeros(len(sequence), np.uint64)
            longer[at] = pair_keys(sequence[at - 1], self.words[self.tokens[at]])
            self.keys[k], first, of = np.unique(longer[at], return_index=True, return_inverse=True)
            self.histories[k], self.lower[k] = self.of[k - 1][at[first] - 1], self.of[k - 1][at[first]]
            self.of[k] = np.full(len(sequence), -1)
            self.of[k][at] = of
            sequence = longer

    def word_counts(self) -> np.ndarray:
        """Training occurrences of each context key, in sorted key order; the start mark counts documents."""
        counts = np.bincount(self.tokens[self.token_train], minlength=len(self.contexts))
        counts[-1] = self.train.sum()
        return counts[self.context_order]

    def counts(self, k: int) -> np.ndarray:
        """Training occurrences of each sequence of k words."""
        of = self.of[k][self.token_train]
        return np.bincount(of[of >= 0], minlength=len(self.keys[k]))


def ask_counts(chunks: DataFrame, buckets: int, order: int) -> DataFrame:
    """What each chunk asks each bucket: its keys there, if any, with its own training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk = Chunk(payload.as_py(), order)
                asked = [(chunk.contexts[chunk.context_order], chunk.word_counts()), *((chunk.keys[k], chunk.counts(k)) for k in range(2, order + 1))]
                dealt = [(keys, n.astype(np.uint32), bucket_cuts(keys, buckets)) for keys, n in asked]
                yield _columns([
                    _message("ask", b, number, pack(*(part for keys, n, cuts in dealt for part in (deltas(keys[cuts[b]:cuts[b + 1]]), n[cuts[b]:cuts[b + 1]]))))
                    for b in range(buckets) if any(cuts[b] < cuts[b + 1] for *_, cuts in dealt)
                ])

    return map_arrow(chunks, run, _MESSAGE)


# ---- counts ----------------------------------------------------------------------------------

def _added(parts: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys, sums of each value over them, every asked key's number, and who asked first."""
    keys, first, number = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
    owner = np.zeros(len(number), bool)
    owner[first] = True
    return keys, [np.bincount(number, np.concatenate(v), len(keys)) for v in values], number, owner


def _count_bucket(asked: pd.DataFrame) -> pd.DataFrame:
    asked = asked.sort_values("chunk")
    parts = [unpack(p) for p in asked["payload"]]
    bucket = int(asked["bucket"].iloc[0])
    out, answers, model = [], [[] for _ in parts], []
    for order in range(1, len(parts[0]) // 2 + 1):
        steps, counts = [p[2 * order - 2] for p in parts], [p[2 * order - 1] for p in parts]
        keys, (total,), number, owner = _added([undelta(s) for s in steps], [counts])
        total = total.astype(np.int64)
        seen = total > 0
        predicted = total[seen & (keys != _START_KEY)] if order == 1 else total[seen]
        repeats = np.bincount(np.minimum(predicted, DISCOUNTED_TO + 2), minlength=DISCOUNTED_TO + 3)
        out.append(_message("stats", bucket, order, stats=[int(predicted.sum()), len(predicted), *repeats[1:DISCOUNTED_TO + 2].tolist()]))
        model += [deltas(keys[seen]), total[seen]]
        cuts = np.cumsum([0, *map(len, steps)])
        for answer, a, b in zip(answers, cuts[:-1], cuts[1:], strict=True):
            answer += [total[number[a:b]]] if order == 1 else [total[number[a:b]], owner[a:b].astype(np.int8)]
    out.append(_message("model", bucket, payload=pack(*model)))
    out += [_message("answer", bucket, int(chunk), pack(*answer)) for chunk, answer in zip(asked["chunk"], answers, strict=True)]
    return pd.DataFrame(out)


class Discounts:
    """Good-Turing discounts of one order from its counts of counts.

    Counts up to ``DISCOUNTED_TO`` shrink by Katz's formula; where the counts of counts are
    too sparse for it to lie between zero and one, by a constant taken off each count.
    """

    def __init__(self, total: int, kinds: int, repeats: list[int]):
        self.total, self.kinds = total, kinds
        n = [0, *repeats]
        k = DISCOUNTED_TO
        self.d = np.ones(k + 2)
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
        constant = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
        for r in range(1, k + 1):
            value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
            self.d[r] = value if 0 < value < 1 else 1 - constant / r
        self.freed = float(sum((1 - self.d[r]) * r * n[r] for r in range(1, k + 1)))

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * self.d[np.minimum(counts, DISCOUNTED_TO + 1)]


class Unigrams:
    def __init__(self, discounts: Discounts):
        self.discounts = discounts
        freed = discounts.freed or 1.0
        self.size = discounts.total + (0 if discounts.freed else 1)
        self.unknown = freed / self.size

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.kept(counts) / self.size, self.unknown)


# ---- scores ----------------------------------------------------------------------------------

def _score_chunk(discounts: dict[int, tuple], buckets: int):
    """The first pass over a chunk with its counts: all but the totals and backoff weights that other chunks bear on."""
    order = max(discounts)

    def run(key: tuple, chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(chunks):
            return pd.DataFrame([], columns=["kind", "bucket", "chunk", "payload", "stats"])
        by_order = {k: Discounts(*d) for k, d in discounts.items()}
        one, uni = by_order[1], Unigrams(by_order[1])
        chunk = Chunk(chunks["payload"].iloc[0], order)
        got = [unpack(p) for p in answers.sort_values("bucket")["payload"]]
        sorted_counts, *asked = (np.concatenate([g[i] for g in got]) for i in range(2 * order - 1))
        history_total = np.empty(len(chunk.contexts), np.int64)
        history_total[chunk.context_order] = sorted_counts
        word_count = history_total[:-1]
        # Of the sequences one word shorter: their part of the sum behind alpha, and of the score.
        mass = uni.p(word_count)
        value = np.log10(mass)
        values, waits, seen, sums, totals = {}, {}, {}, {}, {}
        for k in range(2, order + 1):
            count, owner = asked[2 * k - 4], asked[2 * k - 3]
            history, lower, n = chunk.histories[k], chunk.lower[k], len(history_total)
            seen[k] = count > 0
            kept = by_order[k].kept(count)
            freed = np.where(seen[k], count - kept, 0.0)
            own = seen[k] & (owner == 1)
            sums[k] = np.bincount(history[own], freed[own], n), np.bincount(history[own], mass[lower[own]], n)
            # What the score needs no weight for: the discounted count, or the part of the shorter sequence.
            total = history_total[history]
            sure = np.zeros(n, bool)
            sure[history[freed > 0]] = True
            sure = sure[history]
            value = np.where(seen[k], np.log10(np.maximum(kept, 1e-300)), value[lower])
            value -= np.where(seen[k] & sure, np.log10(np.maximum(total, 1)), 0.0)
            # What waits for a history's sums: backing off (2), or dividing by a total that may be one larger (1).
            waits[k] = np.where(~seen[k] & (total > 0), 2, np.where(seen[k] & ~sure, 1, 0)).astype(np.int8)
            values[k], totals[k] = value, history_total
            history_total, mass = count, kept

        of_token = values[2][chunk.of[2]]
        for k in range(3, order + 1):
            long = np.flatnonzero(chunk.of[k] >= 0)
            of_token[long] = values[k][chunk.of[k][long]]
        score = np.bincount(chunk.doc, of_token, len(chunk.lengths))
        base = np.log10((word_count + ADDED) / (one.total + ADDED * (one.kinds + 1)))
        base_score = np.bincount(chunk.doc, base[chunk.tokens], len(chunk.lengths))
        n_known = np.bincount(chunk.doc, word_count[chunk.tokens] > 0, len(chunk.lengths)).astype(np.int64)

        # Tokens pass from the longest sequence they end to shorter ones until one was seen.
        waiting, wanted = {}, {k: np.zeros(len(totals[k]), bool) for k in totals}
        open_tokens = np.arange(len(chunk.tokens))
        for k in range(order, 1, -1):
            here = open_tokens[chunk.of[k][open_tokens] >= 0]
            kind = waits[k][chunk.of[k][here]]
            late = np.flatnonzero(kind)
            n = np.int64(len(totals[k]))
            key_of = (chunk.doc[here[late]] * n + chunk.histories[k][chunk.of[k][here[late]]]) * 2 + (kind[late] - 1)
            key_of, times = np.unique(key_of, return_counts=True)
            history, kind = (key_of // 2) % n, (key_of % 2).astype(np.int8)
            wanted[k][history] = True
            # A longer history's weight takes in the total of the shorter one.
            shorter = chunk.lower[k - 1][history] if k > 2 else None
            if k > 2:
                wanted[k - 1][shorter[kind == 1]] = True
            waiting[k] = key_of // (2 * n), history, kind, times, shorter
            if k > 2:
                done = np.zeros(len(chunk.tokens), bool)
                done[here] = seen[k][chunk.of[k][here]]
                open_tokens = open_tokens[~done[open_tokens]]

        number = int(key[0])
        ready = [chunk.ids, chunk.known.astype(np.int8), chunk.held.astype(np.int8), chunk.lengths, n_known, base_score, score]
        dealt, rank = [], {}
        for k in range(2, order + 1):
            key_order = chunk.context_order if k == 2 else np.arange(len(totals[k]))
            history_keys = chunk.contexts if k == 2 else chunk.keys[k - 1]
            freed_sum, mass_sum = sums[k]
            sent = key_order[((freed_sum + mass_sum > 0) | wanted[k])[key_order]]
            keys = history_keys[sent]
            dealt.append((k, sent, keys, bucket_cuts(keys, buckets)))
            rank[k] = np.full(len(totals[k]), -1, np.int64)
            rank[k][sent[wanted[k][sent]]] = np.arange(int(wanted[k].sum()))
            doc, history, kind, times, shorter = waiting[k]
            ready += [doc, rank[k][history], kind, times] + ([] if k == 2 else [np.where(kind == 1, rank[k - 1][shorter], 0)])
        rows = [_message("docs", -1, number, pack(*ready))]
        for b in range(buckets):
            if any(cuts[b] < cuts[b + 1] for *_, cuts in dealt):
                parts = []
                for k, sent, keys, cuts in dealt:
                    at = sent[cuts[b]:cuts[b + 1]]
                    parts += [deltas(keys[cuts[b]:cuts[b + 1]]), sums[k][0][at], sums[k][1][at], np.where(wanted[k][at], totals[k][at], 0), wanted[k][at].astype(np.int8)]
                rows.append(_message("ask", b, number, pack(*parts)))
        return pd.DataFrame(rows)

    return run


def _weights(order: int, freed: np.ndarray, mass: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """What a chunk is told of histories: logarithms of weight and total; of longer ones the share left over, the total and the mass its weight needs."""
    size = count + (freed == 0)
    share = np.where(freed == 0, 1.0, freed) / size
    return [np.log10(share / (1 - mass)), np.log10(size)] if order == 2 else [np.log10(share), np.log10(size), mass]


def _weigh_bucket(asked: pd.DataFrame) -> pd.DataFrame:
    """Sums of each history over all chunks, its total and backoff weight, and the answers."""
    asked = asked.sort_values("chunk")
    bucket = int(asked["bucket"].iloc[0])
    parts = [unpack(p) for p in asked["payload"]]
    model, answers = [], [[] for _ in parts]
    for order in range(2, len(parts[0]) // 5 + 2):
        own = [p[5 * order - 10:5 * order - 5] for p in parts]
        keys, (freed, mass), number, _ = _added([undelta(p[0]) for p in own], [[p[1] for p in own], [p[2] for p in own]])
        count = np.zeros(len(keys), np.int64)
        np.maximum.at(count, number, np.concatenate([p[3] for p in own]))
        model += [deltas(keys), freed, mass]
        cuts = np.cumsum([0, *(len(p[0]) for p in own)])
        for answer, part, a, b in zip(answers, own, cuts[:-1], cuts[1:], strict=True):
            at = number[a:b][part[4] == 1]
            answer += _weights(order, freed[at], mass[at], count[at])
    out = [_message("model", bucket, payload=pack(*model))]
    return pd.DataFrame(out + [_message("answer", bucket, int(chunk), pack(*answer)) for chunk, answer in zip(asked["chunk"], answers, strict=True)])


def _finish_chunk(train_tokens: int, order: int):
    def run(_: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame([], columns=columns)
        ids, known, held, lengths, n_known, base, score, *waiting = unpack(docs["payload"].iloc[0])
        got = [unpack(p) for p in answers.sort_values("bucket")["payload"]]
        told = [np.concatenate([g[i] for g in got]) if got else np.zeros(0) for i in range(3 * order - 4)]
        score = score.copy()
        for k in range(2, order + 1):
            doc, history, kind, times, *shorter = waiting[:4] if k == 2 else waiting[5 * k - 11:5 * k - 6]
            if len(doc):
                weight, size = told[:2] if k == 2 else told[3 * k - 7:3 * k - 5]
                weight = weight[history]
                if k > 2:
                    below = told[1] if k == 3 else told[3 * k - 9]
                    weight = weight - np.log10(1 - np.where(kind == 1, told[3 * k - 5][history], 0.0) / 10 ** below[shorter[0]]) if len(below) else weight
                score += np.bincount(doc, np.where(kind == 1, weight, -size[history]) * times, len(ids))
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64").copy() if known.all() else pd.array([i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)], "Int64"),
            "held_out": held == 1, "n_tokens": lengths, "n_known": n_known, "train_tokens": train_tokens, "base_score": base, "score": score,
        })

    return run


def _stored(messages: DataFrame, path: str) -> DataFrame:
    """Write messages partitioned by kind (the model tables are the kind "model") and read them back."""
    messages.write.partitionBy("kind").parquet(path)
    return messages.sparkSession.read.schema(_MESSAGE).parquet(path)


_SUMMARY = "level int, total bigint, kinds bigint, repeats array<bigint>, buckets int"
_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _chunks(docs: DataFrame) -> DataFrame:
    marked = docs.select("doc_id", "text", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("train", "held_out")])
    return materialize(chunk_documents(marked), "token-chunks")


def _learn(chunks: DataFrame, folder: str, order: int) -> tuple[DataFrame, DataFrame, dict[int, tuple]]:
    """Write the model of the chunks' training rows into ``folder``: counts, backoff weights and a summary.

    Returns the messages of the chunks scored so far, those of the weights, and the counts of
    counts of each order.
    """
    if order < 2:
        raise ValueError("a model that backs off has order two or more")
    spark = chunks.sparkSession
    buckets = max(12, -(-chunks.count() * (order - 1) // CHUNKS_PER_BUCKET))
    counted = _stored(ask_counts(chunks, buckets, order).groupBy("bucket").applyInPandas(_count_bucket, _MESSAGE), f"{folder}/counts")
    totals = counted.where("kind = 'stats'").select(F.col("chunk").alias("level"), F.posexplode("stats")).groupBy("level", "pos").agg(F.sum("col").alias("n")).collect()
    found = {(r["level"], r["pos"]): r["n"] for r in totals}
    discounts = {k: (found.get((k, 0), 0), found.get((k, 1), 0), [found.get((k, 2 + r), 0) for r in range(DISCOUNTED_TO + 1)]) for k in range(1, order + 1)}
    answers = counted.where("kind = 'answer'").groupBy("chunk")
    scored = _stored(chunks.groupBy("chunk").cogroup(answers).applyInPandas(_score_chunk(discounts, buckets), _MESSAGE), fresh_path(spark, "chunk-scores"))
    weighed = _stored(scored.where("kind = 'ask'").groupBy("bucket").applyInPandas(_weigh_bucket, _MESSAGE), f"{folder}/weights")
    # The summary is written last: a folder without one holds no finished model.
    spark.createDataFrame([(k, *discounts[k], buckets) for k in discounts], _SUMMARY).coalesce(1).write.parquet(f"{folder}/summary")
    return scored, weighed, discounts


def _finished(scored: DataFrame, weighed: DataFrame, discounts: dict[int, tuple]) -> DataFrame:
    docs, answers = scored.where("kind = 'docs'").groupBy("chunk"), weighed.where("kind = 'answer'").groupBy("chunk")
    return docs.cogroup(answers).applyInPandas(_finish_chunk(discounts[1][0], max(discounts)), _SCORES)


def score_documents(docs: DataFrame, order: int = 2) -> DataFrame:
    """Score ``docs`` (doc_id, text, train, held_out) with a model of ``order`` learnt from its train rows.

    Words are runs free of blanks and of the controls 9 to 13, A-Z lower-cased; each text ends
    with an end mark, counted as a token. Columns: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (log10 of the text's probability). A null text is empty and
    has its end alone, repeated rows count and are scored each, null marks count as false. With
    no training row everything is the unknown word, of probability one. A text is never cut, so
    one above ``CHUNK_TOKENS`` makes a chunk of its own length.
    """
    scored, weighed, discounts = _learn(_chunks(docs), fresh_path(docs.sparkSession, "katz-model"), order)
    return _finished(scored, weighed, discounts)


# ---- stored models -----------------------------------------------------------------------------

def train_model(docs: DataFrame, folder: str, order: int = 2) -> str:
    """Learn a model of ``order`` from every row of ``docs`` (text) and keep it in ``folder``, which must not exist yet.

    Null texts are empty ones, repeated rows count each. ``score_with_model`` reads the folder,
    from any session that reaches it.
    """
    rows = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit(True).alias("train"), F.lit(False).alias("held_out"))
    _learn(_chunks(rows), folder, order)
    return folder


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key stands in sorted keys, and whether it is there (elsewhere the place means nothing)."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at, there = _found(keys, wanted)
    return np.where(there, values[at], 0) if len(keys) else np.zeros(len(wanted), values.dtype)


def _answer_counts(_: tuple, asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Counts of the words and sequences that chunks ask a stored bucket for; nobody owns a sequence here."""
    # The model's part of a bucket is in key order, as the counting left it.
    table = unpack(model["payload"].iloc[0]) if len(model) else []
    keys = [undelta(t) for t in table[::2]]
    out = []
    for bucket, chunk, payload in zip(asked["bucket"], asked["chunk"], asked["payload"], strict=True):
        answer = []
        for i, steps in enumerate(unpack(payload)[::2]):
            count = _looked_up(keys[i], table[2 * i + 1], undelta(steps)).astype(np.int64) if table else np.zeros(len(steps), np.int64)
            answer += [count] if i == 0 else [count, np.zeros(len(steps), np.int8)]
        out.append(_message("answer", int(bucket), int(chunk), pack(*answer)))
    return pd.DataFrame(out, columns=["kind", "bucket", "chunk", "payload", "stats"])


def _answer_weights(_: tuple, asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Backoff weights and totals of the histories that chunks wait for, from a stored bucket."""
    table = unpack(model["payload"].iloc[0]) if len(model) else []
    keys = [undelta(t) for t in table[::3]]
    out = []
    for bucket, chunk, payload in zip(asked["bucket"], asked["chunk"], asked["payload"], strict=True):
        parts, answer = unpack(payload), []
        for i in range(len(parts) // 5):
            steps, _, _, count, waits = parts[5 * i:5 * i + 5]
            wanted = undelta(steps)[waits == 1]
            sums = [_looked_up(keys[i], table[3 * i + j], wanted) if table else np.zeros(len(wanted)) for j in (1, 2)]
            answer += _weights(i + 2, *sums, count[waits == 1])
        out.append(_message("answer", int(bucket), int(chunk), pack(*answer)))
    return pd.DataFrame(out, columns=["kind", "bucket", "chunk", "payload", "stats"])


def _answered(asked: DataFrame, model: DataFrame, shares: int, answer) -> DataFrame:
    """Answers of a stored table; a bucket asked by many chunks is copied, and each copy serves a share of them."""
    copies = model.where("kind = 'model'").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    dealt = asked.withColumn("share", (F.pmod(F.xxhash64("chunk"), F.lit(shares))).cast("int"))
    return dealt.groupBy("bucket", "share").cogroup(copies.groupBy("bucket", "share")).applyInPandas(answer, _MESSAGE)


def score_with_model(docs: DataFrame, folder: str) -> DataFrame:
    """Score ``docs`` (doc_id, text) with the model that ``train_model`` left in ``folder``.

    The columns, and what counts as a word, are those of ``score_documents``; held_out is true
    throughout and train_tokens the model's. Only the buckets that hold a word or a sequence
    of ``docs`` are read into tasks, each as often as the texts to score outgrow those learnt from.
    """
    spark = docs.sparkSession
    summary = spark.read.schema(_SUMMARY).parquet(f"{folder}/summary").collect()
    discounts = {r["level"]: (r["total"], r["kinds"], list(r["repeats"])) for r in summary}
    buckets = summary[0]["buckets"]
    counts, weights = (spark.read.schema(_MESSAGE).parquet(f"{folder}/{name}") for name in ("counts", "weights"))
    chunks = _chunks(docs.select("doc_id", "text", F.lit(False).alias("train"), F.lit(True).alias("held_out")))
    shares = max(1, -(-chunks.count() // (CHUNKS_PER_BUCKET * buckets)))
    answers = _stored(_answered(ask_counts(chunks, buckets, max(discounts)), counts, shares, _answer_counts), fresh_path(spark, "model-counts"))
    scored = _stored(
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_score_chunk(discounts, buckets), _MESSAGE),
        fresh_path(spark, "chunk-scores"),
    )
    weighed = _stored(_answered(scored.where("kind = 'ask'"), weights, shares, _answer_weights), fresh_path(spark, "model-weights"))
    return _finished(scored, weighed, discounts)


def score_held_out(docs: DataFrame, folds: int = 10, fold: int = 0, order: int = 2) -> DataFrame:
    """Learn from the rows outside one fold of crc32(doc_id as text) and score all; a null id is in no fold and not learnt from."""
    remainder = F.crc32(F.col("doc_id").cast("string")) % folds
    return score_documents(docs.select("doc_id", "text", (remainder != fold).alias("train"), (remainder == fold).alias("held_out")), order)
