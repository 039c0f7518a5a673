import math

import numpy as np
import pytest

from epispan.llm import hnsw as h

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def brute(rows, every, top):
    usable = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = {}
    for i, q in usable:
        if i % every == 0:
            found = sorted((-float(v @ q), j) for j, v in usable if j != i and len(v) == len(q))[:top]
            out[i] = [(j, -s) for s, j in found]
    return out


def got(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {q: [found[k] for k in sorted(found)] for q, found in out.items()}


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.2, 5)).astype(np.float32).tolist(), "x") for i in range(150)]
    rows += [(200 + i, rows[3][1], "x") for i in range(60)] + [(301, rows[5][1], "x"), (40, rows[7][1], "x")]
    rows += [(400, None, "x"), (402, [], "x"), (404, [0.0] * 6, "x"), (406, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (408, [float("nan")] * 6, "x"), (410, [float("inf")] + [0.0] * 5, "x"), (None, rows[0][1], "x"), (412, [1.0, 2.0], "x"), (414, [-0.0, 1.0], "x")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = got(h.nearest(frame, every=2, top=8))
    want = brute(rows, 2, 8)
    for q, expected in want.items():
        if q == 40:  # an id with two vectors has the results of both
            continue
        mine = found.get(q, [])
        assert [j for j, _ in mine] == [j for j, _ in expected], q
        assert np.allclose([s for _, s in mine], [s for _, s in expected], rtol=1e-12)
    assert h.nearest(frame.limit(0)).count() == 0
    assert got(h.nearest(frame.where("vec_id in (412, 400)"), every=2)) == {}


@pytest.mark.parametrize("shard_rows", [700, 5000])
def test_recall(spark, shard_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32))
    x = (centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 32))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = got(h.search(h.build_index(frame, shard_rows=shard_rows), frame.where("vec_id % 40 = 0")))
    want = brute(rows, 40, 20)
    recall = np.mean([len({j for j, _ in found[q]} & {j for j, _ in want[q]}) / 20 for q in want])
    assert recall > 0.95
    assert all(len(found[q]) == 20 and q not in {j for j, _ in found[q]} for q in want)


def test_index_holds_every_vector_once(spark):
    frame = spark.createDataFrame([(i, [float(i % 50), 1.0], "x") for i in range(3000)], SCHEMA).repartition(7)
    index = h.build_index(frame, top=3, shard_rows=20).collect()
    assert len(index) > 1 and sum(len(r.ids) for r in index) == 50
    assert sorted(ids[0] for r in index for ids in r.ids) == list(range(50))
    assert all(ids == [ids[0] + 50 * k for k in range(4)] for r in index for ids in r.ids)


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), "x") for i in range(60)]
    rows += [(100 + i, rows[9][1], "x") for i in range(4)]
    want = brute(rows, 2, 8)
    # The query 4 twice, a candidate 30 times ahead of others with its vector.
    repeated = rows + [rows[4]] * 2 + [rows[9]] * 30
    found = got(h.nearest(spark.createDataFrame(repeated, SCHEMA).repartition(3), every=2, top=8))
    assert {q: [j for j, _ in x] for q, x in found.items()} == {q: [j for j, _ in x] for q, x in want.items()}


def test_an_id_with_many_vectors_hides_no_other(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), "x") for i in range(300)]
    rows += [(999, (np.array(rows[0][1]) * (2 + k / 100)).tolist(), "x") for k in range(40)]
    found = got(h.search(h.build_index(spark.createDataFrame(rows, SCHEMA), top=5), spark.createDataFrame(rows[:1], SCHEMA), top=5, beam=16))[0]
    others = sorted((-float(np.dot(v, rows[0][1])), i) for i, v, _ in rows[1:300])
    assert [j for j, _ in found] == [999] + [i for _, i in others[:4]]


def _probe(kind, n, size):
    rng = np.random.default_rng(n + size)
    if kind == "clustered":
        return rng.normal(size=(60, size))[rng.integers(0, 60, n)] + 0.4 * rng.normal(size=(n, size))
    x = rng.normal(size=(n, size))
    return x * rng.lognormal(0, 0.5, (n, 1)) if kind == "lengths" else x


@pytest.mark.parametrize("kind, n, size", [("clustered", 8192, 64), ("even", 8192, 64), ("lengths", 8192, 64), ("even", 8192, 256), ("even", 16384, 64)])
def test_recall_of_hard_shards(kind, n, size):
    """Vectors without clusters, of unequal lengths, of many dimensions, and more of them: the beam grows to suit."""
    import pandas as pd

    x = _probe(kind, n, size)
    (row,) = h._shard_graph(pd.DataFrame({"shard": 0, "node": np.arange(n), "v": list(x), "ids": [[i] for i in range(n)]})).to_dict("records")
    squares = np.einsum("nd,nd->n", x, x)
    lifted = np.concatenate([x, np.sqrt(np.maximum(0, squares.max() - squares))[:, None]], axis=1).astype(np.float32)
    graph = h.Graph(lifted, [np.frombuffer(b, "<i4").reshape(n, -1).astype(np.int64) for b in row["links"]], row["entry"])
    asked = np.random.default_rng(1).permutation(n)[:200]
    found, _ = h.search_graph(graph, np.concatenate([x[asked], np.zeros((200, 1))], axis=1).astype(np.float32), 21, row["beam"])
    truth = np.argsort(-(x[asked] @ x.T), axis=1)[:, :21]
    recall = np.mean([len(np.intersect1d(a, b)) / 21 for a, b in zip(found, truth, strict=True)])
    assert recall >= 0.93, (recall, row["beam"])
