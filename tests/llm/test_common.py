import pyarrow as pa

from epispan.llm import common


def test_batches_are_bounded_in_bytes(spark):
    texts = spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "repeat('x', 1000000) as text")

    def sizes(batches):
        for batch in batches:
            yield {"n": [batch.num_rows]}

    found = [r.n for r in common.map_arrow(texts, sizes, "n bigint").collect()]
    assert sum(found) == 400 and max(found) <= common.BATCH_BYTES // 1_000_000 + 1


def test_narrow_ids_are_widened(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "doc_id int, text string")

    def same(batches):
        for batch in batches:
            yield {"doc_id": batch.column(0), "text": batch.column(1)}

    assert {tuple(r) for r in common.map_arrow(frame, same, "doc_id bigint, text string").collect()} == {(1, "a"), (None, "b")}


def test_slices_keep_every_row():
    batches = [pa.record_batch({"doc_id": [1, 2, None], "text": ["aaa", None, "b" * 50]}), pa.record_batch({"doc_id": [4], "text": [""]})]
    slices = list(common.text_slices(iter(batches), 10))
    assert [k for ids, _ in slices for k in ids] == [1, 2, None, 4] and [len(ids) for ids, _ in slices] == [3, 1]
