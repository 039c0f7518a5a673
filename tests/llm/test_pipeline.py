import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from epispan.llm import langid, pu_quality
from epispan.session import table
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash_links import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_a_brute_force_version(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    net, model = pu_quality.fit(docs, labels), None
    kept = [r for r in docs.collect() if net.score(np.array([pu_quality.text_features(r.text)]))[0] >= 0.5]
    model = langid.fit(spark.createDataFrame(kept, docs.schema))
    kept = [r for r in kept for lang, _ in [model.predict(r.text)] if lang != "und"]
    roots = brute_components({r.doc_id: brute_print(r.text) for r in kept})
    kept = [r for r in kept if roots[r.doc_id] == r.doc_id]
    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    hits = brute([(r.doc_id, r.text) for r in kept], items, 10)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: whole.encode(r.text, add_special_tokens=False).ids for r in kept if not hits[r.doc_id][1]}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 50 < len(want) < 200


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table(spark, SF, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "simhash_near_dedup"


ODD = [
    (None, None, None, None, None, None), (1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "12 !!", "en", None, 5, 1),
    (4, "alpha beta gamma delta. Epsilon zeta eta theta iota kappa.", "en", "s", 3, 1), (4, "alpha beta gamma delta. Epsilon zeta eta theta iota kappa.", "en", "s", 3, 1),
    (5, "alpha beta gamma delta. Epsilon zeta eta theta iota kappa.", None, "s", 3, 2), (None, "lambda mu nu xi omicron pi rho", "en", "s", 3, 2),
    (6, "sigma tau upsilon phi chi psi omega " * 20_000, "en", "s", 3, 2), (7, "one two three four five six seven eight nine ten eleven", "en", "s", 3, 2),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp int"


def _tables(spark, folder, documents):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "zero one two three four five six seven eight nine ten"), (2, None), (None, "x"), (1, "zero")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(4, 1, 0), (4, 0, 0), (7, 1, None), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_odd_rows_pass_through_every_stage(spark, tmp_path):
    folder = _tables(spark, tmp_path, spark.createDataFrame(ODD, SCHEMA).repartition(4))
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns and set(map(repr, kept.collect())) <= set(map(repr, docs.collect()))
    deduplicated = sorted(r.doc_id or -1 for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect())
    assert deduplicated == [-1, -1, 1, 3, 4, 6, 7]
    assert 7 not in {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, folder).collect()}
    assert corpus_pipeline.token_ids(spark, docs, folder).count() == len(ODD)
    assert 4 in {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}


def test_empty_tables(spark, tmp_path):
    folder = _tables(spark, tmp_path, spark.createDataFrame([], SCHEMA))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_nothing_to_learn_rejects_nothing(spark, tmp_path):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("lang", F.lit(None).cast("string"))
    folder = _tables(spark, tmp_path, docs)
    labels = table(spark, folder, "labels")
    assert pu_quality.keep_good(docs, labels.limit(0)).count() == len(ODD)
    assert sorted(r.doc_id or -1 for r in langid.keep_identified(docs).collect()) == [-1, 4, 4, 5, 6, 7]
