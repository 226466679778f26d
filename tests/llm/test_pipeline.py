"""The pipeline's stages against plain versions, and the registered queries."""

import re

import brute

import __spark_entry__ as entry
import corpus_pipeline
from tallystar.llm.fertility import fitted_rules

SF_DIR = "/root/testdata/sf0.001"


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_keep_what_they_should(spark, documents, tmp_path):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == documents.columns
        kept[name] = before, [(r.doc_id, r.text) for r in docs.collect()]
    before, after = kept["quality_rules"]
    rules = fitted_rules(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    verdicts = [(i, brute.quality(x)[-1], brute.fertility(x, rules)[-1]) for i, x in before]
    assert sorted(i for i, _ in after) == sorted(i for i, _, kept in verdicts if kept)
    # The method rejects junk that passes the base rules, and no good text.
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    quality = {r.doc_id: r.quality for r in labels}
    gone = [quality.get(i) for i, failed, kept in verdicts if not failed and not kept]
    assert gone.count(0) >= 5 and gone.count(1) == 0
    before, after = kept["near_duplicates"]
    found = brute.components(before, 5, 80)
    assert sorted(i for i, _ in after) == sorted({c for _, c in found})
    before, after = kept["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hits = brute.overlaps(before, items)
    assert sorted(i for i, _ in after) == sorted(i for (i, _), h in zip(before, hits) if not h[1])
    before, after = kept["personal_data"]
    assert sorted(i for i, _ in after) == sorted(i for i, _ in before)
    texts = dict(before)
    assert all(brute.personal(x) == "" for _, x in after)
    assert all(x == texts[i] for i, x in after if not brute.personal(texts[i]))


def test_run_gives_the_packed_documents(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    rows = result.collect()
    assert result.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_stages_accept_an_empty_table(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.where("doc_id < 0"), SF_DIR).count() == 0


def test_each_operator_has_one_query(spark):
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    other = ("op3_", "op11_", "op12_")  # these read other tables
    rows = {n: entry.queries()[n](spark, SF_DIR) for n in names if not n.startswith(other)}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, frame in rows.items():
        assert ids(frame.select("doc_id").distinct()) == ids(documents), name
