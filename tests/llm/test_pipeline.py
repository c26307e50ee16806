import corpus_pipeline
from tellstar.llm import simhash, toxicity

from .test_decontaminate import brute as contaminated
from .test_simhash import brute_classes, brute_fp
from .test_substring import brute as repeats
from .test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    docs = read("documents")
    own = {r.doc_id: r.text for r in docs.collect()}
    verdict = {r.doc_id: r.predicted for r in toxicity.scores(docs, read("labels")).collect()}

    stage = dict(corpus_pipeline.STAGES)
    kept = stage["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert rows == {d: t for d, t in own.items() if not verdict[d]}

    kept = stage["simhash_near_dedup"](spark, kept, SF)
    assert kept.schema == docs.schema
    ids = sorted(rows)
    root = brute_classes([brute_fp(rows[d]) for d in ids])
    rows = {d: rows[d] for i, d in enumerate(ids) if root[i] == i}
    assert {r.doc_id: r.text for r in kept.collect()} == rows

    kept = stage["substring_dedup"](spark, kept, SF)
    assert kept.schema == docs.schema
    want = {}
    for (d, n, lost, _, gone), text in zip(repeats(sorted(rows.items())), [rows[d] for d in sorted(rows)]):
        if lost < n or not lost:
            want[d] = [w for i, w in enumerate((text or "").encode().split()) if i not in gone]
    found = {r.doc_id: r for r in kept.collect()}
    assert {d: r.text.encode().split() for d, r in found.items()} == want
    assert all(r.text == rows[d] and r.n_chars for d, r in found.items() if len(want[d]) == len(rows[d].encode().split()))
    rows = {d: r.text for d, r in found.items()}

    kept = stage["benchmark_decontamination"](spark, kept, SF)
    assert kept.schema == docs.schema
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    rows = {r[0]: rows[r[0]] for r in contaminated(sorted(rows.items()), items) if not r[5]}
    assert {r.doc_id: r.text for r in kept.collect()} == rows
    assert len(rows) < len(own)

    assert check_pieces(corpus_pipeline.run(spark, SF).collect(), sorted(rows.items())) < 0.01


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF) if "text" in docs.columns else docs
    assert docs.count() == 0


def test_near_dedup_keeps_the_smallest(spark):
    docs = spark.createDataFrame([(5, "a b c d e f g"), (3, "a b c d e f g"), (9, "z y x w v u")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [3, 9]
