import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellstar.operators import landing as ld

from .fixtures import NEW, answer


def test_land_all_counts_and_sibling_records(spark, tree, raw_dir):
    counts = ld.land_all(spark, tree, raw_dir)
    assert counts == {"runs": 3, "records": 7, "questions": 4, "corpus_profiles": 2, "pricing_snapshots": 1}
    sa = ld.read_raw(spark, raw_dir, "scored_answer")
    # records of r1 come from the winning (new) batch only; provenance is the manifest's URI
    r1 = sa.where(F.col("run_id") == "r1-vector").collect()
    assert sorted(r.question_id for r in r1) == ["q1", "q2", "q3"]
    assert all(r.source_uri.endswith(f"{NEW}/r1-vector.manifest.json") for r in r1)


def test_second_pass_is_idempotent(spark, tree, raw_dir):
    first = ld.land_all(spark, tree, raw_dir)
    second = ld.land_all(spark, tree, raw_dir)
    assert first == second
    for t, n in (("run_manifest", 3), ("scored_answer", 7), ("question", 4), ("corpus_profile", 2),
                 ("model_pricing", 1)):
        assert ld.read_raw(spark, raw_dir, t).count() == n


def test_replace_by_run_keeps_absent_runs_and_clears_emptied_runs(spark, tree, raw_dir):
    ld.land_all(spark, tree, raw_dir)
    root = Path(tree)
    # r2 now has no records; r3 is no longer in the source at all
    (root / NEW / "r2-sparql.jsonl").write_text("\n")
    for f in (root / NEW).glob("r3-closed.*"):
        f.unlink()
    ld.land_all(spark, tree, raw_dir)
    sa = ld.read_raw(spark, raw_dir, "scored_answer")
    per_run = {r.run_id: r["count"] for r in sa.groupBy("run_id").count().collect()}
    assert per_run == {"r1-vector": 3, "r3-closed": 2}
    assert ld.read_raw(spark, raw_dir, "run_manifest").count() == 3


def test_duplicate_question_refuses_the_pass_and_changes_nothing(spark, tree, raw_dir):
    ld.land_all(spark, tree, raw_dir)
    p = Path(tree) / NEW / "r2-sparql.jsonl"
    p.write_text(p.read_text() + json.dumps(answer("q1", "graph_sparqlgen")) + "\n")
    with pytest.raises(ld.LoadError):
        ld.land_runs(spark, tree, raw_dir)
    sa = ld.read_raw(spark, raw_dir, "scored_answer")
    assert sa.where(F.col("run_id") == "r2-sparql").count() == 2


def test_missing_records_file_raises_or_skips(spark, tree, raw_dir):
    (Path(tree) / NEW / "r2-sparql.jsonl").unlink()
    missing = ld.missing_records(spark, tree).collect()
    assert [r.run_id for r in missing] == ["r2-sparql"]
    with pytest.raises(ld.LoadError):
        ld.land_runs(spark, tree, raw_dir)
    counts = ld.land_runs(spark, tree, raw_dir, on_missing_records="skip")
    assert counts["runs"] == 2


def test_a_records_file_without_bytes_is_there(spark, tree, raw_dir):
    ld.land_all(spark, tree, raw_dir)
    (Path(tree) / NEW / "r2-sparql.jsonl").write_bytes(b"")
    assert ld.missing_records(spark, tree).count() == 0
    assert ld.land_runs(spark, tree, raw_dir) == {"runs": 3, "records": 5}
    (Path(tree) / NEW / "r3-closed.jsonl").unlink()
    assert [r.run_id for r in ld.missing_records(spark, tree).collect()] == ["r3-closed"]


def test_upsert_replaces_same_key(spark, tree, raw_dir):
    ld.land_all(spark, tree, raw_dir)
    p = Path(tree) / "reference" / "smoke-cc22dd33.json"
    doc = json.loads(p.read_text())
    doc["scale"] = "smoke-v2"
    p.write_text(json.dumps(doc))
    ld.land_corpus_profiles(spark, tree, raw_dir)
    prof = ld.read_raw(spark, raw_dir, "corpus_profile")
    assert prof.count() == 2
    payload = prof.where(F.col("corpus_build_id") == "smoke-cc22dd33").first().payload
    assert json.loads(payload)["scale"] == "smoke-v2"


def test_streaming_landing_matches_batch_landing(spark, tree, tmp_path):
    from tellstar.streaming.landing_stream import start_landing_stream

    raw_s = str(tmp_path / "raw_stream")
    q = start_landing_stream(spark, tree, raw_s, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    sa = ld.read_raw(spark, raw_s, "scored_answer")
    assert sa.count() == 7
    assert ld.read_raw(spark, raw_s, "run_manifest").count() == 3
    # a new run arriving later is landed by the next trigger, earlier runs are untouched
    root = Path(tree)
    (root / "20260603T000000Z").mkdir()
    src = (root / NEW / "r2-sparql.manifest.json").read_text().replace("r2-sparql", "r4-new")
    (root / "20260603T000000Z" / "r4-new.manifest.json").write_text(src)
    (root / "20260603T000000Z" / "r4-new.jsonl").write_text(json.dumps(answer("q1", "graph_sparqlgen")) + "\n")
    q = start_landing_stream(spark, tree, raw_s, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    per_run = {r.run_id: r["count"] for r in ld.read_raw(spark, raw_s, "scored_answer").groupBy("run_id").count().collect()}
    assert per_run == {"r1-vector": 3, "r2-sparql": 2, "r3-closed": 2, "r4-new": 1}


def test_bucketed_layout_equals_run_layout_and_keeps_replace_semantics(spark, tree, tmp_path):
    by_run, by_bucket = str(tmp_path / "raw_run"), str(tmp_path / "raw_bucket")
    ld.land_all(spark, tree, by_run)
    ld.land_all(spark, tree, by_bucket, buckets=4)
    a = ld.read_raw(spark, by_run, "scored_answer").drop("loaded_at")
    b = ld.read_raw(spark, by_bucket, "scored_answer").drop("loaded_at")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    files = list((tmp_path / "raw_bucket" / "scored_answer").glob("landing_pass=*/*.parquet"))
    assert 0 < len(files) <= 4
    # re-pass with r2 emptied and r3 gone from the source: r2 cleared, r3 kept, r1 replaced
    root = Path(tree)
    (root / NEW / "r2-sparql.jsonl").write_text("\n")
    for f in (root / NEW).glob("r3-closed.*"):
        f.unlink()
    counts = ld.land_runs(spark, tree, by_bucket, buckets=4)
    assert counts == {"runs": 2, "records": 3}
    per_run = {r.run_id: r["count"] for r in ld.read_raw(spark, by_bucket, "scored_answer").groupBy("run_id").count().collect()}
    assert per_run == {"r1-vector": 3, "r3-closed": 2}
    again = ld.land_runs(spark, tree, by_bucket, buckets=4)
    assert again == counts
    assert ld.land_runs(spark, tree, by_run, buckets=4) == counts  # a layout holds for one pass only


def test_malformed_documents_fail_the_load(spark, tree, tmp_path):
    (Path(tree) / NEW / "r2-sparql.manifest.json").write_text('{"run_id": "r2-sparql", oops')
    with pytest.raises(Exception):
        ld.land_runs(spark, tree, str(tmp_path / "raw1"))
    (Path(tree) / "reference" / "broken-0000.json").write_text("not json")
    with pytest.raises(Exception):
        ld.land_corpus_profiles(spark, tree, str(tmp_path / "raw2"))
