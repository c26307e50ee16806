"""Landing passes are all-or-nothing, keys are plain file names, streaming equals batch."""

import json
import shutil
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tellstar.functions.jsonx import array_length_or_zero, ground_truth_text, parsed
from tellstar.functions.scalars import usd_per_mtok
from tellstar.operators import landing as ld
from tellstar.session import workspace_dir
from tellstar.sources import fs, tables
from tellstar.sources import landing_files as lf
from tellstar.sources.tables import latest_version, read_table, write_snapshot
from tellstar.streaming.landing_stream import land_arrived, pending_path

from .fixtures import NEW, OLD, answer, manifest


def put(root, batch, run, records=(("q1", 1.0),), text=None, **kw):
    folder = Path(root) / batch
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{run}.manifest.json").write_text(text or json.dumps(manifest(run, "vector", **kw)))
    if records is not None:
        (folder / f"{run}.jsonl").write_text("".join(json.dumps(answer(q, "vector", score=s)) + "\n" for q, s in records))


def state(spark, raw):
    answers = sorted((r.run_id, r.question_id, json.loads(r.payload)["score"]) for r in ld.read_raw(spark, raw, "scored_answer").collect())
    return answers, sorted(r.run_id for r in ld.read_raw(spark, raw, "run_manifest").collect())


def fail(*a, **k):
    raise OSError("stopped")


#: Where a pass is stopped, and whether its commit has taken effect by then.
STEPS = {"answers": False, "guard": False, "snapshot": False, "check": False, "draft": False, "rename": False, "after rename": True, "age": True, "delete": True}


def stop_at(monkeypatch, step):
    from pyspark.sql.readwriter import DataFrameWriter

    if step in ("answers", "snapshot"):
        real, part = DataFrameWriter.parquet, "landing_pass=" if step == "answers" else "/run_manifest/data-"
        monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: fail() if part in path else real(self, path, *a, **k))
    elif step == "check":
        real_guard = ld.pk_guard
        monkeypatch.setattr(ld, "pk_guard", lambda keys, name: fail if name == "run_manifest" else real_guard(keys, name))
    elif step == "draft":
        monkeypatch.setattr(fs, "write_text", fail)
    elif step == "rename":
        monkeypatch.setattr(fs, "rename_new", fail)
    elif step == "after rename":
        real_rename = fs.rename_new
        monkeypatch.setattr(fs, "rename_new", lambda *a: (real_rename(*a), fail()))
    elif step == "age":
        monkeypatch.setattr(fs, "age_seconds", fail)
    elif step == "delete":
        monkeypatch.setattr(tables, "KEEP_SECONDS", -1)
        monkeypatch.setattr(fs, "delete", fail)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Two runs, landed three times (so that there are versions to clean up)."""
    base = tmp_path_factory.mktemp("landed")
    put(base / "land", NEW, "r1")
    put(base / "land", NEW, "r2", records=(("q1", 0.5), ("q2", 0.25)))
    for _ in range(3):
        ld.land_runs(spark, str(base / "land"), str(base / "raw"))
    return base


@pytest.mark.parametrize("step", STEPS)
def test_a_pass_stopped_anywhere_leaves_old_or_new_rows_whole(spark, landed, tmp_path, monkeypatch, step):
    shutil.copytree(landed, tmp_path / "own")
    root, raw = str(tmp_path / "own" / "land"), str(tmp_path / "own" / "raw")
    before = [("r1", "q1", 1.0), ("r2", "q1", 0.5), ("r2", "q2", 0.25)], ["r1", "r2"]
    put(root, NEW, "r1", records=(("q9", 0.0),) if step != "guard" else (("q9", 0.0), ("q9", 0.0)))
    after = [("r1", "q9", 0.0), ("r2", "q1", 0.5), ("r2", "q2", 0.25)], ["r1", "r2"]
    stop_at(monkeypatch, step)
    if STEPS[step]:
        assert ld.land_runs(spark, root, raw) == {"runs": 2, "records": 3}
    else:
        with pytest.raises((OSError, ld.LoadError)):
            ld.land_runs(spark, root, raw)
    monkeypatch.undo()
    assert state(spark, raw) == (after if STEPS[step] else before)
    if step not in ("rename", "after rename"):
        return
    put(root, NEW, "r1", records=(("q9", 0.0),))
    assert ld.land_runs(spark, root, raw) == {"runs": 2, "records": 3}
    assert state(spark, raw) == after
    ld.vacuum_answers(spark, raw)
    ld.vacuum_answers(spark, raw, older_than=0)
    assert state(spark, raw) == after


def test_a_commit_that_cannot_be_told_deletes_nothing(spark, tmp_path, monkeypatch):
    root, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    put(root, NEW, "r1")
    ld.land_runs(spark, root, raw)
    put(root, NEW, "r1", records=(("q9", 0.0),))
    real, real_exists = fs.rename_new, fs.exists
    monkeypatch.setattr(fs, "rename_new", lambda *a: (real(*a), monkeypatch.setattr(fs, "exists", fail), fail()))
    with pytest.raises(tables.CommitUnknown):
        ld.land_runs(spark, root, raw)
    monkeypatch.setattr(fs, "exists", real_exists)
    assert state(spark, raw) == ([("r1", "q9", 0.0)], ["r1"])


def meanwhile(monkeypatch, act):
    """Lets ``act`` run once, just before the next commit."""
    real, acts = tables.publish, [act]

    def publish(*a):
        if acts:
            acts.pop()()
        real(*a)

    monkeypatch.setattr(tables, "publish", publish)


def test_two_passes_from_one_version_both_land(spark, tmp_path, monkeypatch):
    root, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    put(root, NEW, "r0")
    ld.land_runs(spark, root, raw)
    put(root, NEW, "r1", records=(("a", 1.0), ("b", 1.0)))
    put(root, OLD, "r3", records=(("old", 0.0),))
    put(root, NEW, "r2", records=(("c", 0.5),))
    put(root, NEW, "r3", records=(("new", 0.5),))
    theirs = F.expr(f"run_id = 'r2' or (run_id = 'r3' and batch = '{NEW}')")
    found = lf.scan_manifests(spark, root)
    meanwhile(monkeypatch, lambda: ld.land_runs(spark, root, raw, manifests=found.where(theirs)))
    # r3 is landed from a newer batch by the other pass, so this one lands r0 and r1
    assert ld.land_runs(spark, root, raw, manifests=found.where(~theirs)) == {"runs": 2, "records": 3}
    assert state(spark, raw) == ([("r0", "q1", 1.0), ("r1", "a", 1.0), ("r1", "b", 1.0), ("r2", "c", 0.5), ("r3", "new", 0.5)], ["r0", "r1", "r2", "r3"])


def test_two_upserts_from_one_version_both_land(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def put_rows(*rows):
        return ld.upsert(spark, spark.createDataFrame(list(rows), "k string, v int"), path, "k", "t")

    put_rows(("a", 1), ("x", 1))
    meanwhile(monkeypatch, lambda: put_rows(("b", 2), ("x", 2)))
    assert put_rows(("c", 3), ("x", 3)) == 2
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [("a", 1), ("b", 2), ("c", 3), ("x", 3)]


def test_of_two_writers_one_raises(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(3)
    write_snapshot(rows, path)
    base = latest_version(spark, path)
    write_snapshot(rows.limit(2), path, base=base)
    for old in (base, 0):
        with pytest.raises(tables.Conflict):
            write_snapshot(rows.limit(1), path, base=old)
    assert read_table(spark, path).count() == 2
    assert len(list((tmp_path / "t").glob("data-*"))) == 2
    assert fs.create_exclusive(spark, f"{path}/x") and not fs.create_exclusive(spark, f"{path}/x")


def test_old_versions_and_unnamed_folders_go_when_they_are_old(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        write_snapshot(spark.range(n), path)
    (tmp_path / "t" / ("data-" + "0" * 32)).mkdir()
    assert len(tables.versions(spark, path)) == 4
    monkeypatch.setattr(tables, "KEEP_SECONDS", -1)
    tables.expire(spark, path)
    assert [e.version for e in tables.versions(spark, path)] == [3, 4]
    assert len(list((tmp_path / "t").glob("data-*"))) == 2
    with pytest.raises(tables.Conflict):  # a name that is free again is no way back
        write_snapshot(spark.range(9), path, base=0)
    assert read_table(spark, path).count() == 4


def test_checks_read_the_answers_that_are_live(spark, tree, tmp_path):
    """Answers landed after the last build are tested too."""
    from tellstar.plans import declared_checks as dc
    from tellstar.plans.marts import build_star

    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    ld.land_all(spark, tree, raw)
    build_star(spark, raw, marts)
    assert "_int" in str(dc.relations(spark, raw, marts)["stg_traversal"].inputFiles())
    failed = lambda: {(r.check, r.relation, r.column): r.failures for r in dc.run_declared_checks(spark, raw, marts).where("failures > 0").collect()}
    before = failed()
    put(tree, NEW, "r9-late")
    path = Path(tree) / NEW / "r9-late.jsonl"
    path.write_text(path.read_text().replace('"vector"', '"unheard of"'))
    ld.land_runs(spark, tree, raw)
    now = failed()
    assert now[("accepted_values", "stg_scored_answers", "retriever")] == before.get(("accepted_values", "stg_scored_answers", "retriever"), 0) + 1


def test_names_with_blanks_percent_and_plus_below_a_reference_folder(spark, tmp_path):
    root, raw = str(tmp_path / "reference" / "a b+c"), str(tmp_path / "raw")
    for run in ("run a", "r%20b", "p+q", "plain"):
        put(root, "batch 1+%41", run)
    prices = Path(root) / "reference" / "pricing"
    prices.mkdir(parents=True)
    (prices / "ven dor+%.json").write_text('{"meta": {}, "models": {}}')
    (prices.parent / "full x-1.json").write_text('{"corpus_build_id": "full x-1"}')
    assert ld.land_runs(spark, root, raw) == {"runs": 4, "records": 4}
    assert state(spark, raw)[1] == ["p+q", "plain", "r%20b", "run a"]
    assert {r.batch for r in lf.scan_manifests(spark, root).collect()} == {"batch 1+%41"}
    assert ld.missing_records(spark, root).count() == 0
    assert [r.provider for r in lf.scan_pricing(spark, root).collect()] == ["ven dor+%"]
    assert [r.corpus_build_id for r in lf.scan_corpus_profiles(spark, root).collect()] == ["full x-1"]
    uri = lf.scan_manifests(spark, root).select(lf.relative_uri("source_uri", root).alias("u")).collect()
    assert "batch 1+%41/r%20b.manifest.json" in {r.u for r in uri}


@pytest.mark.parametrize("batch,run", [(NEW, "_hidden"), (NEW, ".dot"), ("_batch", "r1")])
def test_names_that_spark_skips_are_refused(spark, tmp_path, batch, run):
    root = str(tmp_path / "land")
    put(root, NEW, "r0")
    put(root, batch, run)
    with pytest.raises(ValueError):
        ld.land_runs(spark, root, str(tmp_path / "raw"))


def arrived(spark, root, *names):
    rows = lf.scan_manifests(spark, root)
    return rows.where(rows.run_id.isin(*names))


def test_streaming_rules(spark, tmp_path):
    root, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    put(root, NEW, "r1", records=(("new", 1.0),))
    land_arrived(spark, root, raw, arrived(spark, root, "r1"))
    put(root, OLD, "r1", records=(("old", 0.0),))
    late = arrived(spark, root, "r1").where(f"batch = '{OLD}'")
    land_arrived(spark, root, raw, late)
    assert state(spark, raw)[0] == [("r1", "new", 1.0)]
    # a manifest before its records waits, and is landed by a later start
    put(root, NEW, "r2", records=None)
    land_arrived(spark, root, raw, arrived(spark, root, "r2"), "skip")
    assert state(spark, raw)[1] == ["r1"] and read_table(spark, pending_path(raw)).count() == 1
    put(root, NEW, "r2", records=(("q1", 0.5),))
    land_arrived(spark, root, raw, None, "skip")
    assert state(spark, raw)[1] == ["r1", "r2"] and read_table(spark, pending_path(raw)).count() == 0
    put(root, NEW, "r3", text='{"run_id": "r3", oops')
    with pytest.raises(Exception):
        land_arrived(spark, root, raw, arrived(spark, root, "r3"))
    assert state(spark, raw)[1] == ["r1", "r2"]


@pytest.mark.parametrize("line", ['{"question_id": "q2"} tail', "{'question_id': 'q3'}", '{"question_id": "a"},{"question_id": "b"}', "[1", ""])
def test_text_that_is_not_one_json_document_is_refused(spark, line):
    rows = spark.createDataFrame([(line,)], "payload string")
    with pytest.raises(Exception):
        ld.valid_json(rows).collect()
    with pytest.raises(Exception):
        rows.select(ld._question_id("payload").alias("q")).collect()


def test_ground_truth_numbers_keep_their_text(spark):
    cases = {'3.10': "3.10", '1e5': "100000", '1.50e-3': "0.00150", '-2.5E+1': "-25", '1234567.0': "1234567.0", '[1, 2.50, "x", null]': "1, 2.50, x",
             '["1e5", 1e5]': "1e5, 100000", '[{"a":1.50,"b":[1,2]}]': '{"a": 1.50, "b": [1, 2]}', '{"k":"a,b: c","n":1.0}': '{"k": "a,b: c", "n": 1.0}', 'true': "true", '"1e5"': "1e5"}
    rows = spark.createDataFrame([(f'{{"g": {x}}}',) for x in cases], "payload string")
    got = [r.t for r in rows.select(ground_truth_text(parsed("payload"), "g").alias("t")).collect()]
    assert got == list(cases.values())


def test_array_length_refuses_other_values(spark):
    rows = spark.createDataFrame([('{"s": "abc"}',)], "payload string")
    with pytest.raises(Exception):
        rows.select(array_length_or_zero(parsed("payload"), "s").alias("n")).collect()


def test_no_machine_local_scratch_on_a_cluster(spark):
    def session(master, conf=None):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k, d=None: conf or d), setCheckpointDir=lambda p: None)
        return SimpleNamespace(sparkContext=sc)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            workspace_dir(session(master))
    assert workspace_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert workspace_dir(spark)


def test_prices_are_exact_or_refused(spark):
    rows = spark.createDataFrame([("1.25E-4",), ("0.0008",), ("0",), (None,)], "p string")
    assert [str(r.r) for r in rows.select(usd_per_mtok(rows.p).alias("r")).collect()] == ["1.250000", "8.000000", "0.000000", "None"]
    for bad in ("0.00000000012345", "1e-13"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "p string").select(usd_per_mtok(F.col("p")).alias("r")).collect()
