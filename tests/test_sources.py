from pyspark.sql import functions as F

from tellstar.functions.jsonx import jtext, parsed
from tellstar.operators import landing as ld
from tellstar.operators.ordinality import line_numbers
from tellstar.sources import landing_files as lf
from tellstar.sources.seeds import read_seed

from .fixtures import NEW, OLD, write_tree


def test_scan_manifests_keys_batches_and_reference_exclusion(spark, tree):
    m = lf.scan_manifests(spark, tree)
    rows = sorted((r.run_id, r.batch) for r in m.collect())
    assert rows == [("r1-vector", OLD), ("r1-vector", NEW), ("r2-sparql", NEW), ("r3-closed", NEW)]


def test_dedupe_newest_batch_wins(spark, tree):
    d = lf.dedupe_run_batches(lf.scan_manifests(spark, tree))
    got = {r.run_id: (r.batch, r.hv) for r in d.select("run_id", "batch", jtext(parsed("payload"), "harness_version")
                                                         .alias("hv")).collect()}
    assert got["r1-vector"] == (NEW, "harness-v2")
    assert len(got) == 3


def test_record_lines_skip_blanks_and_number_records(spark, tree):
    r = lf.scan_record_lines(spark, tree).where(F.col("batch") == NEW)
    got = sorted((x.run_id, x.line_no, x.q) for x in r.select("run_id", "line_no", jtext(parsed("payload"),
                                                                                             "question_id").alias("q")).collect())
    assert got[:3] == [("r1-vector", 0, "q1"), ("r1-vector", 1, "q2"), ("r1-vector", 2, "q3")]
    assert len(got) == 7


def test_line_numbers_across_many_splits(spark, tmp_path):
    """A file split into many byte ranges still numbers every line by its file position."""
    p = tmp_path / "big.jsonl"
    lines = []
    for i in range(3000):
        lines.append(f'{{"i": {i}}}')
        if i % 7 == 0:
            lines.append("   ")
    p.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = spark.read.text(str(p)).select(
            F.col("value"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
        assert df.select("b").distinct().count() > 5
        df = df.where(F.trim("value") != "")
        out = line_numbers(df, "f", "b").select(F.get_json_object("value", "$.i").cast("int").alias("i"), "line_no")
        rows = out.collect()
        assert len(rows) == 3000
        assert all(r.i == r.line_no for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_questions_profiles_pricing(spark, tree, tmp_path):
    assert lf.scan_questions(spark, tree).count() == 4
    assert sorted(r.corpus_build_id for r in lf.scan_corpus_profiles(spark, tree).collect()) == [
        "full-aa00bb11", "smoke-cc22dd33"]
    assert [r.provider for r in lf.scan_pricing(spark, tree).collect()] == ["anthropic"]
    bare = write_tree(tmp_path / "noq", with_questions=False)
    assert lf.scan_questions(spark, str(bare)).count() == 0


def test_seeds_have_pinned_types(spark):
    r = read_seed(spark, "seed_retriever_labels")
    assert dict(r.dtypes)["is_graph"] == "boolean" and dict(r.dtypes)["sort_order"] == "int"
    assert r.count() == 6
    alias = read_seed(spark, "seed_pricing_model_alias")
    assert alias.count() == 0 and dict(alias.dtypes)["model_resolved"] == "string"
    o = read_seed(spark, "seed_pricing_local_overrides")
    assert dict(o.dtypes)["input_usd_per_mtok"] == "decimal(14,6)"


def test_missing_landing_root_raises(spark, tmp_path):
    import pytest

    with pytest.raises(FileNotFoundError):
        lf.scan_manifests(spark, str(tmp_path / "nope"))


def test_file_stem_is_the_key(spark, tree):
    from tellstar.operators import quality as dq

    m = dq.filename_key(lf.scan_manifests(spark, tree), "run_id", "run_id", "run_manifest").first()
    c = dq.filename_key(lf.scan_corpus_profiles(spark, tree), "corpus_build_id", "corpus_build_id", "corpus").first()
    assert m.failures == 0 and c.failures == 0


def test_question_coverage_and_grain_keys(spark, tree, raw_dir):
    from tellstar.operators import quality as dq
    from tellstar.plans.staging import stg_scored_answers, stg_traversal

    ld.land_all(spark, tree, raw_dir)
    a = ld.read_raw(spark, raw_dir, "scored_answer")
    bank = ld.read_raw(spark, raw_dir, "question").select("question_id")
    uncovered = a.join(bank, "question_id", "left_anti").select("run_id", "question_id").collect()
    assert [(r.run_id, r.question_id) for r in uncovered] == [("r3-closed", "q5")]
    g = dq.grain_keys(stg_scored_answers(a)).first()
    assert (g.n_records, g.failures) == (7, 0)
    m = dq.mechanism_derivable(stg_traversal(a)).first()
    assert m.failures == 1  # the unseeded retriever has no derivable mechanism


def test_whitespace_only_lines_are_skipped(spark, tree):
    from pathlib import Path

    from .fixtures import NEW

    p = Path(tree) / NEW / "r2-sparql.jsonl"
    p.write_text("\t\n" + p.read_text() + " \t \r\n")
    r = lf.scan_record_lines(spark, tree).where(F.col("run_id") == "r2-sparql").collect()
    assert sorted(x.line_no for x in r) == [0, 1]
    assert all(x.payload.startswith("{") for x in r)


def test_text_is_read_once_and_numbers_do_not_depend_on_splits(spark, tmp_path, monkeypatch):
    """Both a scan and a landing pass read the text in one plan; what numbers the lines later are
    written values, so splits of another size between the steps change nothing."""
    import json

    from tellstar.operators import ordinality
    from tellstar.sources.landing_files import record_lines

    from .fixtures import answer, manifest

    folder = tmp_path / "land" / NEW
    folder.mkdir(parents=True)
    for run, n in (("r1", 400), ("r2", 3), ("r3", 0)):
        (folder / f"{run}.manifest.json").write_text(json.dumps(manifest(run, "vector")))
        (folder / f"{run}.jsonl").write_text("".join(json.dumps(answer(f"q{i}", "vector")) + ("\n" if i % 5 else "\n\n  \n") for i in range(n)))
    root, raw = str(tmp_path / "land"), str(tmp_path / "raw")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    real = ordinality.range_offsets

    def other_splits(*a):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100m")
        return real(*a)

    monkeypatch.setattr(ordinality, "range_offsets", other_splits)
    monkeypatch.setattr(ld, "range_offsets", other_splits)
    try:
        for read in (lambda: lf.scan_record_lines(spark, root), lambda: ld.land_runs(spark, root, raw) and ld.read_raw(spark, raw, "scored_answer")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
            assert record_lines(spark, root).select("records_uri", "split_start").distinct().count() > 10
            frame = read()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Scan text" not in plan and "Scan parquet" in plan.replace("FileScan", "Scan")
            rows = frame.collect()
            assert len(rows) == 403 and all(json.loads(r.payload)["question_id"] == f"q{r.line_no}" for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # without the number the join that makes it is not there
    answers = ld.read_raw(spark, raw, "scored_answer").drop("line_no")
    assert "lines_before" not in answers._jdf.queryExecution().optimizedPlan().toString()


def test_hidden_names_are_found_by_few_calls(spark, tmp_path, monkeypatch):
    """10,000 files are no more calls than ten; hidden ones are found at any depth, others are not."""
    from tellstar.sources import fs

    calls = []
    real = fs._fs
    monkeypatch.setattr(fs, "_fs", lambda *a: calls.append(a[1]) or real(*a))
    used = []
    for n, root in ((10, tmp_path / "a [1]{x}"), (10_000, tmp_path / "many")):
        for i in range(n):
            folder = root / f"batch{i % 5}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"r{i}.jsonl").touch()
        (root / "_logs").mkdir()
        (root / "_logs" / "note.txt").touch()
        calls.clear()
        assert fs.hidden_files(spark, str(root), (".manifest.json", ".jsonl", ".json")) == []
        used.append(len(calls))
        deep = root / "x" / ".y" / "z"
        deep.mkdir(parents=True)
        for path in (root / "batch1" / "_h.jsonl", deep / "m.manifest.json", root / "_logs" / "p.json"):
            path.touch()
        found = fs.hidden_files(spark, str(root), (".manifest.json", ".jsonl", ".json"))
        assert sorted(f.rsplit("/", 1)[1] for f in found) == ["_h.jsonl", "m.manifest.json", "p.json"]
    assert used[0] == used[1] <= 20


def test_row_positions_of_an_ordered_frame(spark):
    from pyspark.sql import Window

    from tellstar.operators.ordinality import row_positions

    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("g"))
    ordered = frame.orderBy(F.col("g").asc_nulls_last(), "k")
    got = row_positions(ordered)
    assert got.columns == ["k", "g", "place"]
    want = frame.withColumn("place", F.row_number().over(Window.orderBy(F.col("g").asc_nulls_last(), "k")))
    assert got.exceptAll(want.select("k", "g", F.col("place").cast("bigint"))).count() == 0 and got.count() == 5000
    assert row_positions(ordered.limit(0)).count() == 0


def test_small_documents_are_written_by_the_tasks(spark, tmp_path, monkeypatch):
    """The same files as by partitioned writing and renames, which made several driver calls for each
    file (60,000 profiles took most of the time at 1 GB)."""
    from tellstar.sources import fs, sinks

    keys = ["plain", "a b,c", "50%=ä", None, "", "under/neath", *[f"k{i}" for i in range(60)]]
    rows = [(k, n, None if (i, n) == (0, 1) else f"line {n} of {i} ü\n  ") for i, k in enumerate(keys) for n in range(3) if k != ""]
    df = spark.createDataFrame(rows, "cid string, _order int, value string").repartition(3)
    found = {}
    for kind in ("text", "documents"):
        root = f"file://{tmp_path}/{kind}"
        if kind == "documents":
            monkeypatch.setattr(fs, "renames", None)
        written = getattr(sinks, f"write_named_{kind}")(df, ["cid"], f"{root}/_staging", lambda v, root=root: f"{root}/{v['cid']}.json", order="_order")
        there = {str(f.relative_to(tmp_path / kind)): f.read_bytes() for f in (tmp_path / kind).rglob("*.json")}
        assert written == len(there) == len(keys) - 1
        assert not list((tmp_path / kind).rglob(".draft-*"))
        found[kind] = there
    assert found["text"] == found["documents"]


def test_scans_of_many_small_files_have_few_tasks(spark, tmp_path):
    from tellstar.sources import landing_files as lf

    (tmp_path / "reference").mkdir()
    for i in range(200):
        (tmp_path / "reference" / f"c-{i}.json").write_text('{"a": 1}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        scan = lf.scan_corpus_profiles(spark, str(tmp_path))
        assert scan.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
        assert scan.select("corpus_build_id").distinct().count() == 200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_paths_of_answer_lines_need_no_patterns(spark):
    """Parts of a path as the patterns gave them, for every form of the root."""
    from pyspark.sql import functions as F

    from tellstar.sources import landing_files as lf

    rels = ["20240101T000000Z/r-1.jsonl", "r.jsonl", "a/reference/b c/x.y.jsonl", "reference/q.jsonl", "ä/50%+1.jsonl", "a.jsonl/b.txt"]
    cases = [(f"{base}{top}/{rel}", rel) for base in ("file://", "file:", "") for top in ("/data/in",) for rel in rels]
    cases += [("hdfs://n:9/data/in/b/r.jsonl", "b/r.jsonl"), ("file:///other/b/r.jsonl", "/other/b/r.jsonl"), (None, None)]
    df = spark.createDataFrame(cases, "uri string, rel string")
    for root in ("/data/in", "/data/in/", "file:///data/in", "file:/data/in", "hdfs://n:9/data/in", "s3a://bucket/data/in"):
        got = df.select("rel", lf._rel(F.col("uri"), root).alias("got"), lf._stem(F.col("uri"), ".jsonl").alias("stem"), lf.folder_of(F.col("rel")).alias("folder"),
                        F.regexp_extract("uri", r"([^/]+)\.jsonl$", 1).alias("s"), F.regexp_extract("rel", r"^(.*)/[^/]+$", 1).alias("f")).collect()
        assert [r for r in got if (r.rel, r.s, r.f) != (r.got, r.stem, r.folder)] == []
    plan = df.select(lf.folder_of(lf._rel(F.col("uri"), "/data/in")).alias("b"), lf._stem(F.col("uri"), ".jsonl").alias("r"))
    assert "regexp_extract" not in plan._jdf.queryExecution().optimizedPlan().toString().lower()


def test_scans_of_runs_do_not_list_the_reference_files(spark, tree, tmp_path):
    from pathlib import Path

    before = sorted(tuple(r) for r in lf.scan_manifests(spark, tree).select("run_id", "batch").collect())
    odd = Path(tree) / "batch [1]"  # a folder whose name is a pattern, and a run in the root itself
    odd.mkdir()
    for folder, run in ((odd, "r-odd"), (Path(tree), "r-root")):
        (folder / f"{run}.manifest.json").write_text('{"run_id": "x"}')
        (folder / f"{run}.jsonl").write_text('{"question_id": "q1"}\n')
    (Path(tree) / "notes.txt").write_text("no run")
    (Path(tree) / "_SUCCESS").write_text("")
    (Path(tree) / "reference" / "not-a-run.jsonl").write_text('{"question_id": "q1"}\n')
    folders = lf.run_folders(spark, tree)
    assert not [f for f in folders if f.rstrip("/").endswith(("/reference", "/_SUCCESS"))]

    got = sorted(tuple(r) for r in lf.scan_manifests(spark, tree).select("run_id", "batch").collect())
    assert got == sorted([*before, ("r-odd", "batch [1]"), ("r-root", "")])
    lines = lf.record_lines(spark, tree)
    assert not [f for f in lines.inputFiles() if "/reference/" in f]
    runs = {(r.run_id, r.batch) for r in lines.collect()}
    assert {("r-odd", "batch [1]"), ("r-root", "")} <= runs and "not-a-run" not in {r for r, _ in runs}

    only = tmp_path / "only"
    (only / "reference").mkdir(parents=True)
    assert lf.scan_manifests(spark, str(only)).count() == lf.record_lines(spark, str(only)).count() == 0


def test_large_projections_run_in_compiled_methods(spark, tree, raw_dir, tmp_path):
    from tellstar import session
    from tellstar.plans import marts
    from tellstar.plans.staging import explode_answers

    for run in (lambda: ld.land_all(spark, tree, raw_dir), lambda: marts.build_star(spark, raw_dir, str(tmp_path / "marts"))):
        spark.conf.unset(session.METHOD_LIMIT)
        run()
        assert int(spark.conf.get(session.METHOD_LIMIT)) == session.COMPILED_BYTES
    rows = explode_answers(ld.read_raw(spark, raw_dir, "scored_answer"))
    with_limit = sorted(map(str, rows.collect()))
    spark.conf.unset(session.METHOD_LIMIT)
    assert sorted(map(str, explode_answers(ld.read_raw(spark, raw_dir, "scored_answer")).collect())) == with_limit


def test_a_line_is_parsed_once(spark):
    import pytest

    from tellstar.functions.jsonx import strict_struct, stext

    def ids(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "payload string")
        return df.select(stext(strict_struct("payload", "question_id: string"), "question_id").alias("q"))

    good = ids('{"question_id": 3}', '{"x": 1}', "null", ' {"question_id": "a"} ')
    assert [r.q for r in good.collect()] == ["3", None, None, "a"]
    # a use of the parsed array in the branch of a CASE would be a second parse
    assert "THEN from_json" not in good._jdf.queryExecution().analyzed().toString()
    for bad in ("{} {}", "{},{}", "", "{'a': 1}", None):
        with pytest.raises(Exception):
            ids(bad).collect()


def _odd_documents(folder):
    """Documents whose names or bytes a reader may stumble on, and what no reader takes."""
    import os

    folder.mkdir(parents=True)
    for name in ("plain.json", "a b,c.json", "50%=ä+1.json", "%41.json", "{x}[1]*?.json", "x.y.json", "_p=1.json"):
        (folder / name).write_text(f'{{"name": "{name}"}}\n')
    for name, content in (("bom.json", b"\xef\xbb\xbf{}"), ("bytes.json", b'{"a": "\xff\xfe"}\r\n\x00'), ("blank.json", b" \n"), ("empty.json", b""),
                          ("_hidden.json", b"{}"), (".hidden.json", b"{}"), ("_metadata.json", b"{}"), ("other.jsonl", b"{}"), ("pricing/deep.json", b"{}"), ("folder.json/deep.json", b"{}")):
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(content)
    os.symlink(folder / "plain.json", folder / "link.json")
    os.symlink(folder / "nowhere", folder / "broken.json")


def test_documents_are_listed_and_read_by_tasks_as_by_the_reader(spark, tmp_path):
    """The reader's listing kept over 1 KB a file on the driver (360,000 profiles filled its memory)."""
    from tellstar.sources.documents import read_documents

    folder = tmp_path / "a [1]{x} %25" / "reference"
    _odd_documents(folder)
    columns = ["source_uri", F.hex("payload")]
    want = sorted(tuple(r) for r in lf._whole_files(spark, lf.fs.glob_escaped(str(folder)), "*.json", recursive=False).select(*columns).collect())
    assert len(want) == 11
    for root in (str(folder.parent), f"file://{folder.parent}/", f"file:{folder.parent}"):
        scan = lf.scan_corpus_profiles(spark, root)
        assert sorted(tuple(r) for r in scan.select(*columns).collect()) == want
        assert "Scan text" not in scan._jdf.queryExecution().executedPlan().toString()
    assert read_documents(spark, str(folder), ".nothing").count() == 0


def test_large_documents_are_handed_on_one_by_one(spark, tmp_path, monkeypatch):
    from tellstar.sources import documents

    monkeypatch.setattr(documents, "NAMES", 7)
    for i in range(40):
        (tmp_path / f"d{i}.json").write_text(f"{i}" * (2_000_000 if i % 10 == 0 else 1))
    got = documents.read_documents(spark, str(tmp_path), ".json").select("source_uri", "payload").collect()
    assert {r.source_uri.rsplit("/", 1)[1]: r.payload for r in got} == {p.name: p.read_text() for p in tmp_path.iterdir()} and len(got) == 40


def test_hidden_names_are_found_without_every_files_status(spark, tmp_path, monkeypatch):
    """The walk of a mounted folder finds what the patterns found, which held the status of every file."""
    from tellstar.sources import fs

    _odd_documents(tmp_path / "land" / "reference")
    for name in ("b1/_r.jsonl", "b1/r.jsonl", "_logs/note.txt", "_logs/p.json", "x/.y/z/m.manifest.json", "_draft.jsonl/part", "_k=1/a.jsonl"):
        (tmp_path / "land" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "land" / name).touch()
    (tmp_path / "many").mkdir()
    for i in range(40):
        (tmp_path / "many" / f"_h{i}.jsonl").touch()
    calls = []
    real = fs._glob
    monkeypatch.setattr(fs, "_glob", lambda *a: calls.append(a) or real(*a))
    suffixes = (".manifest.json", ".jsonl", ".json")
    for root, most in (("land", 10), ("land", 100), ("land", 3), ("many", 10), ("nowhere", 10), ("land/b1/r.jsonl", 10)):
        got = fs.hidden_files(spark, f"{tmp_path}/{root}", suffixes, most)
        assert not calls
        with monkeypatch.context() as m:
            m.setattr(fs, "_hidden_mounted", lambda *a: None)
            base = fs.glob_escaped(f"file:{tmp_path}/{root}")
            want, depth = [], 1
            while len(want) < most and fs._any(spark, base + "/*" * depth):
                for at in range(depth):
                    names = ["*"] * (depth - 1) + ["*{" + ",".join(suffixes) + "}"]
                    names[at] = "[_.]" + names[at]
                    want += [f for f in real(spark, f"{base}/{'/'.join(names)}") if f not in want]
                depth += 1
        assert got == sorted(want)[:most]


def test_long_lines_are_made_after_the_rows_are_dealt(spark, tmp_path):
    """The same files as from rows that carry their text, which took six times as much shuffle on disk."""
    from tellstar.sources import sinks

    rows = spark.range(500).select((F.col("id") % 7).cast("string").alias("run"), ((F.col("id") * 37) % 501).alias("_order"), "id")
    text = F.concat(F.lit("line "), F.repeat(F.col("id").cast("string"), 300), F.when(F.col("id") % 5 == 0, F.lit("\n  ")).otherwise(F.lit("")))
    dealt = sinks._dealt(rows, ["run"], "_order", text)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= dealt.index("repeat(") < dealt.index("RepartitionByExpression") and dealt.count("repeat(") == 1
    found = []
    for folder, frame, value in (("carried", rows.withColumn("value", text), None), ("made", rows, text)):
        root = f"file://{tmp_path}/{folder}"
        sinks.write_named_text(frame, ["run"], f"{root}/_staging", lambda v, root=root: f"{root}/{v['run']}.jsonl", order="_order", value=value)
        found.append({p.name: p.read_text() for p in (tmp_path / folder).glob("*.jsonl")})
    assert found[0] == found[1] and len(found[0]) == 7
