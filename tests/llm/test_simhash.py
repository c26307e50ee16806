import collections

import numpy as np
import pytest
import xxhash

from tellstar.llm import simhash
from tellstar.llm.components import components
from tellstar.llm.queries import op8_simhash

SF = "/root/testdata/sf0.001"


def brute_fp(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [words[i:i + k] for i in range(len(words) - k + 1)] or [words]
    hs = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(fps, bits=4):
    """The smallest linked index of each index, over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def by_class(fps, labels):
    found = collections.defaultdict(set)
    for f, label in zip(fps, labels):
        found[label].add(f)
    return sorted(map(sorted, found.values()))


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op8_simhash(spark, SF).collect()}
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    fps = [brute_fp(t) for _, t in docs]
    want = brute_classes(fps)
    assert len(rows) == len(docs)
    for (doc, _), fp, root in zip(docs, fps, want):
        assert (rows[doc].fingerprint, rows[doc].component_id) == (f"{fp:016x}", docs[root][0])
    assert len(set(want)) < len(docs)


@pytest.mark.parametrize("dense,short", [(16384, 64), (8, 4), (2, 2)])
def test_links_equal_brute_force_on_chains_and_crowds(spark, monkeypatch, dense, short):
    rng = np.random.default_rng(7)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for base in fps[:6]:  # chains and dense groups
        for _ in range(40):
            base ^= int(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
            fps.append(base)
    fps += [fps[0] ^ int(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))) for _ in range(150)]
    fps = sorted(set(fps))
    monkeypatch.setattr(simhash, "SHORT", short)
    monkeypatch.setattr(simhash, "DENSE", dense)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    edges = simhash.links(frame)
    roots = {r.node: r.root for r in components(edges).collect()}
    assert by_class(signed, [roots.get(f, f) for f in signed]) == by_class(signed, brute_classes(fps))


def test_edge_cases(spark):
    schema = "fp string, doc_id long, text string, component_id int, list int"
    rows = [("x", 5, None, 1, 1), ("x", 3, "", 1, 1), ("x", 4, " \n", 1, 1), ("x", 9, "Alone", 1, 1), ("x", 9, "alone", 1, 1),
            ("x", None, "other words here now and then", 1, 1), ("x", 2, "w " * 50000, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted((r.doc_id or -1, r.component_id or -1, r.fp) for r in simhash.near_duplicates(docs).collect())
    assert [(d, c) for d, c, _ in got] == [(-1, -1), (2, 2), (3, 3), (4, 3), (5, 3), (9, 9), (9, 9)]
    assert [f for d, _, f in got if d in (3, 4, 5)] == [0, 0, 0]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


A, B, C = ("one text about rivers and hills in spring", "another text on trade and tariffs of late", "a third text with words of its own here")


@pytest.mark.parametrize("rows,want", [
    ([(1, A), (1, B), (2, B)], [(1, A), (1, B)]),
    ([(1, B), (2, B), (2, A)], [(1, B), (2, A)]),
    ([(1, A), (1, B), (1, C)], [(1, A), (1, B), (1, C)]),
    ([(1, A), (1, A), (2, A), (1, B)], [(1, A), (1, B)]),
    ([(3, A), (3, A), (2, B), (3, B), (None, A), (None, None), (4, None), (5, "")], [(3, A), (2, B), (None, A), (None, None), (4, None)]),
])
def test_rows_that_share_a_doc_id_are_told_apart_by_text(spark, rows, want):
    import corpus_pipeline

    frame = spark.createDataFrame([(d, t, d, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, _kept long, mark long").repartition(2)
    got = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, frame, "")
    assert got.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
