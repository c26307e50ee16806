import hashlib
from collections import Counter

import pytest
import xxhash

from tellstar.llm import sharding
from tellstar.llm.queries import SHARDS, op7_sharding

SF = "/root/testdata/sf0.001"


def brute(shards, slots):
    """The table from full preference lists."""
    lists = []
    for name in shards:
        d = hashlib.sha256(name.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "little") % slots, int.from_bytes(d[8:16], "little") % (slots - 1) + 1
        lists.append([(offset + j * skip) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for s, wishes in enumerate(lists):
            free = [x for x in wishes if x not in owner]
            if free:
                owner[free[0]] = s
    return [owner[i] for i in range(slots)]


def test_table_equals_preference_lists():
    for n, slots in ((1, 2), (3, 7), (5, 101), (13, 211), (7, 7)):
        names = [f"s{i}" for i in range(n)]
        assert sharding.lookup(names, slots).tolist() == brute(names, slots)


def test_balance_and_little_movement():
    names = [f"s{i}" for i in range(50)]
    table = sharding.lookup(names)
    counts = Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    less = sharding.lookup(names[:-1])
    moved = sum(a != b for a, b in zip(table.tolist(), less.tolist()) if a != 49)
    assert moved < 0.06 * len(table)
    heavy = Counter(sharding.lookup(names, weights=[3] + [1] * 49).tolist())
    assert abs(heavy[0] - 3 * heavy[1]) <= 3
    for bad in (dict(shards=names, slots=65536), dict(shards=[]), dict(shards=["a", "a"]), dict(shards=["a"], weights=[0])):
        with pytest.raises(ValueError):
            sharding.lookup(**bad)


def test_query_places_every_document(spark):
    rows = op7_sharding(spark, SF).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == docs and len(rows) == len(docs)
    table = sharding.lookup(SHARDS)
    assert all(r.shard_id == table[r.slot] and r.shard == SHARDS[r.shard_id] for r in rows)


def test_query_columns_equal_plain_ones(spark):
    slots = sharding.SLOTS
    given = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op7_sharding(spark, SF).collect():
        code = xxhash.xxh64_intdigest(str(r.doc_id).encode(), 42)
        assert r.slot == (code - (code >> 63 << 64)) % slots
        text = given[r.doc_id].text
        assert r.source == given[r.doc_id].source and r.n_bytes == (None if text is None else len(text.encode()))


def test_edge_cases_and_files(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1, "x"), (None, 2, None), (7, 3, "y"), (7, 3, "y"), (8, 4, "")], "doc_id long, slot int, shard string")
    found = sharding.placed(rows, "doc_id", ["a", "b", "c"], 101).collect()
    assert len(found) == 5 and len({r._shard for r in found if r.doc_id is None}) == 1 and len({r._shard for r in found if r.doc_id == 7}) == 1
    assert sharding.placed(rows.limit(0), "doc_id", ["a"], 101).count() == 0
    sharding.write_shards(rows, "doc_id", ["a", "b", "c"], f"{tmp_path}/out", 101)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((str(r.doc_id), r._shard) for r in back.collect()) == sorted((str(r.doc_id), r._shard) for r in found)
