import hashlib
import random

import numpy as np
import pyarrow as pa

from tellstar.llm import substring
from tellstar.llm.queries import op1_substring_dedup

SF = "/root/testdata/sf0.01"


def brute(docs, window=50):
    """(doc_id, n_words, n_removed, sha, removed word numbers) of each (doc_id, text)."""
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), gone))
    return out


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in op1_substring_dedup(spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert got == [r[:4] for r in brute(docs)]
    assert sum(r[2] for r in got) > 0


def test_planted_passages_and_edge_cases(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 74, 75, 120)]
    docs = [(None, shared[4]), (900, None), (901, ""), (902, " \n\t"), (903, "short one"), (904, "be " * 3000), (905, "be " * 120), (904, "be " * 3000),
            (906, shared[5] + " " + shared[5]), (905, text(60) + " " + shared[2])]
    for i in range(60):
        body = text(rng.randrange(0, 90)), rng.choice(shared), text(rng.randrange(0, 90)), rng.choice(shared), text(rng.randrange(0, 40))
        docs.append((rng.randrange(1000) * 3, rng.choice([" ", "\n", "  "]).join(x for x in body if x)))
    docs += [(d + 1 if d else 0, t) for d, t in docs[12:20]]
    frame = spark.createDataFrame([(d, t, i, "k") for i, (d, t) in enumerate(docs)], "doc_id long, text string, hits int, found string").repartition(4)
    got = sorted((tuple(r) for r in substring.report(frame).collect()), key=str)
    want = brute(docs)
    assert [r[:4] for r in got] == sorted((w[:4] for w in want), key=str)
    cover = sorted(((r[0], sorted(i for s in r[4] for i in range(s.start, s.stop))) for r in got), key=str)
    assert cover == sorted(((w[0], sorted(w[4])) for w in want), key=str)
    kept = {r.hits: r for r in substring.without_repeats(frame).collect()}
    assert substring.without_repeats(frame).columns == frame.columns
    for i, (w, (d, t)) in enumerate(zip(want, docs)):
        if w[4] and len(w[4]) == w[1]:
            assert i not in kept
        elif not w[4]:
            assert kept[i].text == t
        else:
            assert hashlib.sha256(b" ".join(kept[i].text.encode().split())).hexdigest() == w[3]
    assert substring.report(frame.limit(0)).count() == 0
    assert substring.without_repeats(frame.limit(0)).count() == 0


def _windows(rows):
    """Rows (part, doc_id, keys) in the form that ``_seen_before`` takes, a batch of 20 each."""
    for lo in range(0, len(rows), 20):
        some = rows[lo:lo + 20]
        yield substring.record(
            part=pa.array([p for p, _, _ in some], pa.int32()), doc_id=np.array([d for _, d, _ in some]), mark=np.array([d for _, d, _ in some]),
            keys=pa.array([np.array(k, np.uint64).tobytes() for _, _, k in some]), checks=pa.array([np.array(k, np.uint32).tobytes() for _, _, k in some]),
            places=pa.array([np.arange(len(k), dtype=np.int32).tobytes() for _, _, k in some]))


def test_held_windows_are_sorted_few_times(monkeypatch):
    """The windows of a part were sorted again for every batch of it: at 6 GB that took most of the time."""
    rng = random.Random(3)
    rows = [(p, d, [rng.randrange(4000) for _ in range(30)]) for p in (0, 1) for d in range(1000)]
    first, want = {}, {}
    for p, d, keys in rows:
        for at, k in enumerate(keys):
            if first.setdefault((p, k), d) < d:
                want.setdefault((p, d), []).append(at)
    work = []
    lexsort = np.lexsort
    monkeypatch.setattr(substring, "WAITING", 2000)
    monkeypatch.setattr(np, "lexsort", lambda keys: work.append(len(keys[0])) or lexsort(keys))
    got = [tuple(r.values()) for b in substring._seen_before(_windows(rows)) for r in b.to_pylist()]
    assert [(d, d, np.array(x, np.int32).tobytes()) for (p, d), x in want.items()] == got
    assert sum(work) < 4 * 30 * len(rows)


def test_a_task_packs_its_chunks_together(spark):
    """A row for each bucket and task: one for each chunk of text made the rows grow with buckets x chunks."""
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{rng.randrange(9999)}" for _ in range(60_000))) for i in range(8)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = []
    meet = substring._meet
    try:
        substring._meet = lambda batches: (substring.record(doc_id=np.array([1]), bucket=pa.array([b.num_rows], pa.int32()), keys=pa.array([b""])) for b in batches)
        rows = [h.bucket for r in substring.anchors(frame, 50, 64).collect() for h in r.hits]
    finally:
        substring._meet = meet
    assert 0 < sum(rows) <= 2 * 64
