"""Long words that polynomial hashes modulo 2**64 cannot tell apart, whatever the multiplier."""

import pytest

from tellstar.llm import decontaminate, hmm, packing, substring

from .test_decontaminate import brute as contaminated
from .test_hmm import brute_base
from .test_substring import brute as repeats
from .test_tokens import WORD, ids_by_operator, word_library


def twins(letters, n=4096):
    """The word of ``n`` letters by the parity of each place's bits, and the one by the opposite."""
    parity = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[p] for p in parity), "".join(letters[1 - p] for p in parity)


PAIRS = [twins("ab"), twins("ab", 1024), twins("xy", 32), twins("xy", 64)]


@pytest.mark.parametrize("one,other", PAIRS)
def test_hashes_differ(one, other):
    a, b = (hmm.Tokens(next(_chunk(w))).hash[0] for w in (one, other))
    assert a != b and a == hmm.Tokens(next(_chunk(one.upper()))).hash[0]


def _chunk(text):
    import pyarrow as pa

    from tellstar.llm.text import chunks
    return chunks([pa.RecordBatch.from_pydict({"text": pa.array([text], pa.binary())})])


def test_repeats_of_long_words(spark):
    one, other = PAIRS[0]
    filler = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(filler + [one])), (2, " ".join(x + "z" for x in filler) + " " + other), (3, " ".join([one, *filler[:49]])), (4, " ".join([other, *filler[:49]])), (5, " ".join([one, *filler[:49]]))]
    got = sorted(tuple(r)[:4] for r in substring.report(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == [r[:4] for r in repeats(docs)]
    assert [r[2] for r in got] == [0, 0, 0, 0, 50]


def test_contamination_by_long_words(spark):
    items = [(1, "start " + PAIRS[0][0]), (2, " ".join([PAIRS[1][0], *"b c d e f g h i j k l m n".split()]))]
    docs = [(1, "start " + PAIRS[0][1]), (2, "start " + PAIRS[0][0]), (3, " ".join([PAIRS[1][1], *"b c d e f g h i j k l m o".split()])), (4, items[1][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r)[:6] for r in decontaminate.report(frame, spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == [r[:6] for r in contaminated(docs, items)]
    assert [r[5] for r in got] == [False, True, False, True]


def test_counts_of_long_words(spark):
    docs = [(i, PAIRS[0][i % 2] if i % 3 else "w " + PAIRS[1][0]) for i in range(40)] + [(100 + i, PAIRS[1][1]) for i in range(3)]
    got = sorted(hmm.scores(spark.createDataFrame(docs, "doc_id long, text string"), rounds=(1,)).collect())
    want = brute_base(sorted(docs))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert [r.base_score for r in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_ids_of_long_words():
    texts = [w for pair in PAIRS for w in pair] * 2
    for text, own in zip(texts, ids_by_operator(texts)):
        assert own.tolist() == [*word_library.encode(text, add_special_tokens=False).ids, 2]
    assert packing.Ids(WORD).by_unit
