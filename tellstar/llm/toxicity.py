"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Many voters look at a document: lexicons of word forms (whole words and beginnings of words,
mined from labelled rows outside the held-out fold, plus fixed ones) and patterns of the text.
A generative model with one hidden class explains their votes: each voter's rates in the two
classes are its accuracy, and voters whose votes still agree within the classes are correlated
and count for less. Its posterior for each sampled document is the label that a sparse linear
classifier on hashed word forms learns; the classifier scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import fold
from .quality import FOLDS, PUNCTUATION, UPPER, _share
from .text import ALNUM_WORD, Chunk, Words, _ROOTS, carried, each_in, map_chunks, mixed, powers, record, restored, schema_of, texts

#: Bounds of the labelled sample: documents of each class (lowest hashes of doc_id).
PER_CLASS = 4_000
#: Hashed word forms of the classifier.
SPACE = 1 << 18
#: Word forms: beginnings of this many bytes, and (0) whole words.
FORMS = (4, 5, 0)
#: Mined lexicon entries, and the voters that share them.
ENTRIES, VOTERS = 384, 32
#: Least log-odds of a mined entry.
LEAST_WEIGHT = 2.0
#: Log-odds that a labelled row's own label adds to its posterior (a voter that is right nine
#: times in ten).
OWN_LABEL = 2.2
#: Words of the lexicon voters that need no labels.
INSULTS = {
    "en": "idiot moron stupid pathetic loser scum trash worthless disgusting clown dumb filthy vermin",
    "de": "idiot dumm dreck abschaum versager widerlich trottel wertlos",
    "fr": "idiot stupide ordure minable débile dégoûtant crétin imbécile",
    "es": "idiota estúpido basura patético imbécil asqueroso inútil escoria",
}


class Forms:
    """Hashed forms of a chunk's words; ``column[f]`` has one slot below SPACE for each word."""

    def __init__(self, part: Chunk):
        self.words = words = part.words(ALNUM_WORD, lower=True)
        up, down = powers(_ROOTS[2], len(words.data))
        sums = np.zeros(len(words.data) + 1, np.uint64)
        np.cumsum((words.data.astype(np.uint64) + np.uint64(1)) * up[:len(words.data)], out=sums[1:])
        self.column = []
        for kind, size in enumerate(FORMS):
            end = np.minimum(words.start + size, words.end) if size else words.end
            h = mixed((sums[end] - sums[words.start]) * down[words.start] + np.uint64(kind * 1000) + (end - words.start).astype(np.uint64))
            self.column.append((h >> np.uint64(46)).astype(np.int64) if SPACE == 1 << 18 else (h % np.uint64(SPACE)).astype(np.int64))

    def distinct(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(document, slot) of every distinct form, of the flagged slots only if given."""
        of, found = self.words.doc(), []
        for column in self.column:
            rows = np.flatnonzero(keep[column]) if keep is not None else slice(None)
            found.append(of[rows] * SPACE + column[rows])
        pair = np.unique(np.concatenate(found))
        return pair // SPACE, pair % SPACE


def slots(words: list[str]) -> np.ndarray:
    """The slots of whole words."""
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    batch = pa.RecordBatch.from_pydict({"text": [data.tobytes()]})
    return np.unique(Forms(Chunk(batch, 0, 1, data, np.array([0, len(data)]))).column[-1])


def patterns(part: Chunk, words: Words) -> np.ndarray:
    """Votes (0/1) of the pattern voters for each document."""
    n, data, bounds = len(part), part.data, part.bounds
    counts = words.counts()
    upper, marks = _share(UPPER[data], bounds), _share(PUNCTUATION[data], bounds)
    bang = data == 0x21
    twice = np.zeros(len(data), bool)
    twice[1:] = bang[1:] & bang[:-1]
    same = np.zeros(len(words), bool)
    h = words.hashes()
    same[1:] = h[1:] == h[:-1]
    again = np.bincount(words.doc(), same, minlength=n) / np.maximum(counts, 1)
    digits = _share((data >= 0x30) & (data <= 0x39), bounds)
    return np.stack([upper > 0.3, marks > 0.12, _share(bang, bounds) > 0.01, _share(twice, bounds) > 0, again > 0.2,
                     digits > 0.1, counts < 20, counts > 2000, _share(data >= 0x80, bounds) > 0.1, _share(data == 0x7C, bounds) > 0], axis=1).astype(np.int8)


def mined(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(slot, weight) of the word forms whose share of documents differs most between classes:
    for ENTRIES forms of toxic documents (positive) and as many of clean ones (negative)."""

    def count(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, SPACE), np.int64)
        for part in parts:
            label = part.column("label").to_numpy()
            of, slot = Forms(part).distinct()
            for y in (0, 1):
                seen[y] += np.bincount(slot[label[of] == y], minlength=SPACE)
        some = np.flatnonzero(seen.sum(axis=0))
        yield record(slot=some, clean=seen[0, some], toxic=seen[1, some])

    rows = map_chunks(sample, count, "slot long, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = (F.col(c) + 0.5 for c in ("clean", "toxic"))
    weight = F.log(toxic / (sizes.get(1, 0) + 1.0)) - F.log(clean / (sizes.get(0, 0) + 1.0))
    rows = rows.withColumn("weight", weight).where("clean + toxic >= 5")
    found = []
    for sign in (1, -1):  # the most telling entries: log-odds times the root of the support
        force = F.col("weight") * F.sqrt(F.col("clean") + F.col("toxic")) * sign
        telling = (force > 3) & (F.col("weight") * sign > LEAST_WEIGHT)
        found += [(r.slot, r.weight) for r in rows.where(telling).orderBy(force.desc(), "slot").limit(ENTRIES).collect()]
    return np.array([s for s, _ in found], np.int64), np.array([w for _, w in found])


@dataclass
class Voters:
    """The lexicon of every voter: ``voter[slot]`` is its number, -1 for other slots."""

    voter: np.ndarray
    fixed: list[np.ndarray]
    strong: np.ndarray

    @staticmethod
    def of(slot: np.ndarray, weight: np.ndarray) -> "Voters":
        voter, strong = np.full(SPACE, -1, np.int16), np.zeros(SPACE, bool)
        toxic, clean = slot[weight > 0], slot[weight < 0]
        voter[toxic] = np.arange(len(toxic)) % VOTERS
        voter[clean] = VOTERS + np.arange(len(clean)) % VOTERS
        strong[toxic] = True
        return Voters(voter, [slots(words.split()) for words in INSULTS.values()], strong)

    def votes(self, part: Chunk, forms: Forms) -> np.ndarray:
        """0/1 votes: mined lexicons, numbers of strong entries, fixed lexicons, patterns."""
        n = len(part)
        of, slot = forms.distinct(self.voter >= 0)
        lexicon = np.zeros((n, 2 * VOTERS), np.int8)
        lexicon[of, self.voter[slot]] = 1
        hits = np.bincount(of, self.strong[slot], minlength=n)
        several = np.stack([hits >= k for k in (1, 2, 3, 5, 8)], axis=1)
        doc = forms.words.doc()
        fixed = [np.bincount(doc, np.isin(forms.column[-1], s), minlength=n) > 0 for s in self.fixed]
        return np.concatenate([lexicon, several, np.stack(fixed, axis=1), patterns(part, forms.words)], axis=1).astype(np.int8)


def label_model(votes: np.ndarray, prior: float, label: np.ndarray, rounds: int = 12, force: np.ndarray | None = None) -> np.ndarray:
    """Posterior chance of the positive class for each row of 0/1 votes.

    Expectation maximisation of a two-class model. A voter's rates in the classes are its
    accuracy. Correlations of the votes' residuals within the classes measure dependence; a
    voter's evidence is divided by one plus its squared correlations with the others, so that
    copies of one voter count about once. The row's own label is a voter of known accuracy,
    which fixes the names of the classes. A row of force n (1 if not given) counts like n rows."""
    if not len(votes):
        return np.empty(0)
    own = OWN_LABEL * (2.0 * label - 1)
    x, p = votes.astype(float), 1 / (1 + np.exp(-own))
    force = np.ones(len(x)) if force is None else force
    for _ in range(rounds):
        rate = [((w[:, None] * x).sum(axis=0) + 0.5) / (w.sum() + 1) for w in (force * (1 - p), force * p)]
        rest = x - np.outer(1 - p, rate[0]) - np.outer(p, rate[1])
        spread = np.sqrt(force @ rest ** 2 / force.sum()) + 1e-9
        linked = (rest.T @ (force[:, None] * rest)) / force.sum() / np.outer(spread, spread)
        np.fill_diagonal(linked, 0)
        trust = 1 / (1 + (linked ** 2).sum(axis=1))
        yes, no = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
        margin = own + np.log(prior / (1 - prior)) + (x * yes + (1 - x) * no) @ trust
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    return p


def linear(first: np.ndarray, slot: np.ndarray, target: np.ndarray, passes: int = 20, rate: float = 0.15, lasso: float = 1e-3, batch: int = 128, known: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model of soft targets on distinct slots, by adaptive
    gradients with a lasso step, so that few slots keep a weight. Both classes weigh the same;
    ``known`` has the rows that each row stands for."""
    known = np.ones(len(target)) if known is None else known / known.mean()
    share = np.clip((known * target).mean(), 0.01, 0.99) if len(target) else 0.5
    force = known * (target * 0.5 / share + (1 - target) * 0.5 / (1 - share))
    weight, seen = np.zeros(SPACE), np.full(SPACE, 1e-6)
    offset = 0.0
    rng = np.random.default_rng(0)
    sizes = np.diff(first)
    for _ in range(passes):
        order = rng.permutation(len(target))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            at = slot[each_in(first[rows], sizes[rows])]
            of = np.repeat(np.arange(len(rows)), sizes[rows])
            margin = offset + np.bincount(of, weight[at], minlength=len(rows))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target[rows]) * force[rows]
            here, back = np.unique(at, return_inverse=True)
            grad = np.bincount(back, error[of], minlength=len(here)) / len(rows)
            seen[here] += grad ** 2
            step = rate / np.sqrt(seen[here])
            moved = weight[here] - step * grad
            weight[here] = np.sign(moved) * np.maximum(np.abs(moved) - step * lasso, 0)
            offset -= 0.1 * error.mean()
    return weight, offset


@dataclass
class Linear:
    slot: np.ndarray
    weight: np.ndarray
    offset: float

    def score(self, parts: Chunk, forms: Forms) -> np.ndarray:
        table = np.zeros(SPACE)
        table[self.slot] = self.weight
        of, slot = forms.distinct(table != 0)
        margin = self.offset + np.bincount(of, table[slot], minlength=len(parts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def sampled(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of up to ``per_class`` labelled documents of each class outside the
    held-out fold (lowest hashes of doc_id), and how many labelled ids each class has."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).dropna()
    rows = rows.where(fold("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    each = [rows.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(each[0].unionByName(each[1]))  # at most twice ``per_class`` rows
    return texts(docs).join(chosen, "doc_id").select("doc_id", "text", "label"), sizes


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Linear:
    """The classifier of ``labels.toxic``. With no labelled row of one of the classes it is a
    constant below one half."""
    sample, sizes = sampled(docs, labels, per_class)
    if not sizes.get(0) or not sizes.get(1):
        return Linear(np.empty(0, np.int64), np.empty(0), -5.0)
    sample = sample.dropDuplicates(["doc_id"]).checkpoint()
    voters = Voters.of(*mined(sample))
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def look(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            forms = Forms(part)
            of, slot = forms.distinct()
            votes = shared.value.votes(part, forms)
            first = np.searchsorted(of, np.arange(len(part) + 1))
            yield record(doc_id=part.column("doc_id"), label=part.column("label"), votes=pa.array([v.tobytes() for v in votes], pa.binary()),
                         slots=pa.array([slot[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()))

    rows = map_chunks(sample, look, "doc_id long, label int, votes binary, slots binary").orderBy("doc_id").toArrow()  # 2 * per_class rows
    votes = np.array([np.frombuffer(v, np.int8) for v in rows.column("votes").to_pylist()])
    lists = [np.frombuffer(s, np.int32) for s in rows.column("slots").to_pylist()]
    first = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    label = rows.column("label").to_numpy()
    force = np.array([sizes[y] / max(1, (label == y).sum()) for y in (0, 1)])[label]  # labelled ids that a row stands for
    target = label_model(votes, (sizes[1] + 0.5) / (sizes[0] + sizes[1] + 1), label, force=force)
    weight, offset = linear(first, np.concatenate(lists).astype(np.int64) if lists else np.empty(0, np.int64), target, known=force)
    kept = np.flatnonzero(weight)
    return Linear(kept, weight[kept], offset)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (null text: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            score = shared.value.score(part, Forms(part))
            yield record(doc_id=part.column("doc_id"), held_out=part.column("held_out"), score=score, predicted=pa.array((score >= threshold).astype(np.int32)))

    frame = texts(docs.select("doc_id", "text").withColumn("held_out", fold("doc_id", FOLDS) == 0), "held_out")
    return map_chunks(frame, run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` without the documents that the classifier calls toxic; other rows are unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))
    frame, names = carried(docs)

    def run(parts: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = shared.value.score(part, Forms(part)) < threshold
            yield part.batch.slice(part.lo, len(part)).select(names).filter(pa.array(keep))

    return restored(map_chunks(frame, run, schema_of(frame, *names)), docs)
