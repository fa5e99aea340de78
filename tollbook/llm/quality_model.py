"""A quality classifier trained without labels of its own: heuristic labellers vote,
expectation-maximisation weighs them, and their posterior trains a linear scorer."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import stored
from tollbook.llm.words import hashed_words, joined, mix, read, window_hashes

#: Weights of the scorer, a power of two, and the texts and labelled texts that it and
#: the word lists are fitted on at most (taken by the hash of their number).
BUCKETS, TRAIN_TEXTS, LABELLED_TEXTS = 1 << 18, 8_000, 12_000
#: Labellers of bad form, and of abuse; abuse lists are made from thirds of the
#: labelled texts, so that they overlap and err separately.
FORM = ("symbols", "shouts", "capitals", "repeats", "variety", "lines")
ABUSE = ("list_a", "list_b", "list_c")
SPLITTERS = np.zeros(256, np.uint8)
for _b in range(128):
    if not chr(_b).isalnum():
        SPLITTERS[_b] = 1


#: Words in other forms share their beginnings: bytes of a stem.
STEM = 4


def plain(texts: list[bytes]) -> list[bytes]:
    """Only runs of letters and digits, with a space for every other ASCII byte."""
    data, offsets = joined(texts)
    raw = np.where(SPLITTERS[data] > 0, np.uint8(0x20), data).astype(np.uint8).tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def words_and_stems(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of a text's words in order, A-Z as a-z, and of their stems."""
    texts = plain(texts)
    stems = hashed_words(texts, lower=True, stem=STEM)
    return [(w, mix(s + np.uint64(STEM))) for w, s in zip(hashed_words(texts, lower=True), stems, strict=True)]


@dataclass
class Measures:
    """Shares by which the form of a text is judged; zero for a text without words."""

    n_words: int
    symbols: float
    shouts: float
    capitals: float
    repeats: float
    distinct: float
    lines: float

    @classmethod
    def of(cls, text: bytes, words: np.ndarray) -> Measures:
        counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        n = max(1, len(words))
        letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
        lines = [line for line in text.split(b"\n") if line.strip()]
        return cls(
            len(words),
            sum(int(counts[b]) for b in b"#*$%&|<>") / n,
            int(counts[0x21]) / n,
            int(counts[65:91].sum()) / letters,
            float((words[1:] == words[:-1]).sum()) / n,
            len(np.unique(words)) / n,
            1 - len(set(lines)) / max(1, len(lines)),
        )

    def votes(self) -> list[int]:
        """1 for bad, -1 for good, 0 without opinion, as FORM lists the labellers."""

        def vote(value: float, good: float, bad: float, enough: bool = True) -> int:
            return 0 if not enough else 1 if value > bad else -1 if value <= good else 0

        return [
            vote(self.symbols, 0.02, 0.10, self.n_words >= 5),
            vote(self.shouts, 0.05, 0.30, self.n_words >= 5),
            vote(self.capitals, 0.15, 0.40, self.n_words >= 10),
            vote(self.repeats, 0.03, 0.20, self.n_words >= 10),
            vote(-self.distinct, -0.30, -0.15, 50 <= self.n_words <= 2000),
            vote(self.lines, 0.10, 0.50, self.n_words >= 20),
        ]

    def features(self) -> np.ndarray:
        """Buckets of the shares, hashed like words."""
        named = (
            ("symbols", self.symbols), ("shouts", self.shouts), ("capitals", self.capitals),
            ("repeats", self.repeats), ("distinct", self.distinct), ("lines", self.lines),
        )
        return np.array([zlib.crc32(f"{k}:{min(10, int(10 * v))}".encode()) % BUCKETS for k, v in named], np.int64)


def features(words: np.ndarray, stems: np.ndarray, measures: Measures) -> np.ndarray:
    """The scorer's distinct inputs: which words and stems a text has, and its shares."""
    hashed = (mix(np.concatenate([words, stems])) % np.uint64(BUCKETS)).astype(np.int64)
    return np.unique(np.concatenate([hashed, measures.features()]))


def sampled(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows, the same ones whenever asked: those whose key hashes lowest."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sketch(words: np.ndarray) -> np.ndarray:
    """The least hash of three words in a row: mostly the same for near copies, hardly
    ever for others."""
    hashes = window_hashes(words, 3) if len(words) >= 3 else mix(words)
    return (hashes.min() if len(hashes) else np.uint64(0)).view(np.int64)


def abuse_lists(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_TEXTS) -> list[np.ndarray]:
    """Three lists of words and stems, each from a third of at most ``limit`` labelled
    texts: those that six toxic texts or more and a twenty-fifth of them have, and that are
    at least twenty times as common there as in others.

    Without labels the lists are empty and their labellers abstain.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    # Of labels that disagree the graver one counts.
    marked = marked.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = sampled(marked, limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = texts.join(F.broadcast(marked), "doc_id").select("doc_id", "text", "toxic")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words_and_stems([t.as_py() or b"" for t in batch.column(1).cast(pa.large_binary())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([sketch(w).item() for w, _ in found], pa.int64()),
                    pa.array([np.unique(np.concatenate(w)).tobytes() for w in found], pa.binary()),
                ],
                names=["doc_id", "toxic", "sketch", "words"],
            )

    # Per third and word, in how many toxic and other texts it is: sums over tasks.
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            third = [(d or 0) % len(ABUSE) for d in batch.column(0).to_pylist()]
            words = [np.frombuffer(w.as_py(), np.int64) for w in batch.column(3)]
            sizes = [len(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(third, np.int64), sizes) if sizes else [], pa.int64()),
                    pa.array(np.concatenate(words) if words else [], pa.int64()),
                    pa.array(np.repeat(np.array(batch.column(1).to_pylist(), np.int64), sizes) if sizes else [], pa.int64()),
                ],
                names=["third", "word", "toxic"],
            )

    # Copies of one toxic text would make all of its words look abusive.
    sketched = chosen.mapInArrow(run, "doc_id long, toxic int, sketch long, words binary")
    first = sketched.groupBy("sketch", "toxic").agg(F.min(F.struct("doc_id", "words")).alias("first"))
    words_of = stored(first.select("first.doc_id", "toxic", "sketch", "first.words"), "labelled")
    sizes = words_of.groupBy((F.col("doc_id") % len(ABUSE)).alias("third")).agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("bad_texts"),
        F.sum((F.col("toxic") != 1).cast("long")).alias("good_texts"),
    )
    common = words_of.mapInArrow(count, "third long, word long, toxic long").groupBy("third", "word").agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("bad"), F.sum((F.col("toxic") != 1).cast("long")).alias("good")
    )
    telling = common.filter("bad >= 6").join(F.broadcast(sizes), "third").filter(
        (F.col("bad") / F.col("bad_texts")) >= 20 * (F.col("good") + 0.5) / (F.col("good_texts") + 1)
    )
    # A word of an ordinary toxic text is in few toxic texts; a word of abuse is in many.
    telling = telling.filter(F.col("bad") >= 0.04 * F.col("bad_texts"))
    found: list[list[int]] = [[] for _ in ABUSE]
    for row in telling.select("third", "word").collect():  # each is in a twenty-fifth of the toxic texts, so there are few
        found[row["third"]].append(row["word"])
    return [np.sort(np.array(x, np.int64).view(np.uint64)) for x in found]


def labelled(docs: DataFrame, lists: list[np.ndarray]) -> DataFrame:
    """Every labeller's vote on every text: 1 bad, -1 good, 0 none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            rows = []
            for text, (words, stems) in zip(texts, words_and_stems(texts), strict=True):
                both = np.concatenate([words, stems])
                abuse = [0 if not len(x) or not len(words) else 1 if np.isin(both, x).any() else -1 for x in lists]
                rows.append((*Measures.of(text, words).votes(), *abuse))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *[pa.array(c, pa.int32()) for c in columns]], names=["doc_id", *FORM, *ABUSE]
            )

    schema = "doc_id long, " + ", ".join(f"{n} int" for n in (*FORM, *ABUSE))
    return _slim(docs).mapInArrow(run, schema)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Where estimation starts: the share of bad texts, a labeller's chance to accuse a
#: good and a bad one if it votes, and the weight of these in each round's sums, as a
#: share of all texts. A labeller knows one kind of fault, so its content makes a text
#: likelier good by no more than CONTENT; and its chance to accuse a good text never
#: rises above ACCUSES_GOOD, or a fault that it alone knows would count as its error.
BAD, ACCUSES_GOOD, ACCUSES_BAD, BELIEF, CONTENT = 0.15, 0.001, 0.15, 0.01, 1.2


def agreement(votes: np.ndarray, n: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (a row each, ``n`` texts).

    Returns the posterior probability of "bad" for each pattern, and the labellers'
    accuracies. Each labeller has a chance to accuse a bad and a good text if it votes,
    and is held so that it accuses bad texts more often; abstaining says nothing.
    """
    against, content = votes > 0, votes < 0
    bad, good = np.full(votes.shape[1], ACCUSES_BAD), np.full(votes.shape[1], ACCUSES_GOOD)
    share, posterior, held = BAD, np.zeros(len(n)), max(BELIEF * n.sum(), 1e-9)
    for _ in range(rounds):
        log_bad = np.log(share) + against @ np.log(bad) + content @ np.log(1 - bad)
        log_good = np.log(1 - share) + against @ np.log(good) + content @ np.log(1 - good)
        posterior = 1 / (1 + np.exp(np.clip(log_good - log_bad, -500, 500)))
        of_bad, of_good = n * posterior, n * (1 - posterior)
        bad = (of_bad @ against + held * ACCUSES_BAD) / (of_bad @ (against | content) + held)
        good = (of_good @ against + held * ACCUSES_GOOD) / (of_good @ (against | content) + held)
        good = np.minimum(good, ACCUSES_GOOD)
        bad = np.minimum(bad, 1 - (1 - good) / CONTENT)
        turned = bad <= good
        bad[turned], good[turned] = ACCUSES_BAD, ACCUSES_GOOD
        share = min(0.5, max(0.01, of_bad.sum() / max(1, n.sum())))
    return posterior, share * bad + (1 - share) * (1 - good)


def fit(
    inputs: list[np.ndarray], target: np.ndarray, epochs: int = 20, rate: float = 0.3, sparse: float = 4.0, even: float = 0.01
) -> tuple[np.ndarray, float]:
    """Logistic regression on distinct hashed inputs, text by text in a fixed random
    order, each input at a pace that slows as it learns. An input's weight stays zero
    until its slopes add up past ``sparse``, so that long texts do not add up noise."""
    drawn, pull = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        z = pull[at]
        return np.where(np.abs(z) <= sparse, 0.0, (np.sign(z) * sparse - z) / ((1 + np.sqrt(drawn[at])) / rate + even))

    # The last weight is the bias.
    rows = [np.append(x, BUCKETS) for x in inputs]
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at = rows[k]
            now = weights(at)
            slope = 1 / (1 + np.exp(-np.clip(now.sum(), -40, 40))) - target[k]
            squared = drawn[at]
            drawn[at] = squared + slope * slope
            pull[at] += slope - (np.sqrt(drawn[at]) - np.sqrt(squared)) / rate * now
    found = weights(slice(None))
    return found[:BUCKETS].astype(np.float32), float(found[BUCKETS])


@dataclass
class Model:
    """The two scorers, and how far each labeller was trusted."""

    form: np.ndarray
    form_bias: float
    abuse: np.ndarray
    abuse_bias: float
    accuracy: dict[str, float]

    def scores(self, inputs: np.ndarray) -> tuple[float, float]:
        """Probability of good form, and of abuse."""
        form = float(self.form[inputs].sum()) + self.form_bias
        abuse = float(self.abuse[inputs].sum()) + self.abuse_bias
        return 1 / (1 + np.exp(np.clip(form, -40, 40))), 1 / (1 + np.exp(-np.clip(abuse, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, texts: int = TRAIN_TEXTS, labelled_texts: int = LABELLED_TEXTS) -> Model:
    """Votes are counted over all documents; the scorer is fitted on at most ``texts``
    of them, half by number and half among those that some labeller accuses."""
    lists = abuse_lists(docs, labels, labelled_texts)
    votes = stored(labelled(docs, lists), "votes")
    names = [*FORM, *ABUSE]
    patterns = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()  # 3 ** 9 rows at most
    accuracy: dict[str, float] = {}
    posterior: dict[str, dict[tuple, float]] = {}
    for kind, group in (("form", FORM), ("abuse", ABUSE)):
        merged: dict[tuple, int] = {}
        for p in patterns:
            key = tuple(p[x] for x in group)
            merged[key] = merged.get(key, 0) + p["n"]
        keys = sorted(merged)
        found, right = agreement(np.array(keys).reshape(len(keys), len(group)), np.array([merged[k] for k in keys], float))
        posterior[kind] = dict(zip(keys, found.tolist(), strict=True))
        accuracy |= dict(zip(group, right.tolist(), strict=True))
    accused = " OR ".join(f"{x} = 1" for x in names)
    rows = votes.filter("doc_id IS NOT NULL")
    chosen = sampled(rows, texts // 2).union(sampled(rows.filter(accused), texts // 2))
    chosen = chosen.groupBy("doc_id").agg(F.min(F.struct(*names)).alias("votes")).select("doc_id", "votes.*")
    inputs = _slim(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.as_py() or b"" for t in batch.column(1).cast(pa.large_binary())]
            found = [
                features(w, s, Measures.of(t, w)).astype("<u4").tobytes()
                for t, (w, s) in zip(raw, words_and_stems(raw), strict=True)
            ]
            votes_ = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), *votes_], names=["doc_id", "inputs", *names])

    schema = "doc_id long, inputs binary, " + ", ".join(f"{n} int" for n in names)
    # Of texts with one number the one with the least inputs stands for all.
    drawn = stored(inputs.mapInArrow(run, schema), "inputs").groupBy("doc_id").agg(F.min(F.struct("inputs", *names)).alias("of"))
    sample = sorted(drawn.select("doc_id", "of.*").collect(), key=lambda r: r["doc_id"])
    x = [np.frombuffer(r["inputs"], "<u4").astype(np.int64) for r in sample]
    form, form_bias = fit(x, np.array([posterior["form"][tuple(r[k] for k in FORM)] for r in sample]))
    abuse, abuse_bias = fit(x, np.array([posterior["abuse"][tuple(r[k] for k in ABUSE)] for r in sample]))
    return Model(form, form_bias, abuse, abuse_bias, accuracy)


def score(docs: DataFrame, model: Model, least_quality: float = 0.5, most_abuse: float = 0.85) -> DataFrame:
    """``doc_id``, ``n_words``, ``quality`` and ``abuse`` (probabilities) and ``kept`` of
    every document: at least the one and less than the other.

    The weights are of fixed size. A null or empty text has no words and gets the
    scores of its measures alone. Repeated rows and null numbers each give their row;
    other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in read(batches):
            rows = []
            for text, (words, stems) in zip(texts, words_and_stems(texts), strict=True):
                rows.append((len(words), *model.scores(features(words, stems, Measures.of(text, words)))))
            counts, quality, abuse = zip(*rows, strict=True)
            kept = [q >= least_quality and a < most_abuse for q, a in zip(quality, abuse, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(quality, pa.float64()), pa.array(abuse, pa.float64()), pa.array(kept, pa.bool_())],
                names=["doc_id", "n_words", "quality", "abuse", "kept"],
            )

    return _slim(docs).mapInArrow(run, "doc_id long, n_words long, quality double, abuse double, kept boolean")
