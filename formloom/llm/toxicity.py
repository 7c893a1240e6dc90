"""Toxicity by weak supervision.

Voters are lexicon entries (words and word beginnings) and patterns that the labelled sample suggests, and the human
label itself. A generative label model holds the rate at which each voter fires for either class, estimated by
expectation maximisation from the votes alone: the human label is one more voter, whose accuracy is estimated like any
other's. It also holds the correlations of voters given the class: voters that fire together count less. A linear
classifier is then trained on the posterior labels, over the voters and how many different entries a text holds. Only
the text is an input of a score.

Votes are cast on the executors: the driver sees which voters fire for a row of the bounded sample, and no text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.shared import Scratch

MAX_ROWS = 8000  # labelled rows that the model is fitted on
CORRELATED = 0.5  # residual votes with so much correlation or more are taken to depend on each other
LEAST_G = 25.0  # bound on the log-likelihood ratio statistic of an entry: none among a million is expected to pass by chance
WORD = re.compile(r"[^\W\d_]+")
STEMS, COUNTS = (4, 5, 6, 7), 4
PATTERNS = (re.compile(r"!{3,}"), re.compile(r"\b(?:you|your|tu|du|usted)\b"), re.compile(r"\b(?:hate|kill|shut up)\b"))


def entries_of(word: str) -> list[str]:
    """A word as a lexicon entry, and its beginnings (marked by a star)."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


@dataclass
class ToxicityModel:
    """weight: of each lexicon entry; pattern_weights, count_weights (distinct entries: 1, 2, 3, 4 and more), bias."""

    weight: dict[str, float]
    pattern_weights: list[float]
    count_weights: list[float]
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        weight = self.weight
        known, plain_words = self.__dict__.setdefault("_telling", {}), self.__dict__.setdefault("_plain_words", set())
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            plain = (text or "").lower()
            hit: set[str] = set()
            hits = 0
            if len(plain_words) > 400_000:  # a memo of words without an entry; any word can be looked up anew
                plain_words.clear()
            for word in set(WORD.findall(plain)) - plain_words:
                got = known.get(word) or tuple(e for e in entries_of(word) if e in weight)
                if got:
                    if len(known) < 400_000:
                        known[word] = got
                    hit.update(got)
                    hits += 1
                else:
                    plain_words.add(word)
            z = self.bias + sum(weight[e] for e in sorted(hit)) + sum(self.count_weights[: min(hits, len(self.count_weights))])
            out[k] = z + sum(w for w, p in zip(self.pattern_weights, PATTERNS, strict=True) if w and p.search(plain))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -35, 35)))


def telling(a: int, c: int, n1: int, n0: int) -> float:
    """The log-likelihood ratio statistic of an entry in a of n1 toxic and c of n0 other rows against equal rates."""
    both = (a + c) / (n1 + n0)
    return 2 * (a * np.log(a / n1 / both) + (c * np.log(c / n0 / both) if c else 0))


def lexicon(counts: Iterable[tuple[str, int, int]], n1: int, n0: int) -> list[str]:
    """Entries (entry, toxic rows, other rows) that stand in toxic rows oftener than in others, the most telling first."""
    n1, n0 = max(1, n1), max(1, n0)
    scored = [(-telling(a, c, n1, n0), e) for e, a, c in counts if a >= 5 and a * n0 > 4 * c * n1]
    return [e for g, e in sorted(scored) if -g >= LEAST_G]


def all_entries(text: str | None) -> set[str]:
    return {e for w in set(WORD.findall((text or "").lower())) for e in entries_of(w)}


def votes_of(text: str | None, place: dict[str, int]) -> list[int]:
    """The voters that fire for a text, in order: entries by their place, then patterns, then how many words hold an entry (1 to 4)."""
    plain = (text or "").lower()
    fired, hits = set(), 0
    for w in set(WORD.findall(plain)):
        got = [place[e] for e in entries_of(w) if e in place]
        fired.update(got)
        hits += bool(got)
    n = len(place)
    fired.update(n + k for k, p in enumerate(PATTERNS) if p.search(plain))
    fired.update(n + len(PATTERNS) + k for k in range(min(hits, COUNTS)))
    return sorted(fired)


def label_model(votes: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row, the rates (class, voter) at which voters fire, and their shares after correlation.

    The last voter is the human label y. The classes are hidden: expectation maximisation begins at what the labels say, with
    some doubt, which tells the two classes apart; then each round estimates the rates of all voters alike, until the
    posterior stays. Weak correlations are chance or what a third voter causes, and don't count.
    """
    voters = np.hstack([votes, y[:, None]]).astype(np.float32)
    post = np.where(y > 0, 0.9, 0.1)
    rates, share = np.full((2, voters.shape[1]), 0.5), np.ones(voters.shape[1])
    for _ in range(rounds):
        mass = np.stack([1 - post, post])
        rates = ((mass @ voters + 0.5) / (mass.sum(1, keepdims=True) + 1)).astype(np.float64)
        # correlation of voters given the class: of what is left of a vote after its expected value
        left = voters - np.stack([1 - post, post], axis=1).astype(np.float32) @ rates.astype(np.float32)
        left /= np.sqrt((left**2).sum(0)) + 1e-9
        related = np.clip(left.T @ left, 0, 1)
        share = 1 / np.maximum(1, np.where(related >= CORRELATED, related, 0).sum(0, dtype=np.float64))
        base = np.log((1 - rates[1]) / (1 - rates[0]))
        fires = np.log(rates[1] / rates[0]) - base
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        z = np.log(prior / (1 - prior)) + voters @ (share * fires) + (share * base).sum()
        before, post = post, 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(post - before).max() < 1e-4:
            break
    return post, rates, share


def linear(x: np.ndarray, target: np.ndarray, ridge: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Weights of a logistic regression on soft labels, bias last, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, ridge = np.zeros(x.shape[1]), np.append(ridge, 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(ridge)
        w = w - np.linalg.solve(h, x.T @ (p - target) + ridge * w)
    return w


def cut_of(z: np.ndarray, y: np.ndarray) -> float:
    """The logit that parts the labels of a calibration sample with the best F1, midway between its neighbours."""
    order = np.argsort(-z, kind="stable")
    found = np.cumsum(y[order])
    f1 = 2 * found / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    return float((z[order][k] + z[order][min(k + 1, len(y) - 1)]) / 2)


def flat_model(y: np.ndarray) -> ToxicityModel:
    """Scores every text by the share of label 1; none is toxic where nothing is labelled."""
    rate = float((y.sum() + 0.5) / (len(y) + 2))
    return ToxicityModel({}, [0.0] * len(PATTERNS), [0.0] * COUNTS, float(np.log(rate / (1 - rate))))


def fitted(entries: list[str], votes: list[list[int]], y: np.ndarray, calibrates: np.ndarray) -> ToxicityModel:
    """The model of the entries' votes. Rows that calibrate only move the bias, so that a score of 0.5 parts their labels best."""
    n = len(entries) + len(PATTERNS)
    x = np.zeros((len(y), n + COUNTS), dtype=np.float32)
    for k, fired in enumerate(votes):
        x[k, fired] = 1
    own, rest = ~calibrates, calibrates
    # voters that fire for the same rows are one voter: its weight is dealt to the first of them
    patterns: dict[bytes, int] = {}
    same = np.array([patterns.setdefault(column.tobytes(), len(patterns)) for column in np.packbits(x[own, :n] > 0, axis=0).T])
    first = np.array([int(np.argmax(same == g)) for g in range(len(patterns))])
    post, _, share = label_model(x[own][:, first], y[own])
    columns = np.append(first, n + np.arange(COUNTS))
    w = np.zeros(n + COUNTS)
    found = linear(x[own][:, columns], post, np.append(1 / share[:-1], np.ones(COUNTS)))
    # an entry that always fires with another takes its part of the weight, so that either alone still tells in a new text
    w[:n] = (found[: len(first)] / np.bincount(same))[same]
    w[n:] = found[len(first) : -1]
    rest = rest if rest.any() else own
    bias = float(found[-1]) - cut_of(x[rest] @ w + found[-1], y[rest])
    return ToxicityModel({e: float(w[k]) for k, e in enumerate(entries)}, [float(t) for t in w[len(entries) : n]], [float(t) for t in w[n:]], bias)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, toxic, calibrates) of at most max_rows labelled documents whose crc32(doc_id) mod 5 isn't 0, chosen by a hash of the id.

    Of several texts of an id that of the least hash counts, of several labels the greatest; a null text is empty. Every
    fourth row, by a hash of its id, calibrates.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"), F.max("toxic").alias("toxic"))
    return rows.select("doc_id", "t.text", (F.col("toxic") != 0).cast("int").alias("toxic"), (F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(4)) == 3).alias("calibrates"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fits on the bounded sample of training_rows: counts of entries and votes come from the executors, no text does.

    Without rows of both labels, or without a telling entry, every text is scored by the share of label 1.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(training_rows(docs, labels, max_rows), "training")
    sample = sorted((r.doc_id, r.toxic, r.calibrates) for r in rows.select("doc_id", "toxic", "calibrates").collect())
    y, calibrates = np.array([float(t) for _, t, _ in sample]), np.array([c for _, _, c in sample], dtype=bool)
    if min((y[~calibrates] > 0).sum(), (y[~calibrates] == 0).sum()) < 40:  # too few to spare some
        calibrates = np.zeros(len(y), bool)
    model = flat_model(y)
    if len(set(y)) == 2:
        own = rows.where("not calibrates") if calibrates.any() else rows

        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                    found = sorted(all_entries(text))
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["entry", "toxic"])

        counts = own.select("text", "toxic").mapInArrow(entries, "entry string, toxic int").groupBy("entry").agg(F.sum("toxic").alias("a"), F.count_if(F.col("toxic") == 0).alias("c"))
        n1, n0 = int(y[~calibrates].sum()), int((1 - y[~calibrates]).sum())
        often = counts.where((F.col("a") >= 5) & (F.col("a") * n0 > F.col("c") * 4 * n1))
        words = lexicon(((r.entry, r.a, r.c) for r in often.collect()), n1, n0)
        if words:
            place = {e: k for k, e in enumerate(words)}

            def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    fired = [votes_of(t, place) for t in batch.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fired, pa.list_(pa.int32()))], ["doc_id", "fired"])

            votes = sorted((r.doc_id, r.fired) for r in rows.select("doc_id", "text").mapInArrow(cast, "doc_id long, fired array<int>").collect())
            model = fitted(words, [v for _, v in votes], y, calibrates)
    scratch.drop()
    return model


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null text scores as an empty one. Each row is scored by its text alone: repeated rows get equal scores,
    other columns are not read, an empty table gives no rows. held_out is false for a null id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(batch.column(2).to_pylist()), pa.float64())], ["doc_id", "held_out", "score"])

    ids = F.col(id_column).cast("long")
    held_out = F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select(ids.alias("doc_id"), held_out.alias("held_out"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents whose text the trained model doesn't predict as toxic, with all their columns.

    A null text is judged as an empty one; repeated rows go or stay together; columns may have any names.
    """
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column("text").to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
