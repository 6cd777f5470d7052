"""Toxic passages by maximum-scoring segments over token log-odds.

Token log-odds come from labelled documents with a Dirichlet prior; a word's features are itself and its proper
beginnings, so that inflected and compounded forms share evidence. Features whose log-odds are significantly above zero
form the lexicon; a word scores its best feature, all other words share one background score. Texts of the same words in the
same order count once in learning. A linear scan (Ruzzo and Tompa) finds every maximal segment. Scores of clean documents follow an extreme-value law in document length; its fit turns a segment's
score into a significance, and a logistic curve over the sum of significances gives the probability.

Learning uses at most ``sample`` labelled rows (those of smallest hash), a documented bound; scoring is one map pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from fathomline.llm.shared import checkpointed
from fathomline.llm.wordvec import Words, chunks, column, mix, tokenise

#: Labelled rows to learn from, at most; and the z-score and log-odds at which a feature enters the lexicon.
SAMPLE = 20_000
Z_LEAST, ODDS_LEAST = 3.2, 2.0
#: Dirichlet prior: documents of each class in which any feature counts as seen beforehand.
PRIOR = 0.5
#: Bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
EULER = 0.5772156649
#: What scoring adds to a row.
SCORED = [StructField("score", DoubleType()), StructField("segments", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])))]


@dataclass
class Model:
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    background: float = -0.01
    decay: float = 1.0  # of the extreme-value law
    log_k: float = 0.0
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)  # logistic curve over (significance, segments)

    def __post_init__(self):
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _find(self, at: np.ndarray, hashes: np.ndarray, best: dict[int, float]) -> None:
        maybe = np.flatnonzero(self.sieve[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[k] == hashes[maybe]
        for place, weight in zip(at[maybe[same]].tolist(), self.weights[k[same]].tolist(), strict=True):
            best[place] = max(weight, best.get(place, 0.0))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of words with a lexicon feature, ascending, and the weight of the best."""
        best: dict[int, float] = {}
        if len(self.hashes) and len(words.start):
            self._find(np.arange(len(words.start)), words.hashes(), best)
            for at, hashes in words.beginnings(BEGINNINGS):
                self._find(at, hashes, best)
        places = sorted(best)
        return np.array(places, np.int64), np.array([best[p] for p in places])


def segments(places: list[int], weights: list[float], background: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score); every place not listed scores ``background`` (below zero).

    Each segment found points to the nearest one before it whose sum before is less; the search goes along these pointers,
    so that no segment is passed twice and the scan is linear.
    """
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at end, pointer
    total, last = 0.0, -1
    for place, weight in zip(places, weights, strict=True):
        total += background * (place - last - 1)
        last = place
        before, total = total, total + weight
        if weight <= 0:
            continue
        start, end, low, high = place, place + 1, before, total
        j = len(found) - 1
        while j >= 0 and found[j][2] >= low:
            j = found[j][4]
        while j >= 0 and found[j][3] < high:
            start, _, low, _, onward = found[j]
            del found[j:]
            j = onward
        found.append((start, end, low, high, j))
    return [(a, b, r - l) for a, b, l, r, _ in found]


def _significance(score: float, n: int, model: Model) -> float:
    """Minus the log of the chance that n clean tokens hold such a segment."""
    x = model.decay * score - math.log(max(n, 1)) - model.log_k
    if x > 30:
        return x
    return -math.log(-math.expm1(-math.exp(-x))) if x > -3.5 else 0.0


def _scan(texts: pa.Array, model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    words = tokenise(texts, lower=True, items=True)
    at, weight = model.hits(words)
    cut = np.searchsorted(at, words.first)
    for d, n in enumerate(words.counts.tolist()):
        low, high = cut[d], cut[d + 1]
        yield n, segments((at[low:high] - words.first[d]).tolist(), weight[low:high].tolist(), model.background) if high > low else []


def _features(n: int, found: list[tuple[int, int, float]], model: Model) -> tuple[float, float]:
    rated = [_significance(s, n, model) for _, _, s in found]
    return math.log1p(sum(x for x in rated if x > 0.7)), math.log1p(sum(x > 3 for x in rated))


def _grouped(batches):
    """Adds a hash of all words of each text in their order, which only copies share."""
    for batch in chunks(batches):
        words = tokenise(column(batch, "text"), lower=True, items=True)
        place = np.arange(len(words.start)) - np.repeat(words.first[:-1], words.counts)
        sums = np.append(np.uint64(0), np.cumsum(mix(words.hashes() + mix(place.astype(np.uint64) + np.uint64(1)))))
        whole = sums[words.first[1:]] - sums[words.first[:-1]]
        yield pa.RecordBatch.from_arrays([column(batch, "text"), column(batch, "toxic").cast(pa.int32()), pa.array(whole.view(np.int64))], names=["text", "toxic", "kin"])


def _presence(batches):
    """For each feature, the toxic and the clean documents of this task that hold it."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in chunks(batches):
        words = tokenise(column(batch, "text"), lower=True, items=True)
        doc = words.doc_of_word()
        parts = [(doc, words.hashes()), *((doc[at], h) for at, h in words.beginnings(BEGINNINGS))]
        doc, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        held.append((h[new], column(batch, "toxic").to_numpy(zero_copy_only=False).astype(bool)[doc[new]]))
    if held:
        h, t = (np.concatenate(x) for x in zip(*held, strict=True))
        distinct, inverse = np.unique(h, return_inverse=True)
        hot = np.bincount(inverse, weights=t, minlength=len(distinct)).astype(np.int64)
        every = np.bincount(inverse, minlength=len(distinct))
        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(hot), pa.array(every - hot)], names=["word", "hot", "cold"])


def _sample_scores(model: Model):
    """Per labelled text: best segment, words, the curve's features and the weights of its lexicon words."""

    def score(batches):
        for batch in chunks(batches):
            words = tokenise(column(batch, "text"), lower=True, items=True)
            at, weight = model.hits(words)
            cut = np.searchsorted(at, words.first)
            rows = [(max((s for _, _, s in found), default=0.0), n, *_features(n, found, model), weight[cut[d] : cut[d + 1]].tolist()) for d, (n, found) in enumerate(_scan(column(batch, "text"), model))]
            best, n, a, b, w = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([column(batch, "toxic").cast(pa.int32()), pa.array(best, pa.float64()), pa.array(n, pa.int64()), pa.array(a, pa.float64()), pa.array(b, pa.float64()), pa.array(w, pa.list_(pa.float64()))], names=["toxic", "best", "n", "a", "b", "w"])

    return score


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> Model:
    """A model from labelled documents outside the held-out fold. Without toxic and clean examples nothing is toxic."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"), folds))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(known), F.col("_id") == F.col("doc_id")).select("text", "toxic")
    texts = texts.mapInArrow(_grouped, "text string, toxic int, kin long").groupBy("kin", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")
    texts = checkpointed(texts)
    size = {bool(r["toxic"]): r["n"] for r in texts.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Model()
    words = texts.mapInArrow(_presence, "word long, hot long, cold long").groupBy("word").agg(F.sum("hot").alias("hot"), F.sum("cold").alias("cold"))
    odds = lambda c, n: F.log((F.col(c) + PRIOR) / (n + PRIOR - F.col(c)))
    weight = odds("hot", size[True]) - odds("cold", size[False])
    z = weight / F.sqrt(1 / (F.col("hot") + PRIOR) + 1 / (F.col("cold") + PRIOR))
    picked = words.where((z >= Z_LEAST) & (weight >= ODDS_LEAST)).select("word", weight.alias("weight")).orderBy("word").collect()
    if not picked:
        return Model()
    hashes = np.array([r["word"] for r in picked], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], np.minimum(np.array([r["weight"] for r in picked]), 12.0)[order])
    scored = lambda: sorted(map(tuple, texts.mapInArrow(_sample_scores(model), "toxic int, best double, n long, a double, b double, w array<double>").collect()))
    rows = scored()
    share = {y: sum(len(r[5]) for r in rows if (r[0] > 0) == y) / max(sum(r[2] for r in rows if (r[0] > 0) == y), 1) for y in (True, False)}
    model.background = min(math.log(max(1 - share[True], 1e-3) / max(1 - share[False], 1e-3)), -0.005)
    cold = np.array([w for r in rows if r[0] == 0 for w in r[5]])
    n = max(sum(r[2] for r in rows if r[0] == 0), 1)
    low, high = 1e-3, 5.0
    mass = lambda d: float(np.exp(d * cold).sum() / n + (1 - len(cold) / n) * math.exp(d * model.background))
    for _ in range(60):  # the decay at which the moment generating function of clean scores is one
        low, high = ((low + high) / 2, high) if mass((low + high) / 2) < 1 else (low, (low + high) / 2)
    model.decay = min(max(low, 0.1), 1.0)
    fit = [model.decay * r[1] - math.log(max(r[2], 1)) for r in scored() if r[0] == 0 and r[2]]
    model.log_k = float(np.mean(fit)) - EULER if fit else 0.0
    rows = scored()
    model.curve = tuple(_logistic(np.array([[r[3], r[4]] for r in rows]), np.array([r[0] > 0 for r in rows], float)))
    return model


def _scorer(model: Model, text: str):
    """Rows come as one struct; its text is read where it lies, so that it travels once."""

    def score(batches):
        rows = (column(batch, "row") for batch in batches)
        for batch in chunks(pa.RecordBatch.from_arrays([row, row.field(text)], names=["row", "text"]) for row in rows):
            chance, found_ = [], []
            for n, found in _scan(column(batch, "text"), model):
                a, b = _features(n, found, model)
                z = model.curve[0] + model.curve[1] * a + model.curve[2] * b
                chance.append(1 / (1 + math.exp(-max(min(z, 35.0), -35.0))))
                found_.append([{"start": s, "end": e, "score": v} for s, e, v in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array(chance, pa.float64()), pa.array(found_, kind)], names=["row", "score", "segments"])

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, model: Model | None = None) -> DataFrame:
    """Per document: row (all its columns), held_out, score, predicted, segments (word places and scores).

    Null and empty texts score as texts without any toxic segment; a null doc_id is never held out nor learnt from;
    repeated rows are scored each; repeated labels count once, toxic if any says so. Needs columns doc_id and text.
    """
    model = train(docs, labels, folds) if model is None else model
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = next(c for c in docs.columns if c.lower() == "text")
    schema = StructType([packed.schema["row"], *SCORED])
    out = packed.mapInArrow(_scorer(model, text), schema)
    return out.select("row", held_out(F.col("row.doc_id"), folds).alias("held_out"), "score", F.expr("CAST(score >= 0.5 AS INT)").alias("predicted"), "segments")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with all their columns. Null and empty texts stay, each of repeated rows is
    judged alike, a null doc_id matters to nothing; without labels of both classes all stay; columns may have any names."""
    return score_toxicity(docs, labels).where("predicted = 0").select("row.*")
