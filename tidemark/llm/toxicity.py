"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; the model of a category sees the probabilities of
the categories before it beside the text.  While fitting, those probabilities are out-of-fold
predictions, so a later model does not learn to trust scores its predecessors gave to their own
training rows.  The models are L2 logistic regressions on the presence of the words and
word stems that discriminate most, and a few measures of the whole text.

The chain is fitted in one task on at most ``TRAIN_ROWS`` labelled documents, drawn by hash; all
documents are scored by a narrow pass.

Defined results: without labelled rows all probabilities are 0; null and word-less texts are
scored as texts without words and are never toxic; labels that are null do not count; of several
labels for a document each is a training row; other columns are never read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored

TRAIN_ROWS = 8_000
VOCABULARY = 768
FOLDS = 3
STEPS = 200
RIDGE = 5.0  # divided by the training rows
LEAST_SPREAD = 0.05  # added to a column's spread: one that hardly varies is not stretched
THRESHOLD = 0.5
# Category and the condition on the columns of ``labels``, in the order of the chain.
CHAIN: tuple[tuple[str, str], ...] = (
    ("low_quality", "quality = 0"),
    ("toxic", "toxic = 1"),
)
# Lower-cases A-Z and blanks all ASCII but letters.
FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))


def words(raw: bytes | None) -> set[str]:
    """A text's words and their stems, the first 4, 5 and 6 characters (marked)."""
    own = set(raw.translate(FOLD).decode().split()) if raw else set()
    return own.union([w[:4] + "*" for w in own], [w[:5] + "*" for w in own if len(w) > 4],
                     [w[:6] + "*" for w in own if len(w) > 5])


def measures(raw: bytes | None) -> list[float]:
    raw = raw or b""
    n = max(len(raw), 1)
    return [(len(raw) - len(raw.translate(None, SYMBOLS))) / n * 10, (len(raw) - len(raw.translate(None, UPPER))) / n,
            min(len(raw), 100_000) ** 0.5 / 300]


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> np.ndarray:
    """Weights, the last one the intercept, by accelerated gradient descent on columns of one scale."""
    ridge = ridge / len(x)
    scale = 1 / (x.std(axis=0) + LEAST_SPREAD)
    middle = x.mean(axis=0)
    z = np.hstack([(x - middle) * scale, np.ones((len(x), 1), x.dtype)])
    vector = np.ones(z.shape[1], x.dtype)
    for _ in range(15):  # the greatest curvature, by power iteration
        vector = z.T @ (z @ vector)
        vector /= np.linalg.norm(vector) or 1
    rate = 1 / (1.1 * float(np.linalg.norm(z @ vector) ** 2) / len(z) / 4 + ridge)
    penalty = np.full(z.shape[1], ridge, x.dtype)
    penalty[-1] = 0
    w = ahead = np.zeros(z.shape[1], x.dtype)
    for step in range(steps):
        gradient = z.T @ (_probability(z @ ahead) - y) / len(z) + penalty * ahead
        after = ahead - rate * gradient
        ahead = after + (step / (step + 3)) * (after - w)
        w = after
    weights = w[:-1] * scale
    return np.append(weights, w[-1] - middle @ weights)


@dataclass
class Chain:
    vocabulary: dict[str, int]
    weights: list[np.ndarray]  # by category: words, measures, categories before, intercept

    def score(self, raw: bytes | None) -> list[float]:
        known = [self.vocabulary[w] for w in self.vocabulary.keys() & words(raw)]
        dense = measures(raw)
        for w in self.weights:
            before = len(dense)
            z = w[known].sum() + float(np.dot(w[len(self.vocabulary):len(self.vocabulary) + before], dense)) + w[-1]
            dense.append(float(_probability(z)))
        return dense[3:]


def choose_words(texts: list[set[str]], y: np.ndarray, most: int) -> dict[str, int]:
    """The words with the greatest chi-square in any category, above what chance gives.

    Of as many words and categories without any effect, the greatest chi-square is about twice
    the logarithm of their number: words below that only fit the noise of the training rows.
    """
    count = Counter(w for text in texts for w in text)
    common = sorted(w for w, n in count.items() if n >= 3)
    place = {w: k for k, w in enumerate(common)}
    n = np.array([count[w] for w in common], float)
    best = np.zeros(len(common))
    for k in range(y.shape[1]):
        with_label = np.zeros(len(common))
        for text, flag in zip(texts, y[:, k]):
            if flag:
                with_label[[place[w] for w in text if w in place]] += 1
        share = y[:, k].mean()
        if 0 < share < 1:
            best = np.maximum(best, (with_label - n * share) ** 2 / (n * share * (1 - share)))
    bound = 2 * np.log(max(2, len(common) * y.shape[1]))
    order = [k for k in np.argsort(-best, kind="stable")[:most] if best[k] > bound]
    return {common[k]: i for i, k in enumerate(order)}


def fit_chain(raws: list[bytes | None], y: np.ndarray, folds: np.ndarray) -> Chain:
    texts = [words(raw) for raw in raws]
    vocabulary = choose_words(texts, y, VOCABULARY)
    x = np.zeros((len(raws), len(vocabulary) + 3 + y.shape[1] - 1), np.float32)
    for i, (raw, text) in enumerate(zip(raws, texts)):
        x[i, [vocabulary[w] for w in vocabulary.keys() & text]] = 1
        x[i, len(vocabulary):len(vocabulary) + 3] = measures(raw)
    weights = []
    for k in range(y.shape[1]):
        width = len(vocabulary) + 3 + k
        target = y[:, k].astype(np.float32)
        if k < y.shape[1] - 1:
            for fold in range(FOLDS):
                out = folds == fold
                if out.any() and (~out).any():
                    w = fit_logistic(x[~out, :width], target[~out])
                    x[out, width] = _probability(x[out, :width] @ w[:-1] + w[-1])
        weights.append(fit_logistic(x[:, :width], target))
    return Chain(vocabulary, weights)


def _fold(column: str) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(29)), F.lit(FOLDS)).cast("int")


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          chain: tuple[tuple[str, str], ...] = CHAIN, train_rows: int = TRAIN_ROWS) -> Chain | None:
    flags = [F.coalesce(F.expr(condition), F.lit(False)).alias(f"y{k}") for k, (_, condition) in enumerate(chain)]
    rows = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL") \
        .select("doc_id", *flags).orderBy(F.xxhash64("doc_id"), "doc_id", *[f"y{k}" for k in range(len(chain))]).limit(train_rows)
    drawn = stored(rows, "labels-drawn")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sample = drawn.join(texts, "doc_id").select("doc_id", "text", _fold("doc_id").alias("fold"),
                                                *[f"y{k}" for k in range(len(chain))])

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in zip(
            batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
            *(c.to_pylist() for c in batch.columns[2:]))]
        if held:
            held.sort(key=lambda row: (row[0], row[1] or b"", row[3:]))
            model = fit_chain([r[1] for r in held], np.array([r[3:] for r in held], bool), np.array([r[2] for r in held]))
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.repartition(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def score(docs: DataFrame, model: Chain | None, *, doc_id: str = "doc_id", text: str = "text",
          chain: tuple[tuple[str, str], ...] = CHAIN) -> DataFrame:
    """Per row: doc_id, a probability for each category and ``toxic``."""
    names = [name for name, _ in chain]

    def run(batch: pa.RecordBatch) -> dict:
        raws = batch.column(1).cast(pa.binary()).to_pylist()
        found = [model.score(raw) if model else [0.0] * len(names) for raw in raws]
        out = {f"p_{name}": [f[k] for f in found] for k, name in enumerate(names)}
        which = names.index("toxic")
        return {"doc_id": batch.column(0), **out,
                "toxic": [f[which] >= THRESHOLD and bool(words(raw)) for f, raw in zip(found, raws)]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, " + "".join(f"p_{n} double, " for n in names) + "toxic boolean")
