"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

Every word has an index vector, sparse and random, made from a hash of the
word. The vector of a word is the sum of the index vectors of the words near
its occurrences in the sample, plus its own, scaled to length one. Words that
are rare in the sample share the vector of their shape (capital, title, number,
punctuation mark and so on), so every token of every text has one. A document
is the mean of its word vectors with a few counts of repetition; the network
is trained on that.
"""

from __future__ import annotations

import operator
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.labelled import append_scores, held_out, sample

#: size of vectors, entries that are not zero, words to either side, words kept, least occurrences
DIM, NONZERO, WINDOW, WORDS, LEAST = 64, 8, 2, 30_000, 5
HIDDEN, ROUNDS, RATE, DECAY = 32, 120, 0.01, 1e-3
THRESHOLD = 0.5
CACHED_WORDS = 200_000
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def shape(word: str) -> str:
    """The shape that stands for a rare word."""
    if not (word[0].isalnum()):
        return f"<mark {word[0]}{min(len(word), 3)}>"
    if any(c.isdigit() for c in word):
        return "<number>" if word.isdigit() else "<mixed>"
    if len(word) > 30:
        return "<long>"
    if word.isupper():
        return "<capital>" if len(word) > 1 else "<letter>"
    return "<title>" if word[0].isupper() else "<word>"


def index_vector(word: str) -> np.ndarray:
    from xxhash import xxh64_intdigest
    rng = np.random.default_rng(xxh64_intdigest(word.encode("utf-8", "replace"), 3))
    v = np.zeros(DIM, np.float32)
    v[rng.choice(DIM, NONZERO, replace=False)] = rng.choice((-1.0, 1.0), NONZERO)
    return v


class Words(dict):
    """Token to row of the vectors; tokens without a row get that of their
    shape, remembered in a table of bounded size."""

    def __init__(self, rows: dict[str, int]):
        super().__init__(rows)
        self.rows = rows

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.rows) + CACHED_WORDS:
            self.clear()
            self.update(self.rows)
        row = self[word] = self.rows.get(shape(word), 0)
        return row


def word_vectors(texts: list[list[str]]) -> tuple[dict[str, int], np.ndarray]:
    counts = Counter(w for t in texts for w in t)
    kept = sorted((w for w, n in counts.items() if n >= LEAST), key=lambda w: (-counts[w], w))[:WORDS]
    shapes = sorted({shape(w) for w in counts} | {"<word>"})
    rows = {w: i for i, w in enumerate(["<none>", *shapes, *kept])}
    index = np.stack([index_vector(w) for w in rows])
    total = index.copy()
    find = Words(rows)
    ids = np.fromiter((find[w] for t in texts for w in t), np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for gap in range(1, WINDOW + 1):
        same = np.nonzero(text[:-gap] == text[gap:])[0]
        for x, y in ((ids[same], ids[same + gap]), (ids[same + gap], ids[same])):
            for at in range(0, len(x), 1 << 16):  # bounded memory
                order = np.argsort(x[at:at + (1 << 16)], kind="stable") + at
                word, first = np.unique(x[order], return_index=True)
                total[word] += np.add.reduceat(index[y[order]], first, axis=0)
    total[0] = 0
    length = np.linalg.norm(total, axis=1, keepdims=True)
    return rows, (total / np.maximum(length, 1e-9)).astype(np.float32)


def features(tokens: list[str], find: Words, vectors: np.ndarray) -> np.ndarray:
    """Mean vector, then length and repetition; zeros for no tokens."""
    n = len(tokens)
    out = np.zeros(DIM + 5, np.float64)
    if n:
        row, times = np.unique(np.fromiter(map(find.__getitem__, tokens), np.int64, n), return_counts=True)
        for at in range(0, len(row), 1 << 15):
            out[:DIM] += times[at:at + (1 << 15)] @ vectors[row[at:at + (1 << 15)]]
        out[:DIM] /= n
        out[DIM:] = (np.log1p(n), sum(map(operator.eq, tokens, tokens[1:])) / n,
                     sum(map(operator.eq, tokens, tokens[2:])) / n, len(set(tokens)) / n, times.max() / n)
    return out


class Model:
    """Vectors, network and temperature; ``constant`` instead if the labelled
    rows hold fewer than two kinds."""

    def __init__(self, rows: list, totals: dict, seed: int = 17):
        self.constant = None
        if min(sum(r[1] == y for r in rows) for y in (0, 1)) < 2:
            n = sum(totals.values())
            self.constant = (totals.get(1, 0) + 1) / (n + 2)
            return
        texts = [TOKEN.findall(r[0]) for r in rows]
        self.rows, self.vectors = word_vectors(texts)
        find = Words(self.rows)
        x = np.stack([features(t, find, self.vectors) for t in texts])
        y, w = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        part = np.arange(len(x)) % 5 == 0  # kept for the temperature
        if min(y[part].sum(), (1 - y[part]).sum()) < 1:
            part[:] = False
        self._train(x[~part], y[~part], w[~part], np.random.default_rng(seed))
        self.temperature = 1.0
        x, y, w = (x[part], y[part], w[part]) if part.any() else (x, y, w)
        z = self._logits(x)
        losses = {t: (w * np.logaddexp(0, np.where(y > 0, -z, z) / t)).sum() for t in np.geomspace(0.25, 8, 41)}
        self.temperature = float(min(losses, key=losses.get))

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def _train(self, x, y, w, rng) -> None:
        """Adam on the weighted log loss; classes weigh alike in the gradient,
        and the shift of the odds that this makes is taken back at the end."""
        share = float((w * y).sum() / w.sum())
        w = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
        self.w1, self.b1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())
        names = ("w1", "b1", "w2", "b2")
        m, v, step = ({n: np.zeros_like(getattr(self, n)) for n in names} for _ in range(2)), None, 0
        m, v = m
        for _ in range(ROUNDS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                i = order[at:at + 256]
                h = np.tanh(x[i] @ self.w1 + self.b1)
                p = 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -30, 30)))
                d = w[i] * (p - y[i]) / len(i)
                back = d[:, None] * self.w2 * (1 - h * h)
                grads = {"w1": x[i].T @ back + DECAY * self.w1, "b1": back.sum(axis=0),
                         "w2": h.T @ d + DECAY * self.w2, "b2": d.sum()}
                step += 1
                for n in names:
                    m[n] = 0.9 * m[n] + 0.1 * grads[n]
                    v[n] = 0.999 * v[n] + 0.001 * grads[n] ** 2
                    setattr(self, n, getattr(self, n) - RATE * (m[n] / (1 - 0.9 ** step))
                            / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8))
        self.b2 = self.b2 + np.log(share / (1 - share))

    def scorer(self):
        if self.constant is not None:
            return lambda texts: [[self.constant] * len(texts)]
        find = Words(self.rows)

        def score(texts: list[str]) -> list[list[float]]:
            x = np.stack([features(TOKEN.findall(t), find, self.vectors) for t in texts])
            z = self._logits((x - self.mean) / self.scale) / self.temperature
            return [(1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()]
        return score


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", parts: int = 3, part: int = 1,
        id_col: str = "doc_id", text_col: str = "text", **bounds) -> Model:
    """Learns from labelled rows outside the held-out part, at most
    ``per_class`` of each label and none longer than ``most_chars``."""
    return Model(*sample(docs, labels, target, parts, part, id_col=id_col, text_col=text_col, **bounds))


def with_score(docs: DataFrame, model: Model, keep: list[str] | None = None, out_col: str = "score",
               text_col: str = "text") -> DataFrame:
    """``keep`` (all columns unless given) and the probability of label 1.

    Null and empty texts get the score of a document without tokens; texts of
    any length are scored whole; repeated rows score alike; a column named
    ``out_col`` is replaced; no rows give no rows. Without two kinds of
    labelled rows every score is the smoothed rate of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c != out_col]
    return append_scores(docs, lambda: shared.value.scorer(), [(out_col, "double")], keep, text_col)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    out = with_score(docs, fit(docs, labels, **options), keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id", options.get("parts", 3), options.get("part", 1)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
