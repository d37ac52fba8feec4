"""Toxicity: a linear-chain conditional random field over tokens.

Token labels come from the document labels: a token of a toxic sample document
is labelled toxic if its word, or one of its prefixes, is found in toxic
documents far more often than in others. The field has two states (clean,
toxic); features of a token are its word, prefixes, suffix and shape. Forward-
backward marginals give each token a probability; a document's score is a
calibrated function of them, and runs of toxic tokens are its offending offsets.

All documents of a batch form one chain that starts anew at each document, and
the recursion runs over that chain in two levels (blocks of steps, then the
steps of all blocks at once), so one long document costs no more than many
short ones of the same total length.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.labelled import append_scores, held_out, sample

TOKEN = re.compile(r"\w+")
#: lengths of the prefixes and of the suffix that are features
PREFIXES, SUFFIX = (3, 4, 5), 3
#: how unevenly a feature must occur for its tokens to be labelled toxic: ratio of the rates, and features of its
#: frequency that may pass by chance
LEAST_RATIO, BY_CHANCE = 8.0, 0.5
#: toxic sample documents from which on the document score is fitted on a part of its own
OWN_PART = 60
ROUNDS, RATE, DECAY = 40, 0.25, 1e-5
PER_CLASS = 1200
THRESHOLD, SPAN_THRESHOLD = 0.3, 0.5
CACHED_WORDS = 200_000
CHAIN_TOKENS = 400_000


def marginals(emission: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability of state 1 at each token, and on demand the expected
    transitions (2 x 2) within documents. ``emission``: log odds of state 1;
    ``first``: whether a token begins a document; ``start``: distribution of
    the first state; ``move``: transition weights."""
    n = len(emission)
    if not n:
        return np.empty(0), np.zeros((2, 2)) if pairs else None
    steps = max(1, int(n ** 0.5))
    blocks = -(-n // steps)
    full = steps * blocks
    e = np.zeros(full)
    e[:n] = np.clip(emission, -30, 30)
    reset = np.ones(full, bool)
    reset[:n] = first
    # weights of (from, to) for entering a token; both states emit with weights of sum 1
    hot = 1 / (1 + np.exp(-e))
    m = np.where(reset[:, None, None], start[None, None, :], move[None]) * np.stack([1 - hot, hot], 1)[:, None, :]
    m = m.reshape(blocks, steps, 2, 2).transpose(1, 2, 3, 0).copy()  # step, from, to, block
    whole = m[0].copy()
    for k in range(1, steps):
        whole = _times(whole, m[k])
        whole /= whole.sum(axis=(0, 1))
    ahead, back = np.empty((2, blocks)), np.empty((2, blocks))  # on entry to a block; on leaving it
    a, b = np.array([0.5, 0.5]), np.array([0.5, 0.5])
    for c in range(blocks):
        ahead[:, c] = a
        a = a @ whole[:, :, c]
        a = a / a.sum()
    for c in range(blocks - 1, -1, -1):
        back[:, c] = b
        b = whole[:, :, c] @ b
        b = b / b.sum()
    alpha, beta = np.empty((steps, 2, blocks)), np.empty((steps, 2, blocks))
    a = ahead
    for k in range(steps):
        a = np.stack([a[0] * m[k, 0, 0] + a[1] * m[k, 1, 0], a[0] * m[k, 0, 1] + a[1] * m[k, 1, 1]])
        a = a / a.sum(axis=0)
        alpha[k] = a
    b = back
    for k in range(steps - 1, -1, -1):
        beta[k] = b
        b = np.stack([m[k, 0, 0] * b[0] + m[k, 0, 1] * b[1], m[k, 1, 0] * b[0] + m[k, 1, 1] * b[1]])
        b = b / b.sum(axis=0)
    both = alpha * beta
    p = (both[:, 1] / both.sum(axis=1)).T.reshape(-1)[:n]
    if not pairs:
        return p, None
    before = np.concatenate([ahead[None], alpha[:-1]])
    joint = before[:, :, None, :] * m * beta[:, None, :, :]
    joint = (joint / joint.sum(axis=(1, 2), keepdims=True)).transpose(3, 0, 1, 2).reshape(-1, 2, 2)[:n]
    return p, joint[~first].sum(axis=0)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.stack([np.stack([x[i, 0] * y[0, j] + x[i, 1] * y[1, j] for j in (0, 1)]) for i in (0, 1)])


def keys(word: str) -> list[str]:
    """Features of a token, as text."""
    low = word.lower()
    return ["w" + low, *["p" + low[:n] for n in PREFIXES if len(low) >= n], "s" + low[-SUFFIX:],
            "U" if word.isupper() else "T" if word[0].isupper() else "d" if word.isdigit() else "l"]


class Emissions(dict):
    """Log odds of a token from its features, in a table of bounded size."""

    def __init__(self, weights: dict[str, float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        weight = self.weights.get
        e = self[word] = self.bias + sum([weight(k, 0.0) for k in keys(word)])
        return e


def marked_features(texts: list[list[str]], labels: list[int]) -> set[str]:
    """Words and prefixes that mark toxic documents: by the ratio of their
    rates, and by the likelihood ratio of their document counts, which has to
    be the larger the more features are as frequent."""
    found = [Counter(), Counter()]
    for tokens, y in zip(texts, labels, strict=True):
        found[y].update({k for w in set(tokens) for k in keys(w) if k[0] in "wp"})
    n1, n0 = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    often = np.sort(np.array([n + found[0][k] for k, n in found[1].items()]
                             + [n for k, n in found[0].items() if k not in found[1]]))
    out = set()
    for k, a in found[1].items():
        b = found[0][k]
        if a < 2 or a / n1 < LEAST_RATIO * (b + 0.5) / n0:
            continue
        g = 0.0
        for got, size in ((a, n1), (b, n0)):
            rate = (a + b) / (n1 + n0)
            g += got * np.log(max(got, 1e-9) / (size * rate)) + (size - got) * np.log(
                max(size - got, 1e-9) / (size * (1 - rate) + 1e-9))
        if g >= np.log((len(often) - np.searchsorted(often, a + b)) / BY_CHANCE):
            out.add(k)
    return out


class Model:
    """Weights of the field and of the document score; ``constant`` instead if
    the labelled rows hold fewer than two kinds."""

    def __init__(self, rows: list, totals: dict):
        self.constant = None
        if min(sum(r[1] == y for r in rows) for y in (0, 1)) < 2:
            n = sum(totals.values())
            self.constant = (totals.get(1, 0) + 1) / (n + 2)
            return
        texts = [TOKEN.findall(r[0]) for r in rows]
        y, w = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
        fit = part = np.ones(len(rows), bool)
        if min(y.sum(), (1 - y).sum()) >= OWN_PART:
            part = np.arange(len(rows)) % 3 == 0  # kept for the document score
            fit = ~part
        learn = [t for t, f in zip(texts, fit, strict=True) if f]
        marks = marked_features(learn, y[fit].tolist())
        self._train(learn, y[fit], marks)
        x = self.summary([t for t, f in zip(texts, part, strict=True) if f])[0]
        self._calibrate(x, y[part], w[part])

    def _train(self, texts: list[list[str]], y: np.ndarray, marks: set[str]) -> None:
        """Gradient ascent on the conditional likelihood of the token labels,
        each weight at its own pace."""
        words: dict[str, int] = {}
        ids = np.fromiter((words.setdefault(w, len(words)) for t in texts for w in t), np.int64)
        lens = np.array([len(t) for t in texts])
        first = np.zeros(len(ids), bool)
        first[(np.cumsum(lens) - lens)[lens > 0]] = True
        marked = np.array([any(k in marks for k in keys(w)) for w in words], bool)
        truth = (marked[ids] & (np.repeat(y, lens) > 0)).astype(float) if len(ids) else np.empty(0)
        index: dict[str, int] = {}
        feats = [[index.setdefault(k, len(index)) for k in keys(w)] for w in words]
        size = len(index)
        flat = np.array([b for f in feats for b in f], np.int64)
        owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
        rate = float(np.clip(truth.mean() if len(truth) else 0, 1e-6, 0.5))
        weights, self.bias = np.zeros(size), float(np.log(rate / (1 - rate)))
        trans = np.zeros((2, 2))
        self.start, self.move = np.array([0.5, 0.5]), np.ones((2, 2))
        seen = np.zeros((2, 2))
        inner = np.nonzero(~first)[0]
        np.add.at(seen, (truth[inner - 1].astype(int), truth[inner].astype(int)), 1)
        speed, tspeed = np.full(size, 1e-3), np.full((2, 2), 1e-3)
        for _ in range(ROUNDS if len(ids) else 0):
            e = (np.bincount(owner, weights[flat], len(feats)) + self.bias)[ids]
            p, pairs = marginals(e, first, self.start, np.exp(trans), pairs=True)
            by_word = np.bincount(ids, truth - p, len(feats))
            g = np.bincount(flat, by_word[owner], size) - DECAY * len(ids) * weights
            speed += g * g
            weights += RATE * 4 * g / np.sqrt(speed)
            g = seen - pairs
            tspeed += g * g
            trans += RATE * g / np.sqrt(tspeed)
        trans -= trans.max()
        self.move = np.exp(trans)
        self.weights = {k: float(weights[i]) for k, i in index.items() if abs(weights[i]) > 1e-4}

    def summary(self, texts: list[list[str]], emissions: Emissions | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per text: largest marginal, expected toxic tokens (log), their
        share (log), chance of any; and the marginals of its tokens."""
        emissions = emissions or Emissions(self.weights, self.bias)
        out, each = np.zeros((len(texts), 4)), [np.empty(0)] * len(texts)
        at = 0
        while at < len(texts):
            to, n = at, 0
            while to < len(texts) and (to == at or n + len(texts[to]) <= CHAIN_TOKENS):
                n += len(texts[to])
                to += 1
            lens = np.array([len(t) for t in texts[at:to]])
            e = np.fromiter(map(emissions.__getitem__, chain.from_iterable(texts[at:to])), float, n)
            first = np.zeros(n, bool)
            begin = np.cumsum(lens) - lens
            first[begin[lens > 0]] = True
            p, _ = marginals(e, first, self.start, self.move)
            for i in np.nonzero(lens)[0]:
                q = p[begin[i]:begin[i] + lens[i]]
                each[at + i] = q
                total = q.sum()
                none = np.log1p(-np.minimum(q, 1 - 1e-9)).sum()
                out[at + i] = q.max(), np.log1p(total), np.log1p(100 * total / len(q)), -np.expm1(none)
            at = to
        return out, each

    def _calibrate(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        """Weighted logistic regression of the document label, with a ridge."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = w * len(w) / w.sum()
        self.coef = np.zeros(z.shape[1])
        ridge = np.diag([0.05 * len(x) / 100 + 0.05] * (z.shape[1] - 1) + [1e-6])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.coef, -30, 30)))
            h = (z * (w * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(self.coef))
            self.coef += np.linalg.solve(h, z.T @ (w * (y - p)) - ridge @ self.coef)

    def scorer(self):
        if self.constant is not None:
            return lambda texts: [[self.constant] * len(texts), [[] for _ in texts]]
        emissions = Emissions(self.weights, self.bias)

        def score(texts: list[str]) -> list[list]:
            x, each = self.summary([TOKEN.findall(t) for t in texts], emissions)
            z = ((x - self.mean) / self.scale) @ self.coef[:-1] + self.coef[-1]
            spans = [_spans(t, q) for t, q in zip(texts, each, strict=True)]
            return [(1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist(), spans]
        return score


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Character offsets of the runs of tokens that are more likely toxic."""
    out: list[dict] = []
    if len(p) and p.max() >= SPAN_THRESHOLD:
        last = -2
        for i, m in enumerate(TOKEN.finditer(text)):
            if p[i] >= SPAN_THRESHOLD:
                if last == i - 1:
                    out[-1]["end"] = m.end()
                else:
                    out.append({"start": m.start(), "end": m.end()})
                last = i
    return out


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", parts: int = 4, part: int = 2,
        per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", **bounds) -> Model:
    """Learns from labelled rows outside the held-out part, at most
    ``per_class`` of each label and none longer than ``most_chars``."""
    return Model(*sample(docs, labels, target, parts, part, per_class, id_col=id_col, text_col=text_col, **bounds))


def tag(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
        text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (array of {start, end},
    code points) of every row.

    Null and empty texts have no spans and the score of a text without tokens;
    texts of any length are tagged whole; repeated rows score alike; other
    columns are not read; no rows give no rows. Without two kinds of labelled
    rows every score is the smoothed rate of label 1.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = append_scores(rows, lambda: shared.value.scorer(),
                        [("score", "double"), ("spans", "array<struct<start:int,end:int>>")], ["doc_id"])
    return out.select("doc_id", held_out("doc_id", options.get("parts", 4), options.get("part", 2)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
