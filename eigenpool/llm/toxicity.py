"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

The kernel of two words counts the subsequences of three characters they share, each gap making a
subsequence weigh less, so `id-iot` or `idxiot` stays close to `idiot`. Words are marked at both
ends; runs of single characters (`i d i o t`) count as one word too. A sentence scores as its
worst word, a document as its worst sentence, so passages around an insult don't water it down.

Fitting works on sentences of labelled documents: a clean document's words are all negative, in a
toxic one the worst word is the positive. It is chosen anew after each fit (multi-instance
learning), next to the words that toxic documents clearly prefer. The support vector machine is linear in the Nyström map of the landmarks; multiplied
out, it is one weight per subsequence, which is what scoring looks up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import unit

#: Labelled documents fitted on, per label and in expectation, and the longest text among them.
FIT_DOCUMENTS = 2_500
FIT_CHARACTERS = 20_000
LANDMARKS = 192
ROUNDS = 4
#: Weight of the mean loss of either label against the squared norm of the weights.
COST = 1000.0
#: Log odds by which a word must prefer toxic documents to start as their positive, and log odds and
#: toxic documents that make a word positive wherever it stands.
FIRST_LIFT = 2.0
SURE_LIFT, SURE_DOCUMENTS = 2.5, 25
DECAY = 0.7
SYMBOLS, MARK = 64, 63
GRAMS = SYMBOLS**3
#: Offsets of the second and third character, up to two skipped ones.
STEPS = [(j, k, DECAY ** (k - 2)) for k in range(2, 5) for j in range(1, k)]
THRESHOLD = 0.7
#: Words whose value is at most this are all the same to a document's score.
FLOOR = 0.0
WORD_CACHE = 200_000
STRIP = ".,;:!?\"'()[]{}<>|“”«»¿¡"

_CODES = np.array([ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) - 48 if "0" <= c <= "9" else 36 + ord(c) % 27 for c in map(chr, range(128))])
_CODES[1] = MARK


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word number, subsequence, weight) for every way to choose three characters near each other."""
    marked = "".join(f"\x01{w}\x01" for w in words)
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(points < 128, _CODES[np.minimum(points, 127)], 36 + points.astype(np.int64) % 27)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    for j, k, weight in STEPS:
        if len(codes) <= k:
            continue
        same = word[:-k] == word[k:]
        found = (codes[:-k] * SYMBOLS + codes[j:len(codes) - k + j]) * SYMBOLS + codes[k:]
        yield word[:-k][same], found[same], weight


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse map of each word, of length 1: (word, subsequence, value), and the lengths before."""
    parts = list(_subsequences(words))
    key = np.concatenate([w * GRAMS + g for w, g, _ in parts] or [np.zeros(0, np.int64)])
    value = np.concatenate([np.full(len(w), x) for w, _, x in parts] or [np.zeros(0)])
    key, at = np.unique(key, return_inverse=True)
    value = np.bincount(at, weights=value, minlength=len(key))
    word, gram = key // GRAMS, key % GRAMS
    length = np.sqrt(np.bincount(word, weights=value**2, minlength=len(words)))
    return word, gram, value / length[word], length


@dataclass
class Model:
    """A weight per subsequence, the bias, and the slope and shift of the probability."""

    weights: np.ndarray
    slope: float
    shift: float

    def words(self, words: list[str]) -> np.ndarray:
        """Each word's value, at least FLOOR."""
        top, length = np.zeros(len(words)), np.zeros(len(words))
        for word, gram, weight in _subsequences(words):
            top += np.bincount(word, weights=weight * self.weights[gram], minlength=len(words))
            length += np.bincount(word, minlength=len(words)) * weight**2
        # The sum of squared occurrences is at most the squared length: an upper bound of the value.
        bound = top / np.sqrt(np.maximum(length, 1e-9))
        out = np.full(len(words), FLOOR)
        rest = np.flatnonzero(bound > FLOOR)
        if len(rest):
            word, gram, value, _ = _features([words[i] for i in rest])
            out[rest] = np.maximum(FLOOR, np.bincount(word, weights=value * self.weights[gram], minlength=len(rest)))
        return out

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30)))


def instances(text: str | None) -> list[str]:
    """The text's words in lower case, and runs of three or more single characters as words."""
    words = (text or "").lower().split()
    singles = [len(w) == 1 for w in words]
    if sum(singles) < 3:
        return words
    extra, run = [], []
    for w, single in zip([*words, ""], [*singles, False], strict=True):
        if single:
            run.append(w)
        else:
            if len(run) >= 3:
                extra.append("".join(run))
            run = []
    return words + extra


class Values(dict):
    """Value per word, found for many missing words at once; forgets when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def of(self, texts: list[list[str]]) -> list[float]:
        out = []
        for words in texts:
            missing = [w for w in set(words) if w not in self]
            if missing:
                if len(self) + len(missing) > WORD_CACHE:
                    self.clear()
                    missing = list(set(words))
                self.update(zip(missing, self.model.words([w.strip(STRIP) for w in missing]).tolist(), strict=True))
            out.append(max(map(self.__getitem__, words), default=FLOOR))
        return out


def _solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = COST, steps: int = 60) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps that are halved until they help; the last
    column of x is the bias."""
    ridge = np.eye(x.shape[1]) / cost
    ridge[-1, -1] = 1e-6

    def loss(v: np.ndarray) -> float:
        return float(v @ ridge @ v + (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum())

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        step = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active]) - w
        size = 1.0
        while size > 1e-3 and loss(w + size * step) > now:
            size /= 2
        new = loss(w + size * step)
        if new >= now * (1 - 1e-6):
            break
        w, now = w + size * step, new
    return w


def _platt(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of label by value, each label weighing the same."""
    x = np.stack([value, np.ones(len(value))], axis=1)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - (y > 0))) + 1e-2 * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hessian, gradient)
    return float(max(0.0, w[0])), float(w[1])


def fit_texts(texts: list[str], toxic: list[int]) -> Model:
    """Fits on a bounded list of texts with labels; without both labels everything scores alike."""
    bags = [sorted({w.strip(STRIP) for w in instances(t)} - {""}) for t in texts]
    y = np.where(np.array(toxic, dtype=int) > 0, 1, -1)
    if not (y > 0).any() or not (y < 0).any():
        return Model(np.zeros(GRAMS), 0.0, 4.0 if (y > 0).any() else -4.0)
    bad, good = Counter(), Counter()
    for bag, label in zip(bags, y, strict=True):
        (bad if label > 0 else good).update(bag)
    n_bad, n_good = (y > 0).sum(), (y < 0).sum()
    lift = {w: float(np.log((n + 1) / (n_bad + 2)) - np.log((good[w] + 1) / (n_good + 2))) for w, n in bad.items()}
    ranked = sorted(lift, key=lambda w: (-lift[w], w))
    negative = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0]))]
    landmarks = list(dict.fromkeys(ranked[:LANDMARKS // 2] + negative[:LANDMARKS // 4] + negative[:: max(1, len(negative) // (LANDMARKS // 4))]))[:LANDMARKS]
    word, gram, value, _ = _features(landmarks)
    known = np.unique(gram)  # only the landmarks' own subsequences count in a kernel with one
    dense = np.zeros((len(landmarks), len(known)), dtype=np.float32)
    dense[word, np.searchsorted(known, gram)] = value
    eigen, vectors = np.linalg.eigh(dense @ dense.T)
    root = vectors / np.sqrt(np.maximum(eigen, 1e-6)) @ vectors.T

    def nystrom(words: list[str]) -> np.ndarray:
        out = np.ones((len(words), len(landmarks) + 1), dtype=np.float32)
        for at in range(0, len(words), 1_000):
            part = words[at:at + 1_000]
            word, gram, value, _ = _features(part)
            column = np.minimum(np.searchsorted(known, gram), len(known) - 1)
            shared = known[column] == gram
            table = np.zeros((len(part), len(known)), dtype=np.float32)
            table[word[shared], column[shared]] = value[shared]
            out[at:at + 1_000, :-1] = table @ dense.T @ root
        return out

    # Negatives: the worst word of each clean document so far, and the commonest words of clean documents and an even share of the others.
    rest = negative[2_000:]
    negatives = negative[:2_000] + rest[:: max(1, len(rest) // 18_000)]
    x_common = nystrom(negatives)
    toxic_bags = [bag for bag, label in zip(bags, y, strict=True) if label > 0 and bag]
    clean_bags = [bag for bag, label in zip(bags, y, strict=True) if label < 0 and bag]
    best = [max(bag, key=lambda w: (lift[w], w)) for bag in toxic_bags]
    sure = np.array([lift[w] for w in best]) > FIRST_LIFT
    hard: Counter = Counter()
    model = None
    for _ in range(ROUNDS):
        # a document without a suspect word teaches nothing in this round
        positive = Counter(w for w, s in zip(best, sure, strict=True) if s)
        positive.update({w: n for w, n in bad.items() if n >= SURE_DOCUMENTS and lift[w] > SURE_LIFT})
        if not positive:
            break
        x, sign, weight = [x_common], [-np.ones(len(negatives))], [np.full(len(negatives), 1 / len(negatives))]
        for words, label in ((positive, 1.0), (hard, -1.0)):
            names = sorted(words)
            n = np.sqrt([words[w] for w in names])
            if names:
                x.append(nystrom(names))
                sign.append(np.full(len(names), label))
                weight.append(n / n.sum())
        w = _solve(np.concatenate(x), np.concatenate(sign), np.concatenate(weight))
        weights = np.zeros(GRAMS, dtype=np.float32)
        weights[known] = root @ w[:-1] @ dense
        model = Model(weights, 1.0, 0.0)
        values = Values(model)
        reached = np.array(values.of(toxic_bags))
        best = [max(bag, key=lambda v: (values.get(v, FLOOR), v)) for bag in toxic_bags]
        sure = (reached + w[-1] > 0) & (np.array([lift[v] for v in best]) > 0)
        values = Values(model)
        values.of(clean_bags)
        hard.update({max(bag, key=lambda v: (values.get(v, FLOOR), v)) for bag in clean_bags} - set(positive))
    if model is None:
        return Model(np.zeros(GRAMS), 0.0, 0.0)
    scores = np.array(Values(model).of(bags))
    model.slope, model.shift = _platt(scores, y)
    return model


def sample(labels: DataFrame) -> DataFrame:
    """About FIT_DOCUMENTS of the rows (doc_id, toxic) of each label, by a hash of the id: few enough to broadcast."""
    labels = labels.where("toxic is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, FIT_DOCUMENTS / n.get(1, 1))).otherwise(min(1.0, FIT_DOCUMENTS / n.get(0, 1)))
    return labels.where(unit(F.lit("toxicity"), F.col("doc_id")) < rate)


def fit(rows: DataFrame) -> Model:
    """Learns from rows (doc_id, text, toxic); null texts or labels are left out.

    About FIT_DOCUMENTS rows of each label with at most FIT_CHARACTERS characters are taken by a hash
    of the id and brought to the driver: a bounded sample of the labelled rows.
    """
    rows = rows.where("text is not null and toxic is not null").where(F.length("text") <= FIT_CHARACTERS)
    rows = rows.select("doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, FIT_DOCUMENTS / n.get(1, 1))).otherwise(min(1.0, FIT_DOCUMENTS / n.get(0, 1)))
    chosen = rows.where(unit(F.lit("toxicity"), F.col("doc_id")) < rate).toPandas().sort_values(["doc_id", "text"])
    return fit_texts(chosen["text"].tolist(), chosen["toxic"].tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of the whole text of every row (doc_id, text).

    Null and empty texts score as a text without any suspect word. Equal texts score alike; ids may be
    null or repeat; other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Values(model)
        for batch in batches:
            p = model.probability(np.array(values.of([instances(t) for t in batch["text"].to_pylist()])))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scored, "doc_id long, score double, predicted int")
