"""Language identification by error-correcting output codes over character 3-grams.

Each learned language has a codeword of signs. For every bit a binary 3-gram classifier tells the
languages with + from those with -, by log odds of 3-gram frequencies. A text is decoded to the
language whose codeword loses least on the text's bit margins; each loss is weighted by how well
that bit's classifier does on that language (loss-weighted decoding). Where the runner-up is close,
the text is flagged as ambiguous.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import unit

UNKNOWN = "und"
#: 64 symbols: 0 is a boundary, 1..26 a-z, the rest other letters by code point.
SYMBOLS = 64
GRAMS = SYMBOLS**3
#: Texts per language, in expectation, on which the reliability of the bits is measured.
RELIABILITY_TEXTS = 500
#: Margins are mean log odds a 3-gram; this many 3-grams' worth make them a confidence.
SHARPNESS = 6.0
SMOOTHING = 2e-6
#: A runner-up with more than this of the best one's likelihood makes a text ambiguous.
AMBIGUOUS = 0.8
#: Mean loss of the best codeword above which a text is in none of the languages. On sf0.1, clean held-out texts lose
#: 0.011 at most; short texts in Finnish, Portuguese, Greek and Russian, none of them learned, 0.17 to 0.69.
LOSS_LIMIT = 0.1
#: Held-out texts with a language that may be lost; where more would be, the decision isn't used.
HELD_OUT_LOST = 0.01
MAX_DENSE_CODES = 5
RANDOM_CODES = 200
SLICE = 1 << 20

_FOLD = np.zeros(0x80, dtype=np.int64)
_FOLD[ord("a"):ord("z") + 1] = np.arange(1, 27)


def grams(text: str) -> np.ndarray:
    """Indices of the text's 3-grams over lower-cased letters, runs of other characters as one boundary."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    other = 27 + (points.astype(np.int64) * 40_503 >> 4) % (SYMBOLS - 27)
    codes = np.where(points < 0x80, _FOLD[np.minimum(points, 0x7F)], other)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[keep]
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64)
    return (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language, with large distances between any two rows.

    Few languages get all ways to part them; many get the best of random codes of 4 log2(n) + 6 bits.
    """
    if n <= MAX_DENSE_CODES:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        code = -np.ones((n, len(splits)))
        for bit, plus in enumerate(splits):
            code[list(plus), bit] = 1
        return code
    rng, best, far = np.random.default_rng(n), None, -1
    for _ in range(RANDOM_CODES):
        code = rng.choice([-1.0, 1.0], size=(n, 4 * int(np.ceil(np.log2(n))) + 6))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = int(((code.shape[1] - code @ code.T) / 2 + np.eye(n) * n * 99).min())
        if near > far:
            best, far = code, near
    return best


@dataclass
class Model:
    """Languages, their codewords, log odds per 3-gram and bit, and decoding weights per language and bit."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    weights: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        found = grams(text)
        total = np.zeros(self.code.shape[1])
        for at in range(0, len(found), SLICE):
            total += self.odds[found[at:at + SLICE]].sum(axis=0, dtype=np.float64)
        return total / max(1, len(found))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score 0 to 1, ambiguous)."""
        return self.decode(text)[:3]

    def told(self, text: str | None) -> tuple[str, bool]:
        """(language, whether it is told: neither ambiguous nor too far from the language's codeword)."""
        language, _, ambiguous, loss = self.decode(text)
        return language, language != UNKNOWN and not ambiguous and loss <= LOSS_LIMIT

    def decode(self, text: str | None) -> tuple[str, float, bool, float]:
        """(language, score 0 to 1, ambiguous, mean loss of the language's codeword)."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False, 0.0
        loss = np.logaddexp(0, -self.code * self.margins(text) * SHARPNESS)
        lost = (self.weights * loss).sum(axis=1)
        likely = -lost * self.code.shape[1]
        likely = np.exp(likely - likely.max())
        first, second = np.argsort(-likely, kind="stable")[:2]
        return self.languages[first], float(likely[first] / likely.sum()), bool(likely[second] > AMBIGUOUS * likely[first]), float(lost[first])


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = grams(text)
            if lang not in totals:
                totals[lang] = np.zeros(GRAMS, dtype=np.int64)
            # long texts by bincount, short ones by the grams they hold
            if len(found) > GRAMS // 8:
                totals[lang] += np.bincount(found, minlength=GRAMS)
            else:
                np.add.at(totals[lang], found, 1)
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
            names=["lang", "gram", "n"])


def fit(rows: DataFrame) -> Model:
    """Learns from all rows (doc_id, text, lang); null or letterless ones are left out.

    Counts are taken over all rows; what reaches the driver is a count per language and 3-gram,
    of at most 64^3 for each language. Reliability is measured on about `RELIABILITY_TEXTS` rows
    a language, chosen by a hash of the id.
    """
    rows = rows.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counted = rows.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    counts = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((GRAMS, 0)), np.zeros((0, 0)))
    share = np.full((len(languages), GRAMS), SMOOTHING)
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        share[i, own["gram"].to_numpy()] += own["n"].to_numpy() / own["n"].sum()
    code = codewords(len(languages))
    odds = np.empty((GRAMS, code.shape[1]), dtype=np.float32)
    for bit in range(code.shape[1]):
        plus = code[:, bit] > 0
        odds[:, bit] = np.log(share[plus].mean(axis=0) / share[~plus].mean(axis=0))
    model = Model(languages, code, odds, np.full(code.shape, 1 / max(1, code.shape[1])))
    if len(languages) > 1:
        model.weights = _reliability(rows, model)
    return model


def _reliability(rows: DataFrame, model: Model) -> np.ndarray:
    """Share of right bits per language and bit, each language's summing to 1."""
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    rate = F.lit(0.0)
    for lang in model.languages:
        rate = F.when(F.col("lang") == lang, min(1.0, RELIABILITY_TEXTS / n[lang])).otherwise(rate)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, seen = np.zeros_like(model.code), np.zeros(len(model.languages))
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                i = model.languages.index(lang)
                hits[i] += model.code[i] * model.margins(text) > 0
                seen[i] += 1
        i, bit = np.nonzero(np.ones_like(hits))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(bit), pa.array(hits[i, bit]), pa.array(seen[i])], names=["i", "bit", "hits", "seen"])

    chosen = rows.where(unit(F.lit("reliability"), F.col("doc_id")) < rate).select("lang", "text")
    found = chosen.mapInArrow(right, "i long, bit long, hits double, seen double").groupBy("i", "bit").agg(F.sum("hits").alias("h"), F.sum("seen").alias("s"))
    weights = np.full(model.code.shape, 0.5)
    for r in found.collect():
        weights[r["i"], r["bit"]] = (r["h"] + 1) / (r["s"] + 2)
    return weights / weights.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of the whole text of every row (doc_id, text).

    Null texts and texts without a letter are `und` with score 0, as is everything if nothing was
    learned. Equal texts get equal results; ids may be null or repeat; other columns are ignored.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(decode, "doc_id long, lang_pred string, score double, ambiguous boolean")


def trusted(docs: DataFrame) -> frozenset[str]:
    """The languages that nearly all held-out texts taken for them are told to be, by a model of the other texts.

    A quarter of the rows (doc_id, text, lang) with a language, by a hash of the id, is held out. A language is trusted if at
    most HELD_OUT_LOST of the held-out texts nearest to it aren't told, and there are some. With fewer than two
    languages nothing can be told, and none is.
    """
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit(rows.where(~held_out))
    if len(model.languages) < 2:
        return frozenset()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, lost = Counter(), Counter()
        for batch in batches:
            for text in filter(has_letter, batch["text"].to_pylist()):
                language, told = model.told(text)
                n[language] += 1
                lost[language] += not told
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([lost[x] for x in n], pa.int64())], names=["lang", "n", "lost"])

    sums = rows.where(held_out).select("text").mapInArrow(count, "lang string, n long, lost long").groupBy("lang").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost"))
    return frozenset(r["lang"] for r in sums.collect() if r["lost"] <= HELD_OUT_LOST * r["n"])


def decided(docs: DataFrame, model: Model, sure: Collection[str]) -> DataFrame:
    """The rows whose text has a language, which is written where `lang` is null; other columns stay.

    Texts without a letter go. A text whose language isn't told goes if the nearest language is one of the
    `sure` ones; else it stays, and a null `lang` stays null.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.told(t) for t in batch["text"].to_pylist()]
            named = [own if own is not None or not told else language for own, (language, told) in zip(batch["lang"].to_pylist(), found, strict=True)]
            at = batch.schema.get_field_index("lang")
            columns = [pa.array(named, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            kept = [language != UNKNOWN and (told or language not in sure) for language, told in found]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
