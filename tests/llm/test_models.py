"""Learned operators: held-out accuracy, edge texts, and what they must not look at."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eigenpool.llm import langid, toxicity

DOCS = "doc_id long, text string, lang string, source string, score string"
WORDS = {
    "en": "the house and river with green water under bridge where people walk every morning".split(),
    "de": "der fluss und das haus mit grünem wasser unter brücke wo menschen jeden morgen gehen".split(),
    "fr": "la rivière et maison avec eau verte sous le pont où gens marchent chaque matin".split(),
    "el": "το σπίτι και ποτάμι με νερό κάτω από γέφυρα όπου άνθρωποι περπατούν κάθε πρωί".split(),
    "ru": "дом и река с зеленой водой под мостом где люди гуляют каждое утро вместе".split(),
    "pt": "a casa e o rio com água verde sob ponte onde pessoas caminham toda manhã não".split(),
}


@pytest.fixture(scope="module")
def languages(spark):
    rng, rows = random.Random(2), []
    for lang, words in WORDS.items():
        rows += [(len(rows) + i, " ".join(rng.choices(words, k=rng.randrange(8, 60))), lang, "s", "x") for i in range(60)]
    return spark.createDataFrame(rows, DOCS)


def test_languages_are_told_apart_on_held_out_texts(spark, languages):
    part = langid.remainder(F.col("doc_id"), 4)
    model = langid.fit(languages.where(part != 2))
    assert model.languages == sorted(WORDS) and len(model.code) == 6
    held = languages.where(part == 2)
    got = {r["doc_id"]: r for r in langid.identify(held, model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in held.collect()}
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in truth]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # neither labels, ids nor sources change a prediction
    other = held.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("source", F.lit(None).cast("string"))
    assert {r["doc_id"] - 10_000: r["lang_pred"] for r in langid.identify(other, model).collect()} == {i: r["lang_pred"] for i, r in got.items()}


def test_texts_without_letters(spark, languages):
    model = langid.fit(languages)
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([None, "", " 12 \n#$", "é", "the " * 200_000])], DOCS)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3 and got[3][0] != "und" and got[4][0] == "en"
    kept = [r["doc_id"] for r in langid.decided(odd, model, ()).collect()]
    assert sorted(kept) == [3, 4] and langid.decided(odd, model, ()).columns == odd.columns


def test_one_and_no_language(spark, languages):
    one = langid.fit(languages.where("lang = 'en'"))
    assert one.predict("irgendein text")[:2] == ("en", 1.0) and one.predict("12")[0] == "und"
    assert langid.fit(languages.where("lang = 'xx'")).predict("text") == ("und", 0.0, False)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_are_far_apart(n):
    code = langid.codewords(n)
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= 1 and (n < 4 or min(apart) >= 3)


INSULTS = ["grobnik", "flurpel", "zankwit"]


def toxic_texts(rng, n, rate):
    words = [f"{a}{b}" for a in ("ta", "mi", "so", "ler", "van") for b in ("no", "ri", "det", "kal", "po", "sun")]
    texts, labels = [], []
    for _ in range(n):
        toxic = rng.random() < rate
        sentences = [" ".join(rng.choices(words, k=8)) for _ in range(6)]
        if toxic:
            sentences[rng.randrange(6)] += " " + rng.choice(INSULTS)
        texts.append(". ".join(sentences))
        labels.append(int(toxic))
    return texts, labels


def test_toxicity_held_out_and_gapped():
    rng = random.Random(4)
    model = toxicity.fit_texts(*toxic_texts(rng, 400, 0.3))
    texts, labels = toxic_texts(rng, 300, 0.3)
    values = toxicity.Values(model).of([toxicity.instances(t) for t in texts])
    flagged = model.probability(np.array(values)) >= toxicity.THRESHOLD
    assert (flagged == (np.array(labels) > 0)).mean() > 0.98
    clean = "taano miri sodet lerkal"
    score = lambda t: float(model.probability(np.array(toxicity.Values(model).of([toxicity.instances(t)])))[0])
    for bent in ("grob-nik", "GROBNIK!", "grobbnik", "flur.pel", "zankwiit"):
        assert score(f"{clean} {bent} {clean}") > 2 * score(clean), bent
    assert toxicity.instances("so g r o b n i k now") [-1] == "grobnik"


def test_exact_value_of_a_word():
    """The pruned look-up equals the kernel expansion over all subsequences."""
    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(size=toxicity.GRAMS).astype(np.float32), 1.0, 0.0)
    for word in ("abcabcab", "aa", "x", "", "ünïcode-wörd", "a" * 40):
        marked, total = [toxicity.MARK] + [int(toxicity._CODES[ord(c)]) if ord(c) < 128 else 36 + ord(c) % 27 for c in word] + [toxicity.MARK], {}
        for i in range(len(marked)):
            for k in range(i + 2, min(i + 5, len(marked))):
                for j in range(i + 1, k):
                    gram = (marked[i] * 64 + marked[j]) * 64 + marked[k]
                    total[gram] = total.get(gram, 0) + toxicity.DECAY ** (k - i - 2)
        norm = np.sqrt(sum(v * v for v in total.values()))
        want = sum(v * model.weights[g] for g, v in total.items()) / norm if total else 0.0
        assert model.words([word])[0] == pytest.approx(max(toxicity.FLOOR, want), rel=1e-4, abs=1e-4)


def test_toxicity_edges(spark):
    texts, labels = toxic_texts(random.Random(8), 80, 0.4)
    rows = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, labels))] + [(900, None, 1), (901, "x", None)], "doc_id long, text string, toxic int")
    model = toxicity.fit(rows)
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([None, "", "   ", texts[0], texts[0], "ta " * 100_000])], DOCS)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert len(got) == 6 and got[0] == got[1] == got[2] and got[3] == got[4] and all(0 <= s <= 1 for s in got.values())
    assert toxicity.score(odd.limit(0), model).count() == 0
    for only in (0, 1):
        assert toxicity.fit(rows.where(F.col("toxic") == only)).probability(np.zeros(1))[0] == pytest.approx(only, abs=0.05)
