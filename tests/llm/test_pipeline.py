"""Each stage of the pipeline against brute force on its own input, and the whole run."""

import random
import re

import pytest

import corpus_pipeline
from brute import brute_components, brute_spans
from eigenpool.llm import langid, minmax, secret_scan

WORDS = {
    "en": "the house and river with green water under bridge where people walk every morning".split(),
    "de": "der fluss und das haus mit grünem wasser unter brücke wo menschen jeden morgen gehen".split(),
    "es": "la casa y el río con agua verde bajo un puente donde gente camina cada mañana".split(),
    "fr": "la rivière et maison avec eau verte sous le pont où gens marchent chaque matin".split(),
}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage, over documents with nulls, copies and secrets."""
    folder = tmp_path_factory.mktemp("pipeline")
    words = "the quick brown fox jumps over a lazy dog while many other animals watch from the far side of this old river".split()
    rows = [(i, " ".join(words[(i * 7 + j * (i % 5 + 1)) % len(words)] for j in range(30 + i)), "en" if i % 3 else "de", f"s{i % 4}" if i % 9 else None, 5) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s1", 5) for i in range(5)]
    rows += [(200, None, "en", "s1", None), (201, "12 34 #", "en", "s2", 7), (202, "", None, "s3", 0), (None, rows[3][1] + " x", "en", "s0", 5),
             (203, "the key is token = \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\" and password=abcdefgh12 for the old river", "en", "s0", 9), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, DOCS)
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, "unused").write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_language_stage(stages):
    before, after = stages[0], stages[1]
    assert plain(after) == plain(r for r in before if r["text"] is not None and re.search(r"[^\W\d_]", r["text"]))


def test_language_stage_uses_the_decision(spark):
    rng, rows = random.Random(3), []
    for lang in ("de", "en", "es", "fr"):
        words = WORDS[lang]
        for _ in range(60):
            rows.append((len(rows), " ".join(rng.choices(words, k=rng.randrange(15, 60))), lang, "s", 5))
    odd = [(1_000, "το σπίτι και ποτάμι με νερό κάτω από γέφυρα όπου άνθρωποι περπατούν", None, "s", 5),
           (1_001, "дом и река с зеленой водой под мостом где люди гуляют", None, "s", 5),
           (1_002, "12 #", "en", "s", 5), (1_003, None, None, "s", None)]
    blank = [(2_000 + i, " ".join(rng.choices(WORDS[lang], k=40)), None, "s", 5) for i, lang in enumerate(("de", "en", "es", "fr"))]
    docs = spark.createDataFrame(rows + odd + blank, DOCS)
    assert langid.trusted(docs) == {"de", "en", "es", "fr"}
    got = {r["doc_id"]: tuple(r) for r in corpus_pipeline.identify(spark, docs, "unused").collect()}
    assert set(got) == {r[0] for r in rows + blank}
    assert all(got[r[0]] == r for r in rows)
    assert [got[2_000 + i] for i in range(4)] == [(i, t, lang, s, n) for (i, t, _, s, n), lang in zip(blank, ("de", "en", "es", "fr"))]


def test_language_stage_judges_each_language_on_its_own(spark):
    rng, rows = random.Random(4), []
    for lang in ("de", "en", "es"):
        for _ in range(60):
            rows.append((len(rows), " ".join(rng.choices(WORDS[lang], k=rng.randrange(15, 60))), lang, "s", 5))
    start = len(rows)
    for _ in range(60):  # one vocabulary under two names: neither can be told from the other
        rows.append((len(rows), " ".join(rng.choices(WORDS["fr"], k=30)), rng.choice(["fr", "fr-x"]), "s", 5))
    odd = (1_001, "12 #", "en", "s", 5)
    docs = spark.createDataFrame([*rows, odd], DOCS)
    sure = langid.trusted(docs)
    assert {"de", "en", "es"} <= sure and not sure >= {"fr", "fr-x"}
    got = {r["doc_id"] for r in corpus_pipeline.identify(spark, docs, "unused").collect()}
    assert got >= set(range(start)) and 1_001 not in got
    told = langid.fit(docs)
    assert got >= {r[0] for r in rows[start:] if told.told(r[1])[0] not in sure}


def test_near_duplicate_stage(stages):
    before, after = stages[1], stages[2]
    rows = sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    _, roots = brute_components([r["text"] for r in rows])
    want = {rows[i]["doc_id"] for i, root in enumerate(roots) if root == i}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_near_duplicate_stage_links_pairs_from_80_percent(spark):
    rng = random.Random(21)
    texts, alike = [], 0
    for k in range(60):
        words = [f"w{rng.randrange(5_000)}" for _ in range(rng.randrange(60, 200))]
        other = words[:-max(1, round(len(words) * rng.uniform(0.12, 0.22)))]
        texts += [" ".join(words), " ".join(other)]
        a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (words, other))
        alike += 0.80 <= len(a & b) / len(a | b) < 0.85
    texts += ["a b c d e f g h i", "a b c d e f g h", "p q r s t u v w x", "p q r s t u v"]  # 0.8 and 0.6 of few shingles
    assert alike >= 20
    _, roots = brute_components(texts, 80)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    got = sorted(r["doc_id"] for r in corpus_pipeline.deduplicate(spark, docs, "unused").collect())
    assert got == [i for i, root in enumerate(roots) if root == i]


def test_near_duplicate_stage_goes_by_row(spark):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join(f"{k}{rng.randrange(900)}" for _ in range(80)) for k in "abcde")
    rows = [(5, a), (5, b), (5, b + " x"), (3, b + " y"), (7, c), (7, c), (None, a), (None, d), (None, d + " x"), (None, e), (None, e),
            (8, ""), (8, ""), (8, " "), (4, c + " z"), (4, a + " z"), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    for parts in (1, 7):
        got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.deduplicate(spark, docs.repartition(parts), "unused").collect()]
        texts_of_d = [g for g in got if g[1] in (d, d + " x")]
        assert len(texts_of_d) == 1 and texts_of_d[0][0] is None
        got.remove(texts_of_d[0])
        # groups: a (5, null, 4), b (5, 5, 3), c (7, 7, 4), d (null, null), e (null, null)
        assert sorted(got, key=str) == sorted([(4, a + " z"), (3, b + " y"), (4, c + " z"), (None, e), (8, ""), (8, " "), (9, None)], key=str)
    clean = spark.createDataFrame([(1, a, "en", "s", 5), (1, b, "en", "s", 5), (1, b + " x", "en", "s", 5)], DOCS)
    got = sorted(r["text"] for r in corpus_pipeline.deduplicate(spark, clean, "unused").collect())
    assert len(got) == 2 and got[0] == a and got[1].startswith(b)


def test_bands_miss_few_pairs():
    assert minmax.bands_for(85) == (24, 6)
    for percent in (60, 70, 80, 85, 90, 95, 99):
        bands, values = minmax.bands_for(percent)
        assert (1 - minmax.meets(percent, values)) ** bands <= minmax.MISS
    assert minmax.bands_for(100)[0] == 1
    with pytest.raises(ValueError):
        minmax.bands_for(5)


def test_secret_stage(stages):
    before, after = {r["doc_id"]: r for r in stages[2]}, {r["doc_id"]: r for r in stages[3]}
    assert set(before) == set(after)
    for i, row in after.items():
        assert row["n_chars"] == len(row["text"]) and not brute_spans(row["text"])
        if not brute_spans(before[i]["text"]):
            assert row["text"] == before[i]["text"]
        else:
            assert "[secret]" in row["text"]
    assert len(secret_scan.RULES) == 8


def test_mixing_stage(stages):
    before, after = stages[3], stages[4]
    size = {r["doc_id"]: len(r["text"].split()) for r in before}
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert all(sum(r["doc_id"] == i for r in after) <= 3 for i in size)
    total = sum(size.values())
    assert abs(sum(size[r["doc_id"]] for r in after) - total) <= 5 * max(size.values())


def test_packing_stage(stages):
    before, after = stages[4], stages[5]
    assert sum(r["piece"] == 0 for r in after) == len(before)
    used = {}
    for r in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 2048


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "unused")
        assert out.count() == 0
