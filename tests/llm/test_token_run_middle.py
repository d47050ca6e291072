"""Token counts, periodic runs and fill-in-the-middle against brute force, the library, and exact round trips."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from eigenpool.llm import fill_middle, periodic_runs, queries, token_counts
from test_exact import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@pytest.fixture(scope="module")
def texts():
    """Prose, loops, copies, odd characters, marks, blanks, empty, null and long texts."""
    rng = random.Random(5)
    made = [prose(rng, rng.randrange(0, 120), rng.choice([2, 3, 40])) for _ in range(40)]
    made += [made[7]] * 3 + ["", None, None, " ", " \n\t\x0b\x0c\r ", "a", "  x y \u0085 z", "Été à Noël 𝒳 ñandú́", "x\u0000y"]
    made += ["a b c " * 40, "one " * 30, "so <P> it", "<S>", "ends <M", "<P", ">", "abc", "!", "a" * 70_000, "ab " * 20_000, prose(rng, 30_000, 9)]
    made += ["中文字符" * 30, "①①  ▁ ▁▁the<s></s><unk><0x41>\t한국 क्ष 😀"]
    return made


def stored(spark, tmp_path, texts, ids=None):
    frame(spark, texts, ids=ids).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11

@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(token_counts.read_model(token_counts.default_model()))


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())


def test_token_counts_are_the_library_s(spark, texts, library):
    got = token_counts.count(frame(spark, texts)).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got["n_bytes"][i], got["n_tokens"][i], got["over_limit"][i]) == (len((t or "").encode()), n, n > 4096), repr(t)[:80]


def test_state_maps_compose_at_any_cut(machine, library):
    rng = random.Random(2)
    parts = ["a", "b", "e", " ", "  ", "\n", "1", "é", "中", "①", "▁", "the", "ing", "😀", "́", "<s>", "<0x41>", "aaaa", " the", "　", "한"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 40)))
        assert {machine.count(text, size) for size in (1, 2, 5, 13, 1 << 14)} == {len(library.encode(text))}, repr(text)


def test_composition_is_associative(machine):
    rng = random.Random(4)
    for _ in range(300):
        a, b, c = (machine.map_of("".join(rng.choices("ab▁1é中", k=rng.randrange(1, 6)))) for _ in range(3))
        left, right = a.then(b).then(c), a.then(b.then(c))
        assert left.apply(machine.start) == right.apply(machine.start)
        assert (left.entry, left.last) == (right.entry, right.last)


def test_compiling_anew_keeps_counts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 20)
    machine = token_counts.Transducer(token_counts.read_model(token_counts.default_model()))
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(1, 9))) for _ in range(40))
        assert machine.count(text) == len(library.encode(text))
        assert len(machine.states) <= 50 and len(machine.words) <= 20


def test_states_are_finite_on_endless_words(machine):
    machine.count("abra" * 5_000)
    before = len(machine.states)
    machine.count("abra" * 50_000)
    assert len(machine.states) <= before + 4


# 12

def brute_runs(words, least):
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # the smallest comes first
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_of_small_alphabets():
    rng = random.Random(8)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 4)):
            n, k = rng.choice([0, 1, 2, 9, 40]), rng.choice([1, 2, 3])
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randrange(1, 9)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            docs.append(words)
        least, bounds = rng.choice([2, 5, 12]), np.cumsum([0, *map(len, docs)])
        got = [tuple(map(int, r)) for r in zip(*periodic_runs.runs_of(np.array(sum(docs, []), np.int64), bounds, least))]
        assert got == [(s + b, n, q) for d, b in zip(docs, bounds.tolist()) for s, n, q in brute_runs(d, least)]


def test_intervals_name_their_largest_child():
    lcp = np.array([0, 1, 3, 1, 0, 2, 2])
    rows = sorted(map(tuple, periodic_runs.intervals(lcp).tolist()))
    assert rows == [(0, 3, 1, 1, 2), (1, 2, 3, 1, 1), (4, 6, 2, 4, 1)]


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_find_runs_and_collapse(spark, texts, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 500)  # slices within a batch
    short = [t for t in texts if len(t or "") < 20_000] + ["ab " * 3_000]
    got = {r["doc_id"]: r for r in periodic_runs.find(frame(spark, short)).collect()}
    assert len(got) == len(short)
    for i, t in enumerate(short):
        words = WORD.findall(t or "")
        runs = brute_runs(words, 12)
        assert [tuple(r) for r in got[i]["runs"]] == runs, repr(t)[:80]
        assert (got[i]["n_words"], got[i]["collapsed"]) == (len(words), collapse(words, runs))


def test_one_word_for_ever(spark):
    row = periodic_runs.find(frame(spark, ["x " * 100_000])).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 100_000, 1)] and row["collapsed"] == "x"


def test_runs_query(spark, tmp_path, texts):
    short = [t for t in texts if len(t or "") < 20_000] * 3
    ids = [i * 37 for i in range(len(short) - 1)] + [None]
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_runs"](spark, stored(spark, tmp_path, short, ids)).collect()}
    looped = 0
    for doc_id, t in zip(ids, short):
        words = WORD.findall(t or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            looped += 1
        runs = brute_runs(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(collapse(words, runs))
    assert looped > 5


# 13

def brute_middle(doc_id, text):
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if h[3] % 100 < 20 else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, "spm" if h[3] % 100 < 20 else "psm", len(prefix), len(middle), out


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        for levels in (1, 2, 3):
            symbols = rng.integers(0, 1 << levels, n).astype(np.uint8)
            matrix = fill_middle.WaveletMatrix(symbols, levels)
            at = np.arange(n + 1)
            for c in range(1 << levels):
                assert matrix.rank(c, at).tolist() == np.concatenate([[0], np.cumsum(symbols == c)]).tolist()


@pytest.mark.parametrize("slice_bytes", [200, 16 << 20])
def test_middles_and_round_trip(spark, texts, monkeypatch, slice_bytes):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", slice_bytes)
    many = texts * 4
    ids = [*range(len(many) - 1), None]
    made = fill_middle.transform(frame(spark, many, ids=ids))
    got = {r["doc_id"]: r for r in made.withColumn("again", fill_middle.restored(made["output"], made["form"])).collect()}
    for doc_id, text in zip(ids, many):
        r = got[doc_id]
        assert tuple(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "output")) == brute_middle(doc_id, text or "")
        assert r["again"] == (text or "")
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_middle_query_agrees_with_sql(spark, tmp_path, texts):
    folder = stored(spark, tmp_path, texts)
    made = queries.QUERIES["op13_fim"](spark, folder)
    got = sorted(map(tuple, made.collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    want = con.sql(f"select {', '.join(made.columns)} from ({queries.SQL['op13_fim']})").fetchall()
    assert got == sorted(want)


def test_repeated_rows_and_no_rows(spark):
    none = frame(spark, [])
    for op in (token_counts.count, periodic_runs.find, periodic_runs.looped, fill_middle.transform):
        assert op(none).count() == 0
        twice = frame(spark, ["a b a b a b a b a b a b"] * 2, ids=[4, 4])
        assert op(twice).count() == 2 and op(twice).distinct().count() == 1
