"""Prose in languages that no reference is of is left to the base rules; gibberish in their letters isn't."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from eigenpool.llm import divergence
from test_exact import frame

STORIES = {
    "ru": """Однажды утром старый рыбак вышел из дома и увидел, что море стало тихим. Он взял сеть, позвал сына, и они вместе пошли к лодке. В лодке лежали
        весла, хлеб и вода. Сын спросил, почему море сегодня такое тихое, и отец ответил, что в такие дни рыба уходит на глубину. Они долго гребли, пока берег
        не стал тонкой линией, и только тогда бросили сеть. Прошел час, потом еще один, но сеть была пустой. Сын хотел вернуться домой, но отец сказал, что
        надо ждать. И когда солнце стало садиться, сеть вдруг потянуло вниз, и они с трудом подняли ее в лодку. В сети была одна большая рыба, и ее хватило
        на всю деревню, и все были рады, и старик тоже был рад.""",
    "it": """Una mattina il vecchio pescatore uscì di casa e vide che il mare era calmo. Prese la rete, chiamò il figlio, e insieme andarono alla barca.
        Nella barca c'erano i remi, il pane e l'acqua. Il figlio chiese perché il mare fosse così calmo, e il padre rispose che in quei giorni i pesci vanno
        in profondità. Remarono a lungo, finché la riva non diventò una linea sottile, e solo allora gettarono la rete. Passò un'ora, poi un'altra, ma la
        rete era vuota. Il figlio voleva tornare a casa, ma il padre disse che bisognava aspettare. E quando il sole stava per tramontare, la rete fu tirata
        verso il basso, e a fatica la sollevarono nella barca.""",
    "pl": """Pewnego ranka stary rybak wyszedł z domu i zobaczył, że morze jest spokojne. Wziął sieć, zawołał syna i razem poszli do łodzi. W łodzi leżały
        wiosła, chleb i woda. Syn zapytał, dlaczego morze jest dziś takie spokojne, a ojciec odpowiedział, że w takie dni ryby schodzą na głębinę. Długo
        wiosłowali, aż brzeg stał się cienką linią, i dopiero wtedy zarzucili sieć. Minęła godzina, potem jeszcze jedna, ale sieć była pusta. Syn chciał
        wrócić do domu, ale ojciec powiedział, że trzeba czekać. I kiedy słońce zaczęło zachodzić, sieć nagle pociągnęło w dół, i z trudem wciągnęli ją do
        łodzi. W sieci była jedna wielka ryba, która wystarczyła dla całej wsi, i wszyscy byli szczęśliwi, a stary rybak też.""",
}


def test_stories_stay_and_gibberish_goes(spark, data_dir):
    rng = random.Random(9)
    made = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randrange(4, 10))) for _ in range(150))
    odd = [made("абвгдежзиклмнопрст"), made("etaoinshrdlcumwf"), " ".join(f"{w}###" for w in STORIES["it"].split())]
    learned = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text", "lang")
    tests = frame(spark, [*STORIES.values(), *odd], langs=[*STORIES, None, None, None], ids=range(-1, -7, -1)).select("doc_id", "text", "lang")
    rows = divergence.judge(learned.unionByName(tests)).where("doc_id < 0").collect()
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in rows} == {
        -1: (False, True), -2: (False, True), -3: (False, True), -4: (False, False), -5: (False, False), -6: (False, False)}


def test_own_share(spark):
    texts = ["a b c a d A, e.", "x x", "", "eins zwei drei", "the ### the ### the", "é É é b"]
    got = {r["doc_id"]: r["s"] for r in frame(spark, texts).select("doc_id", divergence.own_share(F.col("text")).alias("s")).collect()}
    assert got == {0: pytest.approx(1 / 7), 1: 0.0, 2: 0.0, 3: 0.0, 4: pytest.approx(1 / 3), 5: pytest.approx(1 / 4)}


@pytest.mark.parametrize("langs", [(None, None), ("en", None), ("en", "en")])
def test_pipeline_keeps_all_where_no_languages_can_be_told_apart(spark, langs):
    rows = [(i, t, langs[i % 2], "s", 5) for i, t in enumerate([*STORIES.values(), "one two", "12 #", "", None, "one two"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.identify(spark, docs, "unused").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == rows
