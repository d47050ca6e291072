"""License scans by diagonal voting.

All rolling k-grams of words of a text are joined in Spark with the places of the same k-grams in the
license templates. A match at text position i and template position j votes for the diagonal
i - j; votes of one diagonal are added up, neighbouring diagonals, shifted by a few inserted or missing words,
are merged, and the span is verified by the share of the template's words that its votes cover. A merged span
much longer than its template counts as its best diagonal alone. A notice right after a negation isn't one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eigenpool.session import cut_lineage

GRAM = 3
#: Diagonals this near are one span; a span must cover this share of its template's words.
SLACK = 4
COVERED = 0.75
#: Merged diagonals may make a span this many times as long as its template.
STRETCH = 1.5

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices of public licenses as lower-case words, and their labels.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("reserved", "copyright all rights reserved"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# Identifiers of the public list of license names, as they stand in tags and expressions.
IDENTIFIERS = [
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC",
    "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
]
# Words right before a notice that deny it; an apostrophe ends a word.
DENIALS = {"not", "never", "nor", "isn", "aren", "wasn", "weren", "cannot"}

_WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased A-Z; words are runs of ASCII letters and digits and of all other characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def identifier_templates(identifiers: list[str]) -> list[tuple[str, str, float]]:
    """(label, notice, share to cover): tags, and pairs joined by `and` or `or`; all words must be there.

    An expression of several identifiers is found pair by pair. Pairs without any digit are left out, as two plain names.
    """
    tags = [(i.lower(), f"SPDX-License-Identifier: {i}", 1.0) for i in identifiers]
    pairs = [(label.lower(), f"{a} {joint} {b}", 1.0) for a in identifiers for b in identifiers for joint in ("and", "or") for label in (a, b)
             if a != b and any(c.isdigit() for c in a + b)]
    return tags + pairs


def gram_rows(templates: list[tuple], k: int = GRAM) -> tuple[list[tuple], dict[bytes, int]]:
    """(template, label, n_words, needed, gram, place) of all k-grams, and the number of each template word.

    Templates are (label, notice), or (label, notice, share of the words to cover).
    """
    number: dict[bytes, int] = {}
    rows = []
    for t, (label, notice, *needed) in enumerate(templates):
        ids = [number.setdefault(w, len(number) + 1) for w in words_of(notice)]
        for place in range(len(ids) - k + 1):
            rows.append((t, label, len(ids), *(needed or [COVERED]), ids[place:place + k], place))
    base = len(number) + 1
    return [(*row, sum(x * base**i for i, x in enumerate(ids)), place) for *row, ids, place in rows], number


def _read(number: dict[bytes, int], phrases: dict[str, str], k: int):
    """Base measures, every k-gram made of template words (no other can join), and places that a denial reaches."""
    wanted = {tuple(words_of(p)): label for p, label in phrases.items()}
    heads = {p[0] for p in wanted}
    denials = {w.encode() for w in DENIALS}
    base = len(number) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch["text"]:
                words = words_of(text.as_py())
                starts, labels = [], set()
                for i in [i for i, w in enumerate(words) if w in heads]:
                    for phrase, label in wanted.items():
                        if tuple(words[i:i + len(phrase)]) == phrase:
                            starts.append(i)
                            labels.add(label)
                grams, run = [], 0
                ids = [number.get(w, 0) for w in words]
                for i, x in enumerate(ids):
                    run = run + 1 if x else 0
                    if run >= k:
                        grams.append({"gram": sum(y * base**j for j, y in enumerate(ids[i - k + 1:i + 1])), "at": i - k + 1})
                denied = sorted({j for i, w in enumerate(words) if w in denials for j in (i + 1, i + 2)}) if grams else []
                values = (len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels), grams, denied)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("gram", pa.int64()), ("at", pa.int64())])), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))],
                                             names=["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base", "grams", "denied"])

    return read


def spans(rows: DataFrame, templates: DataFrame, k: int = GRAM) -> DataFrame:
    """(row, template, label, first, last, covered, needed) for rows (row, grams): one row a merged diagonal."""
    places = F.broadcast(templates)  # the templates' own k-grams: fixed, a few thousand
    votes = rows.select("row", F.inline("grams")).join(places, "gram")
    keys = ["row", "template", "label", "length", "needed"]
    words = lambda at: F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + k - 1)))))
    votes = votes.groupBy(*keys, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places"))
    votes = votes.withColumn("own", F.struct(words("places").alias("n"), (-F.col("first")).alias("early"), (F.col("last") + k - 1).alias("last")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > SLACK, F.lit(True)).cast("int")
    merged = votes.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order))
    merged = merged.groupBy(*keys, "span").agg(
        F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"), words(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"),
        F.max("own").alias("own"))
    long = F.col("last") - F.col("first") + 1 > STRETCH * F.col("length")
    pick = lambda alone, whole: F.when(long, alone).otherwise(F.col(whole))
    return merged.select(
        "row", "template", "label", pick(-F.col("own.early"), "first").alias("first"), pick(F.col("own.last"), "last").alias("last"),
        (pick(F.col("own.n"), "n") / F.col("length")).alias("covered"), "needed")


def scan(docs: DataFrame, templates: list[tuple] | None = None, phrases: dict[str, str] | None = None, k: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """One row a document, and its verified spans (row, label, first, last, covered).

    Documents: doc_id, row, n_words, n_base, first_word, last_word, base_labels, labels, score for
    every row (doc_id, text). Words count from 0; null and empty texts have none. `score` is 1 where
    a base phrase stands, else the largest share of a template that a span covers, denied ones left out. Repeated rows and
    null ids are rows like others; other columns are ignored.
    """
    spark = docs.sparkSession
    rows, number = gram_rows([*TEMPLATES, *identifier_templates(IDENTIFIERS)] if templates is None else templates, k)
    places = spark.createDataFrame(rows, "template int, label string, length int, needed double, gram long, place long")
    kinds = "doc_id long, row long, n_words long, n_base long, first_word long, last_word long, base array<string>, grams array<struct<gram: bigint, at: bigint>>, denied array<bigint>"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    read = cut_lineage(texts.mapInArrow(_read(number, PHRASES if phrases is None else phrases, k), kinds), "license-words")
    found = cut_lineage(spans(read.where(F.size("grams") > 0), places, k), "license-spans")
    denials = read.where(F.size("denied") > 0).select("row", F.explode("denied").alias("first"))
    found = cut_lineage(found.join(denials, ["row", "first"], "left_anti"), "license-notices")
    enough = F.col("covered") >= F.col("needed")
    by_row = found.groupBy(F.col("row").alias("s_row")).agg(F.max("covered").alias("best"), F.collect_set(F.when(enough, F.col("label"))).alias("more"))
    out = read.join(by_row, F.col("row") == F.col("s_row"), "left")
    none = F.array().cast("array<string>")
    out = out.select(
        "doc_id", "row", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
    return out, found.where(enough).select("row", "label", "first", "last", "covered")
