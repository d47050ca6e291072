"""Quality rules and divergence from language references.

A document's histograms of character classes and of common words are compared with those of each
reference language by the Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1).
References are sums over the whole input. A document fails where its nearest language is too far in
either histogram, unless it is too short for the histogram to mean anything. Too few common words
can't lead far from a reference that holds few itself, so the limit for them follows from the references.

No reference speaks for a language it isn't of. So another script isn't held against a document: its classes are too far only if they
stay so with all letters in one class. And few words common in the references aren't held against a document that has common
words of its own, as prose of any language has: third and later uses of words make up `OWN_SHARE` of it.
"""

from __future__ import annotations

from functools import reduce
from math import log2, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eigenpool.llm.common import BLANK, let
from eigenpool.session import cut_lineage

WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
#: Distances above which a document fails, and the lengths from which they count.
CLASS_LIMIT, CLASS_CHARACTERS = 0.3, 200
WORD_LIMIT, WORD_WORDS = 0.4, 100
#: A document with fewer common words than any reference fails above this share of the distance that one
#: without any would have to the nearest.
LACK_SHARE = 0.83
#: Share of third and later uses of its words from which a document has common words of its own. Of the documents of sf0.1 with
#: `WORD_WORDS` words or more, 114 bad ones that lack common words have at most 0.040, and 99 % of 2,931 good ones 0.058 or more.
OWN_SHARE = 0.045

# Common words of the reference languages.
COMMON = {
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine im dem es an als auch".split(),
    "en": "the of and to in a is that for it was on are as with at be by this have from or an".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como o".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au avec ce il plus".split(),
}
# Character classes; what none of them holds is the last class.
CLASSES = {
    "lower": r"[a-z]+", "upper": r"[A-Z]+", "letter": r"[\p{L}\p{M}&&[^a-zA-Z]]+", "digit": r"\p{N}+",
    "blank": r"[\x20\x09-\x0D]+", "stop": r"[.,;:!?'\"()-]+",
}
WORDS = sorted({w for words in COMMON.values() for w in words}, key=lambda w: w.encode())


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def own_share(text: Column) -> Column:
    """The share of words of letters, whatever their case, that are the third use of a word in the text or a later one."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), "")
    return let(F.sort_array(F.transform(words, lambda w: F.xxhash64(w))), lambda ordered: (
        F.size(F.filter(ordered, lambda x, i: F.get(ordered, i + 2) == x)) / F.greatest(F.size(ordered), F.lit(1))))


def measure(docs: DataFrame) -> DataFrame:
    """One written row per document: base measures, class counts and counts of common words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", BLANK), ""))
    filled = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("filled", filled)
    n_windows = F.size("hashes") - (WINDOW - 1)
    windows = F.when(n_windows > 1, F.transform(
        F.slice("hashes", F.lit(1), F.greatest(n_windows, F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get("hashes", i + k) for k in range(1, WINDOW)))))
    number = F.array(*map(F.lit, WORDS))
    common = F.transform(F.filter("words", lambda w: w.isin(WORDS)), lambda w: F.array_position(number, w).cast("int"))
    rows = rows.withColumn("windows", windows).withColumn("common", F.sort_array(common))
    starts = F.filter(F.sequence(F.lit(1), F.size("common")), lambda i: (i == 1) | (F.get("common", i - 1) != F.get("common", i - 2)))
    rows = rows.withColumn("starts", F.when(F.size("common") > 0, starts).otherwise(F.array().cast("array<int>")))
    counts = F.transform("starts", lambda at, i: F.struct(
        F.get("common", at - 1).alias("word"), (F.coalesce(F.get("starts", i + 1), F.size("common") + 1) - at).cast("double").alias("n")))
    kinds = [_without(F.col("text"), p).cast("long").alias(f"c_{name}") for name, p in CLASSES.items()]
    repeated = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.select(
        "doc_id", "lang", F.monotonically_increasing_id().alias("row"), F.length("text").cast("long").alias("n_chars"),
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _without(F.col("text"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, F.col("windows")).alias("windows"), *kinds, counts.alias("counts"),
        F.when(F.size("words") >= WORD_WORDS, own_share(F.col("text"))).alias("own"))
    return cut_lineage(rows, "measures")


def repeat_words(rows: DataFrame) -> DataFrame:
    """(row, n_repeat_words): words in windows that occur twice or more in their text.

    Only texts with such a window come here; their windows are grouped by text and hash.
    """
    windows = rows.where(F.col("windows").isNotNull()).select("row", F.posexplode("windows").alias("at", "window"))
    twice = windows.groupBy("row", "window").agg(F.count("*").alias("n"), F.collect_list("at").alias("places")).where("n > 1")
    places = twice.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("at"))
    # each window covers its words up to the next such window
    covered = F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW))))
    return places.select(F.col("row").alias("r_row"), F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"))


def references(rows: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of the classes and of the common words for each reference language with documents."""
    rows = rows.where(F.col("lang").isin(list(COMMON)))
    kinds = [f"c_{name}" for name in CLASSES]
    totals = rows.groupBy("lang").agg(F.sum("n_chars").alias("chars"), F.sum("n_words").alias("words"), *(F.sum(k).alias(k) for k in kinds)).collect()
    counts = rows.select("lang", F.inline("counts")).groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    found = {}
    for t in totals:
        if t["chars"] and t["words"]:
            own = {r["word"]: r["n"] for r in counts if r["lang"] == t["lang"]}
            known = [t[k] / t["chars"] for k in kinds]
            found[t["lang"]] = [*known, max(0.0, 1 - sum(known))], [own.get(i + 1, 0.0) / t["words"] for i in range(len(WORDS))]
    return found


def _term(p: Column, q: Column) -> Column:
    """The part of the divergence from one bin."""
    half = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / half)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / half)).otherwise(0.0)) / 2


def _root(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), divergence)))


def class_distance(share: list[float], letters_alike: bool = False) -> Column:
    """Distance of the class histograms; `letters_alike` puts all letters in one class."""
    kinds = [F.col(f"c_{name}").cast("double") / F.col("n_chars") for name in CLASSES]
    kinds.append(F.greatest(F.lit(0.0), 1 - reduce(Column.__add__, kinds)))
    if letters_alike:
        of_letters = [name in ("lower", "upper", "letter") for name in [*CLASSES, ""]]
        join = lambda bins: [sum(x for x, letter in zip(bins, of_letters) if letter), *(x for x, letter in zip(bins, of_letters) if not letter)]
        kinds, share = join(kinds), join(share)
    return _root(reduce(Column.__add__, [_term(p, F.lit(q)) for p, q in zip(kinds, share, strict=True)]))


def word_distance(share: list[float]) -> Column:
    q = F.array(*map(F.lit, share))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(s: Column, x: Column) -> Column:
        p, own = x["n"] / F.col("n_words"), F.element_at(q, x["word"])
        return F.struct((s["sum"] + _term(p, own)).alias("sum"), (s["p"] + p).alias("p"), (s["q"] + own).alias("q"))

    known = sum(share)
    return _root(F.aggregate("counts", start, add, lambda s: (
        s["sum"] + F.greatest(F.lit(0.0), F.lit(known) - s["q"]) / 2
        + _term(F.greatest(F.lit(0.0), 1 - s["p"]), F.lit(max(0.0, 1 - known))))))


def lack_limit(shares: list[list[float]]) -> tuple[float, float]:
    """(least share of common words in a reference, distance above which a document with fewer fails)."""
    least = min(min(1.0, sum(share)) for share in shares)
    rest = 1 - least
    without = (least + (rest * log2(2 * rest / (1 + rest)) if rest > 0 else 0.0) + log2(2 / (1 + rest))) / 2
    return least, LACK_SHARE * sqrt(max(0.0, without))


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdict for every row (doc_id, text, lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance (null where there is no reference, or nothing to measure), kept.
    Null texts are empty and fail by length. Null and other languages add nothing to the references,
    and no document's own language is used to judge it. Prose in a language without a reference, also in another script,
    is left to the base rules. Repeated rows and null ids are rows like
    others; other columns are ignored. Without any reference the base rules decide alone.
    """
    rows = measure(docs)
    known = references(rows)

    def nearest(which: int, distance) -> Column:
        each = [distance(share[which]) for share in known.values()]
        return F.lit(None).cast("double") if not each else each[0] if len(each) == 1 else F.least(*each)

    rows = rows.join(repeat_words(rows), F.col("row") == F.col("r_row"), "left")
    rows = rows.withColumn("n_repeat_words", F.coalesce("n_repeat_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    rows = rows.withColumn("class_distance", F.when(F.col("n_chars") > 0, nearest(0, class_distance)))
    rows = rows.withColumn("word_distance", F.when(F.col("n_words") > 0, nearest(1, word_distance)))
    far = F.col("word_distance") > WORD_LIMIT
    if known:
        least, limit = lack_limit([share[1] for share in known.values()])
        n_common = F.aggregate("counts", F.lit(0.0), lambda s, x: s + x["n"])
        far = far | ((n_common < least * F.col("n_words")) & (F.col("word_distance") > limit))
        far = far & (F.col("own") < OWN_SHARE)
    other = F.when(F.col("class_distance") > CLASS_LIMIT, nearest(0, lambda share: class_distance(share, letters_alike=True)))
    strange = ((F.col("n_chars") >= CLASS_CHARACTERS) & F.coalesce(other > CLASS_LIMIT, F.lit(False))) | ((F.col("n_words") >= WORD_WORDS) & far)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "class_distance", "word_distance", (~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))).alias("kept"))
