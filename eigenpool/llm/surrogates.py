"""Surrogates for personal data: keyed, type-consistent, distinct, and the same for the same entity.

One pattern finds e-mail addresses, IPv6 and IPv4 addresses, payment cards, identity numbers,
phone numbers, and names after a title, in scripts with or without upper case. Where a text has
such names, their words are replaced wherever they stand in that text, and with a surname the given
name before it. An entity falls into parts that have surrogates of their own: an address into
mailbox and domain, a name into words, so that one company keeps one domain and one family one
surname. A part has a canonical form (lower case; digits without the country code 1; the eight groups
of an IPv6 address), so different spellings of one entity get the same surrogate.

A surrogate is drawn character by character from a keyed hash of the canonical form, hashed in an
inner and an outer step with the key in both: digits become digits and letters letters of their script, all else
stays, so format and length are kept. A card that passes the Luhn check gets a surrogate that does. Titles
stay, and with them the gender; where names are inflected for it (Cyrillic, Greek) their last
letter stays too. All distinct parts are checked: where two would get one surrogate, or one would be some
real part, the later is drawn anew, with a longer form once the short ones seem used up. The text is cut at
the entities and put together with the surrogates; nothing of it leaves the executors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eigenpool.llm.common import let
from eigenpool.session import cut_lineage

#: Setting that names the key. The key below only serves where none is set, as in tests: whoever
#: knows the key can look up short numbers.
KEY_SETTING = "spark.eigenpool.surrogates.key"
KEY = "surrogates-1"
#: Draws after which a surrogate grows by a character each.
SAME_LENGTH_DRAWS = 8

# Patterns, in the order in which they are tried; titles give a name's gender.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,60}\.\p{L}{2,24}(?![\p{L}\p{N}])"
IP6 = (r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})"
       r"(?![\p{L}\p{N}:])")
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}(?:-[0-9]{6}-|\x20[0-9]{6}\x20)[0-9]{5})(?![0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = (r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ ]?[0-9]{3}-[0-9]{4}"
         r"|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}|(?<![0-9.,])[2-9][0-9]{2}(?:\.[2-9][0-9]{2}\.|\x20[2-9][0-9]{2}\x20)[0-9]{4})(?![0-9])")
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora|Signor|Signora|г-н|г-жа|господин|госпожа|Господин|Госпожа|κύριος|κυρία|Κύριος|Κυρία"
#: A word of a name: with upper case, two or three Chinese or two to four Korean characters, or a word of another script without case.
NAME_WORD = r"(?:\p{Lu}[\p{L}\p{M}'-]+|\p{IsHan}{2,3}|\p{IsHangul}{2,4}|(?![\p{IsHan}\p{IsHangul}])\p{Lo}[\p{Lo}\p{M}]+)"
NAME = rf"(?<!\p{{L}})(?:{TITLES})\.?\x20{NAME_WORD}(?:\x20{NAME_WORD})?"
KINDS = {"email": EMAIL, "ip6": IP6, "ip": IP, "card": CARD, "id": IDENTITY, "phone": PHONE, "name": NAME}
ANY = "|".join(KINDS.values())
#: Every entity has an @, a digit or a title; texts without are passed over quickly.
HINT = rf"[0-9@]|(?:{TITLES})\.?\x20[\p{{Lu}}\p{{Lo}}]"
#: What stands before a name's word when it comes again: a given name, inside a sentence.
GIVEN = r"(?:(?<=[\p{Ll},]\x20)\p{Lu}\p{Ll}[\p{L}'-]*\x20)?"
# Letters a surrogate's letters are drawn from, by script; the others become Latin.
LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"
# Scripts without case, their first letter and how many follow one another.
UNCASED = {
    "Han": (0x4E00, 20902), "Hangul": (0xAC00, 11172), "Hiragana": (0x3042, 80), "Katakana": (0x30A2, 80), "Arabic": (0x0628, 19),
    "Hebrew": (0x05D0, 27), "Devanagari": (0x0915, 37), "Thai": (0x0E01, 46),
}


def kind_of(entity: Column) -> Column:
    whole = lambda pattern: entity.rlike(rf"^(?:{pattern})$")
    return (F.when(entity.contains("@"), "email").when(entity.rlike("^[0-9A-Fa-f]{1,4}:"), "ip6").when(whole(IP), "ip").when(whole(CARD), "card")
            .when(whole(IDENTITY), "id").when(entity.rlike(r"^[+(0-9]"), "phone").otherwise("name"))


def _is(kind: str):
    return lambda entity: kind_of(entity) == kind


def _titleless(entity: Column) -> Column:
    return F.regexp_replace(entity, rf"^(?:{TITLES})\.?\x20", "")


def _halves(address: Column) -> tuple[Column, Column]:
    """The groups before and after the gap `::`; without a gap, all are before."""
    half = lambda i: F.filter(F.split(F.coalesce(F.get(F.split(address, "::"), F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    return half(0), half(1)


def canonical(entity: Column) -> Column:
    """What tells entities of a kind apart: digits of numbers, lower case of the rest, eight groups of an IPv6 address."""
    digits = F.regexp_replace(entity, r"[^0-9]", "")
    national = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substr(digits, F.lit(2))).otherwise(digits)
    before, after = _halves(F.lower(entity))
    groups = F.concat(before, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(before) - F.size(after))), after)
    groups = F.array_join(F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")
    kind = kind_of(entity)
    return (F.when(kind == "phone", national).when(kind.isin("card", "id"), digits).when(kind == "ip", entity).when(kind == "ip6", groups)
            .when(kind == "email", F.lower(entity)).otherwise(F.lower(_titleless(entity))))


def parts(entity: Column) -> Column:
    """What of an entity has a surrogate of its own, as (kind, form): mailbox and domain, words of a name, or the whole."""
    def part(kind: Column, form: Column) -> Column:
        return F.struct(kind.alias("kind"), form.alias("form"))

    def cut(kind: Column) -> Column:
        form = canonical(entity)
        mail = F.array(part(F.lit("mailbox"), form), part(F.lit("domain"), F.substring_index(form, "@", -1)))
        words = F.transform(F.split(form, " "), lambda w: part(F.lit("word"), w))
        return F.when(kind == "email", mail).when(kind == "name", words).otherwise(F.array(part(kind, form)))

    return let(kind_of(entity), cut)


def _drawn(kind: Column, form: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a part's form: as many characters of the same kinds, and more after many draws.

    A mailbox is drawn before its real domain, so that it differs from the others there.
    """
    inner, outer = (hashlib.sha256(f"{side}\x1f{key}".encode()).hexdigest() for side in ("inner", "outer"))

    def body_of(digest: Column) -> Column:
        def numbers(i: Column) -> Column:
            # eight hex digits of a keyed hash for each character place
            return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(outer), digest, i), 256), 1, 8), 16, 10).cast("long")

        def pick(alphabet: str, n: Column) -> Column:
            return F.substr(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))

        def from_range(first: int, size: int, n: Column) -> Column:
            return F.decode(F.unhex(F.lpad(F.hex(n % size + first), 4, "0")), "UTF-16BE")

        def character(c: Column, i: Column) -> Column:
            def drawn(n: Column) -> Column:
                out = (F.when(c.rlike("[0-9]"), pick("0123456789", n)).when(c.rlike("[a-z]"), pick(LATIN, n)).when(c.rlike(r"\p{IsCyrillic}"), pick(CYRILLIC, n))
                       .when(c.rlike(r"\p{IsGreek}"), pick(GREEK, n)))
                for script, (first, size) in UNCASED.items():
                    out = out.when(c.rlike(rf"(?=\p{{L}})\p{{Is{script}}}"), from_range(first, size, n))
                return out.when(c.rlike(r"\p{L}"), pick(LATIN, n)).when(c.rlike(r"\p{N}"), pick("0123456789", n)).otherwise(c)

            return let(numbers(i), drawn)

        def same(part: Column) -> Column:
            return F.array_join(F.transform(F.split(part, ""), character), "")

        extra = F.greatest(F.lit(0), attempt - SAME_LENGTH_DRAWS)
        more = F.repeat(pick(LATIN, numbers(F.lit(-1))), extra)
        digits = F.repeat(pick("0123456789", numbers(F.lit(-1))), extra)
        # the ending of a domain stays
        ending = F.regexp_extract(form, r"(\.[^.@]*)$", 1)
        domain = F.concat(more, same(F.substr(form, F.lit(1), F.length(form) - F.length(ending))), ending)
        mailbox = F.concat(more, same(F.substring_index(form, "@", 1)), F.lit("@"), F.substring_index(form, "@", -1))
        octet = lambda i: (numbers(F.lit(i)) % 254 + 1).cast("string")
        # the first group stays and zeros stay, until the draws seem used up
        group = lambda g, i: F.when((i == 0) | ((g == "0") & (extra == 0)), g).otherwise(F.concat(
            pick("123456789abcdef", numbers(i)), F.substr(F.lpad(F.hex(numbers(i + 8) % 4096), 3, "0"), F.lit(1), F.when(extra > 0, F.lit(3)).otherwise(F.length(g) - 1))))
        ip6 = F.lower(F.array_join(F.transform(F.split(form, ":"), group), ":"))
        # a number keeps its first digit, so that it stays one of its issuer or country
        number = F.concat(F.substring(form, 1, 1), F.substr(same(form), F.lit(2)))
        card = F.when(luhn(form), luhn_closed(number)).otherwise(number)
        last = F.regexp_extract(form, r"([\p{IsCyrillic}\p{IsGreek}])$", 1)
        word = F.concat(same(F.substr(form, F.lit(1), F.length(form) - F.length(last))), more, last)
        return (F.when(kind == "domain", domain).when(kind == "mailbox", mailbox).when(kind == "ip", F.concat_ws(".", *map(octet, range(4)))).when(kind == "ip6", ip6)
                .when(kind == "card", card).when(kind.isin("phone", "id"), F.concat(number, digits)).otherwise(word))

    return let(F.sha2(F.concat_ws("\x1f", F.lit(inner), kind, form, attempt), 256), body_of)


def _luhn_sum(digits: Column, skip_last: bool) -> Column:
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substr(digits, i.cast("int"), F.lit(1)).cast("int")
        doubled = (n - i) % 2 == 1
        return s + F.when(doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    places = F.sequence(F.lit(1), n - (1 if skip_last else 0))
    return F.when(n > 1, F.aggregate(places, F.lit(0), add)).otherwise(0)


def luhn(digits: Column) -> Column:
    return _luhn_sum(digits, False) % 10 == 0


def luhn_closed(digits: Column) -> Column:
    """The number with its last digit set so that it passes."""
    check = ((10 - _luhn_sum(digits, True) % 10) % 10).cast("string")
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), check)


def rendered(entity: Column, drawn: Column) -> Column:
    """The surrogates of an entity's parts in its spelling: its separators, title, country code, gap and upper case."""
    def number(surrogate: Column) -> Column:
        # digits before the canonical ones are a country code and stay
        ahead = F.length(F.regexp_replace(entity, "[^0-9]", "")) - F.length(canonical(entity))
        start = F.struct((-ahead).alias("at"), F.lit("").alias("out"))

        def digit(s: Column, c: Column) -> Column:
            is_digit = c.rlike("[0-9]")
            put = F.when(is_digit & (s["at"] >= 0), F.substr(surrogate, s["at"] + 1, F.lit(1))).otherwise(c)
            return F.struct((s["at"] + is_digit.cast("int")).alias("at"), F.concat(s["out"], put).alias("out"))

        return F.aggregate(F.split(entity, ""), start, digit, lambda s: F.concat(s["out"], F.substr(surrogate, s["at"] + 1)))

    def address(surrogate: Column) -> Column:
        before, after = _halves(entity)
        groups = F.split(surrogate, ":")
        wide = lambda gs, shift: F.array_join(F.transform(gs, lambda g, i: F.lpad(
            F.get(groups, i + shift), F.greatest(F.length(g), F.length(F.get(groups, i + shift))), "0")), ":")
        gap = F.slice(groups, F.size(before) + 1, 8 - F.size(before) - F.size(after))
        kept = F.concat(wide(before, F.lit(0)), F.lit("::"), wide(after, 8 - F.size(after)))
        out = F.when(~entity.contains("::"), wide(before, F.lit(0))).when(F.forall(gap, lambda g: g == "0"), kept).otherwise(surrogate)
        return F.when(entity == F.upper(entity), F.upper(out)).otherwise(out)

    def cased(word: Column, surrogate: Column) -> Column:
        spelled = F.split(word, "")
        return F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(F.get(spelled, i).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")

    def put(kind: Column) -> Column:
        title = F.regexp_extract(entity, rf"^((?:{TITLES})\.?\x20)", 1)
        name = F.concat(title, F.array_join(F.zip_with(F.split(_titleless(entity), " "), drawn, cased), " "))
        mail = F.concat(F.substring_index(drawn[0], "@", 1), F.lit("@"), F.get(drawn, F.lit(1)))
        return (F.when(kind == "name", name).when(kind == "email", mail).when(kind.isin("card", "phone", "id"), number(drawn[0]))
                .when(kind == "ip6", address(drawn[0])).otherwise(drawn[0]))

    return let(kind_of(entity), put)


def key_of(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, None) or KEY


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, form, attempt, surrogate), all surrogates of a kind distinct and none a real part.

    `entities` is (kind, form), distinct. The smaller form keeps a contested surrogate.
    """
    draw = lambda df: df.withColumn("surrogate", _drawn(F.col("kind"), F.col("form"), F.col("attempt"), key))
    real = cut_lineage(entities, "entities")
    now = cut_lineage(draw(real.withColumn("attempt", F.lit(0))), "drawn")
    while True:
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "form")).alias("first"), F.count("*").alias("n"))
        taken = first.where("n > 1").select("kind", "surrogate", F.col("first.form").alias("owner"))
        used = real.select("kind", F.col("form").alias("surrogate"), F.lit(None).cast("string").alias("owner"))
        clash = now.join(taken.unionByName(used.join(now.select("kind", "surrogate"), ["kind", "surrogate"], "left_semi")), ["kind", "surrogate"])
        again = cut_lineage(clash.where(~F.col("form").eqNullSafe(F.col("owner"))).select("kind", "form").distinct(), "clashes")
        if not again.limit(1).count():
            return now
        again = again.withColumn("again", F.lit(1))
        moved = now.join(again, ["kind", "form"], "left")
        stay = moved.where("again is null").select("kind", "form", "attempt", "surrogate")
        drawn = draw(moved.where("again = 1").select("kind", "form", (F.col("attempt") + 1).alias("attempt")))
        now = cut_lineage(stay.unionByName(drawn), "drawn")


def patterned(rows: DataFrame) -> DataFrame:
    """Adds `pattern`, what to replace in a row's `text`, and `found`, its matches from left to right."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn("found", F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(none))
    words = F.array_distinct(F.flatten(F.transform(F.filter("found", _is("name")), lambda e: F.split(_titleless(e), " "))))
    # the longest first, as one word may begin another; where there is no upper case, words run on and only the title tells a name
    words = F.filter(words, lambda w: w.rlike(r"^\p{Lu}"))
    quoted = F.transform(F.reverse(F.array_sort(words)), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E")))
    mentions = F.concat(F.lit(rf"{ANY}|{GIVEN}(?<![\p{{L}}\p{{M}}])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{M}])"))
    rows = rows.withColumn("pattern", F.when(F.size(words) > 0, mentions).otherwise(F.lit(ANY)))
    again = F.when(F.col("pattern") != ANY, F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.col("found"))
    return rows.withColumn("found", again)


def replace(docs: DataFrame, key: str | None = None) -> DataFrame:
    """(doc_id, text, n_email, n_ip6, n_ip, n_card, n_id, n_phone, n_name) for every row (doc_id, text).

    `text` is the whole text with each entity's surrogate in its place. Null texts stay null and
    texts without an entity stay as they are, with counts 0. Equal parts get equal surrogates in all
    documents, for one key: `key`, or the session's setting `KEY_SETTING`. Names count wherever they are replaced.
    Repeated rows and null ids are rows like others; other columns are ignored.
    """
    key = key or key_of(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    entities = patterned(rows).select(F.explode(F.array_distinct("found")).alias("e")).distinct()
    entities = entities.select(F.explode(parts(F.col("e"))).alias("p")).select("p.*").distinct()
    given = assign(entities, key)
    # Nearly all surrogates come from the first draw and are computed in place; the others are joined.
    again = cut_lineage(given.where("attempt > 0").select("kind", "form", F.col("attempt").alias("attempt")), "redrawn")
    hash_of = F.xxhash64("text")
    if again.limit(1).count():
        at = patterned(rows).select(hash_of.alias("a_hash"), F.explode(F.array_distinct("found")).alias("e"))
        at = at.select("a_hash", F.explode(parts(F.col("e"))).alias("n")).distinct()
        at = at.join(again, (F.col("n.kind") == again["kind"]) & (F.col("n.form") == again["form"])).select(
            "a_hash", F.struct("kind", "form", "attempt").alias("x"))
        redrawn = cut_lineage(at.groupBy("a_hash").agg(F.collect_set("x").alias("redrawn")), "redrawn-texts")
        rows = rows.withColumn("t_hash", hash_of).join(redrawn, F.col("t_hash") == F.col("a_hash"), "left").drop("t_hash", "a_hash")
    else:
        rows = rows.withColumn("redrawn", F.lit(None).cast("array<struct<kind: string, form: string, attempt: int>>"))
    rows = patterned(rows)

    def surrogate(e: Column) -> Column:
        def put(n: Column) -> Column:
            own = F.filter("redrawn", lambda x: (x["kind"] == n["kind"]) & (x["form"] == n["form"]))
            attempt = F.coalesce(F.get(own, F.lit(0))["attempt"], F.lit(0))
            return _drawn(n["kind"], n["form"], attempt, key)

        return let(F.transform(parts(e), put), lambda drawn: rendered(e, drawn))

    gaps = F.split(F.col("text"), F.col("pattern"), -1)
    woven = F.array_join(F.flatten(F.zip_with(gaps, F.transform("found", surrogate), lambda gap, s: F.array(gap, F.coalesce(s, F.lit(""))))), "")
    clean = F.when(F.size("found") > 0, woven).otherwise(F.col("text"))
    counts = [F.size(F.filter("found", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", clean.alias("text"), *counts)
