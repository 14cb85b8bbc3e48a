"""Mapping free-entered values to a canonical list: a partition-based pigeonhole join, in SQL operators only.

A canonical entry has forms: its name, its code, and both written without blanks. Every form is a set of
words. A free value is cut into words; a word means a canonical word when it is within k edits of it
(k by the word's length), or is its beginning, or its consonants. The edit search never compares all
words: each canonical word is cut into k + 1 segments, one of which must occur unchanged in a word
within k edits, and where it can lie follows from the word's length and the edits that remain on either
side; so words join on (length, place, substring) and ``levenshtein`` verifies. A value means the entry whose form it covers completely; of several the one
with the most letters, then the fewest edits. Words that no canonical word is near are noise. What no form
covers is found by anti-join and reported as entry 0.

Work is done on distinct values and distinct words, so frequent values cost once. Defined results: rows
whose values are all NULL or blank are left out; the first value that means an entry decides; empty
tables give empty results; equal scores go to the smallest entry id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

# Digits that stand for number words.
DIGIT_WORDS = {"1": "one", "2": "two", "3": "three", "4": "four", "5": "five", "6": "six"}
#: Edits allowed by word length: (from length, edits).
EDITS = ((0, 0), (4, 1), (6, 2))
MAX_EDITS = EDITS[-1][1]
LEAST_PREFIX = 4
LEAST_SKELETON = 3


def allowed(word: Column) -> Column:
    """Edits allowed to a canonical word; one at most for short codes with a digit, which lie close together."""
    out = F.lit(0)
    for least, k in EDITS[1:]:
        out = F.when(F.length(word) >= least, k).otherwise(out)
    return F.when(word.rlike(r"\d") & (F.length(word) <= 8), F.least(out, F.lit(1))).otherwise(out)


def words_of(text: Column) -> Column:
    """array<string>: lower-case runs of letters and digits; camel case is cut."""
    cut = F.regexp_replace(text, r"(\p{Ll})(\p{Lu})", "$1 $2")
    return F.regexp_extract_all(F.lower(cut), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0))


def joined(text: Column) -> Column:
    """The value in lower case without anything but letters and digits."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{Nd}]+", "")


def in_digits(word: Column) -> Column:
    """The word with a number word at its start written as a digit."""
    for digit, name in DIGIT_WORDS.items():
        word = F.regexp_replace(word, f"^{name}", digit)
    return word


def skeleton(word: Column) -> Column:
    """The word without its vowels, but for a first one."""
    return F.concat(F.substring(word, 1, 1), F.regexp_replace(F.substr(word, F.lit(2)), "[aeiou]", ""))


def shortened(word: Column) -> Column:
    """array<string>: the beginnings of a word and its consonants."""
    n = F.length(word)
    begun = F.when(n > LEAST_PREFIX, F.transform(F.sequence(F.lit(LEAST_PREFIX), F.greatest(n - 1, F.lit(LEAST_PREFIX))), lambda i: F.left(word, i)))
    bare = skeleton(word)
    consonants = F.when((F.length(bare) >= LEAST_SKELETON) & (bare != word), F.array(bare))
    none = F.array().cast("array<string>")
    return F.array_union(F.coalesce(begun, none), F.coalesce(consonants, none))


def forms(entries: DataFrame, id_col: str, text_cols: tuple[str, ...]) -> DataFrame:
    """(entry, form, slots, size, slot, ref, short): each text of an entry as its words, a slot each, and as one word.

    The form as one word has variants in which one of its words is shortened or in digits (short = 1).
    ``size`` is the number of words of the text either way.
    """
    out = None
    for i, c in enumerate(text_cols):
        base = entries.where(F.trim(F.coalesce(F.col(c), F.lit(""))) != "").select(F.col(id_col).alias("entry"), words_of(F.col(c)).alias("ws"), joined(F.col(c)).alias("whole"))
        base = base.withColumn("size", F.size("ws"))
        split = base.select("entry", F.lit(2 * i).alias("form"), F.size(F.array_distinct("ws")).alias("slots"), "size", F.posexplode(F.array_distinct("ws")).alias("slot", "w"))
        split = split.select("entry", "form", "slots", "size", "slot", F.explode(F.array_distinct(F.array("w", in_digits(F.col("w"))))).alias("ref"), F.lit(0).alias("short"))
        variants = F.flatten(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.transform(
            F.array_union(shortened(F.get("ws", k)), F.array(in_digits(F.get("ws", k)))),
            lambda w: F.concat(F.array_join(F.slice("ws", 1, k), ""), w, F.array_join(F.slice("ws", k + 2, F.col("size")), "")),
        )))
        one = base.select("entry", F.lit(2 * i + 1).alias("form"), F.lit(1).alias("slots"), "size", F.lit(0).alias("slot"), "whole", variants.alias("variants"))
        whole = one.select("entry", "form", "slots", "size", "slot", F.col("whole").alias("ref"), F.lit(0).alias("short")).union(
            one.where("size > 1").select("entry", "form", "slots", "size", "slot", F.explode("variants").alias("ref"), F.lit(1).alias("short"))
        )
        both = split.union(whole)
        out = both if out is None else out.union(both)
    return out


def _segments(word: Column, k: Column) -> Column:
    """array<struct(no, start, piece)>: k + 1 nearly equal pieces with their 1-based starts."""
    def piece(i: Column) -> Column:
        n, parts = F.length(word), k + 1
        start = F.floor(i * n / parts).cast("int")
        stop = F.floor((i + 1) * n / parts).cast("int")
        return F.struct(i.alias("no"), (start + 1).alias("start"), F.substring(word, start + 1, stop - start).alias("piece"))

    return F.transform(F.sequence(F.lit(0), k), piece)


def near_words(free: DataFrame, known: DataFrame) -> DataFrame:
    """(word, ref, edits): canonical words that each distinct free word can mean.

    ``free`` has distinct ``word``s, ``known`` distinct ``ref``s with ``single``, true for words of their
    own. Exact words are not searched for edits; beginnings and consonants of single words count one edit.
    """
    known = known.select("ref", "single", allowed(F.col("ref")).alias("k"))
    exact = free.join(known, F.col("word") == F.col("ref")).select("word", "ref", F.lit(0).alias("edits"))
    rest = free.join(known, F.col("word") == F.col("ref"), "left_anti")
    cut = known.where("k > 0").select("ref", "k", F.length("ref").alias("n"), F.explode(_segments(F.col("ref"), F.col("k"))).alias("s"))
    cut = cut.select("ref", "k", "n", "s.no", "s.start", "s.piece", F.length("s.piece").alias("width"), F.explode(F.sequence(F.col("n") - F.col("k"), F.col("n") + F.col("k"))).alias("len"))
    # where a piece can lie in a word of that length: what is before it took at most ``no`` edits or what is after it the others
    # at most, or another piece fits as well
    gap, rest_edits = F.col("len") - F.col("n"), F.col("k") - F.col("no")
    least = F.greatest(F.col("start") - F.col("no"), F.col("start") + gap - rest_edits, F.lit(1))
    most = F.least(F.col("start") + F.col("no"), F.col("start") + gap + rest_edits, F.col("len") - F.col("width") + 1)
    places = cut.withColumns({"least": least, "most": most}).where("least <= most").select("ref", "k", "len", "width", "piece", F.explode(F.sequence("least", "most")).alias("at"))
    places = stored(places, "places")
    # per word length where pieces can lie and how long they are: bounded by the longest canonical word
    shapes: dict[int, list[tuple[int, int]]] = {}
    for r in places.select("len", "at", "width").distinct().orderBy("len", "at", "width").collect():
        shapes.setdefault(r["len"], []).append((r["at"], r["width"]))
    spot = "array<struct<at:int,width:int>>"
    spots = F.lit(None).cast(spot)
    for length, found in shapes.items():
        spots = F.when(F.length("word") == length, F.array(*[F.struct(F.lit(at).alias("at"), F.lit(width).alias("width")) for at, width in found])).otherwise(spots)
    probes = rest.select("word", F.length("word").alias("len"), F.explode(spots).alias("s")).select(
        "word", "len", "s.at", "s.width", F.expr("substring(word, s.at, s.width)").alias("piece")
    )
    close = (
        probes.join(places, ["len", "at", "width", "piece"]).select("word", "ref", "k").distinct()
        .select("word", "ref", "k", F.levenshtein("word", "ref").alias("edits")).where("edits <= k").drop("k")
    )
    nearest = close.withColumn("least", F.min("edits").over(Window.partitionBy("word"))).where("edits = least").drop("least")
    short = known.where("single").select("ref", F.explode(shortened(F.col("ref"))).alias("word"))
    begun = free.join(short, "word").select("word", "ref", F.lit(1).alias("edits"))
    return exact.union(nearest).union(begun).groupBy("word", "ref").agg(F.min("edits").alias("edits"))


def meanings(texts: DataFrame, entries: DataFrame, id_col: str, text_cols: tuple[str, ...]) -> DataFrame:
    """(text, entry) of the distinct texts that mean an entry.

    Of several entries the one with the most words is meant, then the one with the fewest edits, whose
    words lie closest together, and that comes first.
    """
    ref = stored(forms(entries, id_col, text_cols), "forms")
    known = ref.groupBy("ref").agg(F.max(F.col("form") % 2 == 0).alias("single"))
    known_texts = stored(texts.select("text").withColumn("tid", F.monotonically_increasing_id()), "texts")  # long texts travel as ids
    words = words_of(F.col("text"))
    tokens = known_texts.select("tid", F.posexplode(words).alias("at", "word")).union(known_texts.select("tid", F.lit(0), joined(F.col("text"))))
    tokens = stored(tokens.where("word <> ''").groupBy("tid", "word").agg(F.min("at").alias("at")), "words")
    near = stored(near_words(tokens.select("word").distinct(), known), "near")
    # the fewest edits, then the first place, as one number
    cost = F.shiftleft((F.col("edits") + F.col("short")).cast("bigint"), 32) + F.col("at")
    slots = (
        tokens.join(near, "word").join(ref, "ref")
        .groupBy("tid", "entry", "form", "slot")
        .agg(F.min(cost).alias("m"), F.max("slots").alias("slots"), F.max("size").alias("size"))
        .withColumns({"edits": F.shiftright("m", 32), "at": F.col("m").bitwiseAND((1 << 32) - 1)})
    )
    scored = (
        slots.groupBy("tid", "entry", "form")
        .agg(F.count(F.lit(1)).alias("n"), F.max("slots").alias("slots"), F.max("size").alias("size"), F.sum("edits").alias("edits"),
             F.min("at").alias("first"), F.max("at").alias("last"))
        .where("n = slots")
    )
    order = F.struct((-F.col("size")).alias("a"), F.col("edits"), (F.col("last") - F.col("first")).alias("span"), F.col("first"), F.col("entry"))
    best = scored.groupBy("tid").agg(F.min(order).alias("best")).select("tid", F.col("best.entry").alias("entry"))
    return known_texts.join(best, "tid").select("text", "entry")


def mapped(rows: DataFrame, row_id: str, value_cols: tuple[str, ...], entries: DataFrame, id_col: str, text_cols: tuple[str, ...]) -> DataFrame:
    """(row_id, entry): the entry each row means, 0 when none; values are asked in order."""
    values = rows.select(F.col(row_id).alias("row_id"), F.posexplode(F.array(*value_cols)).alias("at", "text")).where("trim(translate(text, '\t\r\n', '   ')) <> ''")
    values = stored(values, "values")
    found = meanings(values.select("text").distinct(), entries, id_col, text_cols)
    meant = values.join(found, "text").groupBy("row_id").agg(F.min(F.struct("at", "entry")).alias("m")).select("row_id", F.col("m.entry").alias("entry"))
    unmatched = values.select("row_id").distinct().join(meant, "row_id", "left_anti").select("row_id", F.lit(0).cast("bigint").alias("entry"))
    return meant.union(unmatched)
