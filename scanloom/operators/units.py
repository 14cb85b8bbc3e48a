"""Quantities recorded in different units: every stated value to one common unit.

A text states a number and, itself or through other text of its row, a unit. Both can be read in more
than one way: ``15,000`` as fifteen or fifteen thousand, ``MT`` as milli or mega. Each pair of readings is
put into the common unit through the physical identities between columns and units (a field is a
frequency over the gyromagnetic ratio; one scanner works near one strength), and the pair with the
smallest log residual against the strength known of the row's scanner is chosen. A pair whose residual
is not clearly the smallest is flagged as not unique.

Defined results: text without exactly one number, NULL and null words state nothing; zero is no
strength; empty tables give empty results; repeated rows are rows of their own; other columns are
ignored. Everything is JVM expressions, over the distinct texts and one small aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# The proton's gyromagnetic ratio in MHz per tesla, and prefixes as powers of ten.
PROTON_MHZ_PER_TESLA = 42.577
PREFIXES = {"": 0, "m": -3, "milli": -3, "u": -6, "µ": -6, "micro": -6, "k": 3, "kilo": 3, "mega": 6, "g": 9, "giga": 9, "n": -9, "nano": -9}
NUMBER_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "ten": "10", "eleven": "11", "twelve": "12",
}
#: Width variants of ASCII, by rule: U+FF01..U+FF5E, and the Greek mu for the micro sign.
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　μ"
_PLAIN = "".join(map(chr, range(0x21, 0x7F))) + " µ"

#: A residual this much (in natural logarithms) above the best one is clearly worse.
CLEAR_MARGIN = math.log(1.5)


@dataclass(frozen=True)
class Unit:
    """Spellings (lower case, without prefix), factor to millitesla, and the prefixes in use."""

    names: tuple[str, ...]
    factor: float
    prefixes: tuple[str, ...]


TESLA = ("t", "tesla", "teslas")
FIELD_UNITS = (
    Unit(TESLA, 1e3, ("", "m", "milli", "u", "µ", "micro", "mega")),
    Unit(("g", "gs", "gauss"), 0.1, ("", "k", "kilo", "m", "milli")),
    Unit(("hz", "hertz"), 1e3 / (PROTON_MHZ_PER_TESLA * 1e6), ("", "k", "kilo", "mega", "m", "g")),
)


def unit_readings(units: tuple[Unit, ...] = FIELD_UNITS) -> dict[str, list[float]]:
    """Spelling in lower case, without hyphens, to its possible factors; ``m`` may mean milli or mega."""
    out: dict[str, list[float]] = {}
    for unit in units:
        for name in unit.names:
            for p in unit.prefixes:
                if len(p) > 1 and len(name) < 3 or len(p) == 1 and len(name) > 2:
                    continue
                factors = [unit.factor * 10.0 ** PREFIXES[p]]
                if p == "m":
                    factors.append(unit.factor * 1e6)
                out.setdefault(p + name, []).extend(factors)
    return out


def plain_text(text: Column) -> Column:
    """Trimmed, in lower case, with ASCII forms of wide characters and digits for number words."""
    out = F.lower(F.trim(F.translate(text, _WIDE, _PLAIN)))
    out = F.regexp_replace(out, r"\bhalf an? ", "0.5 ")
    for word, digit in NUMBER_WORDS.items():
        out = F.regexp_replace(out, rf"\b{word}\b", digit)
    return F.regexp_replace(out, r"(\d) point (\d)", "$1.$2")


#: Labels and nucleus marks that hold digits without stating a value.
_LABELS = r"\b[bf]0\b\s*[=:]?|\(1h\)|\b1h\b"
_NUMBER = r"(?:\d{1,3}(?: \d{3})+|\d[\d.,]*|[.,]\d+)(?:e[+-]?\d+)?"


def numbers(plain: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(plain, _LABELS, " "), F.lit(f"({_NUMBER})"), F.lit(1))


def number_readings(literal: Column) -> Column:
    """array<double>: the values a numeral can mean; points and commas are decimal or group marks."""
    mantissa = F.regexp_replace(F.regexp_extract(literal, r"^([^e]*)", 1), r"[ ]|[.,]$", "")
    exponent = F.regexp_extract(literal, r"(e[+-]?\d+)$", 1)
    grouped = mantissa.rlike(r"^\d{1,3}(,\d{3})+(\.\d*)?$")
    pointed = mantissa.rlike(r"^\d{1,3}(\.\d{3})+(,\d*)?$")
    single = mantissa.rlike(r"^\d*[.,]?\d*$")
    readings = F.array(
        F.when(single, F.translate(mantissa, ",", ".")),
        F.when(grouped, F.translate(mantissa, ",", "")),
        F.when(pointed, F.translate(F.translate(mantissa, ".", ""), ",", ".")),
    )
    values = F.transform(F.filter(readings, lambda x: x.isNotNull()), lambda x: F.concat(x, exponent).try_cast("double"))
    return F.filter(values, lambda x: x.isNotNull() & (x > 0))


def _factors(name: Column) -> Column:
    """array<double> of the factors of a unit's spelling; NULL for other words."""
    table = unit_readings()
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return F.element_at(F.create_map(*pairs), F.translate(name, "-", ""))


def _alternatives() -> str:
    names = sorted(unit_readings(), key=len, reverse=True)
    return "|".join(n.replace("milli", "milli-?").replace("micro", "micro-?").replace("kilo", "kilo-?").replace("mega", "mega-?") for n in names)


def stated_unit(plain: Column) -> Column:
    """The unit in the value's own text, standing alone or right after the number; empty if none."""
    rest = F.regexp_replace(F.regexp_replace(plain, _LABELS, " "), _NUMBER, " ")
    return F.regexp_extract(rest, rf"(?<![a-zµ])({_alternatives()})(?![a-z])", 1)


def named_unit(text: Column) -> Column:
    """The unit that other text of a row names; empty if none.

    Long names count as words anywhere; short ones only where a unit is announced: in brackets, after a
    colon, slash or equals sign, or after ``in`` or ``as``, with nothing after them.
    """
    plain = F.lower(F.translate(F.coalesce(text, F.lit("")), _WIDE, _PLAIN))
    long_names = "|".join(n for n in _alternatives().split("|") if len(n) > 4)
    announced = F.regexp_extract(plain, rf"(?:[\[(:/=]\s*|\b(?:in|as)\s+)({_alternatives()})\s*(?:[\])]|$|[;,])", 1)
    worded = F.regexp_extract(plain, rf"(?<![a-z0-9µ])({long_names})(?![a-z0-9])", 1)
    return F.when(announced != "", announced).otherwise(worded)


def value_readings(values: DataFrame) -> DataFrame:
    """(raw, numbers array<double>, own array<double>, digits) of the distinct texts ``raw`` that state one number.

    ``own`` are the factors of the unit in the text itself, NULL if it has none; digits: nothing but a plain number.
    """
    base = values.where("raw is not null").distinct().withColumn("plain", plain_text(F.col("raw"))).withColumn("nums", numbers(F.col("plain")))
    unit = stated_unit(F.col("plain"))
    found = base.where(F.size("nums") == 1).select(
        "raw", number_readings(F.get("nums", F.lit(0))).alias("numbers"), F.when(unit != "", _factors(unit)).alias("own"),
        F.col("raw").rlike(r"^(\d+\.?\d*|\.\d+)$").alias("digits"), unit.isin(*TESLA).alias("own_tesla"),
    )
    return found.where(F.size("numbers") > 0)


def context_units(texts: DataFrame) -> DataFrame:
    """(text, factors, tesla) of the distinct texts that name a unit."""
    named = texts.where("text is not null").distinct().withColumn("unit", named_unit(F.col("text"))).where("unit <> ''")
    return named.select("text", _factors(F.col("unit")).alias("factors"), F.col("unit").isin(*TESLA).alias("tesla"))


def readings(df: DataFrame, id_col: str, value_col: str, group_col: str, context_cols: tuple[str, ...]) -> DataFrame:
    """(row_id, grp, plain_number, options): every pair of readings in the common unit.

    Texts repeat, so each distinct value and each distinct context is read once and joined back.
    """
    texts = [F.col(c).alias(f"c{i}") for i, c in enumerate(context_cols)]
    rows = df.select(F.col(id_col).alias("row_id"), F.col(group_col).alias("grp"), F.col(value_col).alias("raw"), *texts)
    found = rows.join(stored(value_readings(rows.select("raw")), "values"), "raw")
    for i in range(len(context_cols)):
        units = stored(context_units(rows.select(F.col(f"c{i}").alias("text"))), "contexts")
        found = found.join(units.select(F.col("text").alias(f"c{i}"), F.col("factors").alias(f"f{i}"), F.col("tesla").alias(f"t{i}")), f"c{i}", "left")
    others = [f"{i}" for i in range(len(context_cols))]
    factors = F.coalesce("own", *[f"f{i}" for i in others], F.array(F.lit(1e3)))
    tesla = F.when(F.col("own").isNotNull(), F.col("own_tesla")).otherwise(F.coalesce(*[f"t{i}" for i in others], F.lit(True)))
    options = F.flatten(F.transform("numbers", lambda v: F.transform(factors, lambda f: v * f)))
    return found.select("row_id", "grp", (F.col("digits") & tesla).alias("plain_number"), F.array_distinct(options).alias("options")).where(F.size("options") > 0)


def common_values(df: DataFrame, id_col: str, value_col: str, group_col: str, context_cols: tuple[str, ...]) -> DataFrame:
    """(row_id, value, residual, is_unique, plain_number) of each row that states one value.

    The reference is the mean logarithm of the values with one reading only, of the row's group where
    it has such values, else of all; one number per group is joined.
    """
    found = stored(readings(df, id_col, value_col, group_col, context_cols), "readings")
    sure = found.where((F.size("options") == 1) & ~F.col("plain_number")).select("grp", F.log(F.get("options", F.lit(0))).alias("x"))
    overall = sure.agg(F.avg("x")).first()[0]
    known = sure.groupBy("grp").agg(F.avg("x").alias("centre"))
    ref = F.coalesce(F.col("centre"), F.lit(overall if overall is not None else math.log(1500.0)))
    scored = found.join(known.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g")), "left").withColumn(
        "scored", F.array_sort(F.transform("options", lambda v: F.struct(F.abs(F.log(v) - ref).alias("r"), v.alias("v"))))
    )
    best, second = F.get("scored", F.lit(0)), F.get("scored", F.lit(1))
    return scored.select(
        "row_id", best["v"].alias("value"), best["r"].alias("residual"),
        (second.isNull() | (second["r"] - best["r"] > CLEAR_MARGIN)).alias("is_unique"), "plain_number",
    )
