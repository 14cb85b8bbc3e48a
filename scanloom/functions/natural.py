"""Natural order: digit runs compare as numbers, other text by code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(text: Column) -> Column:
    """Sortable array of structs (is_text, number, text), one per run of digits or other characters.

    Numbers sort before text at the same place. NULL text has a NULL key. Numbers beyond a long compare
    by length and digits, so no run is too long.
    """
    runs = F.regexp_extract_all(text, F.lit(r"\d+|\D+"), F.lit(0))

    def part(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+(?=.)", "")
        number = run.rlike(r"^\d")
        return F.struct(
            F.when(number, 0).otherwise(1).alias("is_text"),
            F.when(number, F.length(digits)).otherwise(0).alias("width"),
            F.when(number, digits).otherwise(run).alias("run"),
        )

    return F.when(text.isNotNull(), F.transform(runs, part))


def natural_text(text: Column, width: int = 20) -> Column:
    """The key as one string: digit runs padded to ``width``. For runs of up to ``width`` digits."""
    runs = F.regexp_extract_all(text, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(r, width, "0")).otherwise(r)), "")
