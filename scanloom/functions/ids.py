"""Identifier text: one spelling per id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that sites write where an id is absent (compared in lower case).
NULL_WORDS = ("", "na", "nan", "none", "null")


def null_words_sql() -> str:
    return ", ".join(f"'{w}'" for w in NULL_WORDS)


def canonical_id(text: Column) -> Column:
    """One spelling for ids that are equal but for case, blanks, ``-``, ``_`` and a final ``.h5``.

    Blank text and the words of NULL_WORDS are NULL, as is an id of separators alone.
    """
    plain = F.regexp_replace(F.lower(text), r"[\s \-_]+", "")
    plain = F.regexp_replace(plain, r"(\.h5)+$", "")
    return F.when(F.lower(F.trim(text)).isin(*NULL_WORDS) | plain.isin(*NULL_WORDS), None).otherwise(plain)


def canonical_id_sql(column: str) -> str:
    """The same rule for DuckDB."""
    plain = f"regexp_replace(regexp_replace(lower({column}), '[\\s\\-_]+', '', 'g'), '(\\.h5)+$', '')"
    return f"(case when lower(trim({column})) in ({null_words_sql()}) or {plain} in ({null_words_sql()}) then null else {plain} end)"
