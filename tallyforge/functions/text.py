"""Text readers: trimming, case, identifiers, vocabularies, JSON rendering of a row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Both ends trimmed of any Unicode white space; a missing cell reads as empty text."""
    return F.btrim(F.coalesce(value, F.lit("")), F.lit(WHITESPACE))


def clean_text(value: Column) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(F.btrim(value, F.lit(WHITESPACE)), F.lit(""))


def is_identifier(value: Column, length: int) -> Column:
    """Exactly ``length`` characters, all letters or digits of any script."""
    return (F.length(value) == length) & value.rlike(r"^[\p{L}\p{N}]+\z")


def title_case(value: Column) -> Column:
    """Upper-case the first letter after any non-letter, lower-case the rest.

    Plain words take the codegen path of ``initcap``; only text with other characters is cut in runs.
    """
    runs = F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    by_run = F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )
    return F.when(value.rlike(r"^[\p{L} ]*\z"), F.initcap(value)).otherwise(by_run)


def first_upper(value: Column) -> Column:
    """First character up, everything after it down."""
    return F.concat(F.upper(F.left(value, F.lit(1))), F.lower(F.substr(value, F.lit(2))))


def from_vocabulary(value: Column, words: Iterable[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """Case-insensitive word replacement; unknown words give ``otherwise`` (NULL by default)."""
    folded = F.lower(value)
    result = None
    for word, meaning in words:
        result = (result if result is not None else F).when(folded == word.lower(), F.lit(meaning))
    return result.otherwise(otherwise) if otherwise is not None else result


def in_domain(value: Column, domain: Sequence[str]) -> Column:
    return F.coalesce(value.isin(list(domain)), F.lit(False))


def longer_than(value: Column, limit: int) -> Column:
    """Length test that ignores trailing blanks."""
    return F.length(F.rtrim(value)) > limit


def row_json(columns: Sequence[str], prefix: str = "") -> Column:
    """The row as JSON text in the given column order, keeping NULL members."""
    return F.to_json(
        F.struct(*[F.col(prefix + c).alias(c) for c in columns]), {"ignoreNullFields": "false"}
    )


def json_field(document: Column, name: str) -> Column:
    return F.get_json_object(document, f"$.{name}")


def is_json(document: Column) -> Column:
    return F.try_parse_json(document).isNotNull()
