"""The scalar helpers as SQL functions, for users who write SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .numbers import LENIENT_NUMBER
from .text import WHITESPACE

_LENIENT = LENIENT_NUMBER.replace("\\", "\\\\")
_BLANKS = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)

# Name -> definition. All are pure expressions, so the optimizer inlines them.
DEFINITIONS = {
    "clean_text": "(v STRING) RETURNS STRING RETURN nullif(trim(BOTH '{blanks}' FROM v), '')",
    "explicit_date": (
        "(v STRING) RETURNS DATE RETURN CASE"
        " WHEN clean_text(v) RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\\\z' THEN try_to_date(clean_text(v), 'yyyy-MM-dd')"
        " WHEN clean_text(v) RLIKE '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}\\\\z' THEN try_to_date(clean_text(v), 'MM/dd/yyyy') END"
    ),
    "us_number": (
        "(v STRING) RETURNS DECIMAL(28,10) RETURN CASE WHEN clean_text(v) RLIKE '{lenient}' THEN"
        " CASE WHEN contains(v, '-') THEN -1 ELSE 1 END"
        " * try_cast(regexp_replace(regexp_replace(clean_text(v), '[+,-]', ''), '[.]$', '') AS DECIMAL(28,10)) END"
    ),
}


def register(spark: SparkSession) -> None:
    for name, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body.format(blanks=_BLANKS, lenient=_LENIENT)}")
