"""Field-wise reading of all-text rows into typed columns plus reasons.

``read_fields`` adds, for every field ``f``:

* ``f``       the typed or normalised value (NULL when it cannot be read),
* ``_raw``    a struct with the untouched cells,
* ``_t_f``    the stripped cell,
* ``_n_f``    the parsed number before narrowing (number fields only).

``field_findings`` turns those columns into ordered (condition, message) pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SQL_DIALECT, Field, RunConfig, TableSpec
from ..functions import dates, numbers, text

NUMERIC = ("price", "rate", "count")
NARROW = {"price": numbers.MONEY, "rate": numbers.RATE}


@dataclass(frozen=True)
class Finding:
    condition: Column
    message: str


def read_fields(raw: DataFrame, spec: TableSpec, config: RunConfig) -> DataFrame:
    """Parse every column of ``raw`` (business columns, ``source_row`` and optional extras)."""
    sql = config.dialect == SQL_DIALECT
    extras = [c for c in raw.columns if c not in spec.columns]
    stripped = raw.select(
        *extras,
        F.struct(*spec.columns).alias("_raw"),
        *[text.strip(F.col(f.name)).alias(f"_t_{f.name}") for f in spec.fields],
    )
    numbered = stripped.withColumns(
        {f"_n_{f.name}": _number(F.col(f"_t_{f.name}"), f, sql) for f in spec.fields if f.kind in NUMERIC}
        or {"_raw": F.col("_raw")}
    )
    return numbered.withColumns({f.name: _value(f, config, F.col(f"_t_{f.name}"), F.col(f"_n_{f.name}")) for f in spec.fields})


def field_value(spec: TableSpec, name: str, config: RunConfig) -> Column:
    """One field as ``read_fields`` reads it, straight from its untouched cell. Joins use it so that rows cross
    their shuffles with raw cells alone and are parsed once, after the last of them."""
    f = spec.field(name)
    cell = text.strip(F.col(name))
    return _value(f, config, cell, _number(cell, f, config.dialect == SQL_DIALECT) if f.kind in NUMERIC else None)


def _number(cell: Column, f: Field, sql: bool) -> Column:
    if sql:
        bare = F.replace(cell, F.lit("$"), F.lit("")) if f.kind == "price" else cell
        read = numbers.us_number_lenient
        return numbers.percent(bare, read) if f.kind == "rate" else read(text.strip(bare))
    if f.kind == "price":
        return numbers.currency(cell)
    return numbers.percent(cell) if f.kind == "rate" else numbers.us_number(cell)


def _value(f: Field, config: RunConfig, cell: Column, number: Column | None) -> Column:
    sql = config.dialect == SQL_DIALECT
    if f.kind == "identifier":
        return F.upper(cell)
    if f.kind == "date":
        return dates.explicit_date(cell)
    if f.kind == "count":
        return numbers.whole_count(number)
    if f.kind in NARROW:
        return number.try_cast(NARROW[f.kind]) if sql or config.enforce_precision else number
    if f.kind == "email":
        return F.nullif(cell if sql else F.lower(cell), F.lit(""))
    if f.kind in ("label", "synonym") and sql:
        return text.from_vocabulary(cell, f.synonyms or [(word, word) for word in f.domain])
    if f.kind == "synonym":
        return text.from_vocabulary(cell, f.synonyms, otherwise=text.title_case(cell))
    if f.kind == "title" and sql:
        return cell if f.name == "reason" else text.first_upper(cell)
    return text.title_case(cell) if f.kind in ("label", "title") else cell


def identity_parts(spec: TableSpec, config: RunConfig) -> list[Column]:
    """What makes two rows the same record: raw cells in the SQL dialect, otherwise the values as read,
    with the stripped cell standing in where nothing could be read."""
    if config.dialect == SQL_DIALECT:
        return [F.col("_raw")[c] for c in spec.columns]
    parts: list[Column] = []
    for f in spec.fields:
        if f.kind in ("date", "price", "rate", "count"):
            value = F.col(f"_n_{f.name}") if f.kind in ("price", "rate") else F.col(f.name)
            cell = F.col(f"_t_{f.name}")
            told = value.isNull() if f.kind == "date" else value.isNull() | ~numbers.is_exact(cell)
            parts += [value, F.when(told, cell)]
        else:
            parts.append(F.col(f.name))
    return parts


def field_findings(spec: TableSpec, config: RunConfig) -> list[Finding]:
    """All field-level reasons in schema order, then vocabulary, then the order window."""
    findings: list[Finding] = []
    for f in spec.fields:
        findings += _reader_findings(f, config)
    for f in spec.fields:
        if f.domain:
            findings.append(Finding(~text.in_domain(F.col(f.name), f.domain), f"{f.name}: unrecognized value"))
    if spec.name == "orders":
        outside = ~dates.in_window(F.col("order_date"), config.order_from, config.order_before)
        findings.append(Finding(outside, f"order_date: outside {config.window_label}"))
    return findings


# Reasons given to a rejected cell.
BAD_IDENTIFIER = "invalid text identifier"
BAD_DATE = "date must be ISO YYYY-MM-DD or US MM/DD/YYYY"
IMPOSSIBLE_DATE = "impossible calendar date"
BAD_NUMBER = "invalid US-locale decimal"
BAD_PRICE = "price must be positive"
BAD_RATE = "outside [0,1]"
BAD_COUNT = "quantity must be a positive integer"
TOO_PRECISE = "outside the model precision"
MISSING = "required field missing"


def _reader_findings(f: Field, config: RunConfig) -> list[Finding]:
    cell, value = F.col(f"_t_{f.name}"), F.col(f.name)
    found: list[Finding] = []

    def add(condition: Column, message: str) -> None:
        found.append(Finding(condition, f"{f.name}: {message}"))

    if f.kind != "email":
        add(cell == "", MISSING)
    if f.kind == "identifier":
        add(~text.is_identifier(value, f.length), BAD_IDENTIFIER)
    elif f.kind == "date":
        shaped = dates.has_date_shape(cell)
        add(~shaped, BAD_DATE)
        add(shaped & value.isNull(), IMPOSSIBLE_DATE)
    elif f.kind in NUMERIC:
        number = F.col(f"_n_{f.name}")
        add(number.isNull(), BAD_NUMBER)
        if f.kind == "price":
            add(number <= 0, BAD_PRICE)
        elif f.kind == "rate":
            add(~number.between(0, 1), BAD_RATE)
        else:
            add(number.isNotNull() & value.isNull(), BAD_COUNT)
        if f.kind in NARROW and config.enforce_precision:
            in_range = number > 0 if f.kind == "price" else number.between(0, 1)
            add(in_range & ~numbers.fits(number, NARROW[f.kind]), TOO_PRECISE)
    return found


def collect_reasons(findings: list[Finding]) -> Column:
    """Every reason that applies, in order, as an array of text."""
    if not findings:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(x.condition, F.lit(x.message)) for x in findings]))


def reason_text(findings: list[Finding]) -> Column:
    """Every reason that applies, in order, as one text; empty without any. Unlike an array that is compacted,
    it is compiled with the conditions in it."""
    return F.concat_ws("; ", *[F.when(x.condition, F.lit(x.message)) for x in findings])


def first_reason(findings: list[Finding]) -> Column:
    """The first reason that applies; empty without any."""
    return F.coalesce(*[F.when(x.condition, F.lit(x.message)) for x in findings], F.lit(""))


def normalize(raw: DataFrame, spec: TableSpec, config: RunConfig) -> DataFrame:
    """The public form: typed columns, ``source_row`` and field-level ``reasons``."""
    parsed = read_fields(raw, spec, config)
    reasons = collect_reasons(field_findings(spec, config))
    return parsed.withColumn("reasons", reasons).select("source_row", *spec.columns, "reasons")
