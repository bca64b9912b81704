"""Table contracts and run settings.

A run is described by data, not code: which columns each table has, how every column is read, which
parents it refers to, the order window, the return cutoff and the dialect of the rules.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

CANONICAL = "canonical"
SQL_DIALECT = "sql"


@dataclass(frozen=True)
class Field:
    """One column. ``kind`` picks the reader: identifier, text, title, label, synonym, date, price,
    rate, count or email."""

    name: str
    kind: str
    length: int | None = None
    max_length: int | None = None
    domain: tuple[str, ...] = ()
    synonyms: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Parent:
    """A reference to the accepted rows of another table. ``noun`` is the word used in reasons."""

    table: str
    column: str
    noun: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    parents: tuple[Parent, ...] = ()
    key_noun: str = ""

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


@dataclass(frozen=True)
class RunConfig:
    tables: tuple[TableSpec, ...]
    order_from: date
    order_before: date
    return_cutoff: date
    sale_status: str = "Completed"
    void_status: str = "Cancelled"
    dialect: str = CANONICAL
    enforce_precision: bool = True

    def table(self, name: str) -> TableSpec:
        return next(t for t in self.tables if t.name == name)

    def with_(self, **changes) -> "RunConfig":
        return replace(self, **changes)

    @property
    def window_label(self) -> str:
        """'2025' for a calendar year, otherwise both ends of the half-open window."""
        start, end = self.order_from, self.order_before
        if (start.month, start.day, end.month, end.day) == (1, 1, 1, 1) and end.year == start.year + 1:
            return str(start.year)
        return f"{start.isoformat()} to before {end.isoformat()}"


# The accepted words of the retail data set.
REGIONS = ("North", "South", "East", "West")
SEGMENTS = ("Consumer", "Business")
CHANNELS = ("Online", "Store")
STATUSES = ("Completed", "Cancelled")
CHANNEL_WORDS = (("web", "Online"), ("online", "Online"), ("retail", "Store"), ("store", "Store"))


def retail_tables(
    *,
    regions: tuple[str, ...] = REGIONS,
    segments: tuple[str, ...] = SEGMENTS,
    id_lengths: tuple[int, int, int, int, int] = (5, 4, 6, 7, 6),
) -> tuple[TableSpec, ...]:
    """The five tables, parents first. ``id_lengths`` follows the same order."""
    customer, product, order, line, event = id_lengths
    return (
        TableSpec(
            "customers",
            (
                Field("customer_id", "identifier", length=customer),
                Field("customer_name", "text", max_length=100),
                Field("region", "label", domain=regions),
                Field("segment", "label", domain=segments),
                Field("email", "email"),
            ),
            key_noun="customer ID",
        ),
        TableSpec(
            "products",
            (
                Field("product_id", "identifier", length=product),
                Field("product_name", "text", max_length=100),
                Field("category", "title", max_length=30),
                Field("list_price", "price"),
            ),
            key_noun="product ID",
        ),
        TableSpec(
            "orders",
            (
                Field("order_id", "identifier", length=order),
                Field("customer_id", "identifier", length=customer),
                Field("order_date", "date"),
                Field("channel", "synonym", domain=CHANNELS, synonyms=CHANNEL_WORDS),
                Field("status", "label", domain=STATUSES),
            ),
            parents=(Parent("customers", "customer_id", "customer"),),
            key_noun="order ID",
        ),
        TableSpec(
            "order_lines",
            (
                Field("order_line_id", "identifier", length=line),
                Field("order_id", "identifier", length=order),
                Field("product_id", "identifier", length=product),
                Field("quantity", "count"),
                Field("unit_price", "price"),
                Field("discount_rate", "rate"),
            ),
            parents=(Parent("orders", "order_id", "order"), Parent("products", "product_id", "product")),
            key_noun="order-line ID",
        ),
        TableSpec(
            "returns",
            (
                Field("return_id", "identifier", length=event),
                Field("order_line_id", "identifier", length=line),
                Field("return_date", "date"),
                Field("return_quantity", "count"),
                Field("reason", "title", max_length=100),
            ),
            key_noun="return ID",
        ),
    )


RETAIL_2025 = RunConfig(
    tables=retail_tables(),
    order_from=date(2025, 1, 1),
    order_before=date(2026, 1, 1),
    return_cutoff=date(2026, 1, 30),
)
