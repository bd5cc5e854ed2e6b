"""Declared relations: columns, keys, references, value rules and defaults.

Spark does not enforce these on Parquet, so the declarations feed three
consumers: readers take the schema, writers take the defaults, and
``operators.quality`` and ``operators.cascade`` take the rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
TEXT = T.StringType()
BINARY = T.BinaryType()
BOOL = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()
MONEY = T.DecimalType(19, 2)
NUMERIC = T.DecimalType(38, 2)
ADDRESS = T.StructType(
    [T.StructField(part, TEXT) for part in ("code", "city", "street", "phone_number")]
)

# Widths of the address parts, status words, and the mail rule.
ADDRESS_WIDTHS = {"code": 15, "city": 30, "street": 30, "phone_number": 20}
SALE_STATUS = ("not processed", "formation", "ready to send", "sent")
PURCHASE_STATUS = ("not processed", "formation", "received")
# \z instead of $, because $ in Java also accepts a final line break.
EMAIL_PATTERN = (
    r"^[a-zA-Z0-9.!#$%&'*+/=?^_`{|}~-]+"
    r"@[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
    r"(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*\z"
)

TODAY = "{as_of}"  # replaced by the as-of date when an expression is built


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False
    width: int | None = None
    allowed: tuple[str, ...] | None = None
    email: bool = False
    default: str | None = None


class Reference(NamedTuple):
    """``child.column`` points at the single-column key ``id`` of ``parent``."""

    column: str
    parent: str
    on_delete_cascade: bool
    on_update_cascade: bool


@dataclass(frozen=True)
class Relation:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    checks: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    # Date column whose year stored copies are partitioned by. It is a column of
    # the table itself or, along ``dated_by``, of the table it belongs to.
    year_of: str | None = None
    dated_by: Reference | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


def _need(name: str, type_: T.DataType, **rules) -> Field:
    return Field(name, type_, required=True, **rules)


def _may(name: str, type_: T.DataType, **rules) -> Field:
    return Field(name, type_, **rules)


def _owned(column: str, parent: str) -> Reference:
    """Rows go away with the parent."""
    return Reference(column, parent, True, True)


def _held(column: str, parent: str) -> Reference:
    """Rows block the deletion of the parent but follow a change of its key."""
    return Reference(column, parent, False, True)


def _fixed(column: str, parent: str) -> Reference:
    """Rows block both the deletion and the key change of the parent."""
    return Reference(column, parent, False, False)


_ID = _need("id", INT)

# Names, types and widths of the columns, keys, references, checks and defaults.
_RELATIONS = (
    Relation(
        "user",
        (
            _ID,
            _need("name", TEXT, width=20),
            _need("surname", TEXT, width=30),
            _need("e_mail", TEXT, email=True),
            _may("adress", ADDRESS),
        ),
        key=("id",),
        unique=("e_mail",),
    ),
    Relation("adress_sale", (_ID, _need("adress", ADDRESS)), key=("id",)),
    Relation(
        "flower",
        (_ID, _may("id_parent", INT), _need("name", TEXT, width=20)),
        key=("id",),
        unique=("name",),
        checks=("id_parent > 0",),
        references=(_held("id_parent", "flower"),),
    ),
    Relation(
        "flower_warehouse",
        (
            _ID,
            _need("id_flower", INT),
            _need("ready_to_sale", BOOL),
            _need("date", DATE, default=TODAY),
            _need("amount", INT),
            _need("cost", MONEY),
            _may("notes", TEXT),
            _may("id_greenhouse", INT, default="1"),
        ),
        key=("id",),
        checks=("amount > 0", "cost > 0", "id_flower > 0"),
        references=(_owned("id_flower", "flower"), _owned("id_greenhouse", "greenhouse")),
    ),
    Relation(
        "sale",
        (
            _ID,
            _need("id_user", INT),
            _may("id_adress", INT),
            _need("buy_date", TIMESTAMP, default=TODAY),
            _need("status", TEXT, allowed=SALE_STATUS, default="'not processed'"),
        ),
        key=("id",),
        checks=("id_user > 0 AND id_adress > 0",),
        references=(_held("id_user", "user"), _held("id_adress", "adress_sale")),
        year_of="buy_date",
    ),
    Relation(
        "sale_detail",
        (
            _ID,
            _need("id_sale", INT),
            _need("id_flower", INT),
            _need("amount", INT, default="1"),
        ),
        key=("id",),
        checks=("amount > 0", "id_sale > 0 AND id_flower > 0"),
        references=(_owned("id_sale", "sale"), _owned("id_flower", "flower")),
        year_of="buy_date",
        dated_by=_owned("id_sale", "sale"),
    ),
    Relation(
        "sale_flower",
        (
            _need("id_sale_detail", INT),
            _need("id_flower_warehouse", INT),
            _need("amount", INT),
        ),
        key=("id_sale_detail", "id_flower_warehouse"),
        checks=("amount > 0", "id_sale_detail > 0 AND id_flower_warehouse > 0"),
        references=(
            _owned("id_sale_detail", "sale_detail"),
            _owned("id_flower_warehouse", "flower_warehouse"),
        ),
        year_of="buy_date",
        dated_by=_owned("id_sale_detail", "sale_detail"),
    ),
    Relation("sale_sum", (_may("sum", LONG),)),
    Relation(
        "dead_flowers",
        (
            _ID,
            _need("id_flower_warehouse", INT),
            _need("date", DATE, default=TODAY),
            _need("count", INT),
            _may("notes", TEXT),
        ),
        key=("id",),
        checks=("count > 0", "id_flower_warehouse > 0"),
        references=(_fixed("id_flower_warehouse", "flower_warehouse"),),
    ),
    Relation(
        "disease",
        (
            _ID,
            _need("name", TEXT, width=30),
            _may("description", TEXT),
            _may("foto", BINARY),
        ),
        key=("id",),
        unique=("name",),
    ),
    Relation(
        "disease_flower",
        (
            _ID,
            _need("id_flower", INT),
            _need("id_disease", INT),
            _need("date", DATE, default=TODAY),
            _need("foto", BINARY),
            _may("notes", TEXT),
        ),
        key=("id",),
        checks=("id_flower > 0 AND id_disease > 0",),
        references=(_owned("id_flower", "flower"), _owned("id_disease", "disease")),
    ),
    Relation("pest", (_ID, _need("name", TEXT, width=30)), key=("id",), unique=("name",)),
    Relation(
        "pest_flower",
        (
            _ID,
            _need("id_flower", INT),
            _need("id_pest", INT),
            _need("date", DATE, default=TODAY),
            _may("foto", BINARY),
            _may("notes", TEXT),
        ),
        key=("id",),
        checks=(f"date <= {TODAY}", "id_flower > 0", "id_pest > 0"),
        references=(_owned("id_flower", "flower"), _owned("id_pest", "pest")),
    ),
    Relation(
        "greenhouse",
        (_ID, _need("id_staff", INT, default="1")),
        key=("id",),
        checks=("id_staff > 0",),
        references=(_held("id_staff", "staff"),),
    ),
    Relation(
        "prevention",
        (
            _ID,
            _need("id_staff", INT),
            _need("date", DATE, default=TODAY),
            _may("cause", TEXT),
            _may("note", TEXT),
            _need("id_greenhouse", INT, default="1"),
        ),
        key=("id",),
        checks=("id_greenhouse > 0", "id_staff > 0"),
        references=(_held("id_staff", "staff"), _held("id_greenhouse", "greenhouse")),
    ),
    Relation(
        "prevention_detail",
        (_need("id_preparation", INT), _need("id_prevention", INT)),
        key=("id_preparation", "id_prevention"),
        checks=("id_preparation > 0 AND id_prevention > 0",),
        references=(
            _owned("id_preparation", "preparation"),
            _owned("id_prevention", "prevention"),
        ),
    ),
    Relation(
        "sheduled_prevention",
        (_ID, _need("id_greenhouse", INT), _need("date", DATE), _may("cause", TEXT)),
        key=("id",),
        checks=("id_greenhouse > 0",),
        references=(_owned("id_greenhouse", "greenhouse"),),
    ),
    Relation(
        "preparation",
        (_ID, _need("id_type", INT), _need("name", TEXT, width=30)),
        key=("id",),
        checks=("id_type > 0",),
        references=(_owned("id_type", "preparation_type"),),
    ),
    Relation(
        "preparation_type",
        (_ID, _need("name", TEXT, width=30)),
        key=("id",),
        unique=("name",),
    ),
    Relation(
        "position_rate",
        (_ID, _need("position", TEXT, width=30), _need("rate", MONEY)),
        key=("id",),
        unique=("position",),
        checks=("rate > 0",),
    ),
    Relation(
        "staff",
        (
            _ID,
            _need("name", TEXT, width=20),
            _need("surname", TEXT, width=30),
            _may("patronymie", TEXT, width=30),
            _need("id_position", INT),
            _need("salary", MONEY, default="100"),
            _need("allowance", NUMERIC, default="0"),
        ),
        key=("id",),
        checks=("id_position > 0",),
        references=(_owned("id_position", "position_rate"),),
    ),
    Relation(
        "purchase",
        (
            _ID,
            _need("id_staff", INT),
            _need("date", TIMESTAMP, default=TODAY),
            _need("status", TEXT, allowed=PURCHASE_STATUS, default="'not processed'"),
            _may("notes", TEXT),
        ),
        key=("id",),
        checks=("id_staff > 0",),
        references=(_held("id_staff", "staff"),),
        year_of="date",
    ),
    Relation(
        "purchase_detail",
        (
            _need("id_flower", INT),
            _need("id_purchase", INT),
            _need("amount", INT),
            _need("cost", MONEY),
        ),
        key=("id_flower", "id_purchase"),
        checks=("amount > 0", "id_flower > 0 AND id_purchase > 0", "cost > 0"),
        references=(_owned("id_flower", "flower"), _owned("id_purchase", "purchase")),
    ),
    Relation(
        "stock",
        (
            _ID,
            _need("id_type", INT),
            _need("name", TEXT, width=30),
            _need("amount", INT),
        ),
        key=("id",),
        unique=("name",),
        checks=("amount > 0", "id_type > 0"),
        references=(_owned("id_type", "stock_type"),),
    ),
    Relation(
        "stock_type", (_ID, _need("name", TEXT, width=30)), key=("id",), unique=("name",)
    ),
    Relation(
        "stock_purchase",
        (
            _ID,
            _need("id_staff", INT),
            _need("date", DATE, default=TODAY),
            _need("status", TEXT, allowed=PURCHASE_STATUS, default="'not processed'"),
        ),
        key=("id",),
        checks=("id_staff > 0",),
        references=(_held("id_staff", "staff"),),
    ),
    Relation(
        "stock_purchase_detail",
        (
            _need("id_stock", INT),
            _need("id_stock_purchase", INT),
            _may("amount", INT),
            _may("cost", MONEY),
        ),
        key=("id_stock", "id_stock_purchase"),
        checks=("amount > 0", "id_stock > 0 AND id_stock_purchase > 0", "cost > 0"),
        references=(
            _owned("id_stock", "stock"),
            _owned("id_stock_purchase", "stock_purchase"),
        ),
    ),
)

CATALOG: dict[str, Relation] = {relation.name: relation for relation in _RELATIONS}
