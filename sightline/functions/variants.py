"""Dynamic JSON values held as VARIANT: truthiness, text and integer tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON renderings that count as false.
FALSY = ["null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"]


def field(doc: Column, name: str) -> Column:
    """Top-level field as VARIANT; null only when it is absent."""
    return F.try_variant_get(doc, f"$.{name}", "variant")


def scalar_text(value: Column) -> Column:
    """The value as text; null when absent or JSON null."""
    return F.try_variant_get(value, "$", "string")


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero and empty values."""
    return value.isNotNull() & ~F.to_json(value).isin(FALSY)


def truthy_text(value: Column, name: str, document: Column) -> Column:
    """Truthiness of a field that was read as text.

    Only text that a false value could have rendered as needs the JSON type, and
    only then is the document looked at again.
    """
    doubtful = value.isin("false", "[]", "{}") | value.startswith("0") | value.startswith("-0")
    again = truthy(field(F.try_parse_json(document), name))
    return F.when(doubtful, again).otherwise(F.coalesce(value != "", F.lit(False)))


def truthy_scalar(value: Column) -> Column:
    """The value as text when it is truthy, else null."""
    as_text = scalar_text(value)
    return F.when(kind(value) == "STRING", F.nullif(as_text, F.lit(""))).otherwise(
        F.when(truthy(value), as_text)
    )


def kind(value: Column) -> Column:
    """Spark's name for the value's type, for example ``BIGINT`` or ``VOID``."""
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def is_integer(kind_name: Column) -> Column:
    """Whether a number was written without fraction or exponent.

    ``3`` is BIGINT and ``3.0`` DECIMAL(1,0); integers beyond 64 bits are
    DECIMAL(p,0) with p of 19 or more.
    """
    return (kind_name == "BIGINT") | kind_name.rlike(r"^DECIMAL\((?:19|2\d|3\d),0\)$")


def float_text(value: Column) -> Column:
    """Text that a plain decimal float reader accepts, else null, as DOUBLE."""
    bare = F.trim(value)
    decimal = bare.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$")
    special = bare.rlike(r"(?i)^[+-]?(?:inf|infinity|nan)$")
    return F.when(decimal | special, bare.try_cast("double"))
