"""SQL snippets for the scalar functions of the plans.

Helpers take and return SQL text for ``selectExpr``/``expr``: one string per column is far cheaper to send to the JVM
than a tree of column objects. All of them are built-in functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COUNT = "decimal(20,0)"  # any long
PRICE = "decimal(18,2)"  # one unit; times any long it still fits AMOUNT
AMOUNT = "decimal(38,2)"  # one line or document
TOTAL = "decimal(38,2)"  # a sum of lines
HOURS = "decimal(18,2)"
RATE = "decimal(18,6)"
SHARE = "decimal(18,4)"  # a discount or another share, which counts to four digits

# Characters that trimming removes (blank, tab, line feed, return, vertical tab, form feed).
_BLANKS = r" \t\n\r\u000B\u000C"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Sequence[str]) -> str:
    return ", ".join(literal(value) for value in values)


def assign(frame: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace or append columns by SQL snippets over the columns of ``frame``, in one projection."""
    kept = [
        f"{columns[name]} as {quoted(name)}" if name in columns else quoted(name) for name in frame.columns
    ]
    new = [f"{text} as {quoted(name)}" for name, text in columns.items() if name not in frame.columns]
    return frame.selectExpr(*kept, *new)


def parse_decimal(name: str, to: str) -> str:
    """Number or null; text that is no number becomes null, extra digits round half up."""
    return f"try_cast({quoted(name)} as {to})"


def parse_or_zero(name: str, to: str) -> str:
    """Number, or zero for a missing value or text that is none; a number beyond the type's range stays unknown."""
    parsed = parse_decimal(name, to)
    return f"if(try_cast({quoted(name)} as double) is null, cast(0 as {to}), {parsed})"


def times(a: str, b: str, to: str) -> str:
    """Exact product; null instead of a failed job where it does not fit."""
    return f"try_cast(try_multiply({a}, {b}) as {to})"


def parse_long(frame: DataFrame, name: str) -> str:
    """Whole number or null. Text that is no integer goes through double, so ``"12.0"`` and ``"1e3"`` are read too."""
    if _is_text(frame, name):
        return f"coalesce(try_cast({quoted(name)} as bigint), try_cast(try_cast({quoted(name)} as double) as bigint))"
    return f"try_cast({quoted(name)} as bigint)"


def parse_bool(name: str) -> str:
    return f"try_cast({quoted(name)} as boolean)"


def parse_date(name: str) -> str:
    return f"try_cast({quoted(name)} as date)"


def parse_timestamp(frame: DataFrame, name: str) -> str:
    """A point in time. Zone-less columns stay zone-less; text is read in the session zone (UTC)."""
    if isinstance(frame.schema[name].dataType, T.TimestampNTZType):
        return quoted(name)
    return f"try_cast({quoted(name)} as timestamp)"


def month_of(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM')"


def pii_hash(value: str) -> str:
    """SHA-256 hex of the trimmed, lower-cased text; null stays null."""
    return f"sha2(lower(trim(both '{_BLANKS}' from string({value}))), 256)"


def half_up(value: str, digits: int) -> str:
    """Round a double half up by scaling and flooring; any engine with IEEE doubles gives the same bits."""
    scale = f"{10**digits}.0D"
    return f"(floor(({value}) * {scale} + 0.5D) / {scale})"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` rounded, null when the denominator is zero or null."""
    return half_up(f"double({numerator}) / nullif(double({denominator}), 0.0D)", digits)


def hours_between(start: str, end: str) -> str:
    """Hours with two digits, exact to the microsecond before rounding."""
    return f"cast({half_up(f'timestampdiff(MICROSECOND, {start}, {end}) / 3.6e9D', 2)} as {HOURS})"


def shift(unit: str, count: str, ts: str) -> str:
    return f"timestampadd({unit}, int({count}), {ts})"


def sku(category: str, number: str, prefix: int = 3, width: int = 6) -> str:
    """``ELE-000042``: category prefix in capitals and a zero-padded number (never cut when longer)."""
    digits = f"string({number})"
    padded = f"if(length({digits}) < {width}, lpad({digits}, {width}, '0'), {digits})"
    return f"concat(upper(left({category}, {prefix})), '-', {padded})"


def is_blank(frame: DataFrame, name: str) -> str:
    """Null or empty text. White space counts as a value; numbers and times are never empty."""
    missing = f"{quoted(name)} is null"
    return f"({missing} or {quoted(name)} = '')" if _is_text(frame, name) else f"({missing})"


def number(frame: DataFrame, name: str) -> str:
    """The column as a number; text that is none becomes null."""
    if isinstance(frame.schema[name].dataType, T.NumericType):
        return quoted(name)
    return f"try_cast({quoted(name)} as double)"


def _is_text(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.StringType)


def holds(condition: str) -> str:
    """A condition with unknown read as false."""
    return f"coalesce({condition}, false)"


def one_of(index: str, values: Sequence[str]) -> str:
    """The value at a zero-based index."""
    return f"element_at(array({listed(values)}), int({index}) + 1)"
