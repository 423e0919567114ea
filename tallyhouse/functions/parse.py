"""Text to typed values. Bad input never raises: it becomes NULL or the given default, an oversize number NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import WHITE_SPACE, strip
from tallyhouse.schemas import AMOUNT, PERCENT

# A decimal literal as Python reads it: optional sign, digits that may be grouped by single
# underscores, optional fraction and exponent. "nan", "inf" and Java suffixes ("1.5d") stay outside.
# White space around it is matched here: one expression tells the number's text, or that there is none.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"^[{WHITE_SPACE}]*([+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?)[{WHITE_SPACE}]*$"

# Digits, with or without decimals, at a length that fits an integer, and that a cast to a decimal type rounds once.
_SHORT = r"^[0-9]{1,9}(?:\.[0-9]{0,9})?\z"

# Accepted date formats in the order they are tried.
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)

# Order status synonyms.
STATUS_SYNONYMS = {
    "complete": "completed",
    "done": "completed",
    "shipped": "shipped",
    "in_transit": "shipped",
    "processing": "processing",
    "pending": "processing",
    "cancel": "cancelled",
    "canceled": "cancelled",
    "return": "returned",
}


def with_parsed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with these columns replaced, each computed once a row.

    Beside plain columns a later filter or column would compute them again; Spark moves no filter below a generator.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))).select(*df.columns)


def _bare(col: Column) -> Column:
    return F.replace(col.cast("string"), F.lit(","), F.lit(""))


def _is_number(col: Column) -> Column:
    return F.coalesce(_bare(col).rlike(_NUMBER), F.lit(False))


def _number_text(col: Column) -> Column:
    """The number's text, "" where there is none.

    The rules below name it once in what most rows take, and look again only at values that gave nothing: Spark computes
    an expression wherever it is named in a filter or behind a condition.
    """
    return F.replace(F.regexp_extract(_bare(col), _NUMBER, 1), F.lit("_"), F.lit(""))


def parse_decimal(col: Column) -> Column:
    """Exact value of a numeric text, NULL when it is not one."""
    return _number_text(col).try_cast("decimal(38,18)")


def _or_default(value: Column, col: Column, default: Column) -> Column:
    """``value`` of a text; where it has none, the default unless the text is a number."""
    return F.coalesce(value, F.when(~_is_number(col), default))


def clean_numeric(col: Column, default: float = 0.0) -> Column:
    """Double value of a numeric text; thousands separators are ignored."""
    return F.coalesce(_number_text(col).try_cast("double"), F.lit(float(default)))


def _is_short(col: Column) -> Column:
    """True for what most texts are: up to nine digits, with at most one point that is not the first sign. No expression is matched."""
    text = col.cast("string")
    return (F.length(text) <= 9) & (text >= "0") & F.translate(text, "0123456789", "").isin("", ".")


def _whole_part(col: Column) -> Column:
    """What stands before the point of a short number."""
    return F.substring_index(col.cast("string"), ".", 1)


def clean_money(col: Column, as_type=AMOUNT, default: int = 0) -> Column:
    """Amount rounded half-up to cents, computed on decimals rather than binary floats.

    Text that is no number takes the default; a number that does not fit the type is NULL, for the
    caller to reject (``plans.silver.oversize_values``).
    """
    any_text = _or_default(F.round(parse_decimal(col), 2).try_cast(as_type), col, F.lit(default).cast(as_type))
    # Decimals of another scale than two are rounded to cents first.
    return F.coalesce(F.when(_is_short(col), col.cast("string").try_cast(as_type)), any_text) if as_type.scale == 2 else any_text


def clean_int(col: Column, default: int = 0) -> Column:
    """Whole part of a numeric text, truncated toward zero; NULL for a number beyond the type."""
    any_text = _or_default(parse_decimal(col).try_cast("int"), col, F.lit(default))
    return F.when(_is_short(col), _whole_part(col).try_cast("int")).otherwise(any_text)


def clean_quantity(col: Column) -> Column:
    """At least one; NULL for a number beyond the type."""
    any_text = _or_default(parse_decimal(col).try_cast("int"), col, F.lit(1))
    short = F.greatest(_whole_part(col).try_cast("int"), F.lit(1))
    # The larger of the number and 1, NULL if there is none, with the number named once: the last of both, negated, in falling order.
    falling = F.sort_array(F.array(-any_text.cast("long"), F.lit(-1).cast("long")), asc=False)
    other = (-F.get(falling, F.lit(1))).cast("int")
    return F.when(_is_short(col), short).otherwise(other)


def clean_percent(col: Column) -> Column:
    """Clamped to 0 to 100, numbers of any size included."""
    beyond = F.when(_number_text(col).try_cast("double") > 0, 100).otherwise(0).cast("decimal(38,18)")
    any_text = F.round(F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(parse_decimal(col), beyond))), 2).cast(PERCENT)
    short = F.least(F.lit(100), col.cast("string").try_cast("decimal(18,2)")).cast(PERCENT)
    return F.when(_is_short(col), short).otherwise(any_text)


def _surely_fits(col: Column, as_type) -> Column:
    """True for a number whose whole part is too short to be beyond the type, also once it is rounded up."""
    digits = 9 if as_type == "int" else as_type.precision - as_type.scale - 1
    return F.coalesce(col.cast("string").rlike(rf"^[0-9]{{1,{digits}}}(?:\.[0-9]*)?\z"), F.lit(False))


def may_not_fit(col: Column, as_type) -> Column:
    """False for most of the text that is none or a number of this type; nothing is parsed."""
    return ~_surely_fits(col, as_type) & _has_digit(col)


def product_may_not_fit(one: Column, other: Column, as_type) -> Column:
    """False for short numbers whose product fits the type, also where a text without a digit stands for 0 or 1."""
    fits = [~_has_digit(c) | F.coalesce(c.cast("string").rlike(_SHORT), F.lit(False)) for c in (one, other)]
    digits = F.length(_whole_part(one)) + F.length(_whole_part(other))
    return ~(fits[0] & fits[1] & F.coalesce(digits < as_type.precision - as_type.scale, F.lit(False)))


def _has_digit(col: Column) -> Column:
    return F.coalesce(col.cast("string").rlike("[0-9]"), F.lit(False))


def does_not_fit(col: Column, as_type) -> Column:
    """True for text that is a number but not one of this type."""
    number = parse_decimal(col)
    fitted = number.try_cast("int") if as_type == "int" else F.round(number, 2).try_cast(as_type)
    return _is_number(col) & fitted.isNull()


def clean_date(col: Column) -> Column:
    """First accepted format that fits, else NULL.

    The shape test in front keeps the parser from raising and swallowing an exception per row and
    pins the year to four digits.
    """
    return F.coalesce(*[
        F.when(col.rlike(rf"^[{WHITE_SPACE}]*{shape[1:-1]}[{WHITE_SPACE}]*$"), F.try_to_date(strip(col), fmt)) for shape, fmt in DATE_FORMATS])


def standardize_status(col: Column) -> Column:
    status = F.lower(strip(col))
    synonyms = F.create_map(*[F.lit(x) for pair in STATUS_SYNONYMS.items() for x in pair])
    return F.coalesce(F.try_element_at(synonyms, status), status)
