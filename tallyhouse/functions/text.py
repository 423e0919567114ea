"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shape of an acceptable e-mail address.
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# The characters that count as white space at the edges of a value. Spark's plain trim()
# removes blanks only.
WHITE_SPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def upper_code(col: Column) -> Column:
    return F.upper(strip(col))


def title_case(col: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    ``initcap`` looks at white space only and would leave "O'neil" and "Mc-donald".
    """
    words = F.split(F.lower(strip(col)), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def clean_email(col: Column) -> Column:
    """Lower-case trimmed address, or NULL when it does not look like one."""
    address = F.lower(strip(col))
    return F.when(address.rlike("(?U)" + EMAIL_SHAPE), address)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))
