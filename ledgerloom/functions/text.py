"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditions import ColumnLike, as_column

# The accepted e-mail form and the blanks removed at both ends of a text.
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
BLANKS = " \t\n\r\f\x0b"

CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_MARK = "\x1f"


def strip(c: ColumnLike) -> Column:
    """Remove blanks of every kind at both ends."""
    return F.trim(as_column(c), F.lit(BLANKS))


def title_case(c: ColumnLike) -> Column:
    """Capital after every non-letter, lower case elsewhere: ``o'brien-SMITH`` to ``O'Brien-Smith``.

    ``initcap`` alone starts a new word only after a space, so a mark and a space are put first wherever a cased
    letter follows something else, and taken out again. Marks that stand in the text are a mark and a 0 meanwhile.
    """
    kept = F.replace(as_column(c), F.lit(_MARK), F.lit(f"{_MARK}0"))
    spaced = F.regexp_replace(kept, f"(?<=[^ {CASED}])(?=[{CASED}])", f"{_MARK} ")
    return F.replace(F.replace(F.initcap(spaced), F.lit(f"{_MARK} "), F.lit("")), F.lit(f"{_MARK}0"), F.lit(_MARK))


def proper_case(c: ColumnLike) -> Column:
    """Name in title case; NULL when missing or blank."""
    name = strip(c)
    return F.when(name != "", title_case(name))


def clean_text(c: ColumnLike) -> Column:
    """Trimmed title case, empty text when missing."""
    return F.coalesce(title_case(strip(c)), F.lit(""))


def squeeze_spaces(c: ColumnLike) -> Column:
    """Single spaces inside, none at the ends."""
    return F.trim(F.regexp_replace(as_column(c), " +", " "))


def metro_city(address: ColumnLike) -> Column:
    """City of ``street, city STATE``: what stands between the first comma and the last word."""
    return F.regexp_extract(F.trim(as_column(address)), r"^[^,]*, (.*) [^ ]+$", 1)


def _digits(c: ColumnLike) -> Column:
    return F.regexp_replace(as_column(c), "[^0-9]", "")


def standardize_phone(c: ColumnLike) -> Column:
    """``(XXX) XXX-XXXX`` for ten digits, with or without a leading 1; UNKNOWN or INVALID otherwise."""
    digits = _digits(c)
    ten = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    shown = F.concat(
        F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)
    )
    return (
        F.when(F.coalesce(strip(c), F.lit("")) == "", "UNKNOWN").when(F.length(ten) == 10, shown).otherwise("INVALID")
    )


def clean_phone(c: ColumnLike) -> Column:
    """The ten digits, or NULL."""
    digits = _digits(c)
    return F.when(F.length(digits) == 10, digits)


def clean_email(c: ColumnLike) -> Column:
    """The trimmed address when its form is right, else NULL."""
    email = strip(c)
    return F.when(email.rlike(rf"\A{EMAIL_PATTERN}\z"), email)


def array_to_text(c: ColumnLike, separator: str = ",") -> Column:
    return F.coalesce(F.array_join(as_column(c), separator), F.lit(""))


def list_length(c: ColumnLike) -> Column:
    """Number of items, 0 when there is no list."""
    items = as_column(c)
    return F.when(items.isNotNull(), F.size(items)).otherwise(0)


def email_key(c: ColumnLike, buckets: int = 100_000) -> Column:
    """The MD5 of the text, read as a 128-bit number, modulo ``buckets``."""
    digest = F.md5(as_column(c).cast("binary"))
    high = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(digest, 17, 16), 16, 10).cast("decimal(20,0)")
    carry = F.lit(2**64 % buckets).cast("bigint")
    return (((high % buckets).cast("bigint") * carry + (low % buckets).cast("bigint")) % buckets).cast("int")
