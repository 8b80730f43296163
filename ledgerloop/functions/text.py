"""Cleaning of raw text columns.  No function here raises on bad input: it yields null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloop.schema import AMOUNT

# Texts that stand for "no value" (case-sensitive).
NULL_TEXTS = ("", "nan", "None")

# Fixed value: the characters that count as white space at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

UNKNOWN_BANK = "UNKNOWN"


def strip(c: Column) -> Column:
    """Without blanks at both ends.

    Trimming a character set is slow, so texts that begin and end with a printable ASCII
    character ("!" to "~") are passed through.
    """
    text = c.cast("string")
    last = F.substring(text, -1, 1)
    outside = (text < "!") | (text >= "\x7f") | (last < "!") | (last >= "\x7f")
    return F.when(outside, F.btrim(text, F.lit(BLANKS))).otherwise(text)


# The as_* functions take stripped text and mention it more than once; operators.cleaning
# strips into columns first, so that generated code stays small and each text is read once.


def as_value(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TEXTS), text)


def as_bank(text: Column, keep_zeros: bool = False) -> Column:
    bank = as_value(text)
    return bank if keep_zeros else F.regexp_replace(bank, r"^0+(?=[0-9]+$)", "")


def as_account(bank: Column, account: Column, keep_zeros: bool = False) -> Column:
    return F.concat(as_bank(bank, keep_zeros), F.lit("_"), as_value(account))


def plain_number(text: Column) -> Column:
    """The text if it is a finite plain number, else the empty text, which casts to null.

    Casts alone would let through 'NaN', 'Infinity' and '12d'.
    """
    return F.regexp_extract(text, NUMBER, 0)


def as_number(text: Column) -> Column:
    """Text of a plain number without commas, or the empty text."""
    return plain_number(F.replace(text, F.lit(","), F.lit("")))


def as_amount(number: Column) -> Column:
    return number.try_cast(AMOUNT)


def is_unfit(number: Column, amount: Column) -> Column:
    """A number that no amount can hold: too large, or so small that nothing is left of it."""
    vanished = (amount == 0) & (number.try_cast("double") != 0)
    return F.when(amount.isNull(), F.coalesce(number != "", F.lit(False))).otherwise(vanished)


def as_timestamp(text: Column) -> Column:
    month_first = F.contains(F.substring(text, 2, 2), F.lit("/"))
    iso = F.when(
        month_first,
        F.regexp_replace(text, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", "$3-$1-$2"),
    ).otherwise(F.translate(text, "/", "-"))
    return iso.try_cast("timestamp_ntz")


def as_label(text: Column) -> Column:
    return F.coalesce(plain_number(text).try_cast("double").try_cast("int"), F.lit(0))


def clean_text(c: Column) -> Column:
    """Stripped text, null for the texts that stand for no value."""
    return as_value(strip(c))


def canonical_bank(c: Column, keep_zeros: bool = False) -> Column:
    """Numeric bank codes without leading zeros, so that 010 and 10 are one bank."""
    return as_bank(strip(c), keep_zeros)


def account_key(bank: Column, account: Column, keep_zeros: bool = False) -> Column:
    """bank_account, null when either part is null."""
    return as_account(strip(bank), strip(account), keep_zeros)


def parse_amount(c: Column) -> Column:
    """Exact amount, null unless the text is a plain number; commas are dropped."""
    return as_amount(as_number(strip(c)))


def unfit_amount(c: Column) -> Column:
    """Whether the text is a plain number that does not fit an amount."""
    number = as_number(strip(c))
    return is_unfit(number, as_amount(number))


def parse_timestamp(c: Column) -> Column:
    """Zone-free timestamp; year-first with dashes or slashes, or month-first with slashes."""
    return as_timestamp(strip(c))


def parse_label(c: Column) -> Column:
    """Integer part of a number, 0 for anything else."""
    return as_label(strip(c))


def bank_of(account: Column) -> Column:
    """Text before the first underscore, or UNKNOWN when there is none."""
    return F.when(
        F.instr(account, "_") > 0, F.substring_index(account, "_", 1)
    ).otherwise(UNKNOWN_BANK)
