"""Numbers written as text.

Most values in a real export are plain digits, or digits with a currency in
front or behind. Those take short paths (an anchored ASCII pattern, a cast);
only the rest pays for the general clean-up. A pattern also decides before a
cast whether it will succeed, as a failing ``try_cast`` costs more than all of
the patterns together.
Every step of the chain uses the one before it exactly once: an expression that
repeats its input is copied by the planner at each use, and a few such steps on
five columns make code too large to compile. Anything that is not a number ends
as null, under ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import WHITESPACE_CLASS

# What may surround a money amount.
CURRENCY_SYMBOLS = "$€£¥₹₽₺₴₦₱₲₵₡₭₮₸"
# Three capitals that are no part of a longer word. The letters come first and
# the look-arounds after them, so that other characters fail at once.
_WORD = r"[\p{L}\p{N}_]"
CURRENCY_CODE = rf"[A-Z]{{3}}(?<!{_WORD}[A-Z]{{3}})(?!{_WORD})"
THOUSANDS_MARK = rf"(?U)(?<=\d)[,{WHITESPACE_CLASS}](?=\d{{3}}(?!\d))"
ACCOUNTING_NEGATIVE = r"^\(.*\)$"
ASCII_WHITESPACE = " \t\n\x0b\x0c\r"

# The short paths take amounts that cannot overflow; longer ones go the general way.
PLAIN_AMOUNT = r"^-?[0-9]{1,300}(?:\.[0-9]+)?\z"
# Nothing that a quantifier took is tried again in a shorter form; no shorter one could match.
_USUAL = r"[0-9]{1,100}+(?:[, ][0-9]{3}){0,60}+(?:\.[0-9]++)?+"
# An amount in parentheses starts with the opening one, which becomes the sign.
USUAL_AMOUNT = (
    rf"^(?:[ \t]*(?:[A-Z]{{3}} |[{CURRENCY_SYMBOLS}])?)"
    rf"(^\({_USUAL}(?=\)\z)|-?{_USUAL}(?=(?: [A-Z]{{3}})?[ \t]*\z))"
)
PLAIN_INTEGER = r"^[+-]?[0-9]+\z"
_NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
NUMBER = rf"^{_NUMBER}\z"
AMOUNT_IN_PARENTHESES_OR_NOT = (
    rf"(?U)^\(?[{WHITESPACE_CLASS}]*({_NUMBER})[{WHITESPACE_CLASS}]*\)?[{WHITESPACE_CLASS}]*\z"
)


def parse_money(text: Column) -> Column:
    """Money text as a double, or null.

    Parentheses around the whole value negate it; anywhere else they make it
    null. A comma or blank counts as a thousands mark only in front of exactly
    three digits, so ``1,25`` is null.
    """
    sign = (
        F.when(text.rlike(ACCOUNTING_NEGATIVE), -1.0)
        .when(text.contains("(") | text.contains(")"), F.lit(None))
        .otherwise(1.0)
    )
    body = F.regexp_replace(text, CURRENCY_CODE, "")
    body = F.translate(body, CURRENCY_SYMBOLS, "")
    body = F.regexp_replace(body, THOUSANDS_MARK, "")
    # "No match" extracts as empty text, which casts to null.
    amount = F.regexp_extract(body, AMOUNT_IN_PARENTHESES_OR_NOT, 1).try_cast("double")
    # One search both tells whether a spelling is usual and finds its amount: none gives null.
    usual = F.get(F.regexp_extract_all(text, F.lit(USUAL_AMOUNT), F.lit(1)), F.lit(0))
    for mark, instead in ((",", ""), (" ", ""), ("(", "-")):
        usual = F.replace(usual, F.lit(mark), F.lit(instead))
    return F.coalesce(
        F.when(text.rlike(PLAIN_AMOUNT), text.try_cast("double")),
        usual.try_cast("double"),
        _finite(amount * sign),
    )


def _finite(value: Column) -> Column:
    """The value, or null where it overflowed. By way of its text, so that it is used once."""
    return F.regexp_extract(value.cast("string"), "^[^I]+$", 0).try_cast("double")


def parse_counter(text: Column) -> Column:
    """Count text as a bigint; a fraction is cut off, anything else is null."""
    body = F.btrim(text, F.lit(ASCII_WHITESPACE))
    return F.when(body.rlike(PLAIN_INTEGER), body.try_cast("bigint")).otherwise(
        F.regexp_extract(body, NUMBER, 0).try_cast("double").try_cast("bigint")
    )
