"""Text standardisation. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and vocabularies the feeds are checked against.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^[\d\s\-\(\)\+]{7,}$"
TEN_DIGITS, PHONE_SHAPE = r"^\d*(\d{3})(\d{3})(\d{4})$", "($1) $2-$3"
SEGMENTS = ["basic", "standard", "premium", "vip"]
TRUE_WORDS = ["true", "1", "y", "yes"]
FALSE_WORDS = ["false", "0", "n", "no"]
PLACEHOLDER_WORDS = ["test", "example", "sample", "firstname", "lastname"]
PAYMENT_SYNONYMS = {
    "credit_card": ["credit_card", "credit card", "creditcard", "cc"],
    "debit_card": ["debit_card", "debit card", "debitcard"],
    "paypal": ["paypal", "pay pal"],
    "gift_card": ["gift_card", "gift card", "giftcard"],
    "cash_on_delivery": ["cod", "cash on delivery", "cash"],
}
CATEGORY_SYNONYMS = {
    "electronics": ["electronics", "electronic", "tech"],
    "clothing": ["clothing", "clothes", "apparel"],
    "home_garden": ["home & garden", "home", "garden"],
    "books": ["books", "book"],
    "sports": ["sports", "sport", "fitness"],
    "toys": ["toys", "toy"],
}


def is_blank(c: Column) -> Column:
    """Null, empty or whitespace only. Never null itself."""
    return c.isNull() | ~c.rlike(r"\S")


def folded(c: Column) -> Column:
    return F.lower(F.trim(c))


def synonym(c: Column, groups: dict[str, list[str]], default: Column) -> Column:
    """Map an already folded value to the name of the group it is listed in."""
    mapped = F
    for name, words in groups.items():
        mapped = mapped.when(c.isin(words), F.lit(name))
    return mapped.otherwise(default)


def name_case(c: Column) -> Column:
    return F.when(~is_blank(c), F.initcap(c))


def email_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(False))


def email_domain(c: Column) -> Column:
    return F.regexp_extract(c, r"@(.+)$", 1)


def us_phone(c: Column) -> Column:
    """``(XXX) XXX-XXXX`` from the last ten digits; null when there are fewer."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.regexp_replace(digits, TEN_DIGITS, PHONE_SHAPE))


def yes_no(c: Column) -> Column:
    """Boolean from the accepted words; null for anything else."""
    word = folded(c)
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def segment(c: Column) -> Column:
    word = folded(c)
    return F.when(word.isin(SEGMENTS), word).otherwise(F.lit("standard"))


def payment_method(c: Column) -> Column:
    return synonym(folded(c), PAYMENT_SYNONYMS, F.lit("other"))


def category(c: Column, *, title: bool = True) -> Column:
    """Canonical category; a null becomes ``uncategorized``, a blank stays blank."""
    word = F.coalesce(folded(c), F.lit("uncategorized"))
    mapped = synonym(word, CATEGORY_SYNONYMS, word)
    return F.initcap(mapped) if title else mapped


def category_title(c: Column) -> Column:
    """Title case only, with no synonym mapping."""
    return F.initcap(F.lower(c))


def full_name(first: Column, last: Column) -> Column:
    return F.nullif(F.concat_ws(" ", first, last), F.lit(""))
