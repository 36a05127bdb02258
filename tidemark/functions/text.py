"""Text expressions: Column in, Column out."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(fixed.NA_TOKENS), c)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def title(c: Column) -> Column:
    """Capital after everything that is no cased letter. A mark with a blank after such characters lets the built-in,
    which only knows words between blanks, do it."""
    marked = F.regexp_replace(c, r"([^\p{Lu}\p{Ll}\p{Lt} ])", "$1\x01 ")
    return F.replace(F.initcap(marked), F.lit("\x01 "), F.lit(""))


def msisdn_candidate(c: Column) -> Column:
    """Digits with the country prefix put in place of a leading 0 or before 8 bare digits."""
    prefix = fixed.MSISDN_PREFIX
    return F.regexp_replace(digits(c), rf"^(?!{prefix})(?:0|(?=\d{{8}}$))", prefix)


def msisdn_valid(candidate: Column) -> Column:
    digits_left = fixed.MSISDN_LENGTH - len(fixed.MSISDN_PREFIX)
    return F.coalesce(candidate.rlike(rf"^{fixed.MSISDN_PREFIX}\d{{{digits_left}}}$"), F.lit(False))


def msisdn_error(raw: Column, candidate: Column) -> Column:
    n = F.length(candidate)
    return (
        F.when(raw.isNull(), "MSISDN is null")
        .when(strip(raw) == "", "MSISDN is empty")
        .when(n != fixed.MSISDN_LENGTH, F.concat(F.lit("Invalid length: "), n.cast("string")))
        .when(~candidate.startswith(fixed.MSISDN_PREFIX), f"Missing prefix {fixed.MSISDN_PREFIX}")
    )


def kit_valid(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^(?!WITHOUT)(?s:.)"), F.lit(False))


def kit_error(raw: Column, code: Column) -> Column:
    return (
        F.when(raw.isNull(), "KIT_CODE is null")
        .when(code == "", "KIT_CODE is empty")
        .when(code.startswith("WITHOUT"), "Invalid kit code (starts with WITHOUT)")
    )


def postal_code(c: Column) -> Column:
    return F.regexp_extract(strip(c), r"^([+-]?\d+)(\.0*)?$", 1).try_cast("int")


def offer_category(c: Column, rules=None) -> Column:
    """First rule whose keyword occurs in the upper-cased offer; rules are (category, keywords) in precedence order."""
    upper = F.upper(c)
    result = F.when(c.isNull() | (c == ""), fixed.OFFER_MISSING)
    for category, words in rules or fixed.OFFER_KEYWORDS:
        result = result.when(reduce(lambda a, b: a | b, [upper.contains(w) for w in words]), category)
    return result.otherwise(fixed.OFFER_DEFAULT)


def one_hot(c: Column, values, prefix: str) -> list[Column]:
    return [F.when(c == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in values]
