"""Coercions of loosely typed JSON values, as expressions over VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|INT|SMALLINT|TINYINT|LONG)$"
#: Python's float(): digits with single underscores between them, a point, an exponent, or the special names.
_NUMBER = r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
_SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def strip(s: Column) -> Column:
    """Without white space of any kind at both ends; between two printable characters of ASCII there is nothing to look for."""
    plain = F.substring(s, 1, 1).between("!", "~") & F.substring(s, -1, 1).between("!", "~")
    return F.when(plain, s).otherwise(F.regexp_replace(F.regexp_replace(s, r"(?U)^\s+", ""), r"(?U)\s+$", ""))


def blank_to_null(s: Column) -> Column:
    return F.nullif(strip(s), F.lit(""))


def text_to_float(s: Column) -> Column:
    t = strip(s)
    special = F.when(F.lower(t).contains("nan"), F.lit(float("nan"))).when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(t.rlike(_NUMBER), F.expr("1") * F.replace(t, F.lit("_"), F.lit("")).try_cast("double")).when(t.rlike(_SPECIAL), special)


def to_float(v: Column) -> Column:
    """Numbers and numeric texts; booleans, lists, objects and other texts are null."""
    k = kind(v)
    return F.when(k.rlike(NUMBER_KINDS), F.try_variant_get(v, "$", "double")).when(k == "STRING", text_to_float(F.try_variant_get(v, "$", "string")))


def to_bool(v: Column) -> Column:
    """Only real booleans."""
    return F.when(kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))


def to_text(v: Column) -> Column:
    """Stripped text, or a number as text; booleans and blanks are null."""
    k = kind(v)
    return F.when(k == "STRING", blank_to_null(F.try_variant_get(v, "$", "string"))).when(k.rlike(NUMBER_KINDS), F.try_variant_get(v, "$", "string"))


def to_count(v: Column) -> Column:
    """Whole numbers; fractions are cut off; texts of digits; booleans are null."""
    k, s = kind(v), F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(v, "$", "double")
    cut = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("long")
    return F.when(k.rlike(NUMBER_KINDS), cut).when((k == "STRING") & strip(s).rlike("^[0-9]+$"), strip(s).try_cast("long"))


def place_id(v: Column) -> Column:
    """An id must be a text with something in it."""
    return F.when(kind(v) == "STRING", blank_to_null(F.try_variant_get(v, "$", "string")))


def localized_text(v: Column) -> Column:
    """Text of an object with a text field, or the text itself; else empty."""
    k = kind(v)
    inner = F.try_variant_get(v, "$.text", "variant")
    return F.coalesce(
        F.when(k.startswith("OBJECT") & (kind(inner) == "STRING"), strip(F.try_variant_get(inner, "$", "string"))).when(k == "STRING", strip(F.try_variant_get(v, "$", "string"))),
        F.lit(""),
    )


def review_text(review: Column) -> Column:
    """The text, or the original text where it is blank."""
    get = lambda p: localized_text(F.try_variant_get(review, p, "variant"))
    return F.coalesce(F.nullif(get("$.text"), F.lit("")), get("$.originalText"))
