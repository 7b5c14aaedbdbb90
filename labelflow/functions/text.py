"""Text columns: whitespace, model input, keyword groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelflow.schema import MINORITY_KEYWORDS, NA_TOKENS, SENTINEL, TEXT_SEPARATOR

# Unicode whitespace plus the four separators that Python also strips.
_SPACE = r"[\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends; SQL `trim` removes only spaces."""
    return F.regexp_replace(col, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def has_text(col: Column) -> Column:
    """True when the value is neither null nor blank; never null."""
    return F.coalesce(col.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def na_to_null(col: Column) -> Column:
    """Replace the missing-value tokens of a CSV reader by null."""
    return F.when(~col.isin(NA_TOKENS), col)


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def is_sentinel(col: Column) -> Column:
    """True for the sentinel category; a null category is not the sentinel."""
    return col.eqNullSafe(F.lit(SENTINEL))


def combined_text(description: Column, collected: Column) -> Column:
    """Model input of a record; a null field counts as blank."""
    return F.concat(blank_if_null(description), F.lit(TEXT_SEPARATOR), blank_if_null(collected))


def keyword_groups(
    text: Column, groups: dict[str, list[str]] = MINORITY_KEYWORDS
) -> Column:
    """Comma list of the groups with a keyword inside the lower-cased text, `""` when none."""
    lowered = F.lower(text)
    hits = []
    for name, keywords in groups.items():
        found = F.lit(False)
        for keyword in keywords:
            found = found | F.contains(lowered, F.lit(keyword))
        hits.append(F.when(found, F.lit(name)))
    return F.concat_ws(",", *hits) if hits else F.lit("")


def fixed(col: Column, digits: int) -> Column:
    """Decimal text of a number, rounded from its exact value (`0.125` gives `0.12`).

    `format_string` would round the shortest decimal form up instead.
    """
    return F.replace(F.format_number(col, digits), F.lit(","), F.lit(""))
