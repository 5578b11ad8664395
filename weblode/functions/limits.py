"""Result limits, given as a number or as request text.

Nothing or no number: 10. ``-1``, or a number that no row count reaches (2^63):
all. Otherwise the whole part; an empty text is 0. Other negative numbers are an
error. Numbers may be decimal, or hexadecimal, octal or binary with a prefix.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_LIMIT = 10
ALL = -1
MOST = 2**63

# Fixed pattern: what counts as a number.
_NUMBER = r"[+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
_PREFIXED = r"0[xX][0-9a-fA-F]+|0[oO][0-7]+|0[bB][01]+"


def _whole(number: float, limit: object) -> int | None:
    if number == ALL or number >= MOST:
        return None
    if number <= ALL:
        raise ValueError(f"limit must be -1 or not negative: {limit}")
    return int(number)


def resolve_limit(limit: int | float | str | None) -> int | None:
    """Number of rows, or ``None`` for all."""
    if limit is None:
        return DEFAULT_LIMIT
    if not isinstance(limit, str):
        return DEFAULT_LIMIT if math.isnan(limit) else _whole(limit, limit)
    text = limit.strip()
    if re.fullmatch(_PREFIXED, text):
        return _whole(int(text, 0), limit)
    if text and not re.fullmatch(_NUMBER, text):
        return DEFAULT_LIMIT
    return _whole(float(text or 0), limit)


def resolve_limits(limit: Column) -> Column:
    """The same for a column of numbers or text; null stands for all."""
    text = F.trim(limit.cast("string"))
    digits = F.ltrim(F.substring(text, F.lit(3), F.length(text)), F.lit("0"))
    prefixed = F.lit(None).cast("bigint")
    # base, digits that always stay below 2^63, and a full length that may
    for sign, base, short, full in (("x", 16, 15, r"[1-7].{15}"), ("o", 8, 21, ""), ("b", 2, 63, "")):
        fits = F.length(digits) <= short
        if full:
            fits = fits | digits.rlike(rf"\A{full}\z")
        value = F.when(digits == "", F.lit("0")).when(fits, F.conv(digits, base, 10)).cast("bigint")
        prefixed = F.when(F.lower(F.substring(text, 2, 1)) == sign, value).otherwise(prefixed)
    parsed = F.when(text == "", F.lit(0.0)).when(
        text.rlike(rf"\A{_NUMBER}\z"), text.try_cast("double")
    )

    def whole(number: Column) -> Column:
        error = F.concat(F.lit("limit must be -1 or not negative: "), number.cast("string"))
        return (
            F.when(number.isNull(), F.lit(DEFAULT_LIMIT).cast("bigint"))
            .when((number == ALL) | (number >= float(MOST)), F.lit(None).cast("bigint"))
            .when(number > ALL, F.floor(F.greatest(number, F.lit(0.0))))
            .otherwise(F.raise_error(error).cast("bigint"))
        )

    # An array of one, so that the text is parsed once however often the
    # number is used.
    decimal = F.transform(F.array(parsed), whole)[0]
    return F.when(text.rlike(rf"\A(?:{_PREFIXED})\z"), prefixed).otherwise(decimal)
