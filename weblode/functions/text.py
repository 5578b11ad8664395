"""Text to index words."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators, characters deleted anywhere in a token, and the
# characters trimmed from its ends (everything up to U+0020).
SEPARATORS = r"[ ,.\-_;]"
DELETED = "\"'[]()$#?!*¿¡%+"
TRIMMED = "".join(map(chr, range(0x21)))

_DELETED = "[" + re.escape(DELETED) + "]+"
_WORD = r"\A[a-zA-Z0-9]+\z"
_STORE_WORD = r"\A[a-zA-Z0-9][a-zA-Z0-9-]*\z"
# A whole token that is a word after trimming.
_TOKEN_WORD = (
    rf"(?<![^{SEPARATORS[1:-1]}])[\x00-\x1f]*+([a-zA-Z0-9]++)"
    rf"(?=[\x00-\x1f]*+(?:{SEPARATORS}|\z))"
)


def _cleaned(text: Column) -> Column:
    """No deleted character is a separator, so deleting them from the whole
    text is the same as deleting them per token."""
    return F.regexp_replace(text, _DELETED, "")


def split_tokens(text: Column) -> Column:
    return F.split(_cleaned(text), SEPARATORS)


def trim_token(token: Column) -> Column:
    return F.btrim(token, F.lit(TRIMMED))


def is_word(token: Column) -> Column:
    """Tokens with any other character are dropped, not split further."""
    return token.rlike(_WORD)


def extract_words(text: Column) -> Column:
    """Array of the words among the tokens, as ``split_tokens``, ``trim_token``
    and ``is_word`` find them, but in one pass over the text."""
    return F.regexp_extract_all(_cleaned(text), F.lit(_TOKEN_WORD), 1)


def count_word(text: Column, word: str) -> Column:
    """How often one word is among those of ``extract_words``, in either case."""
    if not re.fullmatch("[a-zA-Z0-9]+", word):
        return F.lit(0)
    return F.regexp_count(_cleaned(text), F.lit("(?i)" + _TOKEN_WORD.replace("([a-zA-Z0-9]++)", word)))


def has_word(text: Column) -> Column:
    """Whether there is any word; stops at the first."""
    return _cleaned(text).rlike(_TOKEN_WORD)


def is_store_word(word: Column) -> Column:
    """The store also takes inner hyphens, for posting files made elsewhere."""
    return word.rlike(_STORE_WORD)
