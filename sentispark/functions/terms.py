"""Terms for the vector model: words of two letters or more, and their bigrams."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentispark.functions.text import tokens


def vector_tokens(cleaned: Column | str) -> Column:
    """One-letter words vanish before pairs are formed."""
    return F.filter(tokens(cleaned), lambda t: F.length(t) >= 2)


def bigrams(words: Column) -> Column:
    """Neighbouring pairs, formed inside the row: no window, no shuffle."""
    following = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def terms_1_2(words: Column) -> Column:
    return F.concat(words, bigrams(words))


def literal_array(values: Sequence, ddl: str) -> Column:
    """A driver-side list of bounded length as one constant column."""
    return F.from_json(F.lit(json.dumps(list(values))), ddl)
