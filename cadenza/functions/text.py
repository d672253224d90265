"""Text columns: folding, word grams, character grams, distance.

Everything is built from Spark expressions.  Each is kept as SQL text so that a
``SQLTransformer`` can carry it inside a saved pipeline.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A word: two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Code point ranges the accent table is derived from: Latin, Greek and Cyrillic
# letters with marks, and full-width forms.
_ACCENT_RANGES = ((0x00A0, 0x0530), (0x1E00, 0x2000), (0xFF01, 0xFFE7))


def _without_marks(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Arguments of ``translate``: replaced letters first, dropped marks last."""
    replaced, plain, dropped = [], [], []
    for low, high in _ACCENT_RANGES:
        for point in range(low, high):
            letter = chr(point)
            bare = _without_marks(letter)
            if not bare:
                dropped.append(letter)
            elif bare != letter and len(bare) == 1:
                replaced.append(letter)
                plain.append(bare)
    return "".join(replaced + dropped), "".join(plain)


@F.pandas_udf(StringType())
def _strip_any_accent(texts: pd.Series) -> pd.Series:
    return texts.map(_without_marks, na_action="ignore")


def fold_sql(column: str) -> str:
    """Lower case without accents, inside the JVM."""
    source, target = (t.replace("\\", "\\\\").replace("'", "\\'") for t in accent_table())
    return f"translate(lower({column}), '{source}', '{target}')"


def fold(column: str, every_script: bool = False) -> Column:
    """Lower case without accents.

    ``every_script`` also unfolds letters that decompose into several (ligatures,
    Hangul); that needs Python, so apply it to distinct texts only.
    """
    if every_script:
        return _strip_any_accent(F.lower(F.col(column)))
    return F.expr(fold_sql(column))


def words(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit(WORD_PATTERN), F.lit(0))


def word_grams(tokens: Column) -> Column:
    """Distinct words and pairs of neighbouring words of a token array."""
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(F.concat(tokens, pairs))


def char_grams_sql(column: str) -> str:
    """Distinct 4-letter pieces of the space-padded words of a text.

    A padded word of up to four letters is one piece.
    """
    words_once = rf"array_distinct(filter(split({fold_sql(column)}, '\\s+'), w -> w <> ''))"
    padded = f"transform({words_once}, w -> concat(' ', w, ' '))"
    return (
        f"array_distinct(flatten(transform({padded}, w -> transform("
        "sequence(1, greatest(length(w) - 3, 1)), i -> substring(w, i, 4)))))"
    )


def char_grams(column: str) -> Column:
    return F.expr(char_grams_sql(column))


def gram_distance_sql(left: str, right: str) -> str:
    """1 - cosine of two distinct-gram arrays; null where one has no grams."""
    return (
        f"1D - try_divide(cast(size(array_intersect({left}, {right})) as double), "
        f"sqrt(cast(size({left}) as double) * cast(size({right}) as double)))"
    )


def gram_distance(left: str, right: str) -> Column:
    return F.expr(gram_distance_sql(left, right))
