"""Word bags for comparing product names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters read as a space, and what separates words.
_DASHES = "[—\\-]"
_BLANKS = "\\s+"


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), _DASHES, " ")), _BLANKS)


def word_overlap_ratio(catalogue: Column, seller: Column) -> Column:
    """Share of the catalogue name's words that the seller's title repeats.

    Only dashes are stripped. The shared words are counted once each while the
    divisor counts repeats, so ``'a a'`` against itself gives 0.5. A missing
    name on either side gives 0.0.
    """
    wanted = _words(catalogue)
    shared = F.size(F.array_intersect(wanted, _words(seller)))
    return F.ifnull(F.when(F.size(wanted) > 0, shared / F.size(wanted)), F.lit(0.0))


def sorted_words(text: Column) -> Column:
    """Lower-cased words in alphabetical order, one blank between them."""
    return F.array_join(F.sort_array(_words(text)), " ")


def title_similarity(a: Column, b: Column) -> Column:
    """``100 * (1 - levenshtein / longer length)`` of the sorted words; NULL-safe 0.0."""
    left, right = sorted_words(a), sorted_words(b)
    longer = F.greatest(F.char_length(left), F.char_length(right))
    return F.ifnull(
        F.when(longer > 0, 100 * (longer - F.levenshtein(left, right)) / longer), F.lit(0.0)
    )
