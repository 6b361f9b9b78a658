"""Polarity, weight and the blended signal of one post."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmura.defaults import LEXICON_SHARE, TEXT_SHARE


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def lexicon_score(content_folded: Column, bullish: list[str], bearish: list[str]) -> Column:
    """(bull - bear) / (bull + bear) over the lexicon words present; 0 when there are none.

    Takes case-folded text with single spaces. Words are whitespace-separated and count once. The few
    that are in the lexicon are picked first, so that no set is made of all words of a text.
    """
    listed = list(dict.fromkeys([*bullish, *bearish]))
    tokens = F.filter(F.split(F.coalesce(content_folded, F.lit("")), " "), lambda word: word.isin(listed))
    bull = F.size(F.array_intersect(_words(bullish), tokens))
    bear = F.size(F.array_intersect(_words(bearish), tokens))
    return F.when(bull + bear == 0, F.lit(0.0)).otherwise((bull - bear) / (bull + bear))


def engagement_weight(engagement: Column) -> Column:
    return F.log1p(engagement.cast("double"))


def blend_signal(lexicon: Column, weight: Column, strength: Column, max_strength: Column) -> Column:
    """Polarity times engagement weight and relative text strength, clipped to [-1, 1]."""
    engaged = F.coalesce(lexicon * weight, F.lit(0.0))
    textual = F.coalesce(lexicon * (strength / F.nullif(max_strength, F.lit(0.0))), F.lit(0.0))
    blended = F.lit(LEXICON_SHARE) * engaged + F.lit(TEXT_SHARE) * textual
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), blended))
