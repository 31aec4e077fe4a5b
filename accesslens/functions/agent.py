"""User-agent classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from accesslens.constants import UA_KEYWORDS, UA_MOBILE, UA_PC, UA_TV


def ua_keyword(ua: Column, words=UA_KEYWORDS) -> Column:
    """First word of the ordered list found in the lower-cased agent."""
    return keyword_of(F.lower(ua), words)


def keyword_of(low: Column, words=UA_KEYWORDS) -> Column:
    """The same for an agent that is lower-cased already."""
    cases = [F.when(low.contains(w), F.lit(w)) for w in words]
    return F.coalesce(*cases, F.lit("other"))


def _has_any(low: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def ua_device(ua: Column) -> Column:
    low = F.lower(ua)
    return (
        F.when(_has_any(low, UA_TV), "tv")
        .when(_has_any(low, UA_MOBILE), "mobile")
        .when(_has_any(low, UA_PC), "pc")
        .otherwise("other")
    )


def ua_from_list(ua: Column, words: Column) -> Column:
    """Class by a loaded keyword list: ``words`` is an ordered array column."""
    low = F.lower(ua)
    return F.coalesce(F.get(F.filter(words, lambda w: low.contains(w)), F.lit(0)), F.lit("other"))
