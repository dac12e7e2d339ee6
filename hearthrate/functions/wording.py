"""Regular-expression flags over listing and review text."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from hearthrate.functions.nulls import flag

# Feature name -> pattern over the lower-cased description.
DESCRIPTION_PATTERNS = {
    "has_view": r"\bview\b|\bviews\b|\bscenic\b|\bpanoramic\b",
    "has_waterfront": r"\bwaterfront\b|\bwater front\b|\bwaterside\b|\blakefront\b|\bbeachfront\b",
    "is_downtown": r"\bdowntown\b|\bcity cent(?:er|re)\b|\burban core\b",
    "has_hot_tub": r"\bhot tub\b|\bhotttub\b|\bspa\b|\bjacuzzi\b",
    "has_pool": r"\bpool\b|\bswimming pool\b",
    "has_parking": r"\bparking\b|\bgarage\b|\bdriveway\b",
    "has_gym": r"\bgym\b|\bfitness\b|\bworkout\b|\bexercise room\b",
    "has_ev_charger": r"\bev charger\b|\belectric vehicle\b|\bev charging\b|\btesla charger\b",
    "is_newly_renovated": r"\bnew(?:ly)? renovated\b|\brecently renovated\b|\bremodeled\b|\bupdated\b|\bmodern(?:ized)?\b",
    "is_luxury": r"\bluxury\b|\bluxurious\b|\bupscale\b|\bhigh.end\b|\bpremium\b",
    "is_cozy": r"\bcozy\b|\bcosy\b|\bcharm(?:ing)?\b|\bintimate\b|\bquaint\b",
    "has_fireplace": r"\bfireplace\b|\bfire place\b|\bwood.burning\b",
    "has_private_entrance": r"\bprivate entrance\b|\bprivate entry\b|\bseparate entrance\b",
    "has_backyard": r"\bbackyard\b|\bback yard\b|\bprivate yard\b|\bpatio\b|\bdeck\b|\bterrace\b",
    "is_entire_floor": r"\bentire floor\b|\bwhole floor\b|\bfull floor\b|\btop floor\b|\bpenthouse\b",
}

# Feature name -> pattern over the lower-cased amenities text.
AMENITY_PATTERNS = {
    "amenity_has_hot_tub": r"\bhot tub\b|\bhotttub\b|\bjacuzzi\b",
    "amenity_has_pool": r"\bpool\b|\bswimming pool\b",
    "amenity_has_parking": r"\bparking\b|\bgarage\b",
    "amenity_has_gym": r"\bgym\b|\bfitness\b|\bworkout\b",
    "amenity_has_ev_charger": r"\bev charger\b|\belectric vehicle\b|\bev charging\b",
}

# Review words that count as praise or complaint.
PRAISE_WORDS = (
    "clean", "spacious", "view", "location", "quiet",
    "cozy", "comfortable", "beautiful", "amazing", "perfect",
)
COMPLAINT_WORDS = (
    "noisy", "dirty", "small", "outdated", "cold",
    "disappointing", "misleading", "broken", "smell", "mold",
)


def _alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern, split at bars outside groups."""
    parts, depth = [""], 0
    for char in pattern:
        depth += (char == "(") - (char == ")")
        if char == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return parts


def _stem(alternative: str) -> str:
    """Plain text every match of an alternative must hold: its letters up to the first special character."""
    body = alternative.removeprefix(r"\b")
    plain = re.match(r"[a-z ]*", body).group()
    return plain[:-1] if body[len(plain) : len(plain) + 1] in ("?", "*", "{") else plain


def matches(lowered: Column, pattern: str) -> Column:
    """``rlike`` behind a search for the pattern's plain stems.

    A byte search rules out most texts, and only the others pay for the regular
    expression. A pattern with an alternative without stem is matched directly.
    """
    stems = sorted({_stem(part) for part in _alternatives(pattern)})
    if not all(stems):
        return lowered.rlike(pattern)
    return reduce(Column.__or__, [F.contains(lowered, F.lit(stem)) for stem in stems]) & lowered.rlike(pattern)


def pattern_flags(lowered: Column, patterns: Mapping[str, str]) -> list[Column]:
    """One 0/1 column per pattern over text that is already lower case; missing text counts as empty."""
    return [flag(matches(lowered, pattern)).alias(name) for name, pattern in patterns.items()]


def mentions_any(text: Column, words: tuple[str, ...]) -> Column:
    """1 if the text holds one of the words as a whole word."""
    return flag(matches(F.lower(text), "|".join(rf"\b{word}\b" for word in words)))
