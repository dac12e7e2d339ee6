"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Everything is a column expression over the whole text, so a scan needs neither
Python nor a shuffle. Offsets are code points: the gaps between matches come
from ``split`` with the pattern that found them.

The patterns find what their plain forms find, but in linear time: a run that
cannot match is skipped whole (possessive repeats, a start only where a run or
the last match ends) instead of being tried again from each of its characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Characters before a span that are searched for context words.
CONTEXT = 40
# Score an added span must reach; the base kinds are always kept.
LEAST_SCORE = 0.6
# What a context word adds, and what it takes away where a kind needs one.
CONTEXT_GAIN = 0.3

_DIGITS36 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a text every match contains, the score of a confirmed match and its context words."""

    name: str
    pattern: str
    must: str
    score: float
    words: str
    base: bool = True


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, r"mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.7, r"\bip\b|host|server|address|adresse"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", "", 0.7, r"card|karte|carte|tarjeta|visa|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, r"phone|\btel|call|mobile|handy"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", "", 0.7, r"iban|account|konto|cuenta|compte", base=False),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "-", 0.4, r"ssn|social security|tax id", base=False),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d >= 5, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four characters moved to the end, letters as 10-35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        value = F.instr(F.lit(_DIGITS36), F.substring(turned, i, F.lit(1))) - 1
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: ~value.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)"),
        "card": lambda: luhn(digits),
        "phone": lambda: F.length(digits).between(9, 15),
        "iban": lambda: mod97(value),
        "ssn": lambda: ~value.rlike(r"^(?:000|666|9..)|-00-|-0000$"),
    }[kind]()


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (start, end, value) of all matches, in order."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), 0).alias("values"),
        F.transform(F.split(text, kind.pattern, -1), F.length).alias("gaps"),
    )

    def placed(both: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.get(both["gaps"], i)
            value = F.get(both["values"], i)
            end = start + F.length(value)
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))).alias("out"))

        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        count = F.size(both["values"])
        steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])

    # The one-element array binds the two regex results, so that each runs once.
    all_found = F.get(F.transform(F.array(found), placed), 0)
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.contains(text, F.lit(kind.must)), all_found).otherwise(nothing) if kind.must else all_found


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``private``: array of (kind, start, end, score, base), by kind as in KINDS, then start.

    Matches of one kind do not overlap. Base kinds keep every confirmed match;
    the others need LEAST_SCORE, which context words within CONTEXT characters
    before a span help to reach, and must not overlap a base span. A null or empty text has an
    empty array. A column called ``private`` is replaced; all others and all
    rows, repeated ones too, are kept. One pass, no shuffle.
    """
    out = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        out = out.withColumn(f"__{kind.name}", _matches(F.col("__text"), kind))

    def scored(kind: Kind) -> Column:
        def score(m: Column) -> Column:
            left = F.greatest(m["start"] - CONTEXT, F.lit(0))
            near = F.lower(F.substring(F.col("__text"), left + 1, m["start"] - left))
            value = F.lit(kind.score) + F.when(near.rlike(kind.words), CONTEXT_GAIN).otherwise(0.0)
            return F.struct(
                F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                F.least(value, F.lit(1.0)).alias("score"), F.lit(kind.base).alias("base"),
            )

        return F.transform(F.filter(f"__{kind.name}", lambda m: _confirmed(kind.name, m["value"])), score)

    out = out.withColumn("__base", F.concat(*[scored(k) for k in KINDS if k.base]))
    free = lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    added = F.filter(F.concat(*[scored(k) for k in KINDS if not k.base]), lambda s: (s["score"] >= LEAST_SCORE) & free(s))
    out = out.withColumn("private", F.concat("__base", added))
    return out.drop("__text", "__base", *[f"__{k.name}" for k in KINDS])
