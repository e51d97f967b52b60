"""Matches of a pattern with their places, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

SPAN = "struct<kind:string,start:int,end:int,value:string,gap:string>"
NONE = f"array<{SPAN}>"
BLOCK = 256


def none() -> Column:
    return F.array().cast(NONE)


def spans(text: Column, kind: str, pattern: str, maybe: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as array<struct<kind, start, end, value, gap>>; code points, end exclusive.

    `gap` is the text between the match before and this one. What lies between
    matches (split) and the matches (extract all) are laid end to end. `maybe`
    is a cheap condition without which there is no match.
    """

    def starts(gaps: Column, hits: Column) -> Column:
        """Running sums in blocks: appending to an array copies it, so long ones are put together from short ones."""

        def one(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(gaps, i))
            return F.struct((start + F.length(F.get(hits, i))).alias("at"), F.concat(acc["out"], F.array(start)).alias("out"))

        def block(acc: Column, b: Column) -> Column:
            part = F.aggregate(
                F.sequence(b * BLOCK, F.least(b * BLOCK + (BLOCK - 1), F.size(hits) - 1)),
                F.struct(acc["at"].alias("at"), F.array().cast("array<int>").alias("out")), one,
            )
            return let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int"))
        return F.aggregate(blocks, zero, block, lambda acc: F.flatten(acc["out"]))

    def place(gaps: Column, hits: Column) -> Column:
        return let(
            starts(gaps, hits),
            lambda begin: F.transform(
                hits,
                lambda hit, i: F.struct(
                    F.lit(kind).alias("kind"), F.get(begin, i).alias("start"), (F.get(begin, i) + F.length(hit)).alias("end"),
                    hit.alias("value"), F.get(gaps, i).alias("gap"),
                ),
            ),
        )

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = let(hits, lambda h: F.when(F.size(h) == 0, none()).otherwise(let(F.split(text, pattern, -1), lambda g: place(g, h))))
    found = F.when(maybe, found).otherwise(none()) if maybe is not None else found
    return F.coalesce(found, none())


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def written(found: Column) -> Column:
    """kind:start:end, joined by commas, in the order given."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
