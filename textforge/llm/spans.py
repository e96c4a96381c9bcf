"""Places of all matches of a pattern in a text, in built-in functions.

``split`` and ``regexp_extract_all`` find the same leftmost, non-overlapping matches; the gaps and the
matches in turn make up the text, so running lengths give places. Places are code points from 0, ends
are exclusive. One aggregation goes over blocks of matches, an inner one over a block, and only those that
hold are appended, so that a text with very many matches isn't copied again and again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pairs of a block.
BLOCK = 256
SPAN = "array<struct<start:bigint,stop:bigint,value:string>>"


def matches(text: Column, pattern: str, may_match: Column, holds: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the matches for which ``holds(value)``; nothing is searched unless ``may_match``."""
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )
    empty = F.array().cast(SPAN)

    def step(done: Column, pair: Column) -> Column:
        start = done["place"] + F.length(pair["gap"])
        stop = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        good = pair["value"].isNotNull()
        if holds is not None:
            good = good & F.coalesce(holds(pair["value"]), F.lit(False))
        span = F.struct(start.alias("start"), stop.alias("stop"), pair["value"].alias("value"))
        found = F.when(good, F.concat(done["found"], F.array(span))).otherwise(done["found"])
        return F.struct(stop.alias("place"), found.alias("found"))

    def block(done: Column, pairs: Column, at: Column) -> Column:
        """Goes on over one block; only what the block has found is appended to pair by pair."""
        begin = F.struct(done["place"].alias("place"), empty.alias("found"))
        some = F.slice(pairs, at * BLOCK + 1, F.lit(BLOCK))
        return F.aggregate(
            some, begin, step,
            lambda own: F.struct(own["place"].alias("place"), F.concat(done["found"], own["found"]).alias("found")),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("place"), empty.alias("found"))

    def whole(pairs: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
        return F.aggregate(blocks, zero, lambda done, at: block(done, pairs, at), lambda done: done["found"])

    # As the only element of an array, the pairs are made once and then have a name.
    return F.when(may_match, F.get(F.transform(F.array(pairs), whole), F.lit(0))).otherwise(empty)


def labelled(kind: str, rank: int, spans: Column) -> Column:
    """The spans with their kind and its rank among the kinds."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), F.lit(kind).alias("kind")
        ),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
