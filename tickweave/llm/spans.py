"""Places of regular expression matches, from built-in functions alone.

Spark returns the texts of all matches and the gaps between them, but not their
places. The running length of gaps and matches gives the places, in code points. It is
taken over chunks of the matches, each as long as there are chunks, since a fold copies
what it has gathered at every step: a text of many matches costs little more than their
number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,inner:string>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` proposes leftmost non-overlapping spans, in linear time for any
    text. ``inner`` is the group that a check looks at. ``base`` rules are those
    of the result contract, in the order of their ranks."""

    kind: str
    pattern: str
    inner: int = 0
    base: bool = True


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_chunks(
    items: Column,
    zero: Column,
    over: Callable[[Column, Column], Column],
    add: Callable[[Column, Column], Column],
) -> Column:
    """The arrays that ``over`` makes of each chunk of ``items`` and of what the chunks
    before it add up to, one after another. ``add`` adds a chunk to such a state."""

    def carried(chunks: Column) -> Column:
        begin = F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("states"))

        def step(held: Column, chunk: Column) -> Column:
            return F.struct(
                add(held["state"], chunk).alias("state"), F.array_append(held["states"], held["state"]).alias("states")
            )

        return F.aggregate(chunks, begin, step, lambda held: held["states"])

    def cut(held: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(held))).cast("int"), F.lit(1))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(held), F.lit(1)), width)
        return F.transform(firsts, lambda first: F.slice(held, first, width))

    whole = bound(items, cut)
    return bound(whole, lambda chunks: F.flatten(F.zip_with(chunks, carried(chunks), over)))


def propose(rows: DataFrame, text: str, rules: list[Rule], out: str, near: int = 0) -> DataFrame:
    """``rows`` with the array ``out`` of the spans that all rules propose; with ``near``
    each has ``before``, so many code points in front of it, as far as there are."""
    names = [f"{out}_{i}" for i in range(len(rules))]
    found = rows.withColumns(
        {name: F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)) for name, rule in zip(names, rules)}
    )
    placed = [_placed(text, name, rank, rule, near) for rank, (name, rule) in enumerate(zip(names, rules))]
    return found.withColumn(out, F.concat(*placed)).drop(*names)


def _placed(text: str, found: str, rank: int, rule: Rule, near: int) -> Column:
    inner = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.inner)) if rule.inner else F.col(found)
    pairs = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), F.col(found).alias("value"), inner.alias("inner")
    )
    kind = SPAN if not near else SPAN.replace(">>", ",before:string>>")
    none = F.array().cast(kind)

    def last(*parts: Column) -> Column:
        return F.right(F.concat(*parts), F.lit(near)) if near else F.lit("")

    def passed(state: Column, pair: Column) -> Column:
        """Place and last code points after a gap and its match."""
        at = state["at"] + F.length(pair["gap"]) + F.length(pair["value"])
        return F.struct(at.alias("at"), last(state["tail"], pair["gap"], pair["value"]).alias("tail"))

    def step(held: Column, pair: Column) -> Column:
        state = held["state"]
        start = state["at"] + F.length(pair["gap"])
        span = [
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.length(pair["value"])).alias("end"),
            F.lit(rule.kind).alias("kind"),
            pair["value"].alias("value"),
            pair["inner"].alias("inner"),
        ]
        span += [last(state["tail"], pair["gap"]).alias("before")] if near else []
        return F.struct(passed(state, pair).alias("state"), F.array_append(held["spans"], F.struct(*span)).alias("spans"))

    located = in_chunks(
        F.slice(pairs, 1, F.size(found)),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")),
        lambda chunk, state: F.aggregate(
            chunk, F.struct(state.alias("state"), none.alias("spans")), step, lambda held: held["spans"]
        ),
        lambda state, chunk: F.aggregate(chunk, state, passed),
    )
    return F.when(F.size(found) > 0, located).otherwise(none)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, by start and then by rank, joined with commas."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(rows: DataFrame, key: str, spans: str, rules: list[Rule]) -> DataFrame:
    """The result of the span contracts: counts, hash of the base spans, all spans."""
    base = [r for r in rules if r.base]
    bases = F.filter(spans, lambda s: s["rank"] < len(base))
    return rows.select(
        key,
        *(of_kind(F.col(spans), r.kind).alias(f"n_{r.kind}") for r in base),
        F.sha2(listed(bases), 256).alias("base_sha256"),
        listed(F.col(spans)).alias("spans"),
    )
