"""Places of pattern matches as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start: bigint, end: bigint, text: string>>"


def none() -> Column:
    return F.from_json(F.lit("[]"), SPAN)


#: Matches whose places are added up together; the places of a text with n matches take about n times this many steps.
CHUNK = 128
#: A match with the text before it (back to the gap before the last match) and behind it (to the next match's end).
AROUND = "array<struct<start: bigint, end: bigint, text: string, left: string, right: string>>"


def with_matches(rows: DataFrame, patterns: dict[str, tuple[Column, str | Column]], around: tuple[int, int] | None = None) -> DataFrame:
    """Adds for each name an array of (start, end, text) of the leftmost non-overlapping matches of a pattern in `text`.

    Places are code points, the end exclusive. A pattern is only tried on rows where its condition
    holds. Places come from the lengths of the matches and of what lies between them. With `around`, each match also
    has so many code points to its left and to its right, in lower case.
    """
    found = rows.select("*", *[
        F.when(cond, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"{n}_found")
        for n, (cond, p) in patterns.items()
    ])
    left, right = around or (0, 0)
    ends = lambda g: [F.substring(g, 1, right).alias("head"), F.substring(g, -left, left).alias("tail")] if around else []
    between = found.select("*", *[
        F.when(F.size(f"{n}_found") > 0, F.transform(F.split("text", p, -1), lambda g: F.struct(F.length(g).alias("n"), *ends(g)))).alias(f"{n}_between")
        for n, (_, p) in patterns.items()
    ])
    empty = F.from_json(F.lit("[]"), AROUND if around else SPAN)

    def places(n: str) -> Column:
        size = F.size(f"{n}_found")
        gaps = F.slice(f"{n}_between", 1, size)
        pairs = F.zip_with(f"{n}_found", gaps, lambda m, gap: F.struct(m.alias("m"), gap["n"].alias("gap")))
        if around:
            pairs = F.zip_with(pairs, _around(n, size, gaps, *around), lambda pair, sides: F.struct(pair["m"].alias("m"), pair["gap"].alias("gap"), sides.alias("sides")))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + F.length(x["m"])
            sides = [x["sides"]["left"].alias("left"), x["sides"]["right"].alias("right")] if around else []
            one = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("text"), *sides)
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        zero = F.lit(0).cast("bigint")
        chunks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / CHUNK).cast("int")), lambda i: F.slice(pairs, i * CHUNK + 1, F.lit(CHUNK)))
        totals = F.transform("_chunks", lambda c: F.aggregate(c, zero, lambda s, x: s + x["gap"] + F.length(x["m"])))
        begins = F.aggregate(totals, F.array(zero), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))
        each = F.zip_with("_chunks", F.slice("_begins", 1, F.size("_chunks")), lambda c, at: F.aggregate(
            c, F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"]
        ))
        return size, chunks, begins, each

    out = between
    for n in patterns:
        size, chunks, begins, each = places(n)
        none_of = F.array().cast("array<array<struct<m: string, gap: int" + (", sides: struct<left: string, right: string>" if around else "") + ">>>")
        out = out.withColumn("_chunks", F.when(size > 0, chunks).otherwise(none_of)).withColumn("_begins", begins)
        out = out.withColumn(f"{n}_at", F.when(size > 0, F.flatten(each)).otherwise(empty)).drop("_chunks", "_begins")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"{n}_at").alias(n) for n in patterns])


def _around(n: str, size: Column, gaps: Column, left: int, right: int) -> Column:
    """The sides of every match, from its neighbours alone, so that no text is walked through for each match."""
    blank, others = F.array(F.lit("")), F.greatest(size - 1, F.lit(0))
    last = F.concat(blank, F.slice(f"{n}_found", 1, others))
    before_last = F.concat(blank, F.transform(F.slice(gaps, 1, others), lambda g: g["tail"]))
    following = F.concat(F.slice(f"{n}_found", 2, others), blank)
    lefts = F.zip_with(F.zip_with(before_last, last, lambda a, b: F.concat(a, b)), gaps, lambda a, g: F.lower(F.substring(F.concat(a, g["tail"]), -left, left)))
    rights = F.zip_with(F.slice(f"{n}_between", 2, size), following, lambda g, m: F.lower(F.substring(F.concat(g["head"], m), 1, right)))
    return F.zip_with(lefts, rights, lambda a, b: F.struct(a.alias("left"), b.alias("right")))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, _digit(back, i)).otherwise(2 * _digit(back, i) - F.when(_digit(back, i) > 4, 9).otherwise(0)),
    )
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(False)


def _digit(s: Column, i: Column) -> Column:
    return F.ascii(F.substring(s, i, F.lit(1))) - 48


def before(text: Column, start: Column, n: int) -> Column:
    """The n code points before a place, in lower case."""
    first = F.greatest(start - n, F.lit(0))
    return F.lower(F.substring(text, (first + 1).cast("int"), (start - first).cast("int")))


def after(text: Column, end: Column, n: int) -> Column:
    return F.lower(F.substring(text, (end + 1).cast("int"), F.lit(n)))
