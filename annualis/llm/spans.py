"""Spans of regular expressions as native columns: positions count code points, ends are exclusive."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,match:string>"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches (or a group of each)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def located(text: Column, pattern: str, matches: Column) -> Column:
    """array<SPAN> of the matches that found() gave: what lies between matches is what split() gives,
    so positions are running sums of both lengths."""
    empty = F.array().cast(f"array<{SPAN}>")
    between = F.split(text, pattern, -1)
    walk = F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(x["gap"])).alias("start"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                x["match"].alias("match")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(F.size(matches) > 0, walk).otherwise(empty)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    reversed_digits = F.transform(F.split(F.reverse(c), ""), lambda d: F.ascii(d) - 48)
    total = F.aggregate(
        F.transform(reversed_digits, lambda d, k: F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0), lambda a, d: a + F.when(d >= 0, d).otherwise(0))
    return total % 10 == 0


def spelled(spans: Column) -> Column:
    """kind:start:end of spans (struct with kind, rank, start, end) by start, then rank, joined by commas."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ranked(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end")))


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
