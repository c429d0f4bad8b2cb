"""Secret scans: known patterns, and entropy of sliding windows, in column expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# cheap tests, true wherever a pattern above can yield a span
MAY_ASSIGN = r"(?i)passw|secret|token|api_?key"
MAY_ACCESS = r"AKIA[A-Z0-9]{12}"
MAY_HEX = r"[0-9a-f]{32}"
# the same runs without the short ones: a shorter run can't hold a longer one
LONG_ACCESS = r"AKIA[A-Z0-9]{12,}"
LONG_HEX = r"[0-9a-f]{32,}"


@dataclass(frozen=True)
class CharClass:
    """Candidate strings of one character class, and the bits a window of them needs."""

    kind: str
    pattern: str
    may: str
    least_bits: float


WINDOW = 20
CLASSES = (
    CharClass("entropy-hex", r"[0-9A-Fa-f]{20,}", r"[0-9A-Fa-f]{20}", 3.1),
    CharClass("entropy-base64", r"[A-Za-z0-9+/_-]{20,}={0,2}", r"[A-Za-z0-9+/_-]{20}", 3.9),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
# candidates that hold one of these are placeholders, samples or addresses, not secrets
ALLOW_LIST = (
    "example", "EXAMPLE", "placeholder", "changeme", "your", "xxxx", "XXXX", "0000000", "1234567", "abcdefg",
    "ABCDEFG", "://", "www", "lorem",
)

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint,value:string>"


def places(text: Column, pattern: str, kind: str) -> Column:
    """All leftmost non-overlapping matches as spans of code points.

    The pieces between matches come from a split by the same pattern, so running
    sums of piece and match lengths give the starts.
    """
    rank = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("p"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(
            begin.cast("bigint").alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            end.cast("bigint").alias("end"), x["m"].alias("value"),
        )
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(both, start, step, lambda s: s["spans"])


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def bits(n: int, window: int) -> float:
    """Part n * log2(n) of the entropy of a window."""
    return n * math.log2(n) if n else 0.0


def max_entropy(value: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits per character, of any window of ``window`` characters (or of a shorter whole).

    Counts per character are kept from step to step: one goes up for the character
    that enters, one down for the one that leaves, and the sum of n*log2(n) follows.
    """
    table = F.array(*[F.lit(bits(n, window)) for n in range(window + 2)])
    chars = F.split(value, "")
    size = F.least(F.length(value), F.lit(window)).cast("double")
    start = F.struct(
        F.lit(0).alias("i"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")).alias("n"),
        F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"),
    )

    def put(counts: Column, char: Column, by: int) -> Column:
        old = F.coalesce(F.try_element_at(counts, char), F.lit(0))
        kept = F.map_filter(counts, lambda k, v: k != char)
        return F.map_concat(kept, F.map_from_arrays(F.array(char), F.array(old + F.lit(by))))

    def change(counts: Column, char: Column, by: int) -> Column:
        old = F.coalesce(F.try_element_at(counts, char), F.lit(0))
        return F.get(table, old + F.lit(by)) - F.get(table, old)

    def enter(s: Column, c: Column) -> Column:
        return F.struct((s["i"] + 1).alias("i"), put(s["n"], c, 1).alias("n"), (s["sum"] + change(s["n"], c, 1)).alias("sum"), s["best"].alias("best"))

    def leave(s: Column) -> Column:
        gone = F.get(chars, s["i"] - F.lit(window + 1))
        return F.when(
            s["i"] > window,
            F.struct(s["i"].alias("i"), put(s["n"], gone, -1).alias("n"), (s["sum"] + change(s["n"], gone, -1)).alias("sum"), s["best"].alias("best")),
        ).otherwise(s)

    def measure(s: Column) -> Column:
        now = F.log2(size) - s["sum"] / size
        return F.struct(
            s["i"].alias("i"), s["n"].alias("n"), s["sum"].alias("sum"),
            F.when(s["i"] >= size, F.greatest(s["best"], now)).otherwise(s["best"]).alias("best"),
        )

    def once(value: Column, fn) -> Column:
        """Evaluate ``value`` one time, for a function that reads it often."""
        return F.get(F.transform(F.array(value), fn), F.lit(0))

    return F.aggregate(
        chars, start, lambda s, c: once(once(enter(s, c), leave), measure), lambda s: F.greatest(s["best"], F.lit(0.0))
    )


def entropy_places(text: Column, c: CharClass, allow: Sequence[str], window: int) -> Column:
    """Candidates of a class that hold a digit and reach its entropy in a window, without allow-listed ones."""
    listed = [F.lit(a) for a in allow]

    def plain(span: Column) -> Column:
        ok = span["value"].rlike("[0-9]")
        for a in listed:
            ok = ok & ~F.contains(span["value"], a)
        return ok

    return F.filter(F.filter(places(text, c.pattern, c.kind), plain), lambda s: max_entropy(s["value"], window) >= c.least_bits)


def scan(
    docs: DataFrame, text: str = "text", classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW_LIST,
    window: int = WINDOW,
) -> DataFrame:
    """Add ``secrets``: spans (start, rank, kind, end, value) by start, then kind, in code points, end exclusive.

    Known patterns (assignments with a value of 8 characters, access keys, long hex
    runs) always stay. Candidates by entropy are added where they overlap none of
    those and none of an earlier class. NULL and empty texts have no spans. Repeated
    rows are scanned alike, an empty table stays empty, and an input column named
    ``secrets`` is replaced. Rows never move between tasks.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("secrets", "_sec_text", "_sec_spans")]
    body = F.col("_sec_text")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_sec_text"))
    assign = F.filter(
        places(body, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 8
    )
    base = F.concat(
        F.when(body.rlike(MAY_ASSIGN), assign).otherwise(none()),
        F.when(body.rlike(MAY_ACCESS), places(body, LONG_ACCESS, "access")).otherwise(none()),
        F.when(body.rlike(MAY_HEX), places(body, LONG_HEX, "hex")).otherwise(none()),
    )
    rows = rows.select(*keep, "_sec_text", base.alias("_sec_spans"))
    for c in classes:
        spans = F.col("_sec_spans")
        more = F.filter(
            entropy_places(body, c, allow, window),
            lambda s: ~F.exists(spans, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])),
        )
        rows = rows.select(
            *keep, "_sec_text", F.when(body.rlike(c.may), F.concat(spans, more)).otherwise(spans).alias("_sec_spans")
        )
    return rows.select(*keep, F.array_sort("_sec_spans").alias("secrets"))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def is_base(span: Column) -> Column:
    return span["rank"] < 3
