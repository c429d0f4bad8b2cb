"""Line dedup by the spread of a line over distinct sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise

MIN_SITES = 5
MIN_CHARS = 20
LG_K = 10
#: Relative band around the threshold, in standard errors of the sketch, that is counted exactly.
SIGMAS = 4.0


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """128 bits of a trimmed line."""
    body = F.trim(line)
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("line"), body).alias("b"))


def counted(line: Column, min_chars: int) -> Column:
    return F.length(F.trim(line)) >= min_chars


def spread_lines(
    docs: DataFrame, text: str, doc: str, site: str, min_sites: int, min_chars: int, lg_k: int = LG_K, sigmas: float = SIGMAS
) -> DataFrame:
    """Keys (a, b) of lines on at least ``min_sites`` sites, and the smallest document id that holds each.

    A sketch of sites per line is built in every task and merged in the shuffle, so
    a line that stands everywhere moves one sketch per task. Lines whose estimate is
    near the threshold are counted exactly, as pairs of line and site.
    """
    lines = docs.select(
        F.col(doc).alias("_doc"), F.xxhash64(F.col(site)).alias("_site"), F.col(site).isNotNull().alias("_known"),
        F.explode(F.filter(line_array(F.col(text)), lambda x: counted(x, min_chars))).alias("_line"),
    ).select("_doc", "_site", "_known", line_key(F.col("_line")).alias("_key")).select("_doc", "_site", "_known", "_key.a", "_key.b")
    lines = lines.where("_known")
    # most lines stand once: without a second site they need no sketch
    pairs = lines.groupBy("a", "b").agg(
        F.min("_doc").alias("first_doc"), F.min("_site").alias("lo"), F.max("_site").alias("hi"),
        F.count(F.lit(1)).alias("n"),
    ).where("lo < hi" if min_sites > 1 else "true").where(F.col("n") >= min_sites)
    often = materialise(pairs.select("a", "b", "first_doc"))
    held = materialise(lines.join(often, ["a", "b"], "left_semi").select("a", "b", "_site"))
    sketches = held.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", lg_k)).alias("sites"))
    error = sigmas * 1.04 / math.sqrt(2 ** lg_k)
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    near = sketches.where((F.col("sites") >= low) & (F.col("sites") <= high)).select("a", "b")
    exact = (
        held.join(near, ["a", "b"], "left_semi").distinct().groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    )
    chosen = sketches.where(F.col("sites") > high).select("a", "b").unionByName(exact.select("a", "b"))
    return materialise(often.join(chosen, ["a", "b"], "left_semi"))


def dedup(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", site: str = "source", min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS, keep_first: bool = True, lg_k: int = LG_K,
) -> DataFrame:
    """Add ``n_lines``, ``n_removed`` and ``kept_text``; rows are as in ``docs``.

    Lines are compared trimmed and count from ``min_chars`` characters. A line on at
    least ``min_sites`` distinct sites is removed from every document, but stays, where
    ``keep_first`` holds, in the document with the smallest id. A line repeated inside
    one document counts as one site. NULL texts are empty and have one empty line.
    Rows without site spread nothing, but spread lines leave them too; a NULL id is
    never the smallest. Repeated rows are treated alike, an empty table stays empty,
    input columns with the names of added ones are replaced, and all others stay.
    """
    added = ("n_lines", "n_removed", "kept_text")
    keep = [c for c in docs.columns if c not in added]
    same = [F.col(f"row.`{c}`") for c in keep]
    # rows without an id are told apart by their text, so no two texts share one set of marks
    part = F.when(F.col(doc).isNull(), F.xxhash64(F.col(text))).otherwise(F.lit(0))
    spread = spread_lines(docs, text, doc, site, min_sites, min_chars, lg_k)
    hits = (
        docs.select(F.col(doc).alias("_ln_doc"), part.alias("_ln_part"), F.explode(F.array_distinct(F.transform(
            F.filter(line_array(F.col(text)), lambda x: counted(x, min_chars)), line_key))).alias("k"))
        .select("_ln_doc", "_ln_part", "k.a", "k.b").join(spread, ["a", "b"])
    )
    if keep_first:
        hits = hits.where(~F.col("_ln_doc").eqNullSafe(F.col("first_doc")))
    # a document's spread lines: never more than it has lines
    marks = hits.groupBy("_ln_doc", "_ln_part").agg(F.collect_set(F.struct("a", "b")).alias("_ln_bad"))
    # input columns travel in one struct, whatever their names
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("_ln_text"),
        F.col(doc).alias("_ln_id"), part.alias("_ln_at"),
    )
    found = F.col("_ln_id").eqNullSafe(F.col("_ln_doc")) & (F.col("_ln_at") == F.col("_ln_part"))
    out = rows.join(marks, found, "left")
    lines = line_array(F.col("_ln_text"))
    kept = F.when(F.col("_ln_bad").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~(counted(x, min_chars) & F.array_contains(F.col("_ln_bad"), line_key(x))))
    )
    out = out.select("row", lines.alias("_ln_all"), kept.alias("_ln_kept"))
    return out.select(
        *same, F.size("_ln_all").cast("bigint").alias("n_lines"),
        (F.size("_ln_all") - F.size("_ln_kept")).cast("bigint").alias("n_removed"),
        F.array_join("_ln_kept", "\n").alias("kept_text"),
    )


def clean(docs: DataFrame, text: str = "text", length: str | None = "n_chars", **options) -> DataFrame:
    """Documents with spread lines taken out, in the columns of ``docs``; those left without text go.

    ``length`` names a column of text lengths to bring up to date, if it is there.
    """
    rows = dedup(docs, text, **options)
    rows = rows.where((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    new = {text: F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(text))}
    if length and length in docs.columns:
        kind = docs.schema[length].dataType
        new[length] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(F.col(length))
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
