"""Mixing sources to target weights by temperature, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import word_array
from .store import materialise

TARGET_ENTROPY = 0.97  # share of the entropy of even weights
REPEAT_LIMIT = 4.0  # times a source may be used on average
BLOCK_TOKENS = 1 << 20
GRID = 64
ROUNDS = 5


def token_counts(docs: DataFrame, text: str, doc: str, source: str) -> DataFrame:
    """Source as text (NULL: a source of its own) and number of words of every row."""
    return docs.select(
        F.col(doc).alias("_mix_doc"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_mix_text"),
        F.size(word_array(F.col(text))).cast("bigint").alias("_mix_tokens"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~")).alias("_mix_source"),
    )


def _at(totals: DataFrame, low: float, high: float) -> list[tuple[float, float, float]]:
    """Entropy share and largest repetition at exponents from ``low`` to ``high``, in one pass over the sources.

    With n sources of shares p, weights are p^a / sum p^a. The smallest budget that
    uses every token of every source at least once repeats a source of share p by
    p^(a-1) relative to the largest value that any source needs.
    """
    step = (high - low) / GRID
    grid = totals.select("share", F.explode(F.sequence(F.lit(0), F.lit(GRID))).alias("i")).select(
        "i", "share", (F.lit(low) + F.col("i") * F.lit(step)).alias("a")
    )
    power = F.pow(F.col("share"), F.col("a"))
    need = F.pow(F.col("share"), F.col("a") - 1)
    sums = grid.groupBy("i").agg(
        F.min("a").alias("a"), F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("zl"),
        F.count(F.lit(1)).alias("n"), F.max(need).alias("most"), F.min(need).alias("least"),
    )
    entropy = F.when(F.col("n") > 1, (F.log("z") - F.col("zl") / F.col("z")) / F.log("n")).otherwise(1.0)
    rows = sums.select("i", "a", entropy.alias("h"), (F.col("most") / F.col("least")).alias("rep")).collect()
    return [(r["a"], r["h"], r["rep"]) for r in sorted(rows)]


def exponent(totals: DataFrame, target_entropy: float | None, repeat_limit: float | None) -> float:
    """The largest exponent in 0..1 whose weights reach the target entropy, raised as far as the repetition limit asks.

    Entropy falls and repetition falls as the exponent grows, so each search halves in
    on one crossing: every pass cuts the interval to a part of ``GRID``. A pass sends
    ``GRID`` + 1 rows to the driver, however many sources there are.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        rows = _at(totals, low, high)
        if not rows:
            return 1.0
        ok = [a for a, h, rep in rows if (target_entropy is None or h >= target_entropy)]
        low_h = max(ok, default=rows[0][0])
        fits = [a for a, h, rep in rows if repeat_limit is None or rep <= repeat_limit]
        low_r = min(fits, default=rows[-1][0])
        chosen = max(low_h, low_r)
        step = (high - low) / GRID
        if step < 1e-9:
            break
        if low_r > low_h:
            low, high = max(0.0, chosen - step), chosen
        else:
            low, high = chosen, min(1.0, chosen + step)
        if low == high:
            break
    return chosen


def weights(counts: DataFrame, target_entropy: float | None, repeat_limit: float | None) -> DataFrame:
    """One row per source: ``tokens``, ``share`` and ``weight``. Sources without tokens have share and weight 0."""
    totals = materialise(counts.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")))
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.select(
        "_mix_source", "tokens", "n_docs", (F.col("tokens") / F.lit(float(max(everything, 1)))).alias("share")
    )
    a = exponent(shares.where("share > 0"), target_entropy, repeat_limit)
    raw = shares.withColumn("raw", F.when(F.col("share") > 0, F.pow("share", F.lit(a))).otherwise(0.0))
    z, most = raw.agg(F.sum("raw"), F.max(F.when(F.col("raw") > 0, F.col("tokens") / F.col("raw")))).first()
    return raw.select(
        "_mix_source", "tokens", "n_docs", "share", (F.col("raw") / F.lit(z or 1.0)).alias("weight"),
        # smallest budget that uses each source whole at least once
        F.lit((most or 0.0) * (z or 1.0)).alias("whole_budget"), F.lit(a).alias("exponent"),
    )


def _order(seed: int, *cols: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("~")) for c in cols]))


def mix(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source",
    target_entropy: float | None = TARGET_ENTROPY, repeat_limit: float | None = REPEAT_LIMIT,
    budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: its id and source, ``n_tokens``, ``weight``, ``copies``, ``block`` and ``place``.

    A source's quota is its weight times the budget (tokens; without one, the smallest
    budget that uses every source whole at least once). Each source is dealt into
    blocks of about ``block_tokens`` tokens by digest of the row id; blocks, and rows
    inside a block, are permuted by digest. The quota is taken as full passes over all
    blocks and one partial pass that stops inside a block, so ``copies`` differ by at
    most one inside a source. ``block`` is the rank of the block in its source and
    ``place`` the rank of the row in its block. A source without tokens, with empty and
    NULL texts only, has weight 0 and one copy of each row; in other sources rows
    without tokens follow their place. NULL sources form a source of their own. Rows
    that share an id and a source stand in one block in the order of their text's digest;
    rows without id go by that digest. An empty table stays empty, other columns are not read.
    """
    light = materialise(token_counts(docs, text, doc, source))
    per_source = materialise(weights(light, target_entropy, repeat_limit))
    total = F.col("whole_budget") if budget is None else F.lit(float(budget))
    plan = per_source.select(
        "_mix_source", "weight", "tokens", (F.col("weight") * total).alias("quota"),
        F.greatest(F.lit(1), F.ceil(F.greatest(F.col("tokens") / F.lit(float(block_tokens)), F.col("n_docs") / F.lit(4096.0)))).cast("bigint").alias("n_blocks"),
    ).select(
        "*", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens") + F.lit(1e-9))).otherwise(1).cast("bigint").alias("passes")
    ).select(
        "*", F.when(F.col("tokens") > 0, F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("tokens"))).otherwise(0.0).alias("rest")
    )
    # a row has the same block wherever it stands: conv() of 13 hex digits stays below 2^52
    key = F.coalesce(F.col("_mix_doc").cast("string"), F.col("_mix_text"))
    cell = F.conv(F.substring(_order(seed, key), 1, 13), 16, 10).cast("bigint")
    dealt = light.join(plan, "_mix_source").withColumn("_mix_cell", F.pmod(cell, F.col("n_blocks")))
    dealt = materialise(dealt.select("_mix_doc", "_mix_source", "_mix_tokens", "_mix_text", "_mix_cell", "weight", "passes", "rest"))
    blocks = dealt.groupBy("_mix_source", "_mix_cell").agg(F.sum("_mix_tokens").alias("in_block"))
    by_source = Window.partitionBy("_mix_source").orderBy(_order(seed, "_mix_source", F.col("_mix_cell").cast("string")), "_mix_cell")
    blocks = blocks.select(
        "_mix_source", "_mix_cell", F.row_number().over(by_source).cast("bigint").alias("block"),
        (F.sum("in_block").over(by_source) - F.col("in_block")).alias("before"),
    )
    rows = dealt.join(blocks, ["_mix_source", "_mix_cell"])
    in_block = Window.partitionBy("_mix_source", "_mix_cell").orderBy(
        _order(seed + 1, key), "_mix_doc", "_mix_text"
    )
    rows = rows.select(
        "_mix_doc", "_mix_source", "_mix_tokens", "weight", "passes", "rest", "block", "before",
        F.row_number().over(in_block).cast("bigint").alias("place"),
        (F.sum("_mix_tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_mix_tokens")).alias("inside"),
    ).select(
        "_mix_doc", "_mix_source", "_mix_tokens", "weight", "block", "place",
        (F.col("passes") + F.when(F.col("before") + F.col("inside") < F.col("rest"), 1).otherwise(0)).cast("bigint").alias("copies"),
    )
    return rows.select(
        F.col("_mix_doc").alias(doc), F.when(F.col("_mix_source") != "~", F.substring("_mix_source", 2, 1 << 30)).alias(source),
        F.col("_mix_tokens").alias("n_tokens"), "weight", "copies", "block", "place",
    )
