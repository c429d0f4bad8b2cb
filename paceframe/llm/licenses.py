"""Licence scans: a positional index of rare licence words, all in column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import word_array


@dataclass(frozen=True)
class Template:
    """Words of a notice, the phrase that has to stand in it word by word, and its label."""

    label: str
    words: tuple[str, ...]
    phrase: tuple[str, ...]
    base: bool = False


def template(label: str, notice: str, phrase: str, base: bool = False) -> Template:
    return Template(label, tuple(notice.split()), tuple(phrase.split()), base)


BASE = (
    template("mit", "under the mit license", "under the mit license", True),
    template("apache-2", "apache license version 2", "apache license version 2", True),
    template("cc-by-nc", "cc by nc", "cc by nc", True),
)
# short public notices in lower-case words
NOTICES = (
    template("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("gpl-3", "either version 3 of the license or at your option any later version", "version 3 of the license or at your option"),
    template("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    template("gpl-2", "either version 2 of the license or at your option any later version", "version 2 of the license or at your option"),
    template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    template("agpl-3", "under the terms of the gnu affero general public license version 3", "gnu affero general public license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person obtaining a copy"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "distribute this software for any purpose with or without fee"),
    template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    template("cc0", "this work is dedicated to the public domain under cc0", "cc0"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)

#: Rarest words of a phrase that make index entries. A text that holds the phrase holds each of them.
RARE = 2
#: Share of the IDF weight of a notice that must stand at its places besides the phrase.
LEAST = 0.4


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def document_frequencies(docs: DataFrame, text: str, templates: Sequence[Template]) -> tuple[dict[str, int], int]:
    """Number of documents that hold each licence word, and of all documents, over every whole text.

    At most one row per licence word reaches the driver.
    """
    known = F.array(*[F.lit(w) for w in vocabulary(templates)])
    total = F.lit("\x00all")
    counts = (
        docs.select(F.explode(F.concat(F.array_intersect(word_array(F.col(text)), known), F.array(total))).alias("w"))
        .groupBy("w").count().collect()
    )
    found = {r["w"]: r["count"] for r in counts}
    n = found.pop("\x00all", 0)
    return found, n


def idf(df: dict[str, int], n: int, templates: Sequence[Template]) -> dict[str, float]:
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1.0 for w in vocabulary(templates)}


def _offset(t: Template) -> int:
    n = len(t.phrase)
    return next(i for i in range(len(t.words) - n + 1) if t.words[i:i + n] == t.phrase)


def phrase_starts(words: Column, hits: Column, phrase: tuple[str, ...], weight: dict[str, float]) -> Column:
    """Starts of a phrase: positions of its rarest words less their offsets, intersected, then verified word by word."""
    order = sorted(range(len(phrase)), key=lambda i: (-weight[phrase[i]], i))[:RARE]

    def starts(offset: int) -> Column:
        at = F.filter(hits, lambda h: (h["w"] == phrase[offset]) & (h["i"] >= offset))
        return F.transform(at, lambda h: h["i"] - F.lit(offset))

    found = starts(order[0])
    for o in order[1:]:
        found = F.array_intersect(found, starts(o))
    whole = F.array(*[F.lit(w) for w in phrase])
    return F.filter(found, lambda s: F.slice(words, s + F.lit(1), F.lit(len(phrase))) == whole)


def agreement(words: Column, start: Column, t: Template, weight: dict[str, float]) -> Column:
    """Share of the notice's IDF weight whose words stand at their places around the phrase at ``start``."""
    shift = _offset(t)
    total = sum(weight[w] for w in t.words)
    parts = [
        F.when(
            (start + F.lit(k - shift) >= 0) & (F.get(words, start + F.lit(k - shift)) == w), F.lit(weight[w] / total)
        ).otherwise(F.lit(0.0))
        for k, w in enumerate(t.words)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def scan(
    docs: DataFrame, text: str = "text", base: Sequence[Template] = BASE, notices: Sequence[Template] = NOTICES,
    least: float = LEAST,
) -> DataFrame:
    """Add ``n_words``, ``base_places`` (start, label), ``base_labels``, ``labels`` and ``score`` to every row.

    The index holds, for each phrase, its words of highest IDF in this corpus with
    their offsets. A text's index words give candidate starts, starts on which they
    agree are verified against the whole phrase, and a notice counts when words of
    at least ``least`` of its weight stand around the phrase. ``score`` is the best
    agreement of a label found, 1 for a base phrase, 0 without label. Empty and NULL
    texts have no words and no label. Repeated rows are scanned alike, an empty table
    stays empty, and input columns with the names of added ones are replaced.
    """
    templates = [*base, *notices]
    df, n = document_frequencies(docs, text, templates)
    weight = idf(df, n, templates)
    index = sorted({
        t.phrase[i] for t in templates for i in sorted(range(len(t.phrase)), key=lambda i: (-weight[t.phrase[i]], i))[:RARE]
    })
    added = ("n_words", "base_places", "base_labels", "labels", "score")
    keep = [c for c in docs.columns if c not in added and not c.startswith("_lic_")]
    same = [F.col(f"`{c}`") for c in keep]
    known = F.array(*[F.lit(w) for w in index])
    words = F.col("_lic_words")
    none = F.array().cast("array<struct<w:string,i:int>>")
    rows = docs.select(*same, word_array(F.col(text)).alias("_lic_words"))
    rows = rows.select(*same, "_lic_words", F.arrays_overlap(words, known).alias("_lic_any"))
    rows = rows.select(
        *same, "_lic_words", "_lic_any",
        F.when(F.col("_lic_any"), F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(known, h["w"])
        )).otherwise(none).alias("_lic_hits"),
    )
    hits = F.col("_lic_hits")

    def found(t: Template) -> Column:
        if t.base:
            return F.transform(
                phrase_starts(words, hits, t.phrase, weight),
                lambda s: F.struct(s.cast("bigint").alias("start"), F.lit(t.label).alias("label"), F.lit(1.0).alias("score"), F.lit(True).alias("base")),
            )
        return F.filter(
            F.transform(
                phrase_starts(words, hits, t.phrase, weight),
                lambda s: F.struct(s.cast("bigint").alias("start"), F.lit(t.label).alias("label"), agreement(words, s, t, weight).alias("score"), F.lit(False).alias("base")),
            ),
            lambda p: p["score"] >= least,
        )

    empty = F.array().cast("array<struct<start:bigint,label:string,score:double,base:boolean>>")
    rows = rows.select(
        *same, F.size(words).cast("bigint").alias("n_words"),
        F.when(F.size(hits) > 0, F.concat(*[found(t) for t in templates])).otherwise(empty).alias("_lic_found"),
    )
    every = F.col("_lic_found")
    first = F.filter(every, lambda p: p["base"])

    def joined(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return rows.select(
        *same, "n_words",
        F.transform(first, lambda p: F.struct(p["start"].alias("start"), p["label"].alias("label"))).alias("base_places"),
        joined(first).alias("base_labels"), joined(every).alias("labels"),
        F.coalesce(F.array_max(F.transform(every, lambda p: F.least(p["score"], F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )
