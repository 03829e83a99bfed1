"""License scans by a positional index of rare words, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER

#: Fixed value: what stands between words, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A label, the words of its notice and the key phrase that has to stand there in whole."""

    label: str
    key: str
    notice: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_at(self) -> int:
        key = self.key.split()
        return next(i for i in range(len(self.words)) if self.words[i : i + len(key)] == key)


# The base phrases, then key phrases and first sentences of well-known license notices.
TEMPLATES = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    Template("mit-text", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("gpl-text", "terms of the gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "lesser general public license", "gnu lesser general public license"),
    Template("agpl", "affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license"),
    Template("epl", "eclipse public license", "made available under the terms of the eclipse public license"),
    Template("boost", "boost software license", "distributed under the boost software license version 1 0"),
    Template("cc-by", "creative commons attribution", "licensed under a creative commons attribution license"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0 universal public domain dedication"),
    Template("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    Template("zlib", "without any express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    Template("artistic", "artistic license", "licensed under the terms of the artistic license 2 0"),
    Template("cddl", "common development and distribution license", "subject to the terms of the common development and distribution license"),
    Template("eupl", "european union public licence", "licensed under the european union public licence"),
    Template("ofl", "sil open font license", "this font software is licensed under the sil open font license version 1 1"),
    Template("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    Template("python", "python software foundation license", "python software foundation license version 2"),
    Template("postgresql", "permission to use copy modify and distribute this software and its documentation", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
)


def index_of(templates: tuple[Template, ...], weight: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """The rare-token index: of each template's key phrase the word of the highest weight, with (template, place in the
    key phrase)."""
    out: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(templates):
        place, word = max(enumerate(t.key.split()), key=lambda p: (weight[p[1]], -p[0]))
        out.setdefault(word, []).append((k, place))
    return out


def scan(df: DataFrame, templates: tuple[Template, ...] = TEMPLATES, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are what remains between BETWEEN in the text, whose letters A-Z are lower-cased (null text: none), counted from
    0. A first pass counts in how many rows each template word stands, which gives its weight; the counts, one a template
    word, go to the driver. The index then holds each template's key phrase by its rarest word. A second pass looks the
    words of each row up there: a posting moved by its place in the phrase is a possible start, which stays where the
    whole key phrase stands. The score of a start is the share, by weight, of the notice's words that stand at the right
    distance from it; a label needs least at one of its starts. Base templates are their own key phrase. score is the
    best share, 0 without a label.

    Every row gives one row, repeated ones too; rows with empty or null text have 0 words, null positions, empty labels
    and score 0; other columns are left out; an empty table gives no rows. Memory is bounded by a row's own words; nothing
    is shuffled but the counts.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    # Only the first and the last part can be empty.
    words = df.select(F.col(id_col).alias("doc_id"), F.array_remove(F.split(low, BETWEEN), "").alias("words"))
    counted = words.select(F.explode(F.array_append(F.array_intersect("words", F.array(*map(F.lit, vocabulary))), "")).alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in counted}  # a row for each template word at most, and one for all rows
    n = counts.pop("", 0)
    weight = {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary}
    index = index_of(templates, weight)

    def table(rows: list[list[Column]]) -> Column:
        return F.array(*[F.array(*r) for r in rows])

    keys = table([[F.lit(w) for w in t.key.split()] for t in templates])
    notices = table([[F.lit(w) for w in t.words] for t in templates])
    weights = table([[F.lit(weight[w]) for w in t.words] for t in templates])
    key_at = F.array(*[F.lit(t.key_at) for t in templates])
    totals = F.array(*[F.lit(sum(weight[w] for w in t.words)) for t in templates])
    labels = F.array(*[F.lit(t.label) for t in templates])
    is_base = F.array(*[F.lit(t.base) for t in templates])
    entries = F.create_map(*[x for w, found in index.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(k).alias("k"), F.lit(o).alias("o")) for k, o in found]))])

    rare = F.filter(F.transform("words", lambda w, i: F.when(w.isin(list(index)), F.struct(w.alias("w"), i.alias("i")))), lambda p: p.isNotNull())
    possible = F.flatten(F.transform(rare, lambda p: F.transform(F.try_element_at(entries, p["w"]), lambda t: F.struct(t["k"].alias("k"), (p["i"] - t["o"]).alias("s")))))
    found = words.select("doc_id", "words", possible.alias("possible"))

    def stands(c: Column) -> Column:
        key = F.get(keys, c["k"])
        return (c["s"] >= 0) & (F.slice("words", F.greatest(c["s"], F.lit(0)) + 1, F.size(key)) == key)

    def share(c: Column) -> Column:
        notice, by, first = F.get(notices, c["k"]), F.get(weights, c["k"]), c["s"] - F.get(key_at, c["k"])
        here = F.transform(notice, lambda w, j: F.when(F.coalesce(F.get("words", first + j) == w, F.lit(False)), F.get(by, j)).otherwise(0.0))
        return F.least(F.lit(1.0), F.round(F.aggregate(here, F.lit(0.0), lambda a, x: a + x) / F.get(totals, c["k"]), 6))

    placed = found.select("doc_id", "words", F.filter("possible", stands).alias("starts"))
    scored = placed.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.transform("starts", lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), share(c).alias("share"))).alias("starts"))
    base = F.transform(F.filter("starts", lambda c: F.get(is_base, c["k"])), lambda c: c["s"])
    sure = F.filter("starts", lambda c: c["share"] >= least)

    def named(starts: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(starts, lambda c: F.get(labels, c["k"])))))

    return scored.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(base).cast("bigint").alias("first_word"), F.array_max(base).cast("bigint").alias("last_word"),
        named(F.filter("starts", lambda c: F.get(is_base, c["k"]))).alias("base_labels"), named(sure).alias("labels"),
        F.coalesce(F.array_max(F.transform(sure, lambda c: c["share"])), F.lit(0.0)).alias("score"),
    )
