"""License notices in documents, with DataFrame functions only.

A template's notice is looked for in overlapping windows of words.  A window has at
least twice as many words as the template and at most four times, and windows start
at every half of their size, so a notice lies whole in one of them.  Signatures of
one row a band retrieve templates: a window that holds enough of a template agrees
with it in each of 128 bands with a chance of 1 in 8 or more, so that one in 20
million is missed at most.  Matches are then verified exactly, by the share of the
template's shingles that the window holds.

Before windows are cut, documents are left out that hold no shingle of any template,
in which nothing can be found.  Most of those are seen from their words already: they
lack every anchor, and anchors are words such that each shingle of each template holds
one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.llm.common import stored

# Notices as licenses and their authors word them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"
    ),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "Apache-2.0-notice": (
        'you may not use this file except in compliance with the License. You may obtain a copy '
        "of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License"
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work"
    ),
    "GPL-2.0-or-later": "version 2 of the License, or (at your option) any later version",
    "GPL-3.0-or-later": "version 3 of the License, or (at your option) any later version",
    "LGPL": (
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation"
    ),
    "AGPL": (
        "under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT."
    ),
    "BSD-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
}
WIDTH, PERCENT, BANDS = 5, 80, 128
#: Templates and their words are broadcast; more are an error.
MOST_WORDS = 50_000
_SEPARATOR = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of letters, combining marks and digits of any script."""
    return F.filter(F.split(F.lower(text), _SEPARATOR), lambda w: w != "")


def _template_words(notice: str) -> list[str]:
    """The same words; Python's ``re`` has no classes of Unicode categories."""
    return "".join(
        c if unicodedata.category(c)[0] in "LMN" else " " for c in notice.lower()
    ).split()


def anchors(notices: Mapping[str, str], width: int = WIDTH) -> list[str]:
    """Few words of which each shingle of each template holds one, rare ones first.

    A word counts as rare when it is long; it is taken for the shingles it is in.
    """
    shingles = set()
    for notice in notices.values():
        words = _template_words(notice)
        shingles |= {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    chosen = []
    while shingles:
        gain: dict[str, int] = {}
        for shingle in shingles:
            for word in set(shingle):
                gain[word] = gain.get(word, 0) + 1
        best = max(gain, key=lambda w: (len(w) > 3, gain[w] * len(w) ** 2, w))
        chosen.append(best)
        shingles = {s for s in shingles if best not in s}
    return sorted(chosen)


def shingles_of(words: Column, width: int = WIDTH) -> Column:
    """Distinct 64-bit hashes of the word shingles of an array of at least one shingle."""
    return F.array_distinct(hashed_shingles(words, width))


def hashed_shingles(words: Column, width: int = WIDTH) -> Column:
    """The hash of every word shingle of an array, in order."""
    starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
    hashed = F.transform(
        starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, width)))
    )
    return F.when(F.size(words) >= width, hashed).otherwise(F.array().cast("array<bigint>"))


def _bands(shingles: Column, bands: int) -> Column:
    """The least value of each band's order over the shingles."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(band))))

    return F.array(*map(least, range(bands)))


def window_words(template_words: int) -> int:
    """Words of the windows for a template: few sizes, and close ones for short templates."""
    if template_words < 16:
        return -(-2 * template_words // 4) * 4
    size = 32
    while size < 2 * template_words:
        size *= 2
    return size


def _classes(notices: Mapping[str, str]) -> dict[str, int]:
    return {name: window_words(len(_template_words(n))) for name, n in notices.items()}


def templates(spark: SparkSession, notices: Mapping[str, str], bands: int = BANDS) -> DataFrame:
    """license, window (its size), shingles, bands: one row a template."""
    for name, notice in notices.items():
        if len(_template_words(notice)) < WIDTH:
            raise ValueError(f"{name} has fewer than {WIDTH} words")
    if sum(len(_template_words(n)) for n in notices.values()) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words of templates")
    sizes = _classes(notices)
    kind = T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("window", T.IntegerType()),
            T.StructField("notice", T.StringType()),
        ]
    )
    rows = spark.createDataFrame([(k, sizes[k], n) for k, n in notices.items()], kind)
    shingled = rows.select(
        "license", "window", shingles_of(words_of(F.col("notice"))).alias("wanted")
    )
    return shingled.withColumn("bands", _bands(F.col("wanted"), bands))


def scan(
    documents: DataFrame,
    *,
    notices: Mapping[str, str] = NOTICES,
    percent: int = PERCENT,
    bands: int = BANDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document and license found: doc_id, license, first_word, n_words, n_windows,
    matched, wanted.

    ``matched`` of the ``wanted`` distinct shingles of the template are in the best
    window, the first one of equals, which has ``n_words`` words from
    ``first_word`` on (from 0); ``n_windows`` windows hold ``percent`` of 100 or more.

    Words are runs of letters, combining marks and digits, lower-cased; spaces, quotes,
    dashes and bullets beyond ASCII part them like others.  A document without a match,
    null and empty texts included, gives no row; rows with equal ids, whether their texts
    are equal or not, are reported as one document, and each counts its own windows;
    among best windows with one first word the one of more words is reported; null ids are
    one id; an empty table gives an empty result; other columns are not looked
    at.
    """
    spark = documents.sparkSession
    known = templates(spark, notices, bands)
    sizes = sorted(set(_classes(notices).values()))
    needed = F.array(*[F.lit(w) for w in anchors(notices)])
    # Templates are bounded, and so are their shingles.
    wanted = F.lit(sorted({x for r in known.select("wanted").collect() for x in r[0]}))
    # The generator keeps Spark from cutting a text anew wherever its words are used.
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.explode(F.array(words_of(F.col(text_column).cast("string")))).alias("words"),
    )
    holding = texts.where(F.arrays_overlap("words", needed)).where(
        F.arrays_overlap(hashed_shingles(F.col("words")), wanted)
    )

    def cut(size: int) -> Column:
        last = F.greatest(F.size("words") - F.lit(1), F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last, F.lit(size // 2)),
            lambda at: F.struct(
                at.alias("first_word"),
                F.lit(size).alias("window"),
                F.slice(F.col("words"), at + 1, size).alias("part"),
            ),
        )

    windows = holding.select("doc_id", F.explode(F.flatten(F.array(*map(cut, sizes)))).alias("w"))
    windows = windows.select("doc_id", "w.*").where(F.arrays_overlap("part", needed))
    signed = windows.select(
        "doc_id",
        "first_word",
        "window",
        F.size("part").alias("n_words"),
        F.explode(F.array(shingles_of(F.col("part")))).alias("shingles"),
    ).where(F.arrays_overlap("shingles", wanted))
    # Made once for all bands, like the words above.
    signatures = signed.withColumn("bands", F.explode(F.array(_bands(F.col("shingles"), bands))))
    posted = signatures.select("*", F.posexplode("bands").alias("band", "value"))
    # Templates are of bounded size, one row a band.
    posts = F.broadcast(
        known.select(
            "license",
            "wanted",
            F.col("window").alias("class"),
            F.col("bands").alias("own"),
            F.posexplode("bands").alias("own_band", "own_value"),
        )
    )
    met = posted.join(
        posts,
        (F.col("window") == F.col("class"))
        & (F.col("band") == F.col("own_band"))
        & (F.col("value") == F.col("own_value")),
    )
    # A window meets a template once, at the first of the bands in which they agree.
    agree = F.zip_with("bands", "own", lambda ours, theirs: ours == theirs)
    verified = (
        met.where(F.array_position(agree, True) == F.col("band") + 1)
        .select(
            "doc_id",
            "license",
            "first_word",
            "n_words",
            F.size(F.array_intersect("wanted", "shingles")).alias("matched"),
            F.size("wanted").alias("wanted"),
        )
        .where(100 * F.col("matched") >= percent * F.col("wanted"))
    )
    best = F.max(F.struct("matched", -F.col("first_word"), "n_words")).alias("best")
    return (
        verified.groupBy("doc_id", "license", "wanted")
        .agg(best, F.count("*").alias("n_windows"))
        .select(
            "doc_id",
            "license",
            (-F.col("best.col2")).cast("int").alias("first_word"),
            F.col("best.n_words").alias("n_words"),
            "n_windows",
            F.col("best.matched").alias("matched"),
            "wanted",
        )
    )
