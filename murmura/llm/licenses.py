"""License notices in documents, by MinHash over overlapping windows, in DataFrame functions only.

Tokens are runs of letters and digits in lower case; shingles are five tokens. Templates fall into
scales: one of s shingles belongs to the scale z = 1, 2, 4, ... with z / 2 < s <= z. At that scale, windows of
z + step shingles start every ``step`` = z / 2 (1 at least), so any passage of s shingles lies whole in one. A
window and a template it holds to 0.8 then have a Jaccard similarity of 0.26 at least; with 24 bands of one
minimum each they collide with a probability of 0.999 or more (and surely where the similarity is 1).
Pairs that collide are verified by exact containment: 80 % of the template's shingles stand in the
window. A window without any shingle of a template can share no minimum with it, so such
windows are left out before the minima are taken. Where windows of different licenses overlap, those with the larger containment
stay; of what is left each document and template reports its best window.

The templates are a parameter. They are small: their shingles go into the plan as literals up to
LITERALS of them; with more templates the windows are not thinned out before, which changes no result.

Cases: a null, empty or short text (fewer than five tokens) has no windows. Every row is
scanned on its own: rows that repeat a doc_id repeat their matches, a null doc_id is handed through. Other
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS, BANDS, LEAST = 5, 24, 0.8
LITERALS = 50_000
_SPLIT = r"[^\p{L}\p{N}]+"

# Notices of public licenses as they are commonly written.
TEMPLATES = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
     "with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _shingles(text: Column) -> tuple[Column, Column]:
    """Tokens of a text, and the hashes of its shingles out of a column ``_tokens``."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), "")
    own = F.col("_tokens")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(own) - WORDS), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WORDS)])
    )
    return tokens, F.when(F.size(own) >= WORDS, hashes).otherwise(F.array().cast("array<bigint>"))


def _minima(shingles: Column) -> Column:
    """One (band, smallest hash) for each band."""
    return F.array(*[
        F.struct(F.lit(b).alias("band"), F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(b)))).alias("low"))
        for b in range(BANDS)
    ])


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """template, license, wanted (distinct shingles), scale of every template."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)]
    df = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    tokens, hashes = _shingles(F.col("text"))
    df = df.withColumn("_tokens", tokens).withColumn("wanted", F.array_distinct(hashes))
    scale = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("wanted").cast("double")))).cast("int")
    return df.select("template", "license", "wanted", scale.alias("scale"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, license, template, containment, first_token: the best window for each document and template."""
    spark = docs.sparkSession
    known = template_table(spark, templates or TEMPLATES)
    listed = known.select("template", "wanted", "scale").collect()  # the caller's templates
    if any(not r["wanted"] for r in listed):
        raise ValueError(f"a template needs at least {WORDS} tokens")
    scales = sorted({r["scale"] for r in listed})
    literals = {s: sorted({x for r in listed if r["scale"] == s for x in r["wanted"]}) for s in scales}
    tokens, hashes = _shingles(F.col("text").cast("string"))
    # The row number keeps Spark from pushing later filters below the shingles, which would evaluate those once a token.
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("_tokens")).select(
        "doc_id", hashes.alias("_h"), F.monotonically_increasing_id().alias("_row"))
    total = sum(map(len, literals.values()))
    every = sorted({x for v in literals.values() for x in v})
    at = F.sequence(F.lit(0), F.size("_h") - 1)
    if total <= LITERALS:
        at = F.filter(at, lambda i: F.get(F.col("_h"), i).isin(every))
    own = own.withColumn("_at", F.when(F.size("_h") > 0, at).otherwise(F.array().cast("array<int>")))

    def windows(scale: int) -> Column:
        """Starts of the scale's windows around each hit."""
        step = max(1, scale // 2)
        length = scale + step if scale > 1 else 1
        near = F.transform("_at", lambda i: F.sequence(
            F.greatest(F.ceil((i - (length - 1)) / step), F.lit(0)).cast("int"), F.floor(i / step).cast("int")))
        starts = F.transform(F.array_distinct(F.flatten(near)), lambda m: F.struct(
            F.lit(scale).alias("scale"), (m * step).alias("start"), F.lit(length).alias("length")))
        return starts

    spread = own.select("_row", "doc_id", "_h", F.explode(F.concat(*[windows(s) for s in scales])).alias("w")).select(
        "_row", "doc_id", F.col("w.scale").alias("scale"), F.col("w.start").alias("start"),
        F.array_distinct(F.slice("_h", F.col("w.start") + 1, F.col("w.length"))).alias("held"),
    )
    bands = spread.select("_row", "doc_id", "scale", "start", "held", F.explode(_minima(F.col("held"))).alias("m")).select(
        "_row", "doc_id", "scale", "start", "held", "m.band", "m.low")
    keyed = known.select("*", F.explode(_minima(F.col("wanted"))).alias("m")).select(
        "template", "license", "wanted", "scale", "m.band", "m.low")
    if total <= LITERALS:
        keyed = F.broadcast(keyed)
    share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
    proven = bands.join(keyed, ["scale", "band", "low"]).withColumn("share", share).where(F.col("share") >= least)
    found = proven.select(
        "_row", "doc_id", "template", "license", "share", "start", (F.col("start") + F.size("held")).alias("stop")).distinct()
    # Notices of sister licenses differ in a word or two: where windows overlap, the fuller match speaks. Windows meet
    # those of their own stretch of the text; a stretch as long as the longest window holds a bounded number.
    reach = max(scales) + max(1, max(scales) // 2) + WORDS
    placed = found.withColumn("cell", F.explode(F.sequence(
        F.floor((F.col("start") - WORDS) / reach), F.floor((F.col("stop") + WORDS) / reach))))
    fuller = placed.select("_row", "cell", *[F.col(c).alias(f"its_{c}") for c in ("license", "share", "start", "stop")])
    beaten = placed.join(fuller, ["_row", "cell"]).where(
        (F.col("its_license") != F.col("license")) & (F.col("its_share") > F.col("share"))
        & (F.col("its_start") < F.col("stop") + WORDS) & (F.col("start") < F.col("its_stop") + WORDS))
    standing = found.join(beaten.select("_row", "template", "start"), ["_row", "template", "start"], "left_anti")
    best = standing.groupBy("_row", "doc_id", "template", "license").agg(
        F.max(F.struct("share", F.negative("start").alias("back"))).alias("best"))
    return best.select(
        "doc_id", "license", "template", F.round("best.share", 6).alias("containment"), F.negative("best.back").alias("first_token"))
