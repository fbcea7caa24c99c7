"""Licence scan by a trained paragraph classifier, in DataFrame functions only.

Paragraphs (parted by blank lines or by a line end behind the end of a sentence; other line breaks are soft) are described by hashed word bigrams. A multinomial logistic
regression with one class per licence family and version and one for unknown is trained by
gradient steps that are joins and sums over the sparse features: its examples
are the templates, parts of them and templates inside a sentence, against a bounded sample of corpus
paragraphs as unknown (``SAMPLE_PARAGRAPHS``, by a hash order; paragraphs that resemble a template are left out).
The probability from which a family is believed is calibrated on all unknown paragraphs of
the table, each counted as often as it stands there (at most ``FALSE_SHARE`` of them above it). A prediction
counts only if the paragraph also holds enough of one of the family's templates' bigrams, or is a piece of one, and has the
words that tell the family from its neighbours (``MARKS``: version, lesser, affero, sa, nc).

All paragraphs of all texts are scored: those without any weighted bigram have
the unknown class's score and need no further work.

Defined results: a null or empty text has no paragraphs and no families; blank
lines are no paragraphs; repeated paragraphs count each; rows are scored each, also those of one
doc_id; an empty table gives no rows and trains on the templates alone. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

SAMPLE_PARAGRAPHS = 4000
FALSE_SHARE = 0.001
BUCKETS = 1 << 18
STEPS, RATE, DECAY = 10, 10.0, 1e-4
LEAST_COVERED = 0.6
UNKNOWN = "unknown"
#: Longest part of a paragraph that the unknown sample takes, in words, so that the sample is bounded.
SAMPLE_WORDS = 400

#: A piece of a template: at least this many bigrams, of which this share stands in the template.
PIECE_GRAMS, PIECE_SHARE = 12, 0.8

# Notices and texts of the licences, as published.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("isc", "Licensed under the ISC License."),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Licensed under the BSD License."),
    ("bsd", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-2.0", "GNU General Public License, version 2"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "GNU Lesser General Public License, version 2.1"),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "GNU Lesser General Public License, version 3"),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0", "GNU Affero General Public License, version 3"),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "Mozilla Public License, version 2.0"),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0-1.0", "Released under CC0 1.0."),
    ("cc0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved. No part of this work may be reproduced."),
)
#: Fixed values, per family: one word of each group must stand in a paragraph, and none of the last list.
MARKS = {
    "mit": ((("mit", "sublicense"),), ()),
    "isc": ((("isc", "fee"),), ("sublicense",)),
    "apache-2.0": ((("apache",), ("2.0", "2")), ()),
    "bsd": ((("bsd", "redistribution", "redistributions"),), ("3",)),
    "bsd-3-clause": ((("neither", "3"),), ()),
    "gpl": ((("gpl", "general"),), ("lesser", "library", "affero", "1", "2", "3", "2.0", "3.0")),
    "gpl-2.0": ((("gpl", "general"), ("2", "2.0", "v2")), ("lesser", "library", "affero", "3", "3.0", "v3")),
    "gpl-3.0": ((("gpl", "general"), ("3", "3.0", "v3")), ("lesser", "library", "affero")),
    "lgpl-2.1": ((("lgpl", "lesser"), ("2.1", "v2.1")), ("affero",)),
    "lgpl-3.0": ((("lgpl", "lesser"), ("3", "3.0", "v3")), ("affero",)),
    "agpl-3.0": ((("agpl", "affero"),), ()),
    "mpl-2.0": ((("mpl", "mozilla"), ("2", "2.0")), ()),
    "cc-by-4.0": ((("by", "attribution"), ("4.0",)), ("sa", "nc", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs")),
    "cc-by-sa-4.0": ((("sa", "sharealike"), ("4.0",)), ("nc", "nd", "noncommercial", "noderivatives", "noderivs")),
    "cc-by-nc-4.0": ((("nc", "noncommercial"), ("4.0",)), ("sa", "nd", "sharealike", "noderivatives", "noderivs")),
    "cc0-1.0": ((("cc0",),), ()),
    "unlicense": ((("unlicense", "unencumbered"),), ()),
    "proprietary": ((("reserved",),), ()),
}
MARK_WORDS = sorted({w for need, none in MARKS.values() for group in (*need, none) for w in group})
#: Where a paragraph ends: at a blank line, or at a line end behind the end of a sentence; other line ends are soft.
BLANK = r"^\s*$"
PARAGRAPH = r"\R[ \t]*\R\s*|(?<=[.!?:;])[ \t]*\R"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?=\s|$)"), "")


def grams(ws: Column) -> Column:
    """Distinct hashed word bigrams; a single word is its own."""

    def of(w: Column) -> Column:
        pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
        return F.array_distinct(F.when(F.size(w) == 1, F.transform(w, lambda a: F.pmod(F.xxhash64(a), F.lit(BUCKETS)).cast("int"))).otherwise(pairs))

    return F.transform(F.array(ws), of)[0]  # the lambda's variable holds the words, so they are split once


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, par, text): non-blank paragraphs; ``row`` numbers the rows of ``docs``."""
    return docs.select("row", F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), PARAGRAPH)).alias("par", "text")).where(~F.col("text").rlike(BLANK))


def _table(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A table of literal structs, which needs no Python worker."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def templates(spark: SparkSession) -> DataFrame:
    rows = _table(spark, [F.struct(F.lit(k).alias("template"), F.lit(f).alias("family"), F.lit(t).alias("text")) for k, (f, t) in enumerate(TEMPLATES)])
    return rows.select("template", "family", words(F.col("text")).alias("ws")).withColumn("grams", grams(F.col("ws")))


def sampled(pars: DataFrame) -> DataFrame:
    """About 2 x SAMPLE_PARAGRAPHS different paragraphs, by a hash threshold that follows from an approximate count; all if there are fewer."""
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    found = pars.agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).first()["n"]
    upto = min(1 << 40, (2 * SAMPLE_PARAGRAPHS << 40) // max(found, 1))
    return pars.where(h < upto).select("text")


def examples(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(ex, family, grams, part): part 0 trains, part 1 is left out of training."""
    known = templates(spark)
    n = F.size("ws")
    variants = F.array(
        F.col("ws"), F.concat(F.array(F.lit("note"), F.lit("that")), F.col("ws")), F.concat(F.col("ws"), F.array(F.lit("see"), F.lit("the"), F.lit("notice"))),
        F.slice("ws", F.lit(1), F.greatest((n * 4 / 5).cast("int"), F.lit(2))), F.slice("ws", F.greatest((n / 5).cast("int"), F.lit(1)), n),
    )
    positive = known.select("family", F.explode(variants).alias("ws")).withColumn("part", F.lit(0))
    all_grams = known.agg(F.array_distinct(F.flatten(F.collect_list("grams"))).alias("known"))
    unknown = sampled(paragraphs(docs)).select(F.slice(words(F.col("text")), 1, SAMPLE_WORDS).alias("ws")).where(F.size("ws") > 0)
    unknown = unknown.join(F.broadcast(all_grams)).withColumn("g", grams(F.col("ws"))).where(F.size(F.array_intersect("g", "known")) * 2 < F.size("g"))
    unknown = unknown.select(F.lit(UNKNOWN).alias("family"), "ws", (F.pmod(F.xxhash64("ws"), F.lit(2))).cast("int").alias("part"))
    both = positive.unionByName(unknown)
    return both.select(F.xxhash64("family", "ws").alias("ex"), "family", grams(F.col("ws")).alias("grams"), "part").dropDuplicates(["ex"])


def train(rows: DataFrame) -> DataFrame:
    """(gram, class, weight) of the fitted regression; gram -1 is the bias. Only grams of licence examples carry weight."""
    spark = rows.sparkSession
    rows = common.stored(rows.where("part = 0").select("ex", "family", "grams"), "op4-train")
    families = sorted({f for f, _ in TEMPLATES} | {UNKNOWN})
    vocabulary = rows.where(F.col("family") != UNKNOWN).select(F.explode("grams").alias("gram")).distinct()
    # examples that agree in family and weighted grams are one, counted; nearly all unknown ones have none
    seen = rows.select("ex", "family", F.explode_outer("grams").alias("gram")).join(F.broadcast(vocabulary.withColumn("hit", F.lit(True))), "gram", "left")
    alike = seen.groupBy("ex", "family").agg(F.sort_array(F.collect_set(F.when(F.col("hit"), F.col("gram")))).alias("grams")).groupBy("family", "grams").agg(F.count("*").alias("n"))
    alike = common.stored(alike.select(F.xxhash64("family", "grams").alias("ex"), "family", "grams", "n").coalesce(1), "op4-alike")
    cells = common.stored(alike.select("ex", "family", F.explode(F.concat(F.array(F.lit(-1)), "grams")).alias("gram")).coalesce(1), "op4-cells")
    n_classes = len(families)
    balance = alike.groupBy("family").agg(F.sum("n").alias("all"))
    labels = common.stored(alike.join(F.broadcast(balance), "family").select("ex", "family", (F.col("n") / F.col("all") / n_classes).alias("share")).coalesce(1), "op4-labels")
    classes = _table(spark, [F.struct(F.lit(f).alias("class")) for f in families])
    now = _table(spark, [F.struct(F.lit(-1).alias("gram"), F.lit(UNKNOWN).alias("class"), F.lit(0.0).alias("weight"))])
    for _ in range(STEPS):  # the weights: grams of the templates' examples x classes, a bounded table
        z = cells.join(F.broadcast(now), "gram").groupBy("ex", "class").agg(F.sum("weight").alias("z"))
        full = labels.join(F.broadcast(classes)).join(z, ["ex", "class"], "left").fillna(0.0, ["z"])
        norm = full.groupBy("ex").agg(F.sum(F.exp("z")).alias("norm"))
        error = full.join(norm, "ex").select("ex", "class", (F.col("share") * (F.exp("z") / F.col("norm") - (F.col("class") == F.col("family")).cast("double"))).alias("e"))
        slope = cells.select("ex", "gram").join(error, "ex").groupBy("gram", "class").agg(F.sum("e").alias("e"))
        new = slope.join(F.broadcast(now), ["gram", "class"], "left").select("gram", "class", (F.coalesce("weight", F.lit(0.0)) * (1 - DECAY) - RATE * F.col("e")).alias("weight"))
        now = common.stored(new.coalesce(1), "op4-weights")
    return now


def scored(pars: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """keys, family, probability: the likeliest family of each paragraph that has a weighted gram."""
    bias = weights.where("gram < 0").select("class", F.col("weight").alias("bias"))
    seen = pars.select(*keys, F.explode("grams").alias("gram"))
    z = seen.join(F.broadcast(weights.where("gram >= 0")), "gram").groupBy(*keys, "class").agg(F.sum("weight").alias("z"))
    z = z.join(F.broadcast(bias), "class").withColumn("z", F.col("z") + F.col("bias"))
    best = z.groupBy(*keys).agg(F.max(F.struct("z", "class")).alias("top"), F.collect_list("z").alias("all"))
    norm = F.aggregate("all", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top.z")))
    return best.select(*keys, F.col("top.class").alias("family"), (1 / norm).alias("probability"))


def least_probability(likely: DataFrame, n_unknown: int) -> float:
    """The probability that at most FALSE_SHARE of all ``n_unknown`` unknown paragraphs exceed.

    ``likely`` (probability): the unknown paragraphs that some family is believed of with more than 0.5.
    """
    allowed = int(FALSE_SHARE * n_unknown)
    over = likely.orderBy(F.desc("probability")).limit(allowed + 1).agg(F.min("probability").alias("p"), F.count("*").alias("n")).first()
    return max(0.5, over["p"]) if over["n"] > allowed else 0.5


def forms(spark: SparkSession) -> DataFrame:
    """(family, form, need, none): the bigrams of each template, and the words its family is told by."""
    strings = lambda ws: F.array(*map(F.lit, ws)).cast("array<string>")
    marks = _table(spark, [F.struct(F.lit(f).alias("family"), F.array(*map(strings, need)).alias("need"), strings(none).alias("none")) for f, (need, none) in MARKS.items()])
    return templates(spark).select("family", F.col("grams").alias("form")).join(F.broadcast(marks), "family")


def confirmed(found: DataFrame) -> Column:
    """Whether a paragraph (grams, n_grams, marks) holds enough of a template, or is a piece of one, and has its family's words."""
    shared = F.size(F.array_intersect("grams", "form"))
    enough = (shared >= LEAST_COVERED * F.size("form")) | ((F.col("n_grams") >= PIECE_GRAMS) & (shared >= PIECE_SHARE * F.col("n_grams")))
    return enough & F.forall("need", lambda group: F.arrays_overlap(group, F.col("marks"))) & ~F.arrays_overlap("none", "marks")


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_paragraphs, n_license, families (sorted array), probability (of the surest)."""
    spark = docs.sparkSession
    rows = common.stored(examples(spark, docs.select(F.lit(0).alias("row"), "text")) if labelled is None else labelled, "op4-examples")
    weights = train(rows)
    weighted = [r["gram"] for r in weights.where("gram >= 0").select("gram").distinct().orderBy("gram").collect()]  # grams of the templates' examples

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    per_row = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), PARAGRAPH), lambda x: ~x.rlike(BLANK))
    split = numbered.select("row", "doc_id", F.size(per_row).cast("long").alias("n_paragraphs"), F.transform(per_row, lambda x: words(x)).alias("pars"))

    def described(ws: Column, i: Column) -> Column:
        own = grams(ws)
        return F.transform(F.array(own), lambda g: F.struct(
            i.alias("par"), F.filter(g, lambda x: x.isin(weighted)).alias("grams"), F.size(g).alias("n_grams"), F.array_intersect(ws, F.array(*map(F.lit, MARK_WORDS))).alias("marks")))[0]

    split = split.withColumn("n_worded", F.size(F.filter("pars", lambda ws: F.size(ws) > 0)))
    base = common.stored(split.withColumn("pars", F.filter(F.transform("pars", described), lambda p: F.size(p["grams"]) > 0)), "op4-paragraphs")
    every = base.select("row", F.explode("pars").alias("p")).select("row", "p.*")
    known = F.array(*map(F.lit, sorted(r["g"] for r in templates(spark).select(F.explode("grams").alias("g")).distinct().collect())))
    unlike = F.size(F.array_intersect("grams", known)) * 2 < F.col("n_grams")  # as in ``examples``: resembles no template
    scores = scored(every.select("row", "par", "grams"), weights, ["row", "par"]).where((F.col("family") != UNKNOWN) & (F.col("probability") > 0.5))
    scores = common.stored(scores.join(every.select("row", "par", unlike.alias("unlike")), ["row", "par"]), "op4-scores")
    n_worded, n_alike = base.select(F.coalesce(F.sum("n_worded"), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("pars", lambda p: F.size(F.array_intersect(p["grams"], known)) * 2 >= p["n_grams"]))), F.lit(0))).first()
    least = least_probability(scores.where("unlike").select("probability"), n_worded - n_alike)

    pars = every.where(F.size("marks") > 0)
    found = scores.where(F.col("probability") > least).drop("unlike")
    sure = found.join(pars, ["row", "par"]).join(F.broadcast(forms(spark)), "family").where(confirmed(found)).select("row", "par", "family", "probability").distinct()
    per_doc = sure.groupBy("row").agg(F.count("*").alias("n_license"), F.array_sort(F.collect_set("family")).alias("families"), F.max("probability").alias("probability"))
    return base.select("row", "doc_id", "n_paragraphs").join(per_doc, "row", "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_license", F.lit(0).cast("long")).alias("n_license"), F.coalesce("families", F.array().cast("array<string>")).alias("families"), "probability",
    )


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
