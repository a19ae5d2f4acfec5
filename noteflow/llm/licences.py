"""Licence scans with a trained paragraph classifier (operator 6), DataFrame operations only.

A paragraph is a non-blank line; its words are lower-cased runs without ASCII white space or
the punctuation in ``PUNCTUATION``, its features the distinct word unigrams, bigrams and
trigrams.  A multinomial logistic regression over them knows the licence families and
``unknown``; it is trained on the templates below, cut and thinned in fixed ways, and on a
bounded hashed sample of the corpus' own paragraphs (``sample_rows``) that hold no template
trigram and no template's bigrams to the share that would confirm it.  One temperature, chosen by log loss on the other half of that material, calibrates the
probabilities; below ``min_probability`` a paragraph is unknown.  A prediction counts only if
template comparison confirms it: at least ``min_overlap`` of the bigrams of one of the
family's templates stand in the paragraph.

Anchors are words chosen from the templates alone, the same for every table: so many of each
template that its bigrams without any of them are fewer than ``min_overlap`` asks for.  A
paragraph without an anchor can therefore confirm no template, and documents without any are
left out before their lines are touched: the answer for every paragraph of every document is
the same as if all were scored, however frequent a licence is.

Licence headers are wrapped, so with ``wrapped`` passages over several lines are scored too, in
the same way and by their words in one run.  A block is a run of lines with words (a line without
any is its border); in each block the tightest passages that hold ``min_overlap`` of a template's
bigrams within twice the template's words are found, whatever line breaks lie between.  A passage
that holds a confirmed line of its family is that line's; of confirmed passages of a family that
share lines the fullest and then shortest stay.  Rows give the first and last line covered.

Weights, templates and anchors are bounded by the templates and broadcast as literals or
small tables.  Null and empty texts have no paragraphs; a null id is carried; repeated rows
each give their rows (the same id and text count once); a document never meets another, so
no group can be hot.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import durable, table

PUNCTUATION = ".,;:()[]{}\"'!?*#/<>|&%$"
UNKNOWN = "unknown"

# Short public licence statements and headers by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU GPL version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "proprietary": [
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying is strictly prohibited.",
    ],
}

#: Words that are anchors only if a template has no others left.
FUNCTION_WORDS = {"a", "all", "an", "and", "any", "are", "as", "at", "be", "been", "but", "by", "can", "following", "for", "form", "free", "from",
                  "had", "has", "have", "in", "is", "it", "may", "no", "not", "of", "on", "or", "part", "person", "project", "that", "the", "this",
                  "to", "under", "use", "was", "were", "with", "without", "work", "you"}


def words_of(c: Column) -> Column:
    plain = F.translate(F.lower(c), PUNCTUATION + "\t\n\r\u000b\u000c", " " * (len(PUNCTUATION) + 5))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def grams_of(words: Column, sizes=(1, 2, 3)) -> Column:
    """Distinct word n-grams."""
    def of(n: int) -> Column:
        last = F.size(words) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                             lambda i: F.array_join(F.slice(words, i + 1, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*map(of, sizes)))


def paragraphs(docs: DataFrame, id_col: str, text_col: str, only: Column | None = None) -> DataFrame:
    """_id, _line (place of the line), _words; ``only`` filters documents by their words."""
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).where("_text IS NOT NULL")
    if only is not None:
        whole = whole.where(only)
    return whole.select("_id", F.posexplode_outer(F.split("_text", "\n", -1)).alias("_line", "_l")) \
                .select("_id", "_line", words_of(F.col("_l")).alias("_words")).where(F.size("_words") > 0)


def template_rows(spark: SparkSession) -> DataFrame:
    rows = [(f, f"{f}/{k}", t) for f, ts in TEMPLATES.items() for k, t in enumerate(ts)]
    return spark.createDataFrame(rows, "family string, template string, body string") \
                .select("family", "template", words_of(F.col("body")).alias("_words"))


def anchor_words(templates: DataFrame, min_overlap: float) -> list[str]:
    """Words of which every paragraph with ``min_overlap`` of a template's bigrams holds one."""
    chosen: set[str] = set()
    for words in sorted(r["_words"] for r in templates.collect()):
        pairs = set(zip(words, words[1:]))
        need = next((n for n in range(1, len(pairs) + 1) if n / len(pairs) >= min_overlap), len(pairs))
        left = [p for p in pairs if not chosen & {*p}]
        while left and len(left) >= need:
            chosen.add(min({w for p in left for w in p}, key=lambda w: (w in FUNCTION_WORDS or len(w) == 1, -sum(w in p for p in left), -len(w), w)))
            left = [p for p in pairs if not chosen & {*p}]
    return sorted(chosen)


def without(k: int, r: int):
    return lambda w, i: (i % k) != r


def every_third(r: int):
    return lambda w, i: (i % 3) == r


def variants(templates: DataFrame) -> DataFrame:
    """Templates whole, thinned (every k-th word gone) and cut to two thirds; and, as unknown
    text, what is left of a template when only every third word stays."""
    n = F.size("_words")
    keep = [F.col("_words")]
    keep += [F.filter("_words", without(k, r)) for k in (5, 7, 9) for r in (1, 3)]
    keep += [F.slice("_words", 1, F.ceil(n * 2 / 3).cast("int")), F.slice("_words", F.floor(n / 3).cast("int") + 1, n)]
    known = templates.select("family", F.posexplode(F.array(*keep)).alias("_k", "_words"))
    loose = templates.select(F.lit(UNKNOWN).alias("family"), F.posexplode(F.array(
        *[F.filter("_words", every_third(r)) for r in range(3)])).alias("_k", "_words"))
    return known.unionByName(loose).where(F.size("_words") > 0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 4000, min_overlap: float = 0.6) -> dict:
    """Train on the templates and at most about ``sample_rows`` documents' paragraphs."""
    spark = docs.sparkSession
    templates = template_rows(spark)
    total = docs.count()
    picked = docs.select(F.col(id_col).alias("_sid"), F.col(text_col).cast("string").alias("_stext")) \
                 .where(F.pmod(F.xxhash64("_stext"), F.lit(max(1, total // sample_rows + 1))) == 0)
    lines = durable(paragraphs(picked, "_sid", "_stext").select("_words").distinct())
    trigrams = [r[0] for r in templates.select(F.explode(grams_of(F.col("_words"), (3,)))).distinct().collect()]
    other = lines.where(~F.arrays_overlap(grams_of(F.col("_words"), (3,)), F.array(*map(F.lit, trigrams))))
    alike = overlaps(other, ["_words"]).where(F.col("_t.overlap") >= min_overlap).select("_words").distinct()
    other = other.join(alike, "_words", "left_anti").select(F.lit(UNKNOWN).alias("family"), F.lit(0).alias("_k"), "_words")
    rows = variants(templates).unionByName(other).withColumn("grams", grams_of(F.col("_words"))) \
                              .withColumn("half", F.pmod(F.xxhash64("family", "_k", "_words"), F.lit(3)) == 0)
    labels = sorted([*TEMPLATES, UNKNOWN])
    rows = durable(rows.withColumn("label", F.element_at(F.create_map(*[F.lit(x) for k, f in enumerate(labels) for x in (f, float(k))]), F.col("family")))
                       .select("label", "grams", "half", F.when(F.col("family") == UNKNOWN, 1.0).otherwise(10.0).alias("weight")))
    grams = sorted(r[0] for r in variants(templates).select(F.explode(grams_of(F.col("_words")))).distinct().collect())
    vectors = CountVectorizerModel.from_vocabulary(grams, inputCol="grams", outputCol="features")
    trained = LogisticRegression(family="multinomial", regParam=0.003, maxIter=60, weightCol="weight", labelCol="label") \
        .fit(vectors.transform(rows.where("NOT half")))
    weights = trained.coefficientMatrix.toArray()
    model = {"labels": labels, "grams": grams, "weights": weights, "bias": list(trained.interceptVector.toArray()), "scale": 1.0}
    model["scale"] = calibrate(rows.where("half"), model)
    return model


def overlaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, family and _t, the largest share of a template's bigrams that a row's _words hold and which template's."""
    bigrams = template_rows(rows.sparkSession).select("family", "template", grams_of(F.col("_words"), (2,)).alias("_g")) \
                                              .select("family", "template", F.size("_g").alias("_size"), F.explode("_g").alias("_gram"))
    own = rows.select(*keys, F.explode(grams_of(F.col("_words"), (2,))).alias("_gram"))
    return own.join(F.broadcast(bigrams), "_gram").groupBy(*keys, "family", "template", "_size").agg(F.count(F.lit(1)).alias("_n")) \
              .groupBy(*keys, "family").agg(F.max(F.struct((F.col("_n") / F.col("_size")).alias("overlap"), "template")).alias("_t"))


def raw_scores(rows: DataFrame, keys: list[str], model: dict) -> DataFrame:
    """``keys`` and _s, the classes' scores of each row's ``grams``."""
    spark, k = rows.sparkSession, len(model["labels"])
    table_ = spark.createDataFrame([(g, [float(x) for x in model["weights"][:, j]]) for j, g in enumerate(model["grams"])],
                                   "gram string, w array<double>")
    hits = rows.select(*keys, F.explode("grams").alias("gram")).join(F.broadcast(table_), "gram")
    sums = hits.groupBy(*keys).agg(*[F.sum(F.col("w")[i]).alias(f"_w{i}") for i in range(k)])
    return sums.select(*keys, F.array(*[F.col(f"_w{i}") + F.lit(float(model["bias"][i])) for i in range(k)]).alias("_s"))


def softmax(scores: Column, scale: float) -> Column:
    top = F.array_max(scores)
    e = F.zip_with(scores, F.array_repeat(top, F.size(scores)), lambda s, m: F.exp((s - m) * F.lit(scale)))
    return F.zip_with(e, F.array_repeat(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), F.size(scores)), lambda x, t: x / t)


def calibrate(rows: DataFrame, model: dict) -> float:
    """The scale of the scores with the least log loss on held-out rows."""
    named = durable(rows.withColumn("_row", F.monotonically_increasing_id()))
    scored = raw_scores(named, ["_row", "label"], model)
    scales = [0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0]
    loss = scored.agg(*[F.avg(-F.log(F.greatest(softmax(F.col("_s"), s)[F.col("label").cast("int")], F.lit(1e-9)))).alias(f"l{i}")
                        for i, s in enumerate(scales)]).first()
    ranked = [(loss[i], abs(s - 1), s) for i, s in enumerate(scales) if loss[i] is not None]
    return min(ranked)[2] if ranked else 1.0


def passages(docs: DataFrame, min_overlap: float, id_col: str, text_col: str, only: Column) -> DataFrame:
    """_id, _doc, _line, _last, _hs (its lines' hashes), _words: passages of two or more lines of a block that hold
    ``min_overlap`` of a template's bigrams."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).where("_text IS NOT NULL").where(only) \
                .withColumn("_doc", F.xxhash64("_text")).dropDuplicates(["_id", "_doc"])
    in_doc = Window.partitionBy("_id", "_doc").orderBy("_line")
    in_block = Window.partitionBy("_id", "_doc", "_block").orderBy("_line")
    lines = whole.select("_id", "_doc", F.posexplode_outer(F.split("_text", "\n", -1)).alias("_line", "_l")) \
                 .select("_id", "_doc", "_line", words_of(F.col("_l")).alias("_words")).where(F.size("_words") > 0) \
                 .withColumn("_block", F.col("_line") - F.row_number().over(in_doc)) \
                 .withColumn("_from", F.sum(F.size("_words")).over(in_block) - F.size("_words")) \
                 .withColumn("_tail", F.lag(F.element_at("_words", -1)).over(in_block))
    lines = durable(lines)
    # a bigram that crosses a line break is at the line of its second word and begins one line before
    words = F.when(F.col("_tail").isNotNull(), F.concat(F.array("_tail"), F.col("_words"))).otherwise(F.col("_words"))
    wide, crossing = lines.withColumn("_w", words), F.col("_tail").isNotNull().cast("int")
    n = F.size("_w")
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice("_w", i, 2), " ")))
    own = wide.select("_id", "_doc", "_block", "_line", "_from", crossing.alias("_crossing"), F.posexplode(pairs).alias("_at", "_gram")) \
              .select("_id", "_doc", "_block", (F.col("_from") + F.col("_at") - F.col("_crossing")).alias("_pos"),
                      F.when((F.col("_at") == 0) & (F.col("_crossing") == 1), 1).otherwise(0).alias("_before"), "_line", "_gram")
    templates = template_rows(spark).select("template", F.size("_words").alias("_n"), grams_of(F.col("_words"), (2,)).alias("_g")) \
                                    .select("template", "_n", F.size("_g").alias("_size"), F.explode("_g").alias("_gram"))
    hits = own.join(F.broadcast(templates), "_gram")
    # positions in units of the template's words: a window reaches over twice its words
    ahead = Window.partitionBy("_id", "_doc", "_block", "template").orderBy("_unit").rangeBetween(0, 20_000)
    near = hits.withColumn("_unit", F.col("_pos") * F.floor(F.lit(10_000) / F.col("_n"))) \
               .withColumn("_near", F.sort_array(F.collect_list(F.struct("_pos", "_line", "_gram")).over(ahead)))
    grams = F.transform("_near", lambda x: x["_gram"])
    firsts = F.filter("_near", lambda x, i: F.array_position(grams, x["_gram"]) == i + 1)
    spans = near.withColumn("_firsts", firsts).where(F.size("_firsts") / F.col("_size") >= min_overlap) \
                .select("_id", "_doc", "_block", (F.col("_line") - F.col("_before")).alias("_line"), F.element_at("_firsts", -1)["_line"].alias("_last")) \
                .where("_last > _line").distinct()
    of = lines.select(F.col("_id").alias("_i"), F.col("_doc").alias("_d"), F.col("_line").alias("_k"), F.col("_words").alias("_w"))
    inside = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_doc") == F.col("_d")) & F.col("_k").between(F.col("_line"), F.col("_last"))
    return spans.join(of, inside).groupBy("_id", "_doc", "_line", "_last") \
                .agg(F.transform(F.sort_array(F.collect_list(F.struct("_k", "_w"))), lambda x: x["_w"]).alias("_ls")) \
                .select("_id", "_doc", "_line", "_last", F.transform("_ls", lambda w: F.xxhash64(w)).alias("_hs"), F.flatten("_ls").alias("_words"))


def confirmed(found: DataFrame, keys: list[str], model: dict, min_probability: float, min_overlap: float) -> DataFrame:
    """Rows (``keys``, _words) whose family the classifier names and a template confirms: ``keys``,
    family, probability, template, overlap."""
    found = durable(found.withColumn("grams", grams_of(F.col("_words"))))
    scored = raw_scores(found, keys, model).withColumn("_p", softmax(F.col("_s"), model["scale"]))
    best = F.array_max("_p")
    labels = F.array(*map(F.lit, model["labels"]))
    said = scored.select(*keys, best.alias("probability"), F.element_at(labels, F.array_position("_p", best).cast("int")).alias("family")) \
                 .where((F.col("family") != UNKNOWN) & (F.col("probability") >= min_probability))
    # template comparison: share of a template's bigrams that the paragraph holds
    shared = overlaps(found, keys)
    pair = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("a.family") == F.col("b.family")]
    return said.alias("a").join(shared.alias("b"), pair) \
               .where(F.col("b._t.overlap") >= min_overlap) \
               .select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.family").alias("family"), F.col("a.probability").alias("probability"),
                       F.col("b._t.template").alias("template"), F.col("b._t.overlap").alias("overlap"))


def scan(docs: DataFrame, model: dict, min_probability: float = 0.5, min_overlap: float = 0.6,
         id_col: str = "doc_id", text_col: str = "text", wrapped: bool = False) -> DataFrame:
    """Confirmed licence paragraphs: doc_id, line, last_line, family, probability, template,
    overlap.  Single lines, with ``wrapped`` also passages over several lines."""
    spark = docs.sparkSession
    anchors = F.array(*map(F.lit, anchor_words(template_rows(spark), min_overlap)))
    only = F.arrays_overlap(words_of(F.col("_text")), anchors)
    found = paragraphs(docs, id_col, text_col, only=only) \
        .where(F.arrays_overlap("_words", anchors)) \
        .withColumn("_h", F.xxhash64("_words")).dropDuplicates(["_id", "_line", "_h"])
    rest = ["family", "probability", "template", "overlap"]
    single = confirmed(found, ["_id", "_line", "_h"], model, min_probability, min_overlap)
    if wrapped:
        single = durable(single)
    lines = single.select(F.col("_id").alias("doc_id"), F.col("_line").alias("line"), F.col("_line").alias("last_line"), *rest)
    if not wrapped:
        return lines
    keys = ["_id", "_doc", "_line", "_last", "_hs"]
    spans = confirmed(passages(docs, min_overlap, id_col, text_col, only), keys, model, min_probability, min_overlap)
    taken = single.select(F.col("_id").alias("_i"), F.col("_line").alias("_k"), F.col("_h").alias("_own"), F.col("family").alias("_f"))
    free = spans.join(taken, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("family") == F.col("_f"))
                      & F.col("_k").between(F.col("_line"), F.col("_last"))
                      & (F.get("_hs", F.col("_k") - F.col("_line")) == F.col("_own")), "left_anti")
    # passages of a family that share lines: the fullest, then the shortest stay
    per = Window.partitionBy("_id", "_doc", "family").orderBy("_line", "_last")
    apart = F.coalesce(F.col("_line") > F.max("_last").over(per.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    group = Window.partitionBy("_id", "_doc", "family", "_group")
    ranked = free.withColumn("_apart", apart.cast("int")).withColumn("_group", F.sum("_apart").over(per)) \
                 .withColumn("_r", F.rank().over(group.orderBy(F.desc("overlap"), F.col("_last") - F.col("_line"))))
    return lines.unionByName(ranked.where("_r = 1").select(F.col("_id").alias("doc_id"), F.col("_line").alias("line"), F.col("_last").alias("last_line"), *rest))


def op6_licence_paragraphs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs), wrapped=True)
