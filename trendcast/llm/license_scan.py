"""Operator 6: licence scanning with a trained paragraph classifier.

Paragraphs (single lines of a text, and lines up to a blank one joined without
their comment marks; long ones in overlapping windows of words) are turned into hashed word 1- and 2-grams and classified by multinomial logistic
regression into licence families or ``unknown``. Training data are made here:
the notices below with words dropped by rule, alone and inside corpus prose, and
as unknown class a bounded sample of corpus paragraphs, the same with a licence
word put in, and sentences that speak of licences without granting one.

A third of the training rows is held out: the least probability that a family
needs is set where at most ``FALSE_RATE`` of the held-out unknown rows reach it.
A prediction counts as *confirmed* when the paragraph also shares enough n-grams
with a notice of the predicted family.

DataFrame, SQL and the JVM's ML functions only; no Python runs in tasks. Every
paragraph of every text is classified; those with a cue word are marked.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendcast.llm.common import materialize, table, text_or_empty

UNKNOWN = "unknown"
FEATURES = 1 << 13
WINDOW, STRIDE = 64, 32
VARIANTS = 6
NEGATIVES = 600
FALSE_RATE = 0.005
LEAST_PROBABILITY = 0.5
CONFIRM_OVERLAP = 0.6

# Notices of public licences, as they are commonly written.
NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL license",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.", "Licensed under the BSD License", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: redistributions of source code must retain the above copyright notice",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Released under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0 license.", "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain.",
    ],
    "Proprietary": [
        "Copyright. All rights reserved.", "All rights reserved. No part of this work may be reproduced without permission.",
        "This document is proprietary and confidential; unauthorized copying is prohibited. All rights reserved.",
    ],
}
# Sentences with cue words that grant nothing.
SPEAKING_OF = [
    "The officer asked the driver for a license and the papers of the car.",
    "She has held a fishing license since the spring and a trade licence before.",
    "The city may license new taxis next year after a vote of the council.",
    "Their license plate was found near the river by the police.",
    "He was granted poetic license by the critics of the paper.",
    "The warranty of the fridge ran out and the shop refused a repair.",
    "Copyright law is taught in the third year at this school.",
    "The old mill is in the public domain of the village.",
]
# Also blank but for these: lines that part paragraphs.
MARKS = r"^\s*(?:(?://|/\*|\*/|<!--|-->|--|[*#;%!|]|(?i:rem|dnl)\b)[*/#;%!-]*)?\s*|\s*(?:\*+/|-->)?\s*$"
# Of a line that MARKS changes, the first character is one of these, or the last (a sign that ends lines may follow the last mark).
MARK_BEGINS = r"^[\s/*<\-#;%!|rRdD]"
MARK_ENDS = (*" \t\n\x0b\f\r/>", "\x85", "\u2028", "\u2029")
CUES = r"(?i)licen[sc]|copyright|public domain|free software|rights reserved|hereby granted|warrant"
# One of these is in every text with a cue, even one that goes over a line's end.
CUE_WORDS = ("licens", "licenc", "copyright", "domain", "software", "rights", "hereby", "warrant")


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def bare(p: Column) -> Column:
    """A line without its comment marks; one that neither begins nor ends like a mark or a blank is left as it is."""
    may = p.rlike(MARK_BEGINS) | F.right(p, F.lit(1)).isin(*MARK_ENDS)
    return F.when(may, F.regexp_replace(p, MARKS, "")).otherwise(p)


def hashed(ws: Column) -> Column:
    """64-bit hashes of an array of words."""
    return F.transform(ws, lambda w: F.xxhash64(w))


def pairs(hs: Column) -> Column:
    """2-grams of an array of hashed words, hashed likewise."""
    return F.when(F.size(hs) >= 2, F.zip_with(F.slice(hs, 1, F.size(hs) - 1), F.slice(hs, 2, F.size(hs) - 1),
                                              lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))


def grams(ws: Column) -> Column:
    """Hashed 1- and 2-grams of an array of words."""
    return F.concat(hashed(ws), pairs(hashed(ws)))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, part, cue, grams): the n-grams of windows of words of all lines, and of all joined paragraphs.

    line counts from 0; that of a joined paragraph is its first line with a cue
    of its own, or else its first line. Its parts are counted on from that line's.
    ``cue`` says whether the line or the joined paragraph has a cue word.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).filter("text != ''")
    some = functools.reduce(Column.__or__, [F.contains("low", F.lit(w)) for w in CUE_WORDS])
    split = texts.withColumn("low", F.lower("text")).select("doc_id", F.split("text", "\n").alias("raw"), some.alias("may"))
    # The words of a line are taken and hashed once: a joined paragraph's are those of its lines without their marks.
    lines = split.withColumn("bare", F.transform("raw", bare)).withColumn(
        "cue", F.transform("raw", lambda p: F.col("may") & p.rlike(CUES))).withColumn("all", F.transform("raw", lambda p: hashed(words(p))))

    def own(i: Column) -> Column:
        """Words of line i without its marks, taken for the lines of joined paragraphs only, where they differ from the line's."""
        p = F.get(F.col("bare"), i)
        return F.when(p == F.get(F.col("raw"), i), F.get(F.col("all"), i)).otherwise(hashed(words(p)))

    at = "filter(sequence(0, size(raw) - 1), i -> bare[i] != '' and ({} or bare[{}] = ''))"
    spans = lines.withColumn("first", F.expr(at.format("i = 0", "i - 1"))).withColumn("last", F.expr(at.format("i = size(raw) - 1", "i + 1")))
    single = F.expr("transform(sequence(0, size(raw) - 1), i -> struct(i as line, all[i] as ws, 0 as ahead, cue[i] as cue))")
    stretches = F.expr("filter(arrays_zip(first, last), s -> s.last > s.first)")
    joined = F.transform(stretches, lambda s: F.struct(
        F.coalesce(F.get(F.filter(F.sequence(s["first"], s["last"]), lambda i: F.get(F.col("cue"), i)), F.lit(0)), s["first"]).alias("line"),
        F.flatten(F.transform(F.sequence(s["first"], s["last"]), own)).alias("ws"),
        (F.col("may") & F.concat_ws(" ", F.slice("bare", s["first"] + 1, s["last"] - s["first"] + 1)).rlike(CUES)).alias("cue")))
    wrapped = F.transform("joined", lambda s: F.struct(
        s["line"].alias("line"), s["ws"].alias("ws"), F.size(F.get(F.col("all"), s["line"])).alias("ahead"), s["cue"].alias("cue")))
    units = spans.withColumn("joined", joined).select("doc_id", F.explode(F.concat(single, wrapped)).alias("u")).select(
        "doc_id", "u.*").filter(F.size("ws") > 0)

    def last(n: Column) -> Column:
        return F.greatest(F.lit(0), F.ceil((n - WINDOW) / STRIDE)).cast("int")

    # Pairs are made once a line or paragraph too: a window has those that begin at its words but the last.
    one = F.array(F.concat("ws", "pairs"))
    many = F.transform(F.sequence(F.lit(0), last(F.size("ws"))), lambda i: F.concat(
        F.slice(F.col("ws"), i * STRIDE + 1, F.lit(WINDOW)), F.slice(F.col("pairs"), i * STRIDE + 1, F.lit(WINDOW - 1))))
    cut = units.withColumn("pairs", pairs(F.col("ws"))).select(
        "doc_id", "line", "cue", F.when(F.col("ahead") > 0, last(F.col("ahead")) + 1).otherwise(0).alias("before"),
        F.posexplode(F.when(F.size("ws") <= WINDOW, one).otherwise(many)).alias("part", "grams"))
    return cut.select("doc_id", "line", (F.col("part") + F.col("before")).alias("part"), "cue", "grams")


def _constants(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("notice"))
                                                     for a, b in rows])).alias("r")).select("r.*")


def notices(spark: SparkSession) -> DataFrame:
    return _constants(spark, [(k, t) for k, ts in NOTICES.items() for t in ts])


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(family, grams, held): made as the module says; at most a few thousand rows whatever the input."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("length(text) > 0")
    every = max(1, plain.count() // NEGATIVES)
    sample = (plain.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).filter(~F.col("text").rlike(CUES))
              .select("id", F.slice(words(F.substring("text", 1, 4000)), 1, WINDOW).alias("ws")).filter(F.size("ws") > 0))
    prose = materialize(sample, "license_prose")

    # Variant 0 is the notice itself; the others drop about a word in eight.
    varied = notices(spark).unionByName(_constants(spark, [(UNKNOWN, t) for t in SPEAKING_OF])).select(
        "family", words(F.col("notice")).alias("ws"), F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
    dropped = varied.select("family", "v", F.expr(
        "filter(ws, (w, i) -> v = 0 or pmod(xxhash64(w, i, v), 8) != 0)").alias("ws"))
    keyed = dropped.withColumn("k", F.pmod(F.xxhash64("ws", "v"), F.lit(40)))
    around = prose.select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("k"), F.slice("ws", 1, 12).alias("a"),
                          F.slice("ws", 13, 12).alias("z"))
    inside = keyed.join(F.broadcast(around), "k").select("family", F.concat("a", "ws", "z").alias("ws"))
    cue = F.element_at(F.array(*[F.lit(w) for w in ("license", "licence", "copyright", "licensed", "warranty")]),
                       (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int"))
    unknown = prose.select(F.lit(UNKNOWN).alias("family"), F.col("ws")).unionByName(prose.select(
        F.lit(UNKNOWN).alias("family"), F.concat(F.slice("ws", 1, 12), F.array(cue), F.slice("ws", 13, 12)).alias("ws")))
    rows = dropped.select("family", "ws").unionByName(inside).unionByName(unknown)
    return rows.select("family", grams(F.col("ws")).alias("grams"), (F.pmod(F.xxhash64("ws"), F.lit(3)) == 0).alias("held"))


@dataclass
class LicenseModel:
    families: list[str]
    hashing: HashingTF
    regression: LogisticRegressionModel
    least: float

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``grams``) plus family and probability; below the least probability it is unknown."""
        scored = self.regression.transform(self.hashing.transform(rows)).select(*rows.columns, vector_to_array("probability").alias("_p"))
        names = F.array(*[F.lit(f) for f in self.families])
        p = F.array_max("_p")
        best = F.element_at(names, F.array_position("_p", p).cast("int"))
        out = scored.select(*rows.columns, best.alias("_best"), p.alias("_most"))
        family = F.when((F.col("_best") != UNKNOWN) & (F.col("_most") >= self.least), F.col("_best")).otherwise(UNKNOWN)
        return out.select(*rows.columns, family.alias("family"), F.round("_most", 6).alias("probability"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenseModel:
    rows = materialize(training_rows(docs, id_col, text_col), "license_training")
    families = [UNKNOWN, *NOTICES]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    hashing = HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features", binary=True)
    data = hashing.transform(rows.withColumn("label", label)).select("features", "label", "held", F.col("family").alias("true_family"), "grams")
    fitted = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-4, standardization=False).fit(data.filter("not held"))
    # Only the probabilities are asked for.
    fitted.setRawPredictionCol("").setPredictionCol("")
    open_model = LicenseModel(families, hashing, fitted, 0.0)
    held = open_model.predict(data.filter(f"held and true_family = '{UNKNOWN}'").select("grams"))
    taken = held.select(F.when(F.col("family") != UNKNOWN, F.col("probability")).otherwise(0.0).alias("p"))
    limit = taken.agg(F.percentile("p", 1 - FALSE_RATE)).first()[0]
    return LicenseModel(families, hashing, fitted, min(0.99, max(LEAST_PROBABILITY, limit or 0.0)))


def confirm(predicted: DataFrame) -> DataFrame:
    """``predicted`` plus overlap and confirmed: the shared n-grams with the nearest notice of the family.

    The overlap is over the smaller n-gram set of the two.
    """
    spark = predicted.sparkSession
    known = notices(spark).groupBy(F.col("family").alias("_f")).agg(
        F.collect_list(F.array_distinct(grams(words(F.col("notice"))))).alias("_sets"))
    # Only what has a family is compared with notices.
    own = F.when(F.col("family") != UNKNOWN, F.array_distinct("grams"))
    joined = predicted.join(F.broadcast(known), F.col("family") == F.col("_f"), "left").withColumn("_own", own)
    share = "aggregate(_sets, 0D, (m, s) -> greatest(m, size(array_intersect(s, _own)) / least(size(s), size(_own))))"
    return joined.withColumn("overlap", F.coalesce(F.expr(share), F.lit(0.0))).withColumn(
        "confirmed", (F.col("family") != UNKNOWN) & (F.col("overlap") >= CONFIRM_OVERLAP)).drop("_f", "_sets", "_own")


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, part, cue, family, probability, overlap, confirmed) of each line and joined paragraph.

    A null or empty text has none. Repeated rows give repeated paragraphs; a
    null id stays null. Other columns are not read.
    """
    model = model or train(docs, id_col, text_col)
    return confirm(model.predict(paragraphs(docs, id_col, text_col))).drop("grams")


def per_document(found: DataFrame) -> DataFrame:
    """One row per doc_id of a scan's rows: lines with a cue, confirmed lines, their families and best probability, all lines.

    The windows of a line are united first. Counting distinct lines of several
    kinds at once would make a copy of every window for each kind, before it is
    scored. Families are united as bits, which needs no sorting.
    """
    names = sorted(NOTICES)
    known = F.array(*[F.lit(n) for n in names])
    bit = F.get(F.array(*[F.lit(1 << i) for i in range(len(names))]), (F.array_position(known, F.col("family")) - 1).cast("int"))
    bits, best = F.when(F.col("confirmed"), bit), F.when(F.col("confirmed"), F.col("probability"))
    lines = found.groupBy("doc_id", "line").agg(F.max("cue").alias("cue"), F.max("confirmed").alias("confirmed"),
                                                F.bit_or(bits).alias("bits"), F.max(best).alias("probability"))
    counted = lines.groupBy("doc_id").agg(
        F.count_if("cue").alias("n_cue"), F.count_if("confirmed").alias("n_confirmed"), F.coalesce(F.bit_or("bits"), F.lit(0)).alias("bits"),
        F.max("probability").alias("probability"), F.count(F.lit(1)).alias("n_lines"))
    taken = F.filter(known, lambda n, i: F.col("bits").bitwiseAND(F.get(F.array(*[F.lit(1 << k) for k in range(len(names))]), i)) != 0)
    return counted.select("doc_id", "n_cue", "n_confirmed", F.array_join(taken, ",").alias("families"), "probability", "n_lines")


def op6_license_scan(spark, sf_dir):
    """One row per document: its paragraphs with a cue, the confirmed ones and their families, all that were classified."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = per_document(scan_licenses(docs)).withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id").join(hit, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", F.coalesce("n_cue", F.lit(0)).alias("n_cue"), F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed"),
        F.coalesce("families", F.lit("")).alias("families"), "probability", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
