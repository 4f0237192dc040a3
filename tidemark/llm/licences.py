"""Licence notices by paragraph: a trained n-gram classifier with an unknown class, confirmed against templates.

DataFrame functions and the DataFrame-based learning library only; no Python runs on the executors.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Usual short notices, opening words, and whole standard paragraphs of licence families.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd", "Use of this source code is governed by a BSD-style license."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc0", "Released into the public domain under CC0 1.0 Universal."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
UNKNOWN = "unknown"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _followed(left: Column, words: Column, by: int) -> Column:
    """Every entry of ``left`` but the last with the word ``by`` places on."""
    ends = F.slice(words, by + 1, F.size(words))
    return F.zip_with(F.slice(left, 1, F.size(ends)), ends, lambda x, y: F.concat_ws(" ", x, y))


def _on_grams(words: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the 2-grams and of the 3-grams, in order, with repeats."""
    return _bound(words, lambda w: _bound(_followed(w, w, 1), lambda two: _bound(_followed(two, w, 2), lambda three: body(two, three))))


def grams_of(words: Column) -> Column:
    """Word 2-grams and 3-grams, in order, with repeats; none if there are fewer than two words."""
    return _on_grams(words, lambda two, three: F.concat(two, three))


def template_grams_of(words: Column, wanted: list[str]) -> Column:
    """Struct of the distinct grams in ``wanted`` and the number of all distinct grams; null without one in ``wanted``.

    Every wanted 3-gram begins with a wanted 2-gram, so most lines are done after their 2-grams.
    """
    twos, threes = ([g for g in wanted if g.count(" ") == n] for n in (1, 2))

    def rest(words: Column, two: Column, found: Column) -> Column:
        def both(three: Column) -> Column:
            longer = F.array_distinct(F.filter(three, lambda g: g.isin(threes)))
            n = F.size(F.array_distinct(two)) + F.size(F.array_distinct(three))
            return F.struct(F.concat(found, longer).alias("grams"), n.alias("n"))

        return F.when(F.size(found) > 0, _bound(_followed(two, words, 2), both))

    def first(words: Column, two: Column) -> Column:
        return _bound(F.array_distinct(F.filter(two, lambda g: g.isin(twos))), lambda found: rest(words, two, found))

    return _bound(words, lambda w: _bound(_followed(w, w, 1), lambda two: first(w, two)))


def _templates(spark) -> DataFrame:
    rows = [(i, family, text) for i, (family, text) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, family string, line string").withColumn("words", words_of(F.col("line")))


def _examples(templates: DataFrame, lines: DataFrame, sample: int, wanted: list[str]) -> DataFrame:
    """Whole templates and all their windows of two thirds of the words, against lines of the corpus.

    Of a line only the ``wanted`` grams are kept, those that weigh something.
    """
    size = F.size("words")
    width = F.ceil(size * 2 / 3).cast("int")
    windows = templates.select(
        "family", F.explode(F.transform(F.sequence(F.lit(1), size - width + 1), lambda i: F.slice("words", i, width))).alias("words")
    )
    # The last example, of a word that no text holds, stands for the unknown class on an empty corpus.
    blank = templates.limit(1).select(F.lit(UNKNOWN).alias("family"), F.array(F.lit("")).alias("words"))
    known = templates.select("family", "words").union(windows).union(blank)
    # Only hashes are told apart over the corpus; the few lines that they stand for are looked up again.
    hashed = lines.select("line", F.xxhash64("line").alias("hash"))
    several = F.lower("line").rlike(r"[\p{L}\p{N}][^\p{L}\p{N}]+[\p{L}\p{N}]")
    smallest = hashed.where(several).select("hash").distinct().orderBy("hash").limit(sample)
    rest = hashed.join(F.broadcast(smallest), "hash").select("line").distinct().withColumn("words", words_of(F.col("line")))
    own = F.explode_outer(F.array(template_grams_of(F.col("words"), wanted))).alias("own")
    unlike = rest.select("words", own).where("own IS NULL OR 2 * size(own.grams) < own.n")
    unlike = unlike.select(F.lit(UNKNOWN).alias("family"), "words", F.coalesce("own.grams", F.array().cast("array<string>")).alias("grams"))
    return known.withColumn("grams", grams_of(F.col("words"))).union(unlike)


def _softmax_loss(rows, families: list[str], temperature: float) -> float:
    loss = 0.0
    for logits, family in rows:
        scaled = [x / temperature for x in logits]
        top = max(scaled)
        loss += top + math.log(sum(math.exp(x - top) for x in scaled)) - scaled[families.index(family)]
    return loss / max(1, len(rows))


def train(lines: DataFrame, sample: int = 2000) -> tuple[DataFrame, dict[str, float], float]:
    """(weights per gram and family, intercepts, temperature) from templates and at most ``sample`` lines.

    The lines (column ``line``) are those of at least two words with the smallest hashes and stand for the unknown class.

    The vocabulary holds the grams of the templates only: other grams weigh nothing. The temperature is the one with
    the least loss on a fifth of the examples, which the weights have not seen.
    """
    spark = lines.sparkSession
    templates = _templates(spark)
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True)
    vocabulary = counter.fit(templates.withColumn("grams", grams_of(F.col("words"))))
    # The learner passes over them for every iteration: their number is bounded, so a few tasks will do.
    examples = _examples(templates, lines, sample, vocabulary.vocabulary).coalesce(4).cache()
    families = sorted({f for f, _ in TEMPLATES}) + [UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    ready = vocabulary.transform(examples).withColumn("label", label)
    held = F.pmod(F.xxhash64(F.array_join("words", " ")), F.lit(5)) == 0
    whole = (F.col("family") != UNKNOWN) & (F.size("words") < 8)
    learner = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, standardization=False)
    model = learner.fit(ready.where(~held | whole))
    logits = model.transform(ready.where(held)).select("rawPrediction", "family").collect()
    rows = [(r["rawPrediction"].toArray().tolist(), r["family"]) for r in logits]
    temperature = min((_softmax_loss(rows, families, t / 10), t / 10) for t in range(2, 31))[1] if rows else 1.0
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    table = [(gram, [float(x) for x in matrix[:, i]]) for i, gram in enumerate(vocabulary.vocabulary)]
    examples.unpersist()
    weights = spark.createDataFrame(table, "gram string, weights array<double>")
    return weights, dict(zip(families, (float(b) for b in bias), strict=True)), temperature


def scan_licences(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_probability: float = 0.5,
    least_overlap: float = 0.5,
    sample: int = 2000,
    model: tuple | None = None,
) -> DataFrame:
    """One row per paragraph that the classifier gives to a licence family: id, ``paragraph`` (number of its first line,
    from 0), ``line`` (its lines), ``family``, ``probability``, ``template`` (the closest of the family), ``overlap``,
    ``confirmed``.

    Every line of every text is scored where it is read: its 2-grams and 3-grams meet the weights of the trained
    classifier, a table of the templates' grams that does not grow with the corpus; sums per line give the logits, of
    which the unknown class is one. A line without a template gram is unknown and goes no further. Successive lines of
    which at least a third of the grams is in a template make a paragraph, so that wrapped notices come together without
    the text around them; paragraphs of several lines are scored once more as wholes. ``overlap`` is the share of the template's grams that the paragraph has; a
    prediction is confirmed from ``least_overlap`` on.

    A line that is confirmed by itself stands for its paragraph, if the family is the same. Other lines of a confirmed
    paragraph, and unconfirmed paragraphs with a line of their own in the result, give no row. Successive lines that
    hold whole wrapped notices of two families give the likelier one.

    ``model`` is what :func:`train` gives; without one it is trained here, with ``sample`` lines of the corpus.

    Null and empty texts have no lines; equal (id, text) rows are one document and give each result once. Lines of any
    length are scored whole. Other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    lines = df.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), F.posexplode(F.split(text, "\n", -1)).alias("paragraph", "line")
    )
    weights, bias, temperature = model or train(lines, sample)
    families = list(bias)
    names = F.array(*[F.lit(f) for f in families])
    # Bounded by the templates: what the tasks get are literals.
    table = {r["gram"]: r["weights"] for r in weights.collect()}
    weight = F.from_json(F.lit(json.dumps(table)), "map<string,array<double>>")
    def score(units: DataFrame) -> DataFrame:
        """Row by row, without a shuffle. The generators keep Spark from computing a column again in a filter on it."""
        own = units.select("id", "key", "paragraph", "line", F.explode_outer(F.array(template_grams_of(words_of(F.col("line")), list(table)))).alias("own"))
        own = own.where("own IS NOT NULL").select("id", "key", "paragraph", "line", "own.grams", "own.n")
        summed = F.aggregate(
            "grams",
            F.array(*[F.lit(bias[f]) for f in families]),
            lambda total, g: F.zip_with(total, F.element_at(weight, g), lambda a, x: a + x),
            lambda total: F.transform(total, lambda a: a / temperature),
        )
        scored = own.select("*", F.explode_outer(F.array(summed)).alias("logits")).withColumn("top", F.array_max("logits"))
        total = F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
        scored = scored.withColumn("probability", 1 / total)
        scored = scored.withColumn("family", F.element_at(names, F.array_position("logits", F.col("top")).cast("int")))
        known = (F.col("family") != UNKNOWN) & (F.col("probability") >= least_probability)
        return scored.select("id", "key", "paragraph", "line", "family", "probability", "grams", "n", known.alias("known"))

    scored = score(lines).withColumn("like", 3 * F.size("grams") >= F.col("n"))
    scored = scored.where(F.col("known") | F.col("like")).dropDuplicates(["key", "paragraph"])
    scored = materialise(scored, "licence-lines")
    # Lines in succession differ from their place among the lines by the same number.
    place = F.row_number().over(Window.partitionBy("key").orderBy("paragraph"))
    runs = scored.where("like").withColumn("island", F.col("paragraph") - place)
    runs = runs.withColumn("run", F.min("paragraph").over(Window.partitionBy("key", "island")))
    wrapped = runs.groupBy("id", "key", "run").agg(F.sort_array(F.collect_list(F.struct("paragraph", "line"))).alias("all"))
    wrapped = wrapped.where(F.size("all") > 1).select("id", "key", F.col("run").alias("paragraph"), F.array_join("all.line", "\n").alias("line"))
    wrapped = score(wrapped).where("known")
    columns = ["id", "key", "paragraph", "line", "family", "probability", "grams", "run", "whole"]
    alone = scored.where("known").join(runs.select("key", "paragraph", "run"), ["key", "paragraph"], "left")
    alone = alone.withColumn("run", F.coalesce("run", -1 - F.col("paragraph"))).withColumn("whole", F.lit(False)).select(columns)
    found = alone.union(wrapped.withColumn("run", F.col("paragraph")).withColumn("whole", F.lit(True)).select(columns))

    templates = _templates(df.sparkSession).select(
        "template", "family", F.array_distinct(grams_of(F.col("words"))).alias("wanted")
    )
    matched = found.join(F.broadcast(templates), "family")
    matched = matched.withColumn("overlap", F.size(F.array_intersect("grams", "wanted")) / F.size("wanted"))
    best = matched.groupBy("id", "key", "paragraph", "line", "family", "probability", "run", "whole").agg(
        F.max(F.struct("overlap", (-F.col("template")).alias("t"))).alias("best")
    )
    best = best.withColumn("confirmed", F.col("best.overlap") >= least_overlap)
    together = Window.partitionBy("key", "run")
    best = best.withColumn("by_line", F.collect_set(F.when(~F.col("whole") & F.col("confirmed"), F.col("family"))).over(together))
    best = best.withColumn("lines", F.count_if(~F.col("whole")).over(together))
    best = best.withColumn("as_whole", F.max(F.col("whole") & F.col("confirmed")).over(together))
    stays = F.when(~F.col("whole"), F.col("confirmed") | ~F.col("as_whole"))
    stays = stays.when(F.col("confirmed"), ~F.array_contains("by_line", F.col("family"))).otherwise(F.col("lines") == 0)
    return best.where(stays).select(
        F.col("id").alias(id_col), "paragraph", "line", "family", "probability",
        (-F.col("best.t")).alias("template"), F.col("best.overlap").alias("overlap"), "confirmed",
    ).dropDuplicates([id_col, "paragraph", "line"])
