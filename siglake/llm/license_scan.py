"""Licence notices by the Dice coefficient over word bigrams.

Texts and lines are normalised to lower-case words. The coefficient of two bigram sets
can reach a limit only if their sizes are within a factor of each other, which prunes
the templates for a line before anything is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import filled, let, with_once

# The wording of notices in common use.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License.",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
)
LEAST = 0.8


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; a dot between digits stays, as in 2.0."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; the word itself if there is only one."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) >= 2, F.array_distinct(pairs)).otherwise(words)


def _template_bigrams(spark, templates) -> list[list[str]]:
    rows = spark.createDataFrame(list(enumerate(t for _, t in templates)), "i int, t string")
    found = rows.select("i", bigrams(normal_words(F.col("t"))).alias("b")).collect()
    return [r["b"] for r in sorted(found, key=lambda r: r["i"])]


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = LEAST,
    text_col: str = "text",
    name: str = "licenses",
) -> DataFrame:
    """All rows and columns of ``docs`` and the array column ``name``.

    Its structs (``license``, ``line`` from 1, 0 for the whole text, ``dice``) are the
    lines and whole texts whose coefficient with a template is ``least`` or more; of a
    licence's templates the closest counts. A missing or empty text has none; of equal
    coefficients all licences are listed, in order. Templates are a small literal table.
    A column ``name`` is replaced. Rows stay in their task.
    """
    rest = docs.drop(name)
    wanted = _template_bigrams(docs.sparkSession, templates)
    # Both sizes are known: dice = 2 * shared / (n + m) <= 2 * min / (n + m).
    low = min(len(b) for b in wanted) * least / (2 - least) - 1e-9
    high = max(len(b) for b in wanted) * (2 - least) / least + 1e-9
    licences = sorted({licence for licence, _ in templates})

    def closest(found: Column, licence: str) -> Column:
        n = F.size(found)
        scores = []
        for (name_, _), b in zip(templates, wanted):
            if name_ == licence:
                near = (n * (2 - least) >= len(b) * least) & (len(b) * (2 - least) >= n * least)
                dice = 2 * F.size(F.array_intersect(found, F.array(*[F.lit(x) for x in b]))) / (n + len(b))
                scores.append(F.when(near, dice).otherwise(F.lit(0.0)))
        return F.greatest(*scores) if len(scores) > 1 else scores[0]

    def of_line(line: Column, number: Column) -> Column:
        none = F.array().cast("array<struct<license:string,line:int,dice:double>>")
        rows = lambda found: F.filter(
            F.array(*[F.struct(F.lit(x).alias("license"), number.cast("int").alias("line"), closest(found, x).alias("dice")) for x in licences]),
            lambda s: s["dice"] >= least,
        )
        sized = lambda words: F.when(
            F.size(words) >= low, let(bigrams(words), lambda found: F.when(F.size(found).between(low, high), rows(found)).otherwise(none))
        ).otherwise(none)
        return let(normal_words(line), sized)

    text = filled(text_col)
    lines = F.flatten(F.transform(F.split(text, "\n", -1), lambda x, i: of_line(x, i + 1)))
    found = F.concat(of_line(text, F.lit(0)), lines)
    return with_once(rest, name, F.sort_array(found))


def best(found: Column) -> Column:
    """The licence with the highest coefficient, the first by name of equal ones."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct((-s["dice"]).alias("d"), s["license"].alias("license"))))
    return F.get(ordered, 0)["license"]
