"""Licence scans by Dice coefficient over word bigrams (operator 6).

Lines, paragraphs, runs of up to ``WINDOW`` paragraphs and whole texts are normalised
to lower-case words and compared with licence templates.  Paragraphs are parted by lines
without a letter or digit of ASCII, so a notice that is wrapped over the lines of a
comment is one. With a bigrams in the text, b in the template and i in
common (repeats counted), the coefficient is ``2 i / (a + b)``; it can reach t
only if ``b * t / (2 - t) <= a <= b * (2 - t) / t``, so a unit meets just the
templates of a fitting size, by an equi-join on the size.  It also needs
``b * t / (2 - t)`` bigrams of the template, so of any larger share of the
template's bigrams at least one; words that such a share must hold are looked for
first, in whole texts and then in units.  Everything is DataFrame expressions.

A row's ``line`` is a line's number from 0; -1 for the whole text; for a run of
paragraphs -2 less the number of its first, and ``paragraphs`` is how many there are (0 for lines
and whole texts).  A notice inside a longer line or paragraph, or one of more than
``WINDOW`` paragraphs in a longer text, reaches the threshold in no unit.

A null text has no lines; lines of one word have no bigrams and match nothing.
Ties between templates go to the name that sorts first.  Repeated rows give
their own rows, and an empty table none.
"""

from __future__ import annotations

import re
from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import table

#: Up to so many templates go to every task; more are joined by a shuffle.
THRESHOLD, MOST_TEMPLATES, WINDOW = 0.8, 5000, 4
#: What parts paragraphs: line ends with nothing between them that has a word.
PARTED = r"\n(?:[^A-Za-z0-9\n]*\n)+"

#: Licence notices (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT full text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits, parted by single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def word_count(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(F.char_length(normal) - F.char_length(F.replace(normal, F.lit(" "))) + 1)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bigrams(normal: Column) -> Column:
    """All bigrams of a normalised text of two words or more; a repeat carries its number."""

    def pairs(words: Column) -> Column:
        return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))

    def numbered(plain: Column) -> Column:
        counted = F.transform(plain, lambda b, i: F.concat(b, F.lit(" "), F.size(F.filter(F.slice(plain, F.lit(1), i), lambda x: x == b)).cast("string")))
        first = F.transform(plain, lambda b: F.concat(b, F.lit(" 0")))
        return F.when(F.size(F.array_distinct(plain)) == F.size(plain), first).otherwise(counted)

    return bound(bound(F.split(normal, " "), pairs), numbered)


def anchors(templates: dict[str, str], threshold: float) -> list[str]:
    """Words of which a text holds at least one, if any template reaches the threshold with it."""
    chosen: set[str] = set()
    for text in templates.values():
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        pairs = list(zip(words, words[1:]))
        need = len(pairs) - ceil(len(pairs) * threshold / (2 - threshold) - 1e-9) + 1
        open_pairs = [p for p in pairs if not chosen & set(p)]
        while pairs and len(pairs) - len(open_pairs) < need:
            gain = Counter(w for p in open_pairs for w in set(p))
            chosen.add(max(gain, key=lambda w: (len(w) > 4, gain[w], len(w), w)))
            open_pairs = [p for p in open_pairs if not chosen & set(p)]
    return sorted(chosen)


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, line, paragraphs, unit``: lines, runs of paragraphs of several lines, and whole texts of several lines."""
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = F.split("text", "\n")
    unit = lambda line, n, text: F.struct(line.cast("int").alias("line"), F.lit(n).alias("paragraphs"), text.alias("unit"))
    all_lines = F.transform(lines, lambda x, i: unit(i, 0, x))
    none = F.slice(all_lines, 1, 0)
    whole = F.when(F.size(lines) > 1, F.array(unit(F.lit(-1), 0, F.col("text")))).otherwise(none)

    def runs_of(parts: Column, n: int) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size(parts) - n + 1), lambda k: unit(-k - 1, n, F.array_join(F.slice(parts, k, n), "\n")))
        several = F.filter(made, lambda u: F.contains(u["unit"], F.lit("\n"))) if n == 1 else made
        return F.when(F.size(parts) > n, several).otherwise(none)

    def runs(parts: Column) -> Column:
        return F.concat(*(runs_of(parts, n) for n in range(1, WINDOW + 1)))

    return rows.select("id", F.explode(F.concat(all_lines, whole, bound(F.split("text", PARTED), runs))).alias("u")).select("id", "u.line", "u.paragraphs", "u.unit")


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, line, paragraphs, license, dice``: the best template of each unit that reaches the threshold."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    sent = F.broadcast if len(templates) <= MOST_TEMPLATES else lambda df: df
    known = spark.createDataFrame(sorted(templates.items()), "license string, template string").select("license", normalised(F.col("template")).alias("t"))
    known = known.withColumn("b", word_count(F.col("t")) - 1).where("b > 0")
    sizes = F.sequence(F.greatest(F.lit(1), F.ceil(F.col("b") * (threshold / (2 - threshold)) - 1e-9).cast("int")), F.floor(F.col("b") * ((2 - threshold) / threshold) + 1e-9).cast("int"))
    # A template's bigrams are held once; what repeats for each fitting size is its name.
    fitting, grams = known.select("license", "b", F.explode(sizes).alias("a")), known.select("license", bigrams(F.col("t")).alias("theirs"))
    # Without anchors no template has a bigram, and the pattern matches nothing.
    pattern = F.lit("(?<![a-z0-9])(?:" + ("|".join(anchors(templates, threshold)) or "(?!)") + ")(?![a-z0-9])")
    may = lambda c: F.regexp_like(F.lower(c), pattern)
    rows = units(docs.where(may(F.col(text_col))), id_col, text_col).where(may(F.col("unit"))).select("id", "line", "paragraphs", normalised(F.col("unit")).alias("n"))
    rows = rows.withColumn("a", word_count(F.col("n")) - 1)
    most = fitting.agg(F.max("a")).first()[0] or 0
    rows = rows.where((F.col("a") > 0) & (F.col("a") <= most)).withColumn("ours", bigrams(F.col("n")))
    common = F.size(F.array_intersect("ours", "theirs"))
    met = rows.join(sent(fitting), "a").join(sent(grams), "license").select("id", "line", "paragraphs", "license", (2.0 * common / (F.col("a") + F.col("b"))).alias("dice")).where(F.col("dice") >= threshold)
    best = F.min(F.struct((-F.col("dice")).alias("d"), "license"))
    found = met.groupBy("id", "line", "paragraphs").agg(best.alias("x"))
    return found.select(F.col("id").alias(id_col), F.col("line").cast("long").alias("line"), F.col("paragraphs").cast("long").alias("paragraphs"), "x.license", (-F.col("x.d")).alias("dice"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_bigrams(words: str) -> str:
    return f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def _sql_normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'))"


ORACLE = rf"""
WITH t0 AS (SELECT * FROM (VALUES {", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in TEMPLATES.items())}) v(license, template)),
t1 AS (SELECT license, string_split({_sql_normal("template")}, ' ') AS w FROM t0),
t2 AS (SELECT license, unnest({_sql_bigrams("w")}) AS g, len(w) - 1 AS b FROM t1),
t AS (SELECT license, g, b, count(*) AS n FROM t2 GROUP BY ALL),
p AS (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS k FROM (SELECT doc_id, regexp_split_to_array(text, '{PARTED}') AS ps FROM documents WHERE contains(text, chr(10)))),
u0 AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line, 0 AS paragraphs, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, -1, 0, text FROM documents WHERE contains(text, chr(10))
    UNION ALL SELECT doc_id, -1 - k, n, array_to_string(ps[k:k + n - 1], chr(10)) FROM p, range(1, {WINDOW + 1}) r(n) WHERE n < len(ps) AND k + n - 1 <= len(ps) AND (n > 1 OR contains(ps[k], chr(10)))),
u1 AS (SELECT doc_id, line, paragraphs, string_split({_sql_normal("unit")}, ' ') AS w FROM u0),
u2 AS (SELECT doc_id, line, paragraphs, len(w) - 1 AS a, unnest({_sql_bigrams("w")}) AS g FROM u1 WHERE len(w) > 1),
u AS (SELECT doc_id, line, paragraphs, a, g, count(*) AS n FROM u2 GROUP BY ALL),
m AS (SELECT doc_id, line, paragraphs, license, 2.0::DOUBLE * sum(least(u.n, t.n))::BIGINT / (any_value(a) + any_value(b)) AS dice FROM u JOIN t USING (g) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line, paragraphs ORDER BY dice DESC, license) AS r FROM m WHERE dice >= {THRESHOLD})
SELECT doc_id, line::BIGINT AS line, paragraphs::BIGINT AS paragraphs, license, dice FROM k WHERE r = 1
"""
