"""Licence scan with DataFrame and SQL functions only.

A text is compared with licence templates as a whole, line by line, and by runs of consecutive lines, as notices are
wrapped.  Texts and templates are normalised (lower case,
runs of anything but letters and digits become one space) and turned into sets of word bigrams; the score is the Dice
coefficient 2 * common / (a + b).  A template can only reach the threshold t if its number of bigrams lies between
a * t / (2 - t) and a * (2 - t) / t, so sizes prune the templates before any set is compared, and a line that is outside
the bounds of all templates is not turned into bigrams at all.

A run holds no bigram that the whole text does not, and a template needs a * t / (2 - t) of its own bigrams in common.
So runs are made only where the whole text has as many of some template's bigrams, and only up to twice the words that
the largest such template allows (words of which bigrams repeat count once in the score; a run that is more than half
repeats is not looked at).  Lines without a word are no part of a run.

Templates are a parameter: a short list, part of the expression, not a table that is joined.

Defined cases: null and empty texts have no licence; a text or line of fewer than two words has no bigrams and no score;
the best score wins, then the first template by name, then a single line before a run of few and of more lines, then the
first line (0 is the whole text; a run has the number of its first line); repeated rows get a row
each; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.8
#: Licence notices as they are usually written into files.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                      "later version.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                      "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                      "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                      "to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_OTHER = "[^\\p{L}\\p{N}]+"


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bigram_set(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1),
                        lambda i: F.concat(F.element_at(words, i), F.lit(" "), F.element_at(words, i + 1)))
    return F.array_distinct(pairs)


def _scores(i: int, name: str, grams: list[str], least: float, most: float) -> Column:
    """Scores of the units whose size is within the bounds of one template."""
    n, wanted = len(grams), F.array(*map(F.lit, grams))
    near = F.filter("units", lambda u: F.size(u["b"]).between(n * least, n * most))
    return F.transform(near, lambda u: F.struct(
        (F.lit(2.0) * F.size(F.array_intersect(u["b"], wanted)) / (F.size(u["b"]) + n)).alias("dice"),
        F.lit(-i).alias("first"), (-u["span"]).alias("span"), (-u["line"]).alias("line"), F.lit(name).alias("license")))


def _normal(x: Column) -> Column:
    """Words of a text; a text without any has one empty word."""
    return F.split(F.btrim(F.regexp_replace(F.lower(x), _OTHER, " ")), " ")


def _reached(sets: list[tuple[str, list[str]]], least: float) -> Column:
    """Size of the largest template that a run of lines may reach: the whole text has enough of its bigrams; 0 if none."""
    whole = F.get(F.filter("units", lambda u: u["line"] == 0), F.lit(0))["b"]
    every = F.array(*map(F.lit, sorted({g for _, grams in sets for g in grams})))
    hit = F.coalesce(F.array_intersect(whole, every), F.array().cast("array<string>"))
    return F.aggregate(F.array(hit), F.lit(0), lambda most, x: F.greatest(most, F.lit(0), *[
        F.when(F.size(F.array_intersect(x, F.array(*map(F.lit, grams)))) >= len(grams) * least, len(grams)).otherwise(0)
        for _, grams in sets]))


def _runs(size: Column, low: float, most: float) -> Column:
    """Units of two and more consecutive lines with words, each start with every end within the bound on words."""
    bound = F.floor(2 * size * most + 1).cast("int")
    lines = F.filter(F.transform(F.split("t", "\n"), lambda x, i: F.struct((i + 1).alias("line"), _normal(x).alias("w"))),
                     lambda x: F.get(x["w"], F.lit(0)) != "")
    return F.flatten(F.transform(F.array(lines), lambda own: F.flatten(F.transform(own, lambda x, i: _from(own, x, i, bound, low)))))


def _from(lines: Column, first: Column, i: Column, bound: Column, low: float) -> Column:
    """Units that start with one line."""
    none = F.array().cast("array<struct<line:int,span:int,w:array<string>>>")
    start = F.struct(first["w"].alias("w"), none.alias("found"), F.lit(True).alias("open"))

    def add(so_far: Column, x: Column) -> Column:
        words = F.concat(so_far["w"], x["w"])
        unit = F.struct(first["line"].alias("line"), (F.size(so_far["found"]) + 2).alias("span"), words.alias("w"))
        return F.when(so_far["open"] & (F.size(so_far["w"]) + F.size(x["w"]) <= bound),
                      F.struct(words.alias("w"), F.concat(so_far["found"], F.array(unit)).alias("found"), F.lit(True).alias("open"))
                      ).otherwise(F.struct(so_far["w"].alias("w"), so_far["found"].alias("found"), F.lit(False).alias("open")))

    units = F.aggregate(F.slice(lines, i + 2, bound), start, add, lambda done: done["found"])
    return F.filter(units, lambda u: F.size(u["w"]) - 1 >= F.greatest(F.lit(low), F.lit(1.0)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``(doc_id, license, dice, line)`` for each row of ``docs``; null, 0 and null where no template reaches the threshold."""
    sets = sorted((name, bigrams(t)) for name, t in (TEMPLATES if templates is None else templates).items())
    sets = [x for x in sets if x[1]]
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    low = min((len(b) for _, b in sets), default=1) * least
    high = max((len(b) for _, b in sets), default=0) * most
    text = F.coalesce(F.col("t"), F.lit(""))
    lines = F.concat(F.array(text), F.split(text, "\n"))  # line 0 is the whole text
    units = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    # a word and its gap are two characters at least: shorter units have too few bigrams
    long_enough = F.filter(units, lambda u: F.length(u["x"]) >= 2 * low + 1)
    words = F.transform(long_enough, lambda u: F.struct(
        u["line"].alias("line"), _normal(u["x"]).alias("w")))
    # repeated bigrams count once, so only the lower bound holds for words
    fitting = F.filter(words, lambda u: F.size(u["w"]) - 1 >= F.greatest(F.lit(low), F.lit(1.0)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).select(
        "doc_id", "t", F.transform(fitting, lambda u: F.struct(u["line"].alias("line"), F.lit(0).alias("span"),
                                                               _bigram_set(u["w"]).alias("b"))).alias("units"))
    if sets:
        runs = F.when(F.col("size") > 0, _runs(F.col("size"), low, most)).otherwise(
            F.array().cast("array<struct<line:int,span:int,w:array<string>>>"))
        rows = rows.select("*", _reached(sets, least).alias("size")).select("doc_id", "units", runs.alias("runs")).select(
            "doc_id", F.concat("units", F.transform("runs", lambda u: F.struct(
                u["line"].alias("line"), u["span"].alias("span"), _bigram_set(u["w"]).alias("b")))).alias("units"))
    sized = F.filter("units", lambda u: F.size(u["b"]).between(low, high))
    scores = [_scores(i, name, grams, least, most) for i, (name, grams) in enumerate(sets)]
    found = F.concat(*scores) if scores else F.array().cast("array<struct<dice:double,first:int,span:int,line:int,license:string>>")
    best = F.array_max(F.filter(found, lambda s: s["dice"] >= threshold))
    return rows.select("doc_id", sized.alias("units")).select("doc_id", best.alias("s")).select(
        "doc_id", F.col("s.license").alias("license"), F.coalesce(F.col("s.dice"), F.lit(0.0)).alias("dice"),
        (-F.col("s.line")).cast("int").alias("line"))


def oracle() -> str:
    """The same in DuckDB, comparing every unit with every template."""
    sets = sorted((name, bigrams(t)) for name, t in TEMPLATES.items())
    values = ", ".join(f"({i}, '{name}', [{', '.join(repr(g) for g in grams)}])" for i, (name, grams) in enumerate(sets))
    return f"""
        with t(i, license, g) as (values {values}),
        l as (select doc_id, unnest([coalesce(text, '')] || string_split(coalesce(text, ''), chr(10))) x,
                     generate_subscripts([coalesce(text, '')] || string_split(coalesce(text, ''), chr(10)), 1) - 1 line from documents),
        w as (select doc_id, line, string_split(trim(regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') w from l),
        b as (select doc_id, line, list_distinct([w[k] || ' ' || w[k + 1] for k in range(1, len(w))]) b from w where len(w) > 1),
        s as (select doc_id, i, license, line, 2.0 * len(list_intersect(b, g)) / (len(b) + len(g)) dice from b, t),
        r as (select *, row_number() over (partition by doc_id order by dice desc, i, line) n from s where dice >= {THRESHOLD})
        select d.doc_id, license, coalesce(cast(dice as double), 0.0) dice, cast(line as integer) line
        from documents d left join (select * from r where n = 1) r on d.doc_id = r.doc_id"""
