"""Licence notices found by Dice similarity of word bigrams, in DataFrame operations only."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licences and the notices that grant them (fixed values: the wording of the licences).
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
]
KINDS = ("text", "paragraph", "line", "run")
#: Words that turn one licence into another: a run of words has those of its template and no others.
QUALIFIERS = set("affero alike commercial derivatives lesser library nc nd noderivatives noderivs noncommercial sa sharealike".split())
#: Words that tell little; others are looked for first.
COMMON = set("a an and any as at by copy file for free from in is it may met not of on or other that the this to use version with without you".split())


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip().split(" ")


def bigrams(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """Fewest and most bigrams that a text with Dice ``least`` to a template of ``size`` can have."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def telling_words(templates: list[list[str]], least: float) -> list[str]:
    """Words of which every text that is near enough to a template holds one at least.

    Such a text has the bigrams of the template but for b - least * b / (2 - least) of
    them; it therefore has one of any set of more than so many. Words are added, those
    not COMMON and the longest first, until enough of each template's bigrams hold one.
    """
    words: list[str] = []
    for t in sorted(templates, key=len):
        need = len(t) - size_bounds(len(t), least)[0] + 1
        for w in sorted({w for b in t for w in b.split()} - set(words), key=lambda w: (w in COMMON, -len(w), w)):
            if sum(any(x in words for x in b.split()) for b in t) >= need:
                break
            words.append(w)
    return sorted(words)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _runs(rows: DataFrame, listed: list[tuple[str, str]], least: float) -> DataFrame:
    """(id, kind, i, m) of the runs of words that match a template."""
    own = [(i, name, words_of(text), bigrams(text)) for i, (name, text) in enumerate(listed)]
    own = [t for t in own if t[3]]
    schema = "struct<dice: double, template: int, license: string>"
    starts = sorted({b for t in own for b in t[3]})
    longest = max((len(t[2]) for t in own), default=0)
    rows = rows.select("id", F.split(_normal(F.col("text")), " ").alias("w")).where(F.size("w") > 1)
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)).isin(starts))
    rows = rows.select("id", F.explode(F.transform(at, lambda i: F.struct(i.cast("long").alias("i"), F.slice("w", i + 1, longest).alias("r")))).alias("u")).select("id", "u.i", "u.r")
    pairs = F.transform(F.sequence(F.lit(0), F.size("r") - 2), lambda i: F.concat_ws(" ", F.get("r", i), F.get("r", i + 1)))
    rows = rows.select("id", "i", "r", pairs.alias("p"))
    found = []
    for i, name, words, b in own:
        run, near = F.slice("r", 1, len(words)), F.array_distinct(F.slice("p", 1, len(words) - 1))
        needed = sorted({w for w in words if w.isdigit() or w in QUALIFIERS})
        others = sorted(QUALIFIERS - set(words))
        dice = 2.0 * F.size(F.array_intersect(near, F.array(*map(F.lit, b)))) / (F.size(near) + len(b))
        same = ~F.arrays_overlap(run, F.array(*map(F.lit, others)))
        for w in needed:
            same = same & F.array_contains(run, w)
        found.append(F.struct(F.when(F.get("p", F.lit(0)).isin(b), F.when(same, dice)).alias("dice"), F.lit(i).alias("template"), F.lit(name).alias("license")))
    near = F.filter(F.array(*found), lambda m: m["dice"] >= least) if found else F.array().cast(f"array<{schema}>")
    return rows.select("id", F.lit(3).alias("kind"), "i", F.explode(near).alias("m"))


def scan(docs: DataFrame, least: float = 0.8, notices: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, template, unit, number, dice): the best match of each licence in each document.

    Compared are the whole text, its paragraphs (between blank lines) and its lines, each
    lower-cased with everything but a-z and 0-9 as spaces. The Dice coefficient is
    2 |A n B| / (|A| + |B|) over distinct word bigrams; ``least`` or more is a match.
    Texts without any of the templates' telling words are passed over, which loses no
    match, and a template is compared only with units whose number of bigrams lies within
    the bounds for a match. ``template`` is its place among the notices, ``unit`` text,
    paragraph or line, ``number`` its place from 1. Ties: the smaller unit, the earlier one,
    the earlier template.

    A notice beside other words, in a sentence or in lines with comment signs, is none of
    these units. A licence without a match among them is looked for in all runs of words
    of a template's length that begin with one of its bigrams (shorter at the text's end),
    across lines. Such a run has the template's numbers and QUALIFIERS, and no
    other QUALIFIERS. ``unit`` is then run, ``number`` the place of its first word.

    Units of a word or none, null and empty texts match nothing. Repeated rows (one id)
    give one match per licence; rows with a null id are taken together. An empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    listed = NOTICES if notices is None else notices
    own = [(i, name, bigrams(text)) for i, (name, text) in enumerate(listed)]
    own = [t for t in own if t[2]]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = telling_words([t[2] for t in own], least)
    rows = rows.where(F.lower("text").rlike("(?<![a-z0-9])(?:" + "|".join(words) + ")(?![a-z0-9])") if own else F.lit(False))

    def units(kind: int, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), p.alias("p")))

    each = F.concat(units(0, F.array("text")), units(1, F.split("text", r"\n[ \t\r]*\n")), units(2, F.split("text", "\n")))
    runs = _runs(rows, listed, least)
    rows = rows.select("id", F.explode(each).alias("u")).select("id", "u.kind", "u.i", F.split(_normal(F.col("u.p")), " ").alias("w"))
    lowest = min((size_bounds(len(t[2]), least)[0] for t in own), default=0)
    rows = rows.where((F.size("w") > 1) & (F.size("w") > lowest))
    pairs = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)))
    rows = rows.select("id", "kind", "i", F.array_distinct(pairs).alias("b"))

    found = []
    for i, name, b in own:
        lo, hi = size_bounds(len(b), least)
        both = F.size(F.array_intersect("b", F.array(*map(F.lit, b))))
        dice = F.when(F.size("b").between(lo, hi), 2.0 * both / (F.size("b") + len(b)))
        found.append(F.struct(dice.alias("dice"), F.lit(i).alias("template"), F.lit(name).alias("license")))
    near = F.filter(F.array(*found), lambda m: m["dice"] >= least) if found else F.array().cast("array<struct<dice: double, template: int, license: string>>")
    matches = rows.select("id", "kind", "i", F.explode(near).alias("m")).unionByName(runs)
    best = F.max(F.struct((F.col("kind") < 3).alias("whole"), "m.dice", "kind", (-F.col("i")).alias("early"), (-F.col("m.template")).alias("first"))).alias("x")
    out = matches.groupBy("id", F.col("m.license").alias("license")).agg(best)
    unit = F.element_at(F.array(*map(F.lit, KINDS)), F.col("x.kind") + 1)
    return out.select(F.col("id").alias(id_col), "license", (-F.col("x.first")).alias("template"), unit.alias("unit"), (1 - F.col("x.early")).alias("number"), F.col("x.dice").alias("dice"))


def sql(least: float = 0.8) -> str:
    """The same matches by comparing every unit with every template."""
    values = ", ".join("({}, '{}', [{}])".format(i, name, ", ".join(f"'{b}'" for b in bigrams(text))) for i, (name, text) in enumerate(NOTICES))
    return f"""
WITH t(template, license, tb) AS (VALUES {values}),
u AS (
  SELECT doc_id, 0 AS kind, 1 AS number, text AS p FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 1, unnest(range(1, len(x) + 1)), unnest(x) FROM (SELECT doc_id, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS x FROM documents WHERE text IS NOT NULL)
  UNION ALL SELECT doc_id, 2, unnest(range(1, len(x) + 1)), unnest(x) FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)
),
words AS (SELECT doc_id, kind, number, string_split(trim(regexp_replace(lower(p), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u),
b AS (SELECT doc_id, kind, number, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) > 1),
m AS (
  SELECT doc_id, kind, number, template, license, 2.0::DOUBLE * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice
  FROM b, t WHERE list_has_any(b, tb)
)
SELECT doc_id, license, template, ['text', 'paragraph', 'line'][kind + 1] AS unit, number, dice
FROM m WHERE dice >= {least}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, kind DESC, number, template) = 1
"""
