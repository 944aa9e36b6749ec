"""License scans in DataFrame functions only (operator 6).

The whole text is normalised (lower case, letters and digits, single spaces,
so line breaks and comment marks part nothing) and compared with license
templates by the Dice coefficient of the sets of word bigrams.  A unit is a
window that starts at any bigram of the text that the template has too, of the
template's length or a quarter longer.  A coefficient of t needs sets whose
sizes differ by a factor of at most (2 - t) / t and t n / (2 - t) shared
bigrams of a template of n: windows with fewer are never made, and a text
without one of a template's longest n - t n / (2 - t) + 1 bigrams has no match.
A match falls if another license shares more bigrams with a window over half of
it or more (as many, at a higher score): GPL 3 is no GPL 2, a BSD text no
shorter BSD text.  ``SPDX-License-Identifier`` tags count as they stand.

Everything is computed within the row, in stretches of SEGMENT bigrams with the
longest window on both sides: no shuffle, however many documents there are.

Cases: null text is empty text; a text of one word has no bigram and matches
nothing but tags; windows at the end of a text are cut there; licenses that
share and score the same are all named, the first by name as the best; other
columns are never read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import whole_text

THRESHOLD = 0.8
STRETCH = 5         # quarters of a template's length that the longer window has
SEGMENT = 1024
PLACE = "struct<name:string,shared:int,score:double,s:int,e:int>"
SPDX_ID = "[A-Za-z0-9][A-Za-z0-9.+-]*"
TAG = rf"SPDX-License-Identifier:([ \t(]*{SPDX_ID}(?:[) \t]+(?:AND|OR|WITH)[( \t]+{SPDX_ID})*)"
EXCEPTION, SUFFIX = rf"WITH[ \t]+{SPDX_ID}", r"(-only|-or-later|\+)?[-.+]*$"
# License texts and notices.
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
       "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
       "the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.")
# Notices and short license texts by SPDX name; a parameter of ``scan``.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    # the sentence that all BSD texts open with; the texts of two and three clauses share more with their own templates
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("BSD-2-Clause", BSD),
    ("BSD-3-Clause", BSD + " " + BSD_THIRD),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def all_bigrams(word_list: Column) -> Column:
    """Pairs of neighbouring words in order; none for fewer than two words."""
    return F.zip_with(F.slice(word_list, 1, F.size(word_list) - 1), F.slice(word_list, 2, F.size(word_list)),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def template_sets(spark, templates) -> list[tuple[str, int, list[str]]]:
    """(name, length in bigrams, distinct bigrams) of each template, by the same functions as the documents."""
    rows = spark.createDataFrame([(k, n, t) for k, (n, t) in enumerate(templates)], "k int, name string, text string")
    cut = rows.withColumn("words", words(F.col("text"))).select("k", "name", F.size("words").alias("n"), F.array_distinct(all_bigrams(F.col("words"))).alias("grams"))
    return [(r.name, r.n - 1, r.grams) for r in cut.orderBy("k").collect() if r.grams]


def lengths(n: int) -> list[int]:
    """Window lengths for a template of n bigrams."""
    return sorted({n, -(-n * STRETCH // 4)})


def least_shared(n: int, threshold: float) -> int:
    """Distinct bigrams of a template of n that every match shares with it."""
    return math.ceil(threshold * n / (2 - threshold) - 1e-9)


def _among(grams) -> str:
    return "({})".format(", ".join(f"'{g}'" for g in grams))


def _matches(name: str, length: int, grams: list[str], threshold: float) -> str:
    """SQL over a stretch s (lo, to, g) and its hits (i, x): one template's matching windows."""
    n, least, own = len(grams), least_shared(len(grams), threshold), _among(grams)
    factor = (2 - threshold) / threshold
    longest = max(lengths(length))
    near = f"""filter(p, (q, j) -> q < s.to AND get(p, j + {least - 1}) < q + {longest})"""
    windows = ", ".join(f"array_distinct(slice(s.g, q + 1, {m}))" for m in lengths(length))
    ends = ", ".join(str(m) for m in lengths(length))
    scored = f"""transform(array({windows}), (w, k) -> named_struct('n', size(w), 'e', least(q + get(array({ends}), k), size(s.g)),
        'shared', IF(size(w) <= {n * factor!r}D AND size(w) * {factor!r}D >= {n}, size(filter(w, x -> x IN {own})), 0)))"""
    return f"""flatten(transform(array(transform(filter(hits, h -> h.x IN {own}), h -> h.i)), p -> IF(size(p) < {least},
        cast(array() AS array<{PLACE}>), flatten(transform({near}, q -> filter(transform({scored},
          w -> named_struct('name', '{name}', 'shared', w.shared, 'score', 2.0D * w.shared / (w.n + {n}), 's', s.lo + q, 'e', s.lo + w.e)),
          m -> m.score >= {threshold!r}D))))))"""


def places(grams: str, sets, threshold: float) -> Column:
    """Array of PLACE: the windows over a list of bigrams that match and that no other license takes."""
    halo = max(max(lengths(length)) for _, length, _ in sets)
    every = _among(sorted({g for *_, own in sets for g in own}))
    found = ", ".join(_matches(name, length, own, threshold) for name, length, own in sets)
    stretches = f"""transform(sequence(0, size({grams}) - 1, {SEGMENT}), c -> named_struct('at', c, 'lo', greatest(0, c - {halo}),
        'to', c + {SEGMENT + halo} - greatest(0, c - {halo}),
        'g', slice({grams}, greatest(0, c - {halo}) + 1, c + {SEGMENT + 2 * halo} - greatest(0, c - {halo}))))"""
    taken = """exists(found, o -> o.name <> m.name AND (o.shared > m.shared OR (o.shared = m.shared AND o.score > m.score))
        AND 2 * (least(o.e, m.e) - greatest(o.s, m.s)) >= m.e - m.s)"""
    return F.expr(f"""flatten(transform({stretches}, s -> flatten(transform(
        array(filter(transform(s.g, (x, i) -> named_struct('i', i, 'x', x)), h -> h.x IN {every})), hits ->
        flatten(transform(array(flatten(array({found}))), found ->
          filter(found, m -> m.s >= s.at AND m.s < s.at + {SEGMENT} AND NOT {taken})))))))""")


def tags(text: Column) -> Column:
    """Sorted names of SPDX-License-Identifier tags, without exceptions and without "only", "or later" and plus signs."""
    def names(tag):
        kept = F.regexp_replace(tag, EXCEPTION, "")
        ids = F.filter(F.regexp_extract_all(kept, F.lit(SPDX_ID), F.lit(0)), lambda x: ~x.isin("AND", "OR"))
        return F.transform(ids, lambda x: F.regexp_replace(x, SUFFIX, ""))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), names))))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, license (best), score, licenses (names, sorted, comma-joined), tags (those of tags),
    places (array of name, shared, score and the window's bigrams from s up to e, by s)."""
    if not 0 < threshold <= 1 or len(templates) > 500:
        raise ValueError("the threshold lies in (0, 1]; templates are literals of the plan, 500 at most")
    if any(not re.fullmatch(r"[A-Za-z0-9.+-]+", name) for name, _ in templates):
        raise ValueError("templates are named by SPDX identifiers")
    sets = template_sets(docs.sparkSession, templates) if templates else []
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(text.contains("SPDX-License-Identifier:"), tags(text)).otherwise(
        F.array().cast("array<string>")).alias("tags"), words(text).alias("words"))
    rows = rows.select("doc_id", "tags", F.when(F.size("words") > 1, all_bigrams(F.col("words"))).otherwise(F.array().cast("array<string>")).alias("grams"))
    if sets:
        first = {g for _, _, own in sets for g in sorted(own, key=lambda g: (-len(g), g))[:len(own) - least_shared(len(own), threshold) + 1]}
        rows = rows.withColumn("grams", F.when(F.exists("grams", lambda g: g.isin(sorted(first))), F.col("grams")))
        rows = rows.select("doc_id", "tags", F.when(F.size("grams") > 0, places("grams", sets, threshold)).alias("found"))
    else:
        rows = rows.withColumn("found", F.lit(None))
    rows = rows.select("doc_id", "tags", F.coalesce(F.col("found").cast(f"array<{PLACE}>"), F.array().cast(f"array<{PLACE}>")).alias("places"))
    rated = F.concat(F.transform("places", lambda m: F.struct((-m["score"]).alias("score"), (-m["shared"]).alias("shared"), m["name"].alias("name"))),
                     F.transform("tags", lambda t: F.struct(F.lit(-1.0).alias("score"), F.lit(0).alias("shared"), t.alias("name"))))
    rows = rows.withColumn("best", F.array_min(rated))
    names = F.array_sort(F.array_union(F.transform("places", lambda m: m["name"]), F.col("tags")))
    return rows.select("doc_id", F.col("best.name").alias("license"), (-F.col("best.score")).alias("score"), F.array_join(names, ",").alias("licenses"),
                       F.array_join("tags", ",").alias("tags"), F.sort_array(F.transform("places", lambda m: F.struct(
                           m["s"].alias("s"), m["e"].alias("e"), m["name"].alias("name"), m["shared"].alias("shared"), m["score"].alias("score")))).alias("places"))
