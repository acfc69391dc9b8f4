"""License scans (operator 3, native).

A text is its words (runs of letters and digits, case folded) and their shingles of five. Templates are found in two steps:

* Retrieval: MinHash over overlapping windows of the text, one row to a band. Windows of ``WINDOW`` consecutive shingles, one
  starting at every shingle, give the smallest of each of ``BANDS`` hashes. A template's own windows are hashed alike, and a text that
  shares a value with a template retrieves it. Templates of at most ``SHORT`` shingles are retrieved by windows of one shingle, so for
  certain. For longer ones equal windows collide for certain; where words were changed, added or left out in place, the lost shingles
  are in blocks of four or more, so that of m shingles, 0.8 of them held, some 0.8 m / (0.05 m + 1), that is 7 or more, stand side by side and hold a window. In the worst case
  the text has the shingles one by one among foreign ones. A shingle is the smallest of one of its four windows with probability 2/5, and if
  it is so in the template, then in the text, whose neighbours are others, with 5/7; ``missed`` gives the chance that no band
  brings the two together: below 0.0005 from 17 shingles on.
* Verification: the share of the template's distinct shingles that the text holds, exactly; ``LEAST`` or more is a match.

All of it is one projection of the scan: no shuffle, no Python. The templates are literals of the plan; their number is that of this
module's list (bounded), not of the data.

Edges: null text is empty text, without matches; a text of fewer than five words has none. Repeated rows are separate rows; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, prepare, table

SIZE, LEAST = 5, 0.8
WINDOW, BANDS, SHORT = 4, 2, 16
#: Notices of public licenses.
TEMPLATES = {
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-licensed": "This project is licensed under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
}


def missed(m: int) -> float:
    """Bound on the chance that a text which holds LEAST of a template's m shingles, each apart from the others, shares no band value with it."""
    return 0.0 if m <= SHORT else math.exp(-BANDS * LEAST * m * (2 / 5) * (5 / 7))


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(words: Column) -> Column:
    """Hash of every run of SIZE words, in order."""
    one = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SIZE)])
    return F.when(F.size(words) >= SIZE, F.transform(F.sequence(F.lit(0), F.size(words) - SIZE), one)).otherwise(F.array().cast("array<bigint>"))


def window_minima(s: Column, band: int) -> Column:
    """The smallest hash of each window of WINDOW shingles."""
    hashed = F.transform(s, lambda x: F.xxhash64(x, F.lit(band)))
    least = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.least(*[F.get(h, i + k) for k in range(WINDOW)]))
    return F.when(F.size(s) >= WINDOW, let(hashed, least)).otherwise(F.array().cast("array<bigint>"))


def band_values(s: Column) -> Column:
    """Of all windows: single shingles, and each band's minima of the wide ones."""
    return F.concat(s, *[window_minima(s, band) for band in range(BANDS)])


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_licenses, licenses (names of the templates found, sorted, comma-joined)."""
    spark = prepare(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    sketch = let(word_hashes(F.col("text")), lambda w: let(shingles(w), lambda s: F.struct(F.array_distinct(s).alias("s"), band_values(s).alias("values"))))
    known = spark.createDataFrame(sorted(templates.items()), "name string, text string").select("name", sketch.alias("x")).select("name", "x.*").collect()
    known = [(t["name"], t["s"], [v for v in t["values"] if len(t["s"]) <= SHORT or v not in t["s"]]) for t in known]
    every = longs(sorted({v for _, _, values in known for v in values}))

    def verified(s: Column, some: Column) -> Column:
        """Names of the templates that share a band value and whose shingles the text holds."""
        holds = [
            F.when(F.arrays_overlap(some, longs(sorted(set(values)))) & (F.size(F.array_intersect(s, longs(own))) >= F.lit(LEAST * len(own) - 1e-9)), F.lit(name))
            for name, own, values in known
        ]
        return F.when(F.size(some) > 0, F.array_compact(F.array(*holds))).otherwise(F.array().cast("array<string>"))

    names = let(
        word_hashes(F.col("text")),
        lambda w: let(shingles(w), lambda s: let(F.array_intersect(band_values(s), every), lambda some: verified(s, some))),
    )
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), let(names, lambda n: F.struct(F.size(n).cast("long").alias("n_licenses"), F.array_join(n, ",").alias("licenses"))).alias("x"))
    return held.select("doc_id", "x.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


SQL = (
    "WITH t(name, text) AS (VALUES "
    + ", ".join(f"('{k}', '{v.replace(chr(39), 2 * chr(39))}')" for k, v in sorted(TEMPLATES.items()))
    + r"""),
w AS (
  SELECT name, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w, true AS template, NULL::BIGINT AS doc_id FROM t
  UNION ALL
  SELECT NULL, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> ''), false, doc_id FROM documents
), s AS (
  SELECT name, doc_id, template, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w
)
SELECT d.doc_id, count(t.name) AS n_licenses, coalesce(string_agg(t.name, ',' ORDER BY t.name), '') AS licenses
FROM (SELECT * FROM s WHERE NOT template) d
LEFT JOIN (SELECT * FROM s WHERE template) t ON len(list_intersect(d.s, t.s)) >= 0.8 * len(t.s)
GROUP BY d.doc_id
"""
)
