"""License scans with DataFrame functions only.

A text's words (a-z, 0-9 and non-ASCII characters, lower-cased) give hashed
3-word shingles.  Templates are grouped by length; a group of templates of at
most ``W / 2`` words is looked for in windows of ``W`` words that start every
``W / 2`` words, so each run of template length lies wholly inside one window.

1. texts that share no shingle with any template are dropped (exact: their
   containment is zero), which leaves the few texts that are cut into windows;
2. windows without a shingle of their group's templates are dropped, exact too;
3. the MinHash values of a window, one per band, retrieve templates with an equal
   value.  The number of bands is set per group so that a window at the threshold
   misses all bands with probability below ``MISS``;
4. retrieved pairs are verified by exact containment: the share of the template's
   distinct shingles that the window holds;
5. templates that overlap are told apart.  Where another template holds the threshold
   of a template's shingles, a window must hold half of those it lacks (a version, say);
   if it lacks none (BSD-2 in BSD-3), a finding of the longer one covers the shorter at
   that place.  Notices of one name (up to ``-header``, ``-text``, ``-title``) do not
   cover each other.  The SQL states the same rules without bands.

Everything is row-local up to the retrieved pairs, which are few; templates are
literals, so nothing that grows with the data is broadcast.

Defined results: a null or short text holds no license; a template of fewer than
three words is refused; every row is judged by its own text, whether its id repeats,
is null, or neither: findings are joined by a landed row number.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import land

SHINGLE = 3
THRESHOLD = 0.8
MISS = 1e-6

# Wording of common license notices, by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    # a title of up to four shingles misses the threshold as soon as one word differs
    "AGPL-3.0": "Affero General Public License, version 3",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "CC0-1.0": "CC0 1.0 Universal",
    "EPL-1.0": "Eclipse Public License v 1.0",
    "EPL-1.0-title": "Eclipse Public License, version 1.0",
    "EPL-2.0": "Eclipse Public License v 2.0",
    "EPL-2.0-title": "Eclipse Public License, version 2.0",
    "LGPL-2.0": "Library General Public License, version 2",
    "LGPL-2.1": "Lesser General Public License, version 2.1",
    "LGPL-3.0": "Lesser General Public License, version 3",
    "MPL-2.0-title": "Mozilla Public License Version 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
}
#: the other GNU headers are the one above with other words
_GNU = TEMPLATES["GPL-header"]
TEMPLATES |= {
    "GPL-2.0-header": _GNU.replace("version 3", "version 2"),
    "LGPL-2.1-header": _GNU.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"),
    "LGPL-3.0-header": _GNU.replace("GNU General", "GNU Lesser General"),
    "AGPL-3.0-header": _GNU.replace("GNU General", "GNU Affero General"),
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def window_of(n_words: int) -> int:
    """Window size of a template: the power of two of at least twice its words, 16 at least."""
    return max(16, 1 << math.ceil(math.log2(2 * n_words)))


def bands_for(window: int, shingles: int, threshold: float) -> int:
    """Bands (of one value each) that a window at the threshold misses with
    probability ``MISS`` at most."""
    held = math.ceil(threshold * shingles)
    j = held / (window - SHINGLE + 1 + shingles - held)
    return math.ceil(math.log(MISS) / math.log(1 - j))


def groups(templates: Mapping[str, str], threshold: float) -> dict[int, tuple[list[str], int]]:
    """window size -> (templates, bands)."""
    out: dict[int, tuple[list[str], int]] = {}
    for name, text in templates.items():
        ws = template_words(text)
        if len(ws) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        size = window_of(len(ws))
        distinct = len({tuple(ws[i:i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)})
        names, bands = out.get(size, ([], 0))
        out[size] = ([*names, name], max(bands, bands_for(size, distinct, threshold)))
    return out


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def shingles(words_: Column) -> Column:
    """Hashes of all runs of three words, by position (empty if there is none).
    The words are bound to a lambda variable, so that they are split once and not
    once per position, wherever the optimizer moves the expression."""
    def runs(ws: Column) -> Column:
        last = F.size(ws) - SHINGLE
        return F.when(last >= 0, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))).otherwise(
                F.array().cast("array<bigint>"))
    return F.get(F.transform(F.array(words_), runs), F.lit(0))


def minhashes(hashes: Column, bands: int) -> Column:
    """One minimum per band (``bands`` differently seeded hashes)."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, k))))


def _template_table(spark, templates: Mapping[str, str], threshold: float):
    """(name, window, bands, set) of every template, hashed by the same expressions."""
    rows = [(n, size, bands, " ".join(template_words(templates[n])))
            for size, (names, bands) in groups(templates, threshold).items() for n in names]
    return (spark.createDataFrame(rows, "name string, window int, bands int, text string")
            .withColumn("set", F.array_distinct(shingles(F.split("text", " ")))).drop("text"))


def family(name: str) -> str:
    return re.sub("-(header|text|title)$", "", name)


def siblings(sets: Mapping[str, list], threshold: float) -> tuple[dict[str, list[list]], list[tuple[str, str]]]:
    """(shingles that tell a template from each close one, (shorter, longer) pairs of
    which the longer holds the whole shorter)."""
    marks: dict[str, list[list]] = {n: [] for n in sets}
    inside = []
    for n, s in sets.items():
        for other, o in sets.items():
            lacks = sorted(set(s) - set(o))
            if other == n or len(s) - len(lacks) < threshold * len(s):
                continue
            if lacks:
                marks[n].append(lacks)
            elif len(o) > len(s) and family(n) != family(other):
                inside.append((n, other))
    return marks, inside


def _hits(docs: DataFrame, templates: Mapping[str, str], threshold: float, id_col: str,
          text_col: str) -> tuple[DataFrame, DataFrame]:
    """(row and id of every input row, findings by row)."""
    spark = docs.sparkSession
    known = _template_table(spark, templates, threshold).cache()
    sets = {r["name"]: (r["window"], r["bands"], r["set"]) for r in known.collect()}   # the template list
    known.unpersist()
    marks, inside = siblings({n: s for n, (_, _, s) in sets.items()}, threshold)
    every = sorted({h for _, _, s in sets.values() for h in s})

    def literal(values):
        return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")
    text = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       shingles(words(F.col(text_col).cast("string"))).alias("h"))
    # all rows are numbered; the shingles of the few texts that are left are read once per window size
    rows, _ = land(text.select("row", "id", F.when(F.arrays_overlap("h", literal(every)), F.col("h")).alias("h")), "license-texts")
    text = rows.where("h is not null").select("row", "h")
    found = None
    for size in sorted({w for w, _, _ in sets.values()}):
        mine = {n: s for n, (w, _, s) in sets.items() if w == size}
        bands = max(b for w, b, _ in sets.values() if w == size)
        step = size // 2
        windows = (text.select("row", "h", F.explode(F.sequence(
                       F.lit(0), F.greatest(F.size("h") - 1, F.lit(0)), F.lit(step))).alias("start"))
                   .select("row", "start", F.array_distinct(F.slice("h", F.col("start") + 1, size - SHINGLE + 1)).alias("w"))
                   .where(F.arrays_overlap("w", literal(sorted({h for s in mine.values() for h in s})))))
        keyed = windows.select("row", "start", "w", F.posexplode(minhashes(F.col("w"), bands)).alias("band", "value"))
        wanted = (spark.createDataFrame([(n, s, marks[n]) for n, s in mine.items()],
                                        "name string, set array<bigint>, marks array<array<bigint>>")
                  .select("name", "set", "marks", F.posexplode(minhashes(F.col("set"), bands)).alias("band", "value")))
        told = F.forall("marks", lambda m: F.size(F.array_intersect("w", m)) * 2 >= F.size(m))
        near = (keyed.join(F.broadcast(wanted), ["band", "value"])          # bands x templates rows
                .where(told)
                .select("row", "start", F.lit(size).alias("window"), "name",
                        (F.size(F.array_intersect("w", "set")) / F.size("set")).alias("containment"))
                .where(F.col("containment") >= threshold))
        found = near if found is None else found.unionByName(near)
    rows = rows.select("row", "id")
    found = found.distinct()
    if not inside:
        return rows, found
    found, _ = land(found, "license-hits")
    pairs = spark.createDataFrame(inside, "name string, other string")
    longer = (found.select(F.col("row").alias("i"), F.col("start").alias("s"), F.col("window").alias("n"), F.col("name").alias("other"))
              .join(F.broadcast(pairs.withColumnRenamed("name", "short")), "other").select("i", "s", "n", "short").distinct())
    covered = ((F.col("row") == F.col("i")) & (F.col("name") == F.col("short"))
               & (F.col("start") < F.col("s") + F.col("n")) & (F.col("s") < F.col("start") + F.col("window")))
    return rows, found.join(longer, covered, "left_anti")


def license_hits(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, row, start, window, name, containment``: windows (first word, size) that
    hold ``threshold`` or more of a template; ``row`` tells rows of one id apart."""
    rows, found = _hits(docs, templates, threshold, id_col, text_col)
    return rows.join(found, "row").select(F.col("id").alias(id_col), "row", "start", "window", "name", "containment")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_licenses, licenses`` (sorted, comma-joined) and
    ``containment`` (of the best, 0 without one)."""
    rows, found = _hits(docs, templates, threshold, id_col, text_col)
    hits = found.groupBy("row").agg(F.sort_array(F.collect_set("name")).alias("names"), F.max("containment").alias("best"))
    return rows.join(hits, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.size("names"), F.lit(0)).cast("bigint").alias("n_licenses"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
        F.coalesce("best", F.lit(0.0)).alias("containment"))


def oracle(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same answer as SQL: every window's containment, without bands; a window must
    hold half of each list of marks, and a longer template covers a shorter one."""
    rows, sets = [], {}
    for size, (names, _) in groups(templates, threshold).items():
        for n in names:
            ws = template_words(templates[n])
            rows.append(f"('{n}', {size}, '{' '.join(ws)}')")
            sets[n] = sorted({" ".join(ws[i:i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)})
    marks, inside = siblings(sets, threshold)
    marked = [f"('{n}', {k}, '{g}')" for n, lists in marks.items() for k, m in enumerate(lists) for g in m] or ["('', 0, '')"]
    pairs = [f"('{a}', '{b}')" for a, b in inside] or ["('', '')"]
    return f"""
WITH t AS (SELECT name, size, string_split(txt, ' ') AS ws FROM (VALUES {', '.join(rows)}) v(name, size, txt)),
ts AS (SELECT DISTINCT name, size, array_to_string(ws[i:i + 2], ' ') AS g
       FROM (SELECT name, size, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)),
tn AS (SELECT name, count(*) AS n FROM ts GROUP BY name),
mk AS (SELECT * FROM (VALUES {', '.join(marked)}) v(name, k, g)),
mn AS (SELECT name, k, count(*) AS n FROM mk GROUP BY name, k),
cv AS (SELECT * FROM (VALUES {', '.join(pairs)}) v(name, other)),
w AS (SELECT row_number() OVER () AS r, doc_id,
        list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SEPARATORS}'), lambda x: x <> '') AS ws
      FROM documents),
d AS (SELECT r, i - 1 AS p, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
m AS (SELECT r, p, d.g, name, size FROM d JOIN ts ON ts.g = d.g),
h0 AS (SELECT DISTINCT r, name, size, s, g
       FROM (SELECT r, name, g, p, size,
                    unnest([p // (size // 2) * (size // 2), p // (size // 2) * (size // 2) - size // 2]) AS s FROM m)
       WHERE s >= 0 AND p <= s + size - 3),
h1 AS (SELECT r, h0.name, size, s, count(*) / max(n) AS best FROM h0 JOIN tn ON tn.name = h0.name
       GROUP BY r, h0.name, size, s HAVING count(*) / max(n) >= {threshold}),
hm AS (SELECT h0.r, h0.name, h0.s, mk.k, count(*) AS c FROM h0 JOIN mk ON mk.name = h0.name AND mk.g = h0.g GROUP BY ALL),
bad AS (SELECT DISTINCT h1.r, h1.name, h1.s FROM h1 JOIN mn ON mn.name = h1.name
        LEFT JOIN hm ON hm.r = h1.r AND hm.name = h1.name AND hm.s = h1.s AND hm.k = mn.k
        WHERE 2 * coalesce(hm.c, 0) < mn.n),
h2 AS (SELECT * FROM h1 ANTI JOIN bad ON bad.r = h1.r AND bad.name = h1.name AND bad.s = h1.s),
lo AS (SELECT h2.r, cv.name, h2.s, h2.size FROM h2 JOIN cv ON cv.other = h2.name),
h AS (SELECT * FROM h2 ANTI JOIN lo ON lo.r = h2.r AND lo.name = h2.name AND h2.s < lo.s + lo.size AND lo.s < h2.s + h2.size),
f AS (SELECT r, name, max(best) AS best FROM h GROUP BY r, name),
a AS (SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS l, max(best) AS b FROM f GROUP BY r)
SELECT w.doc_id, coalesce(n, 0) AS n_licenses, coalesce(l, '') AS licenses, coalesce(b, 0.0::DOUBLE) AS containment
FROM w LEFT JOIN a ON a.r = w.r"""
