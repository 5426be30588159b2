"""Licences of files: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by path.

A file's units are its lines and its paragraphs. A unit's terms are weighted by tf x idf, idf counted over the
templates (a term of none has the largest); a unit is of the licence whose template it is closest to, if the
cosine reaches the threshold. A file named like a licence file licenses its directory; any other file with a
licensed unit has a header of its own. A file without either inherits from its nearest ancestor directory that
is licensed.

How it runs. Native expressions only. A unit that holds none of a template's heaviest terms cannot reach the
threshold (the rest of the template's vector is too short, by Cauchy-Schwarz), so one pattern over the text
finds the units to look at, without loss. Their terms are counted in place, in sorted arrays; a unit whose other
terms outweigh those of the templates cannot reach the threshold either. What is left is joined with the table of
template terms, whose size is fixed, and summed per unit before anything is shuffled. Inheritance joins distinct directories with their ancestors, not files, so that a
directory with a third of all files is one row until the last join; that one is against a written table.

Defined results:
- A null text is empty and has no licence. A null path is in no directory: such a file has its own licence only.
- Ties: the higher score, then the licence that sorts first; of several licence files in a directory, the one
  with the best score, then the licence that sorts first. Rows that repeat a key and a path share the best licence found in any.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import whole, written

# The usual notices of licences, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: neither the name of the copyright holder nor the names of its contributors"
        " may be used to endorse or promote products derived from this software",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution."
        " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    ),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License version 2 as published by the Free Software Foundation.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
        " (at your option) any later version.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 3 of the License, or"
        " (at your option) any later version.",
    ),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software.",
    ),
)
# The identifiers of SPDX tags, by the licence they name. The words of the tag count twice in these templates: an
# identifier that is not listed is then of no licence, and an identifier alone ("mit" in German) is no tag.
TAGS = {
    "AGPL-3.0": "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later",
    "Apache-2.0": "Apache-2.0",
    "BSD-2-Clause": "BSD-2-Clause",
    "BSD-3-Clause": "BSD-3-Clause",
    "BSL-1.0": "BSL-1.0",
    "CC-BY-4.0": "CC-BY-4.0",
    "CC-BY-NC-4.0": "CC-BY-NC-4.0",
    "CC-BY-NC-ND-4.0": "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0": "CC-BY-NC-SA-4.0",
    "CC-BY-ND-4.0": "CC-BY-ND-4.0",
    "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "CC0-1.0": "CC0-1.0",
    "EPL-2.0": "EPL-2.0",
    "GPL-2.0": "GPL-2.0 GPL-2.0-only GPL-2.0-or-later",
    "GPL-3.0": "GPL-3.0 GPL-3.0-only GPL-3.0-or-later",
    "ISC": "ISC",
    "LGPL-2.1": "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later",
    "LGPL-3.0": "LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later",
    "MIT": "MIT",
    "MPL-2.0": "MPL-2.0",
    "Unlicense": "Unlicense",
    "Zlib": "Zlib",
}
TEMPLATES += tuple(
    (name, f"SPDX-License-Identifier: SPDX-License-Identifier: {tag}") for name, tags in TAGS.items() for tag in tags.split()
)
# Words of any English text. They count in every vector, but a unit is not looked at for these alone where others suffice.
FUNCTION_WORDS = set(
    "a all an and any are as at be by can for form free from has in is it may no not of on or that the this to under use"
    " was with without work you your".split()
)
# The most frequent words of any text, the commonest last: they are anchors only where all others do not suffice.
COMMON_LAST = "mit or this from at are by with as be for it that is a in to and of the".split()
TERM = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
THRESHOLD = 0.65
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"


class Weights:
    """idf over the templates and the unit vectors of the templates."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in templates]
        counts = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
        appears = Counter(term for c in counts for term in c)
        self.outside = math.log(1 + len(templates)) + 1
        self.idf = {term: math.log((1 + len(templates)) / (1 + n)) + 1 for term, n in appears.items()}
        self.vectors = []
        for c in counts:
            vector = {term: n * self.idf[term] for term, n in c.items()}
            norm = math.sqrt(sum(w * w for w in vector.values()))
            self.vectors.append({term: w / norm for term, w in vector.items()})

    def anchors(self, threshold: float) -> list[str]:
        """Terms of which a unit must hold one to reach the threshold: per template, as few of the rarest as leave
        a rest that is too short; function words only where the others do not suffice."""
        common = {t: i for i, t in enumerate(COMMON_LAST)}
        out: set[str] = set()
        for vector in self.vectors:
            rest = 1.0
            for term in sorted(vector, key=lambda t: (common.get(t, -1), t in FUNCTION_WORDS, -self.idf[t], t)):
                if rest < (threshold - 1e-9) ** 2:
                    break
                out.add(term)
                rest -= vector[term] ** 2
        return sorted(out)


def _any_of(words: Iterable[str]) -> str:
    """A pattern for any of these words, as a tree by their letters: one branch is tried per place, not every word."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def below(node: dict) -> str:
        branches = [re.escape(letter) + below(rest) for letter, rest in sorted(node.items()) if letter]
        if not branches or (len(branches) == 1 and "" not in node):
            return "".join(branches)
        return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    firsts = "".join(map(re.escape, sorted(set(tree) - {""})))
    return f"(?=[{firsts}]){below(tree)}" if firsts else "(?!)"


def _units(text: Column) -> Column:
    """Lines and paragraphs, each once."""
    return F.array_distinct(F.concat(F.split(text, r"\n"), F.split(text, r"\n[ \t\r]*\n")))


def _among(terms: Iterable[str]) -> Callable[[Column], Column]:
    return lambda run: run["term"].isin(*terms)


def _squares(runs: str, which: Callable[[Column], Column]) -> Column:
    """The sum of the squared counts of these runs."""
    return F.aggregate(F.filter(runs, which), F.lit(0.0), lambda total, r: total + r["n"] * r["n"])


def unit_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str | None = None,
) -> DataFrame:
    """place (the path), unit, name, score: the best template of every unit that reaches the threshold.

    With a ``key`` also its value, as the first column."""
    spark, weights = files.sparkSession, Weights(templates)
    held = r"(?i)(?<![a-z0-9])" + _any_of(weights.anchors(threshold)) + r"(?![a-z])"
    of = [] if key is None else [F.col(key).alias("k")]
    kept = ["row", *(["k"] if of else []), "place", "unit"]
    units = (
        files.select(
            F.monotonically_increasing_id().alias("row"), *of, F.col(path).alias("place"), whole(text).alias("t")
        )
        .where(F.col("t").rlike(held))
        .select(*kept[:-1], F.posexplode(_units(F.col("t"))).alias("unit", "line"))
        .where(F.col("line").rlike(held))
    )
    # Exploded from one element each: the optimizer would put the whole array's expression into every step of the next.
    terms = F.expr(f"sort_array(regexp_extract_all(lower(line), r'{TERM}', 0))")
    units = units.select(*kept, F.explode(F.array(terms)).alias("all")).where(F.size("all") > 0)
    # Where the runs of equal terms end in the sorted array; a term's count is the distance to the end before.
    ends = F.filter(F.sequence(F.lit(1), F.size("all")), lambda i: ~F.get("all", i).eqNullSafe(F.get("all", i - 1)))
    units = units.select(*kept, "all", F.explode(F.array(ends)).alias("ends"))
    runs = F.transform(
        "ends",
        lambda end, i: F.struct(
            F.element_at("all", end).alias("term"), (end - F.coalesce(F.get("ends", i - 1), F.lit(0))).cast("double").alias("n")
        ),
    )
    units = units.select(*kept, F.explode(F.array(runs)).alias("runs"))
    # Squared lengths: of the terms outside the templates exactly, of the others at most.
    common = sorted(weights.idf.keys() & FUNCTION_WORDS)
    telling = sorted(weights.idf.keys() - FUNCTION_WORDS)
    told = F.struct(
        F.filter("runs", _among(weights.idf)).alias("known"),
        (_squares("runs", lambda r: ~_among(weights.idf)(r)) * weights.outside**2).alias("rest"),
    )
    # Exploded as well: they would be worked out once more in every place of the condition below.
    units = units.select(*kept, F.explode(F.array(told)).alias("told")).select(*kept, "told.known", "told.rest")
    most = sum(
        (
            _squares("known", _among(terms)) * max(weights.idf[t] for t in terms) ** 2
            for terms in (common, telling)
            if terms
        ),
        F.lit(0.0),
    )
    # The cosine is at most the share of the known terms in the unit's length.
    reaches = most * (1 - (threshold - 1e-6) ** 2) >= F.col("rest") * (threshold - 1e-6) ** 2
    counted = units.where((F.size("known") > 0) & reaches).select(*kept, "rest", F.inline("known"))
    # As many rows as the templates have terms.
    width = range(len(templates))
    rows = [(term, idf, *[v.get(term, 0.0) for v in weights.vectors]) for term, idf in weights.idf.items()]
    table = spark.createDataFrame(rows, "known string, idf double, " + ", ".join(f"w{i} double" for i in width))
    weight = F.col("n") * F.col("idf")
    # All terms of a unit are in one task, so that one row per unit is shuffled.
    summed = (
        counted.join(F.broadcast(table), F.col("term") == F.col("known"))
        .groupBy(*kept)
        .agg(
            F.sqrt(F.max("rest") + F.sum(weight * weight)).alias("norm"),
            *[F.sum(weight * F.col(f"w{i}")).alias(f"d{i}") for i in width],
        )
    )
    # Rounded, so that the order in which terms were added cannot decide.
    scored = [
        F.struct((-F.round(F.col(f"d{i}") / F.col("norm"), 6)).alias("least"), F.lit(name).alias("name"))
        for i, name in enumerate(weights.names)
    ]
    best = F.least(*scored)
    return summed.select(*kept[1:], best["name"].alias("name"), (-best["least"]).alias("score")).where(
        F.col("score") >= threshold
    )


def scan(
    files: DataFrame,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    license_file: str = LICENSE_FILE,
) -> DataFrame:
    """key, path, own_license, own_score, license, origin, licensed_by per file.

    ``origin``: ``header`` or ``file`` for a licence of its own, ``inherited`` from directory ``licensed_by``, or null.
    """
    own = (
        unit_licenses(files, path, text, templates, threshold, key)
        .groupBy(F.col("k").alias("own_key"), F.col("place").alias("own_path"))
        .agg(F.min(F.struct((-F.col("score")).alias("least"), "name")).alias("best"))
        .select("own_key", "own_path", F.col("best.name").alias("own_license"), (-F.col("best.least")).alias("own_score"))
    )
    own = written(own, "license-own")
    directory = F.regexp_replace("place", r"/?[^/]*$", "")
    told = (
        files.select(F.col(key).alias("k"), F.col(path).alias("place"))
        .join(own, F.col("k").eqNullSafe(F.col("own_key")) & F.col("place").eqNullSafe(F.col("own_path")), "left")
        .drop("own_key", "own_path")
        .withColumn("directory", directory)
        .withColumn("names_directory", F.regexp_extract("place", r"([^/]*)$", 1).rlike(license_file))
    )
    licensed = written(
        told.where("own_license is not null and names_directory")
        .groupBy(F.col("directory").alias("ancestor"))
        .agg(F.min(F.struct((-F.col("own_score")).alias("least"), "own_license")).alias("best"))
        .select("ancestor", F.col("best.own_license").alias("ancestor_license")),
        "license-directories",
    )
    steps = F.split("directory", "/")
    ancestors = F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda i: F.concat_ws("/", F.slice(steps, F.lit(1), i))
    )
    inherited = written(
        told.where("directory is not null")
        .select("directory")
        .distinct()
        .select(F.col("directory").alias("of"), F.posexplode(F.array_distinct(ancestors)).alias("depth", "above"))
        .join(licensed, F.col("above") == F.col("ancestor"))
        .groupBy("of")
        .agg(F.max(F.struct("depth", "ancestor", "ancestor_license")).alias("nearest"))
        .select("of", F.col("nearest.ancestor").alias("nearest"), F.col("nearest.ancestor_license").alias("inherited")),
        "license-inherited",
    )
    has_own = F.col("own_license").isNotNull()
    return told.join(inherited, F.col("directory") == F.col("of"), "left").select(
        F.col("k").alias(key),
        F.col("place").alias(path),
        "own_license",
        "own_score",
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(has_own & F.col("names_directory"), "file")
        .when(has_own, "header")
        .when(F.col("inherited").isNotNull(), "inherited")
        .alias("origin"),
        F.when(~has_own, F.col("nearest")).alias("licensed_by"),
    )


def scan_sql(files: str, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan as DuckDB SQL over a relation ``files`` (path, doc_id, text), by plain comparison of all units."""
    weights = Weights(templates)
    values = ", ".join(
        f"({i}, '{weights.names[i]}', '{term}', {w!r})" for i, v in enumerate(weights.vectors) for term, w in v.items()
    )
    idfs = ", ".join(f"('{term}', {idf!r})" for term, idf in weights.idf.items())
    name_pattern = LICENSE_FILE.removeprefix("(?i)")
    return f"""
WITH files AS ({files}),
v(template, name, term, w) AS (VALUES {values}),
idf(term, idf) AS (VALUES {idfs}),
lines AS (SELECT path, unnest(list_distinct(list_concat(string_split(text, chr(10)),
  string_split_regex(text, '\\n[ \\t\\r]*\\n')))) AS line FROM files),
u AS (SELECT path, line, row_number() OVER () AS unit FROM lines
  WHERE regexp_matches(line, '(?i)licen[sc]|copyright|permi|redistribut|software|mozilla|gnu|waived|unencumbered|cc')),
t AS (SELECT path, unit, term, count(*) AS n FROM (
  SELECT path, unit, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM u) GROUP BY ALL),
x AS (SELECT path, unit, t.term, n * coalesce(idf, {weights.outside!r}) AS tfidf FROM t LEFT JOIN idf USING (term)),
norms AS (SELECT path, unit, sqrt(sum(tfidf * tfidf)) AS norm FROM x GROUP BY ALL),
dots AS (SELECT path, unit, template, name, sum(tfidf * w) AS dot FROM x JOIN v USING (term) GROUP BY ALL),
scored AS (SELECT path, name, round(dot / norm, 6) AS score FROM dots JOIN norms USING (path, unit)),
own AS (SELECT path, arg_min(name, (-score, name)) AS own_license, max(score) AS own_score
  FROM scored WHERE score >= {threshold} GROUP BY path),
told AS (SELECT files.*, own_license, own_score, regexp_replace(path, '/?[^/]*$', '') AS directory,
  regexp_matches(lower(regexp_extract(path, '([^/]*)$', 1)), '{name_pattern}') AS names_directory
  FROM files LEFT JOIN own USING (path)),
licensed AS (SELECT directory AS ancestor, arg_min(own_license, (-own_score, own_license)) AS ancestor_license
  FROM told WHERE own_license IS NOT NULL AND names_directory GROUP BY directory),
near AS (SELECT d.directory, arg_max(ancestor, length(ancestor)) AS nearest,
  arg_max(ancestor_license, length(ancestor)) AS inherited
  FROM (SELECT DISTINCT directory FROM told) d JOIN licensed
  ON d.directory = ancestor OR starts_with(d.directory, ancestor || '/') OR ancestor = '' GROUP BY d.directory)
SELECT path, doc_id, own_license, own_score, coalesce(own_license, inherited) AS license,
  CASE WHEN own_license IS NOT NULL AND names_directory THEN 'file' WHEN own_license IS NOT NULL THEN 'header'
    WHEN inherited IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own_license IS NULL THEN nearest END AS licensed_by
FROM told LEFT JOIN near USING (directory)
"""
