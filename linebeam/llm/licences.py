"""Licence scan: TF-IDF cosine of notices to templates, then directory inheritance.

DataFrame operations only. Units of text (lines, paragraphs) are compared with a
short list of licence templates as sparse TF-IDF vectors. The document frequencies
of all terms, the templates' and the units', come from the whole table: each text's
distinct terms are counted in one pass. By Cauchy-Schwarz a unit that
reaches the threshold holds one of a template's heaviest terms (its anchors), and
the templates' and the most frequent terms bound its cosine from above; only units
with an anchor and a bound that reaches the threshold are weighed: both filters lose
nothing. Equal units, as of copied files, are weighed once, by their hash.

A file without a notice of its own takes the licence of its nearest ancestor
directory that has one, by joins of directory paths with the directories'
licences. A directory's licence is declared by a licence file (by name) or, with
``leading_declares``, by any file that starts with a notice; among several the
smallest path decides.

Cases: null or empty text has no units; null path: no directory, only a notice
of its own counts. Rows equal in path and text agree. Every row is returned;
licence null if none applies. Equal cosines: the licence later in the alphabet; a
licence that is another with a clause more counts where both are found.
An empty table gives no rows. Only ``keep`` columns are returned.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linebeam.llm.common import staged

THRESHOLD = 0.6
FREQUENT = 500   # so many of the most frequent terms are known while texts are read
TERMS = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SPDX_KEY, SPDX_TERM = r"spdx-license-identifier:[\x20\t]*", "spdx-license-identifier."
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([._-][^/]*)?$"

# Identifiers that an SPDX line names; the GNU ones also with their suffixes
SPDX_IDS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
            "ISC", "MIT", "MPL-2.0", "Unlicense")
GNU_IDS = ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")
EXTENDS = {"BSD-3-Clause": "BSD-2-Clause"}   # the first is the second with a clause more: where both are found, it is the first
SPDX_LINE = "SPDX-License-Identifier: "
# Notices, standard headers, titles and opening paragraphs of licences, by SPDX identifier
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Use of this source code is governed by the BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
TEMPLATES = (*NOTICES, *[(i, SPDX_LINE + i) for i in SPDX_IDS], *[(i, SPDX_LINE + i + end) for i in GNU_IDS for end in ("", "-only", "-or-later")])


def terms_of(text: Column) -> Column:
    """Words; an SPDX line's key and identifier are one, so that another identifier is another word."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), SPDX_KEY, SPDX_TERM), F.lit(TERMS), F.lit(0))


def _template_terms(text: str) -> list:
    return re.findall(TERMS, re.sub(SPDX_KEY, SPDX_TERM, text.lower()))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)])


def anchors_of(weights: dict, threshold: float) -> set:
    """The heaviest terms of a template without which no cosine reaches the threshold."""
    order = sorted(weights.items(), key=lambda x: (-x[1], x[0]))
    left = total = sum(w * w for w in weights.values())
    out = set()
    for term, w in order:
        if left < threshold * threshold * total * (1 - 1e-9):
            break
        out.add(term)
        left -= w * w
    return out


def _numbers(values: dict) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(t) for t in values]), F.array(*[F.lit(v) for v in values.values()]))


def may_reach(text: Column, idf: dict, tops: dict, floor: float, threshold: float) -> Column:
    """Whether the cosine of a unit to a template can reach the threshold. ``idf`` has all terms of the templates,
    ``tops`` the largest weight of each in a template; any term outside ``idf`` weighs ``floor`` or more in the
    unit's length. Lambdas name what is used more than once, so that it is made once a unit."""
    idfs, heaviest = _numbers(idf), _numbers(tops)

    def bounded(terms, inside):
        weighed = F.transform(F.array_distinct(inside), lambda t: F.struct(
            ((F.size(inside) - F.size(F.array_remove(inside, t))) * idfs[t]).alias("w"), F.coalesce(heaviest[t], F.lit(0.0)).alias("top")))
        others = (F.size(terms) - F.size(inside)) * F.lit(floor * floor)
        return F.exists(F.array(weighed), lambda each: (
            F.aggregate(each, F.lit(0.0), lambda total, x: total + x["w"] * x["top"])
            >= threshold * (1 - 1e-9) * F.sqrt(F.aggregate(each, others, lambda total, x: total + x["w"] * x["w"]))))

    known = sorted(idf)
    return F.exists(F.array(terms_of(text)), lambda terms: F.exists(
        F.array(F.filter(terms, lambda t: t.isin(known))), lambda inside: bounded(terms, inside)))


def notices(rows: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, licence, cosine, unit): the best notice of each text that has one,
    from (key, text); a unit goes by its hash, so rows per term stay short."""
    spark = rows.sparkSession
    counts = [(name, Counter(_template_terms(text))) for name, text in templates]
    vocabulary = {t for _, c in counts for t in c}
    seen = staged(rows.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
                  .groupBy("term").agg(F.count("*").alias("df")), "terms")
    df = {r["term"]: r["df"] for r in seen.where(F.col("term").isin(sorted(vocabulary))).collect()}   # the templates' terms at most
    total = rows.count()
    idf = {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in sorted(vocabulary)}
    vectors = [(name, {t: n * idf[t] for t, n in c.items()}) for name, c in counts]
    anchors = _strings(set().union(*[anchors_of(v, threshold) for _, v in vectors]))
    often = {r["term"]: math.log((1 + total) / (1 + r["df"])) + 1 for r in seen.orderBy(F.desc("df"), "term").limit(FREQUENT).collect()}
    scaled = [(name, {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()}) for name, v in vectors]
    weights = spark.createDataFrame([(n, name, t, idf[t] * w) for n, (name, v) in enumerate(scaled) for t, w in sorted(v.items())],
                                    "template int, licence string, term string, weight double")
    tops = {t: max(v.get(t, 0.0) for _, v in scaled) for t in idf}

    parts = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n\s*\n")))
    units = staged(rows.where(F.arrays_overlap(terms_of(F.col("text")), anchors)).select("key", F.explode(parts).alias("text"))
                   .where(F.arrays_overlap(terms_of(F.col("text")), anchors) & may_reach(F.col("text"), often | idf, tops, min(often.values(), default=1.0), threshold))
                   .select("key", F.xxhash64("text").alias("unit"), terms_of(F.col("text")).alias("terms")), "units")
    held = (units.select("unit", "terms").dropDuplicates(["unit"]).select("unit", F.explode("terms").alias("term"))
            .groupBy("unit", "term").agg(F.count("*").alias("tf")))
    known = (seen.join(held.select("term").distinct(), "term", "left_semi")
             .select("term", (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1).alias("idf")))
    w = F.col("tf") * F.col("idf")
    length = held.join(known, "term").groupBy("unit").agg(F.sqrt(F.sum(w * w)).alias("length"))
    dots = (held.join(weights, "term").groupBy("unit", "template", "licence")
            .agg(F.sum(F.col("tf") * F.col("weight")).alias("dot")))
    near = staged(dots.join(length, "unit").withColumn("cosine", F.col("dot") / F.col("length"))
                  .where(F.col("cosine") >= threshold).groupBy("unit", "licence").agg(F.max("cosine").alias("cosine")), "near")
    found = F.struct("cosine", "licence", "unit")
    longer = {name: F.max(F.when(F.col("licence") == name, found)).alias(f"longer{n}") for n, name in enumerate(EXTENDS)}
    best = units.select("key", "unit").join(near, "unit").groupBy("key").agg(F.max(found).alias("best"), *longer.values())
    for n, (name, shorter) in enumerate(EXTENDS.items()):
        best = best.withColumn("best", F.when((F.col("best.licence") == shorter) & F.col(f"longer{n}").isNotNull(), F.col(f"longer{n}")).otherwise(F.col("best")))
    return best.select("key", "best.licence", "best.cosine", "best.unit")


def inherited(dirs: DataFrame, declared: DataFrame) -> DataFrame:
    """(dir, licence, from_path): the nearest ancestor's declaration for each directory.
    ``declared``: (dir, licence, from_path), one row per directory."""
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    up = dirs.select("dir", F.posexplode(ancestors).alias("depth", "ancestor"))
    found = up.join(declared.withColumnRenamed("dir", "ancestor"), "ancestor")
    return (found.groupBy("dir").agg(F.max(F.struct("depth", "licence", "from_path")).alias("near"))
            .select("dir", "near.licence", "near.from_path"))


def licence_scan(files: DataFrame, path: str, text: str, *, keep=(), templates=TEMPLATES, threshold: float = THRESHOLD,
                 leading_declares: bool = False) -> DataFrame:
    """``keep`` columns, path, licence, via ('notice' or 'directory'), cosine, from_path per row of ``files``."""
    rows = files.select(*keep, F.col(path).alias("__path"), F.col(text).alias("__text"), F.xxhash64(path, text).alias("__key"))
    own = notices(rows.select(F.col("__key").alias("key"), F.col("__text").alias("text")), templates, threshold)
    has_dir = F.col("__path").contains("/")
    folder = F.when(has_dir, F.regexp_replace("__path", r"/[^/]*$", ""))
    heads = rows.select(*keep, "__key", "__path", folder.alias("__dir"), F.substring_index("__text", "\n", 1).alias("__first"))
    joined = heads.join(own.withColumnRenamed("key", "__key"), "__key", "left")
    speaks = F.col("__path").rlike(LICENCE_FILE)
    if leading_declares:
        speaks = speaks | (F.col("unit") == F.xxhash64("__first"))
    declared = (joined.where(F.col("licence").isNotNull() & F.col("__dir").isNotNull() & speaks)
                .groupBy(F.col("__dir").alias("dir")).agg(F.min(F.struct("__path", "licence")).alias("d"))
                .select("dir", "d.licence", F.col("d.__path").alias("from_path")))
    dirs = heads.where(F.col("__dir").isNotNull()).select(F.col("__dir").alias("dir")).distinct()
    near = inherited(dirs, declared).select(F.col("dir").alias("__dir"), F.col("licence").alias("up"), "from_path")
    out = joined.join(near, "__dir", "left")
    mine = F.col("licence").isNotNull()
    return out.select(*keep, F.col("__path").alias("path"), F.coalesce("licence", "up").alias("licence"),
                      F.when(mine, "notice").when(F.col("up").isNotNull(), "directory").alias("via"),
                      F.col("cosine"), F.when(mine, F.col("__path")).otherwise(F.col("from_path")).alias("from_path"))
