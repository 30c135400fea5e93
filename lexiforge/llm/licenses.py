"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

Terms are the words and word pairs of the templates, weighed by their rarity among all scanned files. Around each word
that licence statements use, windows of a text are compared with each template's header; a file named like a licence
file is compared as a whole as well. A file without a licence of its own inherits that of the nearest directory above it
that holds a licence file: distinct directories are joined with licence directories on their ancestors' paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, written

THRESHOLD = 0.7
#: Words on each side of a licence word that a window takes at most.
WINDOW = 24
TERM = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
FILE_NAME = r"(?i)^(licen[cs]es?|copying|copyright|notice|unlicense)([._-].*)?$"

# Identifiers, names, statements and (where they are short) texts of public licences.
_MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject
to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_2_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED."""
_BSD_3_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS
PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
_UNLICENSE_TEXT = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial,
and by any means."""
TEMPLATES = {
    "Apache-2.0": ["SPDX-License-Identifier: Apache-2.0", "Apache License 2.0", "Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 Terms and conditions for use, reproduction, and distribution"],
    "BSD-2-Clause": ["SPDX-License-Identifier: BSD-2-Clause", "BSD 2-Clause License", "Licensed under the Simplified BSD License", _BSD_2_TEXT],
    "BSD-3-Clause": ["SPDX-License-Identifier: BSD-3-Clause", "BSD 3-Clause License", "Licensed under the New BSD License", _BSD_3_TEXT],
    "CC-BY-4.0": ["SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["SPDX-License-Identifier: CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["SPDX-License-Identifier: CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["SPDX-License-Identifier: CC0-1.0", "CC0 1.0 Universal public domain dedication"],
    "GPL-2.0": ["SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPLv2", "Released under the GPL v2", "This work is licensed under the GNU General Public License, version 2", "GNU General Public License Version 2, June 1991"],
    "GPL-3.0": ["SPDX-License-Identifier: GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv3", "Released under the GPL v3", "This work is licensed under the GNU General Public License, version 3", "GNU General Public License Version 3, 29 June 2007"],
    "LGPL-3.0": ["SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3", "Licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["SPDX-License-Identifier: AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3", "Licensed under the GNU Affero General Public License, version 3"],
    "ISC": ["SPDX-License-Identifier: ISC", "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", _ISC_TEXT],
    "MIT": ["SPDX-License-Identifier: MIT", "Released under the MIT License", "The MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", _MIT_TEXT],
    "MPL-2.0": ["SPDX-License-Identifier: MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"],
    "Unlicense": ["SPDX-License-Identifier: Unlicense", "This is free and unencumbered software released into the public domain", _UNLICENSE_TEXT],
}
#: Words around which a text is looked at.
TRIGGERS = frozenset("license licence licensed licenced licenses unlicense permission redistribution copyright cc cc0 gpl lgpl agpl gplv lgplv agplv mit apache bsd mozilla creative unencumbered spdx".split())


def terms(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


class Templates:
    """The templates' sparse vectors over their own terms."""

    def __init__(self, templates: dict[str, list[str]], idf: dict[str, float] | None = None):
        self.named = [(name, Counter(terms(TERM.findall(t.lower())))) for name, several in sorted(templates.items()) for t in several]
        self.terms = sorted({x for _, c in self.named for x in c})
        self.index = {x: k for k, x in enumerate(self.terms)}
        self.single = {x for x in self.terms if " " not in x}
        self.idf = np.array([(idf or {}).get(x, 1.0) for x in self.terms])
        self.matrix = np.array([self._vector(c) for _, c in self.named])

    def _vector(self, counts: Counter) -> np.ndarray:
        v = np.zeros(len(self.terms))
        for x, n in counts.items():
            if (k := self.index.get(x)) is not None:
                v[k] = (1 + math.log(n)) * self.idf[k]
        size = math.sqrt(v @ v)
        return v / size if size else v

    def best(self, words: list[str]) -> tuple[float, str | None]:
        cosines = self.matrix @ self._vector(Counter(terms(words)))
        k = int(cosines.argmax())
        return float(cosines[k]), self.named[k][0]

    def scan(self, text: str | None, whole: bool = False) -> tuple[str | None, float]:
        """The licence of the best window of a text (of the whole text too, for a licence file) and its cosine.

        A window is a run of template words around a trigger, at most WINDOW to each side; words that no template has end
        it, so that prose around a statement does not dilute it.
        """
        if not text:
            return None, 0.0
        words = TERM.findall(text.lower())
        top: tuple[float, str | None] = self.best(words) if whole else (0.0, None)
        last = -1
        for k, w in enumerate(words):
            if w not in TRIGGERS or k <= last:
                continue
            a = z = k
            while a > 0 and k - a < WINDOW and words[a - 1] in self.single:
                a -= 1
            while z < len(words) - 1 and z - k < WINDOW and words[z + 1] in self.single:
                z += 1
            last = z
            for b in range(a, k + 1):  # a common word before the statement may be in a template by chance
                for e in {z, max(k, z - 1), max(k, z - 2)}:
                    got = self.best(words[b : e + 1])
                    if got[0] > top[0] + 1e-12:
                        top = got
        return top[1], top[0]


def term_weights(files: DataFrame, text_col: str, templates: dict[str, list[str]] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequencies of the templates' terms among all texts; bounded by the templates."""
    import pyarrow as pa

    own = Templates(templates)
    singles, index = own.single, own.index

    def run(batches: Iterator) -> Iterator:
        df: Counter = Counter()
        for b in batches:
            for x in b.column(0):
                if t := x.as_py():
                    words = TERM.findall(t.lower())
                    df.update(singles.intersection(words))
                    known = [w if w in singles else None for w in words]
                    df.update({p for a, b in zip(known, known[1:], strict=False) if a and b and (p := f"{a} {b}") in index})
                df[""] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(df), pa.string()), "n": pa.array(list(df.values()), pa.int64())})

    found = {r.term: r["n"] for r in files.select(col(files, text_col).alias("t")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    total = found.get("", 0)
    return {x: math.log((1 + total) / (1 + found.get(x, 0))) + 1 for x in own.terms}


def license_scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str | None = None, threshold: float = THRESHOLD, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per file: (id,) path, license, score, via (header, file, inherited or none), license_dir.

    Paths are separated by "/". A file with a statement of cosine `threshold` or more has that licence (via header; via
    file for one that is named like a licence file). Others inherit the licence of the nearest licence file in their
    directory or above; of several in one directory the best match, then the least path counts. Null paths inherit
    nothing; null and empty texts have no header. Repeated rows give rows of their own; other columns are ignored.
    """
    import pyarrow as pa

    weights = term_weights(files, text_col, templates)
    # A statement of a few common words must not look like a licence: pairs count by their rarity, too.
    shared = files.sparkSession.sparkContext.broadcast(Templates(templates, weights))

    def run(batches: Iterator) -> Iterator:
        own = shared.value
        for b in batches:
            got = [own.scan(t.as_py(), whole=f.as_py()) for t, f in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array([g[0] if g[1] >= threshold else None for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["id", "path", "is_file", "own", "score"])

    path = col(files, path_col).cast("string")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    rows = files.select((col(files, id_col) if id_col else F.lit(None).cast("long")).alias("id"), path.alias("path"), col(files, text_col).alias("t"), F.coalesce(name.rlike(FILE_NAME), F.lit(False)).alias("is_file"))
    kind = rows.schema["id"].dataType.simpleString()
    found = written(rows.mapInArrow(run, f"id {kind}, path string, is_file boolean, own string, score double").withColumn("dir", directory(F.col("path"))), "licences")
    granted = found.filter("is_file and own is not null and path is not null").groupBy(F.col("dir").alias("l_dir")).agg(F.min_by("own", F.struct(-F.col("score"), "path")).alias("l_own"))
    dirs = found.filter("own is null and path is not null").select("dir").distinct()
    above = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("l_dir")).join(granted, "l_dir")
    nearest = cut(above.groupBy("dir").agg(F.max_by(F.struct("l_dir", "l_own"), F.length("l_dir")).alias("n")))
    out = found.join(nearest.withColumnRenamed("dir", "n_dir"), (F.col("dir") == F.col("n_dir")) & F.col("own").isNull(), "left")
    out = out.select(
        *([F.col("id").alias(id_col)] if id_col else []),
        "path",
        F.coalesce("own", "n.l_own").alias("license"),
        "score",
        F.when(F.col("own").isNotNull() & F.col("is_file"), "file").when(F.col("own").isNotNull(), "header").when(F.col("n").isNotNull(), "inherited").otherwise("none").alias("via"),
        F.when(F.col("own").isNull(), F.col("n.l_dir")).alias("license_dir"),
    )
    return out


def directory(path: Column) -> Column:
    """A path's directory with a final slash ("" for none)."""
    return F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)


def ancestors(dir_: Column) -> Column:
    """A directory and all above it, the root "" included."""
    parts = F.filter(F.split(dir_, "/"), lambda p: p != "")
    lead = F.when(dir_.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.concat(lead, F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))))
