"""License scans: normalised text against licence templates by the Dice
coefficient over distinct word bigrams.

The units compared are the lines of a document and its blocks (separated by
blank lines) of more than one line. A unit of a bigrams and a template of b
can only reach Dice t if a lies between t*b/(2-t) and b*(2-t)/t, so most units
are dropped by size alone and the rest meet only templates of fitting size.
Built-in column functions only; nothing is shuffled.

Defined results: lower case, every run of other characters than letters and
digits is one space; units of fewer than two words have no bigrams and match
nothing, as do null and empty texts; of equally good templates the first by
name is reported; rows are judged alone, so repeated rows repeat; extra
columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

#: Notices by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms "
                         "of the GNU General Public License as published by the Free Software Foundation, either "
                         "version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights."),
    # paragraphs of whole licence texts
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
            " and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
            " Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MIT", "The software is provided \"as is\", without warranty of any kind, express or implied, including"
            " but not limited to the warranties of merchantability, fitness for a particular purpose and "
            "noninfringement. In no event shall the authors or copyright holders be liable for any claim, "
            "damages or other liability, whether in an action of contract, tort or otherwise, arising "
            "from, out of or in connection with the software or the use or other dealings in the software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies."),
    ("ISC", "The software is provided \"as is\" and the author disclaims all warranties with regard to this "
            "software including all implied warranties of merchantability and fitness. In no event shall "
            "the author be liable for any special, direct, indirect, or consequential damages or any "
            "damages whatsoever resulting from loss of use, data or profits, whether in an action of "
            "contract, negligence or other tortious action, arising out of or in connection with the use "
            "or performance of this software."),
    ("BSD-3-Clause", "Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer."),
    ("BSD-3-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list "
                     "of conditions and the following disclaimer in the documentation and/or other "
                     "materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be "
                     "used to endorse or promote products derived from this software without specific "
                     "prior written permission."),
    ("BSD-3-Clause", "This software is provided by the copyright holders and contributors \"as is\" and any "
                     "express or implied warranties, including, but not limited to, the implied warranties"
                     " of merchantability and fitness for a particular purpose are disclaimed. In no event"
                     " shall the copyright holder or contributors be liable for any direct, indirect, "
                     "incidental, special, exemplary, or consequential damages (including, but not limited"
                     " to, procurement of substitute goods or services; loss of use, data, or profits; or "
                     "business interruption) however caused and on any theory of liability, whether in "
                     "contract, strict liability, or tort (including negligence or otherwise) arising in "
                     "any way out of the use of this software, even if advised of the possibility of such "
                     "damage."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under "
                   "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                   "ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under "
                          "the terms of the GNU Affero General Public License as published by the Free "
                          "Software Foundation, either version 3 of the License, or (at your option) any "
                          "later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the "
                "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
                  "software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
]
DICE = 0.8
_OTHER = r"[^\p{L}\p{N}]+"


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bigrams(text: Column) -> Column:
    def pairs(w: Column) -> Column:
        return F.when(F.size(w) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))))

    words = F.array_remove(F.split(F.lower(text), _OTHER), "")
    return F.get(F.transform(F.array(words), pairs), F.lit(0))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """One row for each unit that matches: doc_id, unit (line or block), unit_no
    (its number, from 0), license, dice (of the best template)."""
    known = [(name, len(b), b) for name, b in ((n, template_bigrams(t)) for n, t in templates) if b]
    if not known:
        raise ValueError("no template has two words")
    sizes = [n for _, n, _ in known]
    least = lambda k: k * dice / (2 - dice) - 1e-9
    most = lambda k: k * (2 - dice) / dice + 1e-9
    lo, hi = least(min(sizes)), most(max(sizes))

    def units(parts: Column, kind: str, several: bool = False) -> Column:
        u = F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.cast("bigint").alias("unit_no"), x.alias("x")))
        return F.filter(u, lambda s: s["x"].contains("\n")) if several else u

    each = F.concat(units(F.split("text", "\n", -1), "line"),
                    units(F.split("text", r"\n[\x20\x09\x0D]*\n\s*", -1), "block", several=True))
    sized = F.filter(F.transform(each, lambda s: F.struct(s["unit"].alias("unit"), s["unit_no"].alias("unit_no"), _bigrams(s["x"]).alias("b"))),
                     lambda s: (F.size(s["b"]) >= lo) & (F.size(s["b"]) <= hi))
    rows = docs.select("doc_id", F.explode(sized).alias("u")).select("doc_id", "u.unit", "u.unit_no", "u.b")
    n = F.size("b")
    scored = F.array(*[F.when((n >= least(k)) & (n <= most(k)), F.struct(
        (2.0 * F.size(F.array_intersect("b", F.array(*map(F.lit, b)))) / (n + k)).alias("dice"),
        F.lit(name).alias("license"))) for name, k, b in known])
    best = F.reduce(F.filter(scored, lambda s: s["dice"] >= dice), F.lit(None).cast("struct<dice:double,license:string>"),
                    lambda a, s: F.when(a.isNull() | (s["dice"] > a["dice"]) | (
                        (s["dice"] == a["dice"]) & (s["license"] < a["license"])), s).otherwise(a))
    return rows.withColumn("best", best).where("best IS NOT NULL").select(
        "doc_id", "unit", "unit_no", "best.license", F.round("best.dice", 6).alias("dice"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, dice: float = DICE) -> str:
    rows = ", ".join(f"({_sql_text(n)}, [{', '.join(map(_sql_text, template_bigrams(t)))}])" for n, t in templates)
    return rf"""
WITH t(license, tb) AS (VALUES {rows}),
raw AS (SELECT doc_id, text, 'line' AS unit, split(text, chr(10)) AS p FROM documents
        UNION ALL SELECT doc_id, text, 'block', regexp_split_to_array(text, '\n[\x20\x09\x0D]*\n\s*') FROM documents),
u AS (SELECT doc_id, unit, unnest(range(len(p))) AS unit_no, unnest(p) AS x FROM raw WHERE text IS NOT NULL),
w AS (SELECT doc_id, unit, unit_no, list_filter(regexp_split_to_array(lower(x), '[^\p{{L}}\p{{N}}]+'), lambda y: y <> '') AS w
      FROM u WHERE unit = 'line' OR contains(x, chr(10))),
b AS (SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w WHERE len(w) > 1),
d AS (SELECT doc_id, unit, unit_no, license, 2.0::DOUBLE * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice FROM b, t
      WHERE len(b) <= 3 * len(tb) AND len(tb) <= 3 * len(b)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, license) AS n FROM d WHERE dice >= {dice})
SELECT doc_id, unit, unit_no, license, round(dice, 6) AS dice FROM r WHERE n = 1
"""
