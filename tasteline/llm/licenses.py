"""Licence notices in texts: known sentences first, then rules over their order."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm.text import without

# Notices as they are published, without the lines that name a holder, in the order in which
# their rules are tried: rule, licence, text.
NOTICES: list[tuple[str, str, str]] = [
    ("apache-notice", "Apache-2.0", """
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""),
    ("apache-short-notice", "Apache-2.0", """
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
"""),
    ("agpl3-notice", "AGPL-3.0-or-later", """
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU Affero General Public License for more details.
"""),
    ("gpl3-notice", "GPL-3.0-or-later", """
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""),
    ("gpl2-notice", "GPL-2.0-or-later", """
This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""),
    ("lgpl21-notice", "LGPL-2.1-or-later", """
This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""),
    ("mpl-notice", "MPL-2.0", """
This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""),
    ("mit-notice", "MIT", """
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""),
    ("bsd-3-notice", "BSD-3-Clause", """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""),
    ("bsd-2-notice", "BSD-2-Clause", """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""),
    ("isc-notice", "ISC", """
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""),
    ("unlicense-notice", "Unlicense", """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""),
    ("apache-line", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-line-2", "Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("mit-line", "MIT", "Released under the MIT License."),
    ("mit-line-2", "MIT", "Licensed under the MIT License."),
    ("mit-line-3", "MIT", "This project is licensed under the MIT License."),
    ("mit-permission", "MIT", """
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""),
    ("gpl3-work", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-line", "GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("by-nc-line", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("by-nc-work", "CC-BY-NC-4.0", """
This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
International License."""),
    ("by-line", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("by-work", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("by-sa-line", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("by-sa-work", "CC-BY-SA-4.0", """
This work is licensed under a Creative Commons Attribution-ShareAlike 4.0
International License."""),
    ("cc0-work", "CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("bsd-conditions", "BSD", """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""),
    ("bsd-line", "BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
]

# Ends of sentences: closing marks before white space, and lines without a letter or digit. Other line ends only wrap.
_ENDS = "[.!?:;]+[\"')\\]]*[ \\x09-\\x0D]+|\\n[^A-Za-z0-9\\n]*\\n"
# Sentences of fewer words stand in too many texts to say anything.
_LEAST_WORDS = 4


def sentences_of(notice: str) -> list[str]:
    """What the splitter makes of a notice."""
    parts = (re.sub("[^a-z0-9]+", " ", part.lower()).strip() for part in re.split(_ENDS, notice))
    return [part for part in parts if len(part.split()) >= _LEAST_WORDS]


def _tables() -> tuple[dict[str, str], list[tuple[str, str, tuple[str, ...]]]]:
    names: dict[str, str] = {}
    rules = []
    for rule, licence, notice in NOTICES:
        for i, sentence in enumerate(sentences_of(notice), 1):
            names.setdefault(sentence, f"{rule}-{i}")
        rules.append((rule, licence, tuple(names[s] for s in sentences_of(notice))))
    return {name: sentence for sentence, name in names.items()}, rules


# Known sentences by identifier, and the rules: name, licence, identifiers in order. Sentences used by a
# rule are not seen by later ones.
SENTENCES, RULES = _tables()
# A sentence can't be wrapped over more lines than it has words.
_MOST_LINES = max(len(s.split()) for s in SENTENCES.values())
_LAST_WORDS = sorted({s.split()[-1] for s in SENTENCES.values()})


def normalised(sentence: Column) -> Column:
    """Lower case, each run of anything but a-z and 0-9 as one space."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _sentences(text: Column) -> Column:
    """The lines of each sentence, normalised; empty lines and sentences are left out."""
    parts = F.split(F.coalesce(text, F.lit("")), _ENDS)
    lines = F.transform(parts, lambda part: F.filter(F.split(normalised_lines(part), "\n"), lambda x: x != ""))
    return F.filter(lines, lambda x: F.size(x) > 0)


def normalised_lines(text: Column) -> Column:
    """Lower case, each run of other signs as one space, line ends kept and without spaces beside them."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9\n]+", " "), " *\n *|^ +| +$", "\n")


def _known_of(lines: Column, table: Column) -> Column:
    """Identifiers of the known sentences in the lines of one part of a text.

    The lines from one on up to the last may be a wrapped sentence; of all such,
    the one that begins first counts. Lines before it, or all of them if there is
    none, may be sentences of their own that no mark closes.
    """
    n = F.size(lines)

    def single(some: Column) -> Column:
        return F.transform(some, lambda x: F.element_at(table, x))

    starts = F.sequence(F.greatest(n - (_MOST_LINES - 1), F.lit(1)), n)
    joined = F.transform(starts, lambda i: F.element_at(table, F.array_join(F.slice(lines, i, n), " ")))
    first = F.array_position(F.transform(joined, lambda x: x.isNotNull()), True).cast("int")
    at = F.element_at(starts, first)
    wrapped = F.concat(single(F.slice(lines, 1, at - 1)), F.slice(joined, first, 1))
    may_end = F.element_at(lines, -1).rlike(f"(?:^| )(?:{'|'.join(_LAST_WORDS)})$")
    several = F.when(may_end & (first > 0), wrapped).otherwise(single(lines))
    return F.filter(F.when(n == 1, single(lines)).otherwise(several), lambda x: x.isNotNull())


def _token(name: str) -> str:
    return f"<{name}>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_sentences``, ``known``, ``rules`` and ``licences`` to the rows.

    ``known`` has the identifiers of the recognised sentences in text order,
    ``rules`` the names of the matched rules in rule order (once for each match)
    and ``licences`` the distinct licences, sorted. A rule matches consecutive
    recognised sentences; others between them don't count. A sentence ends at a
    closing mark before white space and at a line without letters and digits;
    other line ends and what begins a line, such as comment marks, only wrap it. A
    line that no mark closes may be a sentence by itself. All of it happens
    inside the row, on the whole text. Null and empty texts have no sentences.
    Input columns of these names are replaced; repeated rows are repeated.
    """
    out = ("n_sentences", "known", "rules", "licences")
    table = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    rows = docs.select(F.struct(*without(docs, *out)).alias("row"), _sentences(F.col(text)).alias("sentences"))
    names = F.flatten(F.transform("sentences", lambda x: _known_of(x, table)))
    rows = rows.select("row", F.size("sentences").cast("long").alias("n_sentences"), names.alias("known"))
    # The sequence as a string in which each identifier stands in brackets.
    left = F.array_join(F.transform("known", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    rows = rows.withColumn("left", left).withColumn("hits", F.array().cast("array<struct<rule:string,licence:string>>"))

    rules = F.array(
        *[
            F.struct(F.lit("".join(map(_token, names))).alias("tokens"), F.lit(rule).alias("rule"), F.lit(licence).alias("licence"))
            for rule, licence, names in RULES
        ]
    )

    def tried(state: Column, rule: Column) -> Column:
        rest = F.replace(state["left"], rule["tokens"], F.lit("|"))
        n = _replaced(state["left"], rest, rule["tokens"])
        hit = F.struct(rule["rule"].alias("rule"), rule["licence"].alias("licence"))
        return F.struct(rest.alias("left"), F.concat(state["hits"], F.array_repeat(hit, n)).alias("hits"))

    done = F.aggregate(rules, F.struct("left", "hits"), tried)["hits"]
    hits = F.when(F.size("known") > 0, done).otherwise(F.col("hits"))
    rows = rows.select("row", "n_sentences", "known", hits.alias("found"))
    return rows.select(
        "row.*",
        "n_sentences",
        "known",
        F.transform("found", lambda x: x["rule"]).alias("rules"),
        F.array_sort(F.array_distinct(F.transform("found", lambda x: x["licence"]))).alias("licences"),
    )


def _replaced(before: Column, after: Column, tokens: Column) -> Column:
    """Number of replacements of ``tokens`` by one character that made ``after`` of ``before``."""
    return ((F.length(before) - F.length(after)) / (F.length(tokens) - 1)).cast("int")


def scan_report(docs: DataFrame) -> DataFrame:
    """One row per document; sequences as comma-joined strings."""
    found = scan(docs.select("doc_id", "text"))
    joined = {c: F.array_join(c, ",") for c in ("known", "rules", "licences")}
    return found.select(
        "doc_id", "n_sentences", F.size("known").cast("long").alias("n_known"), *[v.alias(c) for c, v in joined.items()]
    )


def scan_sql() -> str:
    """The same report as SQL for DuckDB: lines as rows, wrapped sentences by aggregating the rows from each line on."""
    table = ", ".join(f"('{sentence}', '{name}')" for name, sentence in SENTENCES.items())
    steps, last = [], "seq"
    for i, (_, _, names) in enumerate(RULES):
        tokens = "".join(map(_token, names))
        steps.append(
            f"s{i} AS (SELECT *, replace(left{i}, '{tokens}', '|') AS left{i + 1}, "
            f"CAST((len(left{i}) - len(replace(left{i}, '{tokens}', '|'))) / ({len(tokens)} - 1) AS BIGINT) AS n{i} FROM {last})"
        )
        last = f"s{i}"
    rules = " || ".join(f"list_resize(CAST([] AS VARCHAR[]), n{i}, '{rule}')" for i, (rule, _, _) in enumerate(RULES))
    lics = " || ".join(f"CASE WHEN n{i} > 0 THEN ['{lic}'] ELSE CAST([] AS VARCHAR[]) END" for i, (_, lic, _) in enumerate(RULES))
    ends = _ENDS.replace("'", "''")
    return f"""
WITH known(sentence, name) AS (VALUES {table}),
docs AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
parts AS (
    SELECT r, unnest(p) AS part, unnest(range(len(p))) AS k
    FROM (SELECT r, regexp_split_to_array(coalesce(text, ''), '{ends}') AS p FROM docs)
), cut AS (
    SELECT r, k, unnest(w) AS line, unnest(range(len(w))) AS i
    FROM (SELECT r, k, string_split(part, chr(10)) AS w FROM parts)
), lines AS (
    SELECT r, k, i, trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) AS line FROM cut
    WHERE regexp_matches(line, '[A-Za-z0-9]')
), sizes AS (
    SELECT r, k, max(i) AS last FROM lines GROUP BY r, k
), ending AS (
    SELECT l.r, l.k, l.i FROM lines l JOIN sizes s ON l.r = s.r AND l.k = s.k AND l.i = s.last
    WHERE regexp_extract(l.line, '[a-z0-9]+$') IN (SELECT regexp_extract(sentence, '[a-z0-9]+$') FROM known)
), tails AS (
    SELECT a.r, a.k, a.i, string_agg(b.line, ' ' ORDER BY b.i) AS sentence
    FROM lines a JOIN ending e ON a.r = e.r AND a.k = e.k AND e.i - a.i < 1000
    JOIN lines b ON a.r = b.r AND a.k = b.k AND b.i >= a.i
    GROUP BY a.r, a.k, a.i
), wrapped AS (
    SELECT r, k, min(i) AS i, arg_min(name, i) AS name FROM tails JOIN known USING (sentence) GROUP BY r, k
), named AS (
    SELECT r, k, i, name FROM wrapped
    UNION ALL
    SELECT l.r, l.k, l.i, n.name FROM lines l JOIN known n ON l.line = n.sentence
    LEFT JOIN wrapped w ON l.r = w.r AND l.k = w.k WHERE w.i IS NULL OR l.i < w.i
), hits AS (
    SELECT r, list(name ORDER BY k, i) AS names FROM named GROUP BY r
), counts AS (
    SELECT r, count(*) AS n_sentences FROM sizes GROUP BY r
), seq AS (
    SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(names, CAST([] AS VARCHAR[])) AS names,
           coalesce(array_to_string(list_transform(names, lambda x: '<' || x || '>'), ''), '') AS left0
    FROM docs LEFT JOIN hits USING (r) LEFT JOIN counts USING (r)
), {", ".join(steps)}
SELECT doc_id, n_sentences, len(names) AS n_known, coalesce(array_to_string(names, ','), '') AS known,
       coalesce(array_to_string({rules}, ','), '') AS rules,
       coalesce(array_to_string(list_sort(list_distinct({lics})), ','), '') AS licences
FROM {last}
"""
