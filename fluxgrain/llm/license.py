"""Licence recognition by sentence rules.

A text's sentences (parts between line ends, or ends of sentence followed by white space) are normalised: ASCII letters to
lower case, every other run of characters than ``a-z 0-9 .`` to one space. Known sentences map to identifiers. The
sequence of a text's identifiers, in order, is matched against the ordered rules: a rule matches where its
identifiers follow one another. A line end that follows no end of sentence may be an end of sentence or a space: a known sentence is found
wherever it begins after one of either kind and ends before one, also if it wraps over lines, follows a title or a copyright line, or has a comment's
signs before its lines. Of known sentences that begin at one place the longest counts.
The first matching rule names the licence; all matching ones are listed in the order of the rules.

Only built-in functions run, row by row: no shuffle, no Python. Null and empty texts have no sentences and the licence is
null. Repeated rows are each judged. Texts without any of the keywords (each known sentence has one) are not cut up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, as published in the licences' texts and notices, by identifier.
SENTENCES = {
    "apache-ref": "Licensed under the Apache License, Version 2.0",
    "apache-ref-long": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-ref": "Released under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "cc-by-nc-ref": "Licensed under CC BY-NC 4.0",
    "cc-by-ref": "Licensed under CC BY 4.0",
    "cc-by-sa-ref": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-ref": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
#: Ordered rules: the first that matches names the licence.
RULES = (
    ("Apache-2.0", ("apache-ref-long", "apache-use", "apache-copy", "apache-asis", "apache-see")),
    ("Apache-2.0", ("apache-ref-long", "apache-use")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-asis")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("GPL-3.0-only", ("gpl3-ref",)),
    ("MPL-2.0", ("mpl-ref",)),
    ("Apache-2.0", ("apache-ref",)),
    ("MIT", ("mit-ref",)),
    ("Unlicense", ("unlicense",)),
)
KEYWORDS = "licen|permi|warrant|redistribut|public domain|free software|hope that"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = r"[.!?;:,]*[ \t\r\f]*\n|[.!?;:]+[ \t\r\f]+|[.!?;:]+$"
OTHER = "[^a-z0-9.]+"


def known() -> dict[str, str]:
    """Normal sentence -> identifier. A known sentence that is itself cut (at ';' or '.') is known by each part, numbered."""
    import re

    out: dict[str, str] = {}
    for name, text in SENTENCES.items():
        parts = [p for p in re.split(CUT, text) if p.strip()]
        for i, p in enumerate(parts):
            out.setdefault(re.sub(OTHER, " ", p.lower()).strip(), name if i == 0 else f"{name}+{i}")
    return out


def rule_sequences() -> list[tuple[str, list[str]]]:
    ids = known()
    parts = {n: [n, *sorted((v for v in ids.values() if v.startswith(n + "+")), key=lambda v: int(v.rpartition("+")[2]))] for n in SENTENCES}
    return [(name, [p for s in seq for p in parts[s]]) for name, seq in RULES]


def heard_sequences() -> list[tuple[str, list[str]]]:
    """The rules with each part named as identifiers() names it: GPL 2 and 3 begin with the same part, which has one identifier."""
    import re

    ids = known()
    parts = {n: [ids[re.sub(OTHER, " ", p.lower()).strip()] for p in re.split(CUT, t) if p.strip()] for n, t in SENTENCES.items()}
    return [(name, [p for s in seq for p in parts[s]]) for name, seq in RULES]


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences in order. H marks ends of sentence and S other line ends: no upper-case letters are left by then."""
    ids = F.create_map(*[F.lit(x) for kv in known().items() for x in kv])
    ends = F.regexp_replace(F.translate(text, UPPER, LOWER), r"(?<![.!?;:])[.!?;:]+(?:[ \t\r\f\n][^a-z0-9.]*|$)", "H")
    marked = F.concat(F.lit("H"), F.regexp_replace(ends, r"\n[^a-z0-9.H]*", "S"), F.lit("H"))
    normalised = F.regexp_replace(F.regexp_replace(marked, "[^a-z0-9.HS]+", " "), " ?([HS]) ?", "$1")
    each = "|".join(s.replace(".", r"\.").replace(" ", "[ S]") for s in sorted(known(), key=len, reverse=True))
    said = F.regexp_extract_all(normalised, F.lit(rf"[HS]({each})\.*(?=[HS])"), F.lit(1))
    return F.transform(said, lambda s: F.element_at(ids, F.translate(s, "S", " ")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_known, sentence_ids, licenses (matched rules' names, each once), license (null if none) for each row of docs."""
    text = F.col("text")
    hit = F.translate(text, UPPER, LOWER).rlike(KEYWORDS.replace(" ", OTHER))
    found = docs.select(F.col(id_col), F.col(text_col).alias("text")).select(id_col, F.coalesce(F.when(hit, identifiers(text)), F.array().cast("array<string>")).alias("ids"))
    said = F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" "))
    names = F.array(*[F.when(F.contains(F.col("said"), F.lit(" " + " ".join(seq) + " ")), F.lit(name)) for name, seq in heard_sequences()])
    found = found.withColumn("said", said).withColumn("names", F.array_distinct(F.filter(names, lambda x: x.isNotNull())))
    return found.select(id_col, F.size("ids").cast("bigint").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"), F.array_join("names", ",").alias("licenses"), F.get("names", F.lit(0)).alias("license"))


def scan_sql() -> str:
    """The same in DuckDB SQL for sentences that do not wrap. Of wrapped ones it finds those that two readings, cut at each line end or at none, find."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    ids = known()
    table = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in ids.items()) + "}"
    norm = lambda t: f"list_filter(list_transform(list_transform(string_split_regex({t}, {q(CUT)}), lambda s: trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'))), lambda s: element_at(ids, s)[1]), lambda x: x IS NOT NULL)"
    names = ", ".join(f"CASE WHEN contains(said, {q(' ' + ' '.join(seq) + ' ')}) THEN {q(name)} END" for name, seq in rule_sequences())
    dedup = "list_filter(names, lambda x, i: x IS NOT NULL AND list_position(names, x) = i)"
    return f"""WITH base AS (SELECT doc_id, text, {table} AS ids, regexp_matches(translate(text, '{UPPER}', '{LOWER}'), '{KEYWORDS}') AS hit FROM documents),
both_ AS (SELECT doc_id, CASE WHEN hit THEN {norm('text')} ELSE []::VARCHAR[] END AS a, CASE WHEN hit THEN {norm("translate(text, chr(10), ' ')")} ELSE []::VARCHAR[] END AS b FROM base),
seq AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids FROM both_),
said AS (SELECT doc_id, ids, ' ' || array_to_string(ids, ' ') || ' ' AS said FROM seq),
named AS (SELECT doc_id, ids, [{names}] AS names FROM said),
final AS (SELECT doc_id, ids, {dedup} AS names FROM named)
SELECT doc_id, len(ids)::BIGINT AS n_known, array_to_string(ids, ',') AS sentence_ids, array_to_string(names, ',') AS licenses, names[1] AS license FROM final"""
