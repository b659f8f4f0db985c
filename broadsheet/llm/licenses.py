"""Licence scans by sentence rules: sentences become identifiers, identifier sequences become licences.

A text is cut into sentences at line breaks and after . ! ? ; or : before white space. Each is lower-cased
(A-Z), everything but a-z and 0-9 becomes one space, and the rest is looked up among the known sentences. A known
sentence is also found where it is wrapped over lines that follow each other without a blank one, or goes on after `v.`;
a line that is known by itself comes first. n_sentences counts lines as sentences all the same.
The identifiers found, in order and without the unknown sentences between them, form the document's sequence;
a rule names a licence and the identifiers that must follow each other in it. DataFrame functions only: the
tables are literals of the plan, far below any limit.

Nulls: a null text has one empty sentence, no identifier and no licence. Repeated sentences count each time, a licence
is named once. Licences are listed in the rules' order. Whole texts are read. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: well-known licence sentences, normalised, with an identifier each
SENTENCES = {
    "mit-ref": "released under the mit license",
    "mit-lic": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-ref": "licensed under the apache license version 2 0",
    "apache-ref-short": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-lead": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "bsd-redis": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccby4": "licensed under cc by 4 0",
    "ccbysa4": "licensed under cc by sa 4 0",
    "ccbync4": "licensed under cc by nc 4 0",
    "cc0": "released under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}
# fixed values: rules, a licence and the identifiers that follow each other, the most specific first
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-lic",)),
    ("Apache-2.0", ("apache-ref-short", "apache-use")),
    ("Apache-2.0", ("apache-ref", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-ref",)),
    ("Apache-2.0", ("apache-ref-short",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-or-later", ("gpl-free-lead", "gpl3-terms")),
    ("GPL-2.0-or-later", ("gpl-free-lead", "gpl2-terms")),
    ("BSD-3-Clause", ("bsd-redis", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redis", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2",)),
    ("CC-BY-4.0", ("ccby4",)),
    ("CC-BY-SA-4.0", ("ccbysa4",)),
    ("CC-BY-NC-4.0", ("ccbync4",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("All-Rights-Reserved", ("reserved",)),
]
# end of fixed values

_CUT = r"[.!?;:]+[ \t\n\x0B\f\r]+|\n"
_SPACE = r"[ \t\n\x0B\f\r]"
#: Marks in normalised texts: a sentence ends for certain, or may go on (\n).
_END = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def n_sentences(text: Column) -> Column:
    return F.size(F.split(F.coalesce(text, F.lit("")), _CUT, -1)).cast("long")


def _marked(text: Column) -> Column:
    """The text normalised, with _END at ends of sentences and a line break where lines end or `v.` does."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER + _END, _LOWER + " ")
    soft = F.regexp_replace(lower, r"(?<![a-z0-9])v\.(?:[ \t\x0B\f\r]*\n|[ \t\x0B\f\r]+)", "v\n")
    cut = F.regexp_replace(soft, rf"[.!?;:]+{_SPACE}+", _END)
    return F.regexp_replace(F.regexp_replace(cut, rf"[^a-z0-9\n{_END}]+", " "), rf" ?([\n{_END}]) ?", "$1")


def _ids(text: Column, known: dict[str, str]) -> Column:
    table = F.create_map(*[x for k, v in known.items() for x in (F.lit(v), F.lit(k))])
    longest = sorted(known.values(), key=len, reverse=True)
    either = "|".join([*longest, *(v.replace(" ", r"[ \n]") for v in longest)])
    found = F.regexp_extract_all(F.trim(_marked(text)), F.lit(rf"(?<![^\n{_END}])(?:{either})(?![^\n{_END}])"), F.lit(0))
    return F.transform(found, lambda s: F.element_at(table, F.translate(s, "\n", " ")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] = SENTENCES, rules: list[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """(id, n_sentences, sentence_ids, licenses): the identifiers joined by > and the licences joined by a comma, both in order."""
    base = docs.select(F.col(id_col), n_sentences(F.col(text_col)).alias("n_sentences"), _ids(F.col(text_col), known).alias("ids"))
    sequence = F.concat(F.lit(">"), F.array_join("ids", ">"), F.lit(">"))
    named = F.array(*[F.when(F.contains("sequence", F.lit(f">{'>'.join(ids)}>")), F.lit(name)) for name, ids in rules])
    licences = F.array_join(F.array_distinct(F.array_compact(named)), ",")
    return base.withColumn("sequence", sequence).select(id_col, "n_sentences", F.array_join("ids", ">").alias("sentence_ids"), licences.alias("licenses"))


def op8(docs: DataFrame) -> DataFrame:
    return scan(docs)


def _sql() -> str:
    known = ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items())
    named = ", ".join(f"CASE WHEN contains(q, '>{'>'.join(ids)}>') THEN '{name}' END" for name, ids in RULES)
    return f"""
WITH s AS (
  SELECT doc_id, list_transform(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.!?;:]+[ \\t\\n\\x0B\\f\\r]+|\\n'), lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))) AS found FROM documents),
e AS (SELECT doc_id, unnest(found) AS sentence, unnest(range(len(found))) AS i FROM s),
k(id, sentence) AS (VALUES {known}),
m AS (SELECT doc_id, string_agg(k.id, '>' ORDER BY i) AS sentence_ids FROM e JOIN k ON e.sentence = k.sentence GROUP BY doc_id),
r AS (SELECT s.doc_id, len(s.found) AS n_sentences, coalesce(m.sentence_ids, '') AS sentence_ids, '>' || coalesce(m.sentence_ids, '') || '>' AS q FROM s LEFT JOIN m ON s.doc_id = m.doc_id),
n AS (SELECT doc_id, n_sentences, sentence_ids, list_filter([{named}], lambda x: x IS NOT NULL) AS names FROM r)
SELECT doc_id, n_sentences, sentence_ids, array_to_string(list_transform(list_filter(range(len(names)), lambda i: list_position(names, names[i + 1]) = i + 1), lambda i: names[i + 1]), ',') AS licenses FROM n
"""


OP8_SQL = _sql()
