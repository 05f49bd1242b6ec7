"""Licence scans by sentence rules, in built-in DataFrame functions alone.

A text is cut into sentences three times: line by line, and (licence texts are often wrapped)
with line breaks read as spaces inside paragraphs, which a blank line ends, and
everywhere. A known sentence that the cut parts is known by its pieces in a row. A sentence is normalised (ASCII letters
lowered, everything but ASCII letters and digits a single space) and looked up in a
table of known licence sentences. The identifiers found, in order, are matched
against rules: a rule names a licence and the identifiers that must follow each other
in that order with no other licence sentence between them. A licence is
reported if a rule of it matches any of the sequences. Nothing is shuffled; texts without any
word that a known sentence needs are not cut at all.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import own_prefix, text_of

# Known licence sentences (wording of the licences and of their usual notices).
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "Licensed under the Apache License, Version 2.0.",
    4: "This work is licensed under the GNU General Public License, version 3.",
    5: "Licensed under CC BY-NC 4.0.",
    6: "Licensed under CC BY 4.0.",
    7: "Licensed under CC BY-SA 4.0.",
    8: "All rights reserved.",
    9: "The MIT License (MIT)",
    10: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions:",
    11: "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
    12: "Licensed under the Apache License, Version 2.0 (the \"License\");",
    13: "you may not use this file except in compliance with the License.",
    14: "You may obtain a copy of the License at",
    15: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    16: "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.",
    17: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution.",
    18: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    19: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    20: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    21: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted.",
}

# Ordered rules, licence identifier and sentence identifiers.
RULES = [
    ("MIT", [1]),
    ("MIT", [2]),
    ("MIT", [9]),
    ("MIT", [10, 11]),
    ("Apache-2.0", [3]),
    ("Apache-2.0", [12, 13]),
    ("GPL-3.0", [4]),
    ("GPL-3.0-or-later", [19]),
    ("CC-BY-NC-4.0", [5]),
    ("CC-BY-4.0", [6]),
    ("CC-BY-SA-4.0", [7]),
    ("BSD-2-Clause", [15, 16, 17]),
    ("BSD-3-Clause", [15, 16, 17, 18]),
    ("MPL-2.0", [20]),
    ("ISC", [21]),
    ("all-rights-reserved", [8]),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(sentence: str) -> str:
    """The normalised form of a known sentence; the same rule as :func:`_normal` for columns."""
    lowered = sentence.translate(str.maketrans(_UPPER, _LOWER))
    return re.sub(r"[^a-z0-9]+", " ", lowered).strip(" ")


def _normal(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.translate(c, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def triggers(sentences: dict[int, str]) -> list[str]:
    """Words of which every known sentence has at least one: the longest of each, each once."""
    return sorted({max(normal(s).split(), key=len) for s in sentences.values()})


def pieces(sentence: str) -> list[str]:
    """Normalised pieces of a known sentence, cut by the same rule as texts in :func:`_ids`."""
    return [p for p in map(normal, re.sub(r"([.!?:;])[ \t\r]+", r"\1\n", sentence).split("\n")) if p]


def _known(sentences: dict[int, str]) -> tuple[Column, list[tuple[str, int]]]:
    """A map from pieces to names, and the sentences of several pieces: their names in a row and identifier.

    A piece that is a sentence has its identifier as name, others a letter and a number.
    """
    cut = {i: pieces(s) for i, s in sorted(sentences.items())}
    names = {p[0]: str(i) for i, p in cut.items() if len(p) == 1}
    for p in chain.from_iterable(cut.values()):
        names.setdefault(p, f"p{len(names)}")
    rows = [(",".join(names[p] for p in ps), i) for i, ps in cut.items() if len(ps) > 1]
    known = F.create_map(*chain.from_iterable((F.lit(p), F.lit(n)) for p, n in names.items()))
    return known, sorted(rows, key=lambda r: (-r[0].count(","), r[1]))


def _ids(text: Column, known: Column, rows: list[tuple[str, int]]) -> Column:
    """Identifiers of the known sentences of ``text``, in order."""
    cut = F.split(F.regexp_replace(text, r"([.!?:;])[ \t\r]+", "$1\n"), "\n")
    # a blank piece parts nothing; any other unknown piece parts the pieces of a sentence
    cut = F.filter(F.transform(cut, _normal), lambda s: s != "")
    line = F.array_join(F.transform(cut, lambda s: F.coalesce(F.element_at(known, s), F.lit("-"))), ",")
    for row, i in rows:
        line = F.regexp_replace(line, f"(?<![^,]){row}(?![^,])", str(i))
    return F.filter(F.split(line, ","), lambda n: n.rlike("^[0-9]+$")).cast("array<int>")


def _matched(ids: Column, rules: list[tuple[str, list[int]]]) -> Column:
    """Licences of the rules whose identifiers follow each other in ``ids``."""
    line = F.concat(F.lit(","), F.array_join(ids.cast("array<string>"), ","), F.lit(","))
    hits = [F.when(line.contains("," + ",".join(map(str, seq)) + ","), F.lit(name)) for name, seq in rules]
    return F.array_compact(F.array(*hits))


def scan(docs: DataFrame, sentences: dict[int, str] | None = None,
         rules: list[tuple[str, list[int]]] | None = None, text_col: str = "text",
         ids_col: str = "sentence_ids", out_col: str = "licenses") -> DataFrame:
    """``docs`` plus ``ids_col`` (known sentences, line by line, in order) and ``out_col`` (sorted licences).

    Null and empty texts, and texts without a known sentence, get empty arrays. Rows are
    independent: repeated rows, null ids and all other columns pass through; input columns of
    the two output names are replaced. An empty table gives an empty result.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    known, rows = _known(sentences)
    text = text_of(text_col)
    likely = F.translate(text, _UPPER, _LOWER).rlike("|".join(triggers(sentences)))
    none = F.array().cast("array<int>")
    # blank lines stay as two line feeds
    stripped = F.regexp_replace(text, "[ \t\r]*\n[ \t\r]*", "\n")
    by_line, by_paragraph, unwrapped = (F.when(likely, _ids(form, known, rows)).otherwise(none) for form in (
        text, F.regexp_replace(stripped, "(?<!\n)\n(?!\n)", " "), F.regexp_replace(text, "[ \t\r]*\n[ \t\r]*", " ")))
    own = own_prefix(docs)
    loose, close = f"{own}unwrapped", f"{own}paragraphs"
    out = docs.drop(ids_col, out_col).withColumn(ids_col, by_line)
    out = out.withColumn(loose, unwrapped).withColumn(close, by_paragraph)
    found = F.array_sort(F.array_distinct(F.concat(*(_matched(F.col(c), rules) for c in (ids_col, close, loose)))))
    return out.withColumn(out_col, found).drop(loose, close)


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_sentences, sentence_ids and licenses as text."""
    found = scan(docs.select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))


def report_sql() -> str:
    """DuckDB SQL for :func:`report` over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(normal(s))}, {i})" for i, s in sorted(SENTENCES.items()))
    names = " UNION ALL ".join(
        f"SELECT doc_id, rid, '{name}' AS license FROM seqs WHERE contains(line, '{',' + ','.join(map(str, seq)) + ','}')"
        for name, seq in RULES)
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
cuts AS (
  SELECT rid, doc_id, form, unnest(parts) AS part, unnest(range(len(parts))) AS pos FROM (
    SELECT rid, doc_id, form,
           string_split(regexp_replace(body, '([.!?:;])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)) AS parts
    FROM (SELECT rid, doc_id, 'line' AS form, text AS body FROM src
          UNION ALL
          SELECT rid, doc_id, 'wrapped', regexp_replace(text, '[ \\t\\r]*\\n[ \\t\\r]*', ' ', 'g') FROM src))),
found AS (
  SELECT rid, doc_id, form, pos, id FROM cuts
  JOIN known ON sentence = trim(regexp_replace(translate(part, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g'))),
seqs AS (SELECT rid, doc_id, form, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY pos) AS ids,
                ',' || string_agg(id::VARCHAR, ',' ORDER BY pos) || ',' AS line
         FROM found GROUP BY ALL),
named AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM ({names}) GROUP BY rid)
SELECT s.doc_id, coalesce(q.n, 0)::BIGINT AS n_sentences, coalesce(q.ids, '') AS sentence_ids,
       coalesce(n.licenses, '') AS licenses
FROM src s LEFT JOIN seqs q ON q.rid = s.rid AND q.form = 'line' LEFT JOIN named n ON n.rid = s.rid
"""
