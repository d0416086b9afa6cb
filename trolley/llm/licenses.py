"""Licence scans: normalised sentences to identifiers, identifier sequences to ordered rules.

A text is cut into sentences (after ``.``, ``;`` or ``:`` before white space, and at blank lines). A
sentence is normalised (lower case, runs of anything but ASCII letters and digits one blank) and
looked up among the known licence sentences; one that is not known as a whole is looked up line by
line, so a licence line under other text is found, and so is a sentence wrapped over lines. A rule
is a licence with the sentences that must follow each other, others in between allowed. Where a
longer rule of a family holds, the shorter ones it contains are not reported.

Standard sentences with such a mark inside (``FORMS``) are known by their pieces, which must stand
side by side with nothing in between; each counts as one licence sentence. The SQL the query is
compared with has ``SENTENCES`` and ``RULES`` only and finds none of these.

All of it is built-in functions on one row at a time: nothing is shuffled and no Python runs.

Defined results: a null or empty text has no sentences. Repeated rows and null ids each give their
own result row. An empty table gives an empty result. Text of any length is one row's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# licences' own sentences, normalised, each with the identifier used in the rules.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-limit": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-short": "released under the mit license",
    "mit-short-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "gpl-3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-2-short": "this work is licensed under the gnu general public license version 2",
    "gpl-grant-3": "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
    "the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-zero": "licensed under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl-3": "spdx license identifier gpl 3 0 or later",
}

# Rules as (licence, sentences in order); a family's longer rules come first.
RULES = [
    ("Apache-2.0", ["apache-grant", "apache-limit", "apache-copy", "apache-asis"]),
    ("Apache-2.0", ["apache-grant", "apache-limit"]),
    ("Apache-2.0", ["apache-short"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-short-2"]),
    ("MIT", ["spdx-mit"]),
    ("ISC", ["isc-grant"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0", ["gpl-grant-3", "gpl-hope"]),
    ("GPL-3.0", ["gpl-3-short"]),
    ("GPL-3.0", ["spdx-gpl-3"]),
    ("GPL-2.0", ["gpl-2-short"]),
    ("MPL-2.0", ["mpl-form"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc-zero"]),
    ("Unlicense", ["unlicense"]),
]
_LICENSE = "you can redistribute it and or modify it under the terms of the gnu {}general public license as published by the free software foundation"
_HOPE = "this {} is distributed in the hope that it will be useful but without any warranty"
_IMPLIED = "without even the implied warranty of merchantability or fitness for a particular purpose"
_LATER = "either version {} of the license or at your option any later version"

# Pairs of an identifier and the pieces, normalised, that ENDS leaves of a standard sentence.
FORMS = [
    ("spdx-mit", ["spdx license identifier", "mit"]),
    ("spdx-apache", ["spdx license identifier", "apache 2 0"]),
    ("spdx-gpl-3", ["spdx license identifier", "gpl 3 0 or later"]),
    ("mpl-form", ["this source code form is subject to the terms of the mozilla public license v", "2 0"]),
    ("gpl-hope", [_HOPE.format("program"), _IMPLIED]),
    ("lgpl-hope", [_HOPE.format("library"), _IMPLIED]),
    ("gpl-grant-2", [_LICENSE.format(""), _LATER.format("2")]),
    ("gpl-grant-2", [f"{_LICENSE.format('')} {_LATER.format('2')}"]),
    ("gpl-grant-3", [_LICENSE.format(""), _LATER.format("3")]),
    ("lgpl-grant-2-1", [_LICENSE.format("lesser "), _LATER.format("2 1")]),
    ("lgpl-grant-2-1", [f"{_LICENSE.format('lesser ')} {_LATER.format('2 1')}"]),
    ("lgpl-grant-3", [_LICENSE.format("lesser "), _LATER.format("3")]),
    ("lgpl-grant-3", [f"{_LICENSE.format('lesser ')} {_LATER.format('3')}"]),
    ("agpl-grant-3", [_LICENSE.format("affero "), _LATER.format("3")]),
    ("agpl-grant-3", [f"{_LICENSE.format('affero ')} {_LATER.format('3')}"]),
]

# Rules over FORMS, as RULES.
FORM_RULES = [
    ("GPL-2.0", ["gpl-grant-2", "gpl-hope"]),
    ("LGPL-2.1", ["lgpl-grant-2-1", "lgpl-hope"]),
    ("LGPL-2.1", ["lgpl-grant-2-1", "gpl-hope"]),
    ("LGPL-3.0", ["lgpl-grant-3", "lgpl-hope"]),
    ("LGPL-3.0", ["lgpl-grant-3", "gpl-hope"]),
    ("AGPL-3.0", ["agpl-grant-3", "gpl-hope"]),
]
#: A licence that is not reported where another, whose rules contain its own, is.
CONTAINED = {"BSD-2-Clause": "BSD-3-Clause"}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What ends a sentence; the mark goes with it.
ENDS = r"[.;:][ \t\r\n]+|\n[ \t\r]*\n"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan_licences(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, n_licence_sentences, sequence, licences, n_licences`` of each row.

    ``sequence`` are the identifiers found, in order, between blanks; ``licences`` the licences
    whose rules hold, sorted, between commas.
    """
    # Pieces have the names ~0, ~1, ...; what is known as a whole has its identifier.
    pieces = {p: f"~{k}" for k, p in enumerate(dict.fromkeys(p for _, form in FORMS for p in form))}
    names_of = pieces | {s: i for i, s in SENTENCES.items()}
    known = ", ".join(f"{quoted(s)}, {quoted(i)}" for s, i in names_of.items())

    def identifier(sentence: str) -> str:
        folded = f"translate({sentence}, '{UPPER}', '{LOWER}')"
        return f"element_at(map({known}), trim(regexp_replace({folded}, '[^a-z0-9]+', ' ')))"

    def holds(sentences: list[str]) -> str:
        wanted = ", ".join(map(quoted, sentences))
        step = f"CASE WHEN s < {len(sentences)} AND x = element_at(array({wanted}), s + 1) THEN s + 1 ELSE s END"
        return f"aggregate(ids, 0, (s, x) -> {step}) = {len(sentences)}"

    cut = f"split(coalesce(text, ''), {quoted(ENDS)})"
    looked_up = docs.select("doc_id", "text").selectExpr(
        "doc_id",
        f"transform(filter({cut}, c -> c RLIKE '[A-Za-z0-9]'), c -> struct(c AS c, {identifier('c')} AS i)) AS found",
    )
    looked_up = looked_up.selectExpr(
        "doc_id",
        "CAST(size(found) AS BIGINT) AS n_sentences",
        # A sentence that is not known as a whole: its lines. What is not known is a dash.
        "transform(flatten(transform(found, f -> CASE WHEN f.i IS NOT NULL OR instr(f.c, '\\n') = 0 THEN array(f.i) "
        "ELSE transform(filter(split(f.c, '\\n'), c -> c RLIKE '[A-Za-z0-9]'), "
        f"c -> {identifier('c')}) END)), i -> coalesce(i, '-')) AS units",
    )
    # Pieces side by side become their sentence; what is left of pieces is nothing.
    joined = "concat('<', array_join(units, '><'), '>')"
    for name, form in sorted(FORMS, key=lambda f: -len(f[1])):
        parts = "".join(f"<{names_of[p]}>" for p in form)
        joined = f"replace({joined}, {quoted(parts)}, {quoted(f'<{name}>')})"
    looked_up = looked_up.selectExpr(
        "doc_id",
        "n_sentences",
        "CASE WHEN exists(units, u -> startswith(u, '~')) THEN "
        f"filter(split(substr({joined}, 2, length({joined}) - 2), '><'), u -> NOT u RLIKE '^[~-]') "
        "ELSE filter(units, u -> u <> '-') END AS ids",
    )
    rules = RULES + FORM_RULES
    names = sorted({name for name, _ in rules})
    tests = {n: " OR ".join(holds(r) for name, r in rules if name == n) for n in names}
    for small, large in CONTAINED.items():
        tests[small] = f"({tests[small]}) AND NOT ({tests[large]})"
    found = ", ".join(f"CASE WHEN {tests[n]} THEN {quoted(n)} END" for n in names)
    return looked_up.selectExpr(
        "doc_id", "n_sentences", "ids", f"filter(array({found}), n -> n IS NOT NULL) AS _found"
    ).select(
        "doc_id",
        "n_sentences",
        F.expr("CAST(size(ids) AS BIGINT)").alias("n_licence_sentences"),
        F.array_join("ids", " ").alias("sequence"),
        F.array_join("_found", ",").alias("licences"),
        F.expr("CAST(size(_found) AS BIGINT)").alias("n_licences"),
    )
