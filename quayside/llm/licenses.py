"""Licence recognition by sentences: known sentences become identifiers, rules match their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of public licence texts and notices, and their identifiers.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-title": "Apache License",
    "apache-version": "Version 2.0, January 2004",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-header": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "gpl3-version": "Version 3, 29 June 2007",
    "gpl2-version": "Version 2, June 1991",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "lgpl-version": "Version 2.1, February 1999",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "agpl-version": "Version 3, 19 November 2007",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "0bsd-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted."
    ),
    "as-is-author": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0.",
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl2-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
}

#: A licence holds where the identifiers of one of its rules occur in this order.
RULES = [
    ("AGPL-3.0", ["agpl-title", "agpl-version"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("Apache-2.0", ["apache-title", "apache-version"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("GPL-2.0", ["gpl-title", "gpl2-version"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0", ["gpl-title", "gpl3-version"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-header"]),
    ("ISC", ["isc-grant", "as-is"]),
    ("LGPL-2.1", ["lgpl-title", "lgpl-version"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("Unlicense", ["unlicense"]),
    ("0BSD", ["0bsd-grant", "as-is-author"]),
    ("ISC", ["isc-grant", "as-is-author"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("BSL-1.0", ["bsl-title"]),
    ("BSL-1.0", ["bsl-notice"]),
    ("EPL-1.0", ["epl1-title"]),
    ("EPL-2.0", ["epl2-title"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("LGPL-3.0", ["lgpl-title", "gpl3-version"]),
]

#: The names under which notices refer to a licence.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "0BSD License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPLv3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPLv2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPLv3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "MIT": ["MIT License", "MIT/X11 License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License", "zlib/libpng License"],
}
#: How a notice begins.
NOTICES = [
    f"{start} under the {terms}"
    for start in (
        "Licensed", "Released", "Distributed", "This project is licensed", "This software is licensed", "This program is licensed",
        "This library is licensed", "This work is licensed", "This code is licensed", "This file is licensed",
    )
    for terms in ("", "terms of the ")
]

#: The GNU licences by their short names, and their versions.
GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = {"GPL": ["2.0", "3.0"], "LGPL": ["2.1", "3.0"], "AGPL": ["3.0"]}

#: SPDX identifiers; those of the GNU licences follow from their versions.
SPDX = [
    "0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "EPL-1.0", "EPL-2.0", "ISC", "MIT", "MPL-2.0", "Unlicense", "Zlib",
    *(f"{f}-{v}{form}" for f, versions in GNU_VERSIONS.items() for v in versions for form in ("", "-only", "-or-later")),
]
#: An identifier after an SPDX tag, and the expression of them that the tag gives, in lower case.
_SPDX_ID = r"[a-z0-9+-]+(?:\.[a-z0-9+-]+)*"
_SPDX_TAG = rf"spdx-license-identifier:[ \t]*(\(*{_SPDX_ID}\)*(?:[ \t]+(?:or|and|with)[ \t]+\(*{_SPDX_ID}\)*)*)"


def _gnu_header(family: str, version: str) -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Sentences and rules of the header that a GNU licence asks for, in its usual punctuations."""
    name, short, key = GNU[family], version.removesuffix(".0"), f"{family.lower()}-{version}"
    redistribute = f"you can redistribute it and/or modify it under the terms of the {name}"
    header = "gpl-header" if key == "gpl-3.0" else f"{key}-header"  # the one that is stated above
    later = f"either version {short} of the License, or (at your option) any later version."
    sentences = {
        f"{family.lower()}-redistribute": f"{redistribute} as published by the Free Software Foundation;",
        f"either-{short}": later,
        header: f"{redistribute} as published by the Free Software Foundation, {later}",
        f"{key}-only": f"{redistribute} version {short} as published by the Free Software Foundation.",
    }
    rules = [
        (f"{family}-{version}-or-later", [f"{family.lower()}-redistribute", f"either-{short}"]),
        (f"{family}-{version}-or-later", [header]),
        (f"{family}-{version}-only", [f"{key}-only"]),
    ]
    return sentences, rules


#: A licence is not reported beside one that has all of its sentences and more.
WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}

#: An end mark that closes a sentence, and a line break, which may also lie within one.
_END_MARK = r"[.!?:;]+(?:[ \t]+|(?=[\r\n])|$)"
_LINE_BREAK = r"\r\n|[\r\n]"
#: What stands for a line break within a paragraph, and for the end of a sentence or paragraph.
_SOFT, _HARD = "\x01", "\x02"
#: One of these is in every known sentence, so a text without any of them has no known sentence.
ANCHORS = ["licen", "released under", "distributed under", "permi", "copyright", "warrant", "redistribut", "software", "version ", "may not use"]


def normalised(sentence: str) -> str:
    """The form in which sentences are compared: lower-case ASCII letters and digits, single spaces."""
    low = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.translate(_LOWER))
    return " ".join(low.split())


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SOFT + _HARD, "abcdefghijklmnopqrstuvwxyz  ")


def _fragments(low: Column) -> Column:
    """The normalised words of a text with a mark at each line break and sentence end, and at both ends.

    Line breaks next to each other, also with comment marks between them, end a paragraph.
    """
    marked = F.regexp_replace(F.regexp_replace(low, _END_MARK, _HARD), _LINE_BREAK, _SOFT)
    spaced = F.regexp_replace(marked, f"[^a-z0-9{_SOFT}{_HARD}]+", " ")
    tight = F.regexp_replace(F.concat(F.lit(_HARD), spaced, F.lit(_HARD)), f" ?([{_SOFT}{_HARD}]) ?", "$1")
    return F.regexp_replace(tight, f"[{_SOFT}{_HARD}]{{2,}}", _HARD)


def _known() -> dict[str, str]:
    """Normalised sentence -> identifier. The sentences stated by themselves come before those that follow from names."""
    known = {normalised(text): name for name, text in SENTENCES.items()}
    for family, versions in GNU_VERSIONS.items():
        for version in versions:
            for name, text in _gnu_header(family, version)[0].items():
                known.setdefault(normalised(text), name)
    for license_name, names in NAMES.items():
        for name in names:
            for notice in NOTICES:
                known.setdefault(normalised(f"{notice}{name}"), f"notice-{license_name.lower()}")
    return known


def _rules() -> dict[str, list[list[str]]]:
    """The rules of each licence, in alphabetical order: sequences of identifiers."""
    every = list(RULES)
    for family, versions in GNU_VERSIONS.items():
        for version in versions:
            every += _gnu_header(family, version)[1]
    every += [(name, [f"notice-{name.lower()}"]) for name in NAMES]
    every += [(name, [f"spdx-{name.lower()}"]) for name in SPDX]
    found: dict[str, list[list[str]]] = {}
    for name, rule in every:
        found.setdefault(name, []).append(rule)
    return dict(sorted(found.items()))


def _spdx() -> dict[str, str]:
    """SPDX identifier in lower case -> identifier of the sequence; a plus sign is the older form of "or later"."""
    found = {name.lower(): f"spdx-{name.lower()}" for name in SPDX}
    return found | {n.removesuffix("-or-later") + "+": i for n, i in found.items() if n.endswith("-or-later")}


def _sentences(known: list[str], gap: str) -> str:
    """Matches a known sentence, the longest at a place: a tree of words, `gap` between two of them."""
    tree: dict = {}
    for sentence in known:
        node = tree
        for word in sentence.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def following(node: dict) -> str:
        words = [w + rest(node[w]) for w in sorted(node) if w]
        return words[0] if len(words) == 1 else f"(?:{'|'.join(words)})"

    def rest(node: dict) -> str:
        if list(node) == [""]:
            return ""
        more = gap + following(node)
        # A longer sentence is tried before the one that ends here.
        return f"(?:{more})?" if "" in node else more

    return following(tree)


def _in_order(found: Column, rule: list[str]) -> Column:
    """Whether the rule's identifiers occur in `found` (each between bars) one after the other."""
    return found.rlike(_sequence(rule))


def _sequence(rule: list[str]) -> str:
    return r"\|.*".join(r"\|" + name.replace(".", r"\.") for name in rule) + r"\|"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, sentences (known identifiers in text order, comma-joined), licenses and n_licenses.

    Texts are cut into sentences, which are normalised and looked up among the known ones. A
    sentence may be wrapped over lines, each with comment marks; a line or several may also be one
    without an end mark, as titles are. Of known sentences that overlap the first and of these the
    longest counts. The identifiers of SPDX tags come after the sentences; unknown ones and exceptions
    are passed over. A rule matches where its identifiers occur in order, others between them allowed. `licenses` lists
    each matching licence once, in alphabetical order, comma-joined; a licence that is contained
    in another matching one is left out. Null, empty and other texts without a known sentence have
    empty strings and 0. A row per row of `docs`; other columns are ignored.

    One pass of column expressions without a shuffle. Texts without any anchor word, which every
    known sentence has, are not cut.
    """
    known = _known()
    assert all(any(a in s for a in ANCHORS) for s in known)
    lookup = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    # Anchors hold letters and single spaces; other characters may stand between words in a text.
    anchored = F.lit(False)
    low = _lower(F.col("__text"))
    for word in ANCHORS:
        anchored = anchored | low.contains(word.split(" ")[0])
    pattern = f"(?<=[{_SOFT}{_HARD}]){_sentences(list(known), f'[ {_SOFT}]')}(?=[{_SOFT}{_HARD}])"
    found = F.regexp_extract_all(_fragments(low), F.lit(pattern), F.lit(0))
    ids = F.transform(found, lambda x: F.element_at(lookup, F.translate(x, _SOFT, " ")))
    spdx = _spdx()
    by_tag = F.create_map(*(F.lit(x) for pair in spdx.items() for x in pair))
    tags = F.transform(F.regexp_extract_all(low, F.lit(_SPDX_TAG), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(_SPDX_ID), F.lit(0)))
    tagged = F.transform(F.filter(F.flatten(tags), lambda x: x.isin(list(spdx))), lambda x: F.element_at(by_tag, x))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    rows = rows.select("doc_id", F.when(anchored, F.array_join(F.concat(ids, tagged), ",")).otherwise("").alias("sentences"))
    found = F.concat(F.lit("|"), F.regexp_replace("sentences", ",", "||"), F.lit("|"))
    by_name: dict[str, Column] = {}
    for name, rules in _rules().items():
        for rule in rules:
            by_name[name] = by_name[name] | _in_order(found, rule) if name in by_name else _in_order(found, rule)
    names = F.array_compact(
        F.array(*(F.when(by_name[n] & ~by_name[WITHIN[n]] if n in WITHIN else by_name[n], n) for n in sorted(by_name)))
    )
    none = F.array().cast("array<string>")
    return (
        rows.withColumn("__names", F.when(F.col("sentences") != "", names).otherwise(none))
        .select("doc_id", "sentences", F.array_join("__names", ",").alias("licenses"), F.size("__names").cast("long").alias("n_licenses"))
    )


def oracle() -> str:
    """The same in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = _known()
    spdx = _spdx()
    rules = {
        name: " OR ".join(f"regexp_matches(bars, {quote(_sequence(rule))})" for rule in of) for name, of in _rules().items()
    }
    cases = [
        f"CASE WHEN ({rules[n]})" + (f" AND NOT ({rules[WITHIN[n]]})" if n in WITHIN else "") + f" THEN {quote(n)} END"
        for n in sorted(rules)
    ]
    # A mark stands twice, so that each of two sentences side by side has one of its own.
    sentences = _sentences(list(known), r"(?: |\x01\x01)")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH known AS (SELECT unnest([{", ".join(map(quote, known))}]) AS sentence, unnest([{", ".join(map(quote, known.values()))}]) AS name),
spdx AS (SELECT unnest([{", ".join(map(quote, spdx))}]) AS tag, unnest([{", ".join(map(quote, spdx.values()))}]) AS name),
rows AS (SELECT row_number() OVER () AS row_no, doc_id,
    translate(coalesce(text, ''), '{upper}' || chr(1) || chr(2), '{lower}  ') AS low FROM documents),
marked AS (SELECT row_no, low, regexp_replace(regexp_replace(regexp_replace(low, '[.!?:;]+([ \\t]+|$)', chr(2), 'g'),
    '[.!?:;]+([\\r\\n])', chr(2) || '\\1', 'g'), '\\r\\n|[\\r\\n]', chr(1), 'g') AS line FROM rows),
spaced AS (SELECT row_no, low, regexp_replace(chr(2) || regexp_replace(line, '[^a-z0-9\\x01\\x02]+', ' ', 'g') || chr(2),
    ' ?([\\x01\\x02]) ?', '\\1', 'g') AS line FROM marked),
doubled AS (SELECT row_no, low, regexp_replace(regexp_replace(line, '[\\x01\\x02]{{2,}}', chr(2), 'g'), '([\\x01\\x02])', '\\1\\1', 'g') AS line
    FROM spaced),
cut AS (SELECT row_no, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
    FROM (SELECT row_no, regexp_extract_all(line, {quote(rf"[\x01\x02]({sentences})[\x01\x02]")}, 1) AS parts FROM doubled)),
tags AS (SELECT row_no, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (SELECT row_no, flatten(list_transform(
    regexp_extract_all(low, {quote(_SPDX_TAG)}, 1), lambda x: regexp_extract_all(x, {quote(_SPDX_ID)}))) AS parts FROM rows)),
ids AS (SELECT row_no, string_agg(name, ',' ORDER BY kind, pos) AS sentences FROM (
    SELECT row_no, 1 AS kind, pos, name FROM cut JOIN known ON sentence = replace(part, chr(1) || chr(1), ' ')
    UNION ALL SELECT row_no, 2, pos, name FROM tags JOIN spdx ON tag = part) GROUP BY row_no),
found AS (SELECT doc_id, coalesce(sentences, '') AS sentences, '|' || replace(coalesce(sentences, ''), ',', '||') || '|' AS bars
    FROM rows LEFT JOIN ids USING (row_no)),
named AS (SELECT doc_id, sentences, list_filter([{", ".join(cases)}], lambda x: x IS NOT NULL) AS names FROM found)
SELECT doc_id, sentences, array_to_string(names, ',') AS licenses, CAST(len(names) AS BIGINT) AS n_licenses FROM named"""
