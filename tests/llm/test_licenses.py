import random
import re
import textwrap

import duckdb
import pyarrow as pa

from quayside.llm import licenses


def scan(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["sentences"], r["licenses"], r["n_licenses"]) for r in licenses.scan_licenses(df).orderBy("doc_id").collect()]


def test_rules(spark):
    s = licenses.SENTENCES
    mit = "\n".join([s["mit-title"], "Copyright (c) 2020 Somebody.", s["mit-grant"], s["mit-condition"], s["as-is"]])
    bsd = " ".join([s["bsd-grant"], "*", s["bsd-source"], "*", s["bsd-binary"]])
    got = scan(
        spark,
        mit,
        bsd,
        bsd + " " + s["bsd-endorse"],
        " ".join([s["bsd-binary"], s["bsd-source"], s["bsd-grant"]]),
        "Some prose.\n" + s["mit-notice"].upper() + "\nMore; " + s["apache-notice"] + " End",
        s["apache-header"] + " " + s["apache-use"],
        s["gpl-free"] + " " + s["gpl-header"],
        "Prose about a license, released under the MIT license terms of use.",
    )
    assert [g[1] for g in got] == ["MIT", "BSD-2-Clause", "BSD-3-Clause", "", "Apache-2.0,MIT", "Apache-2.0", "GPL-3.0-or-later", ""]
    assert got[0][0] == "mit-title,mit-grant,mit-condition,as-is" and got[4][2] == 2


def test_every_sentence_is_found(spark):
    names = list(licenses.SENTENCES)
    got = scan(spark, *(f"Before it. {licenses.SENTENCES[n]}\nAfter it." for n in names))
    assert [g[0] for g in got] == names


def test_awkward(spark, awkward, no_docs):
    rows = licenses.scan_licenses(awkward).collect()
    assert len(rows) == 11 and all(r["licenses"] == "" and r["n_licenses"] == 0 for r in rows)
    assert licenses.scan_licenses(no_docs).collect() == []
    long = "Word. " * 60_000 + licenses.SENTENCES["cc0-notice"]
    assert scan(spark, long, long + " " + long)[1][1] == "CC0-1.0"


def test_native(documents):
    plan = licenses.scan_licenses(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_wrapped(spark):
    """Texts as they stand in files: wrapped, with comment marks, titles on lines of their own."""
    s = licenses.SENTENCES
    texts = {
        "MIT": ["MIT License", "Copyright (c) 2020 Somebody", s["mit-grant"], s["mit-condition"], s["as-is"]],
        "BSD-3-Clause": [s["bsd-grant"], *(f"{i}. {s[n]}" for i, n in enumerate(["bsd-source", "bsd-binary", "bsd-endorse"], 1))],
        "ISC": ["Copyright 2020 Somebody", s["isc-grant"], s["as-is"]],
        "GPL-3.0-or-later": [s["gpl-free"] + " " + s["gpl-header"]],
        "MPL-2.0": [s["mpl-notice"] + " 2.0. If a copy of it was not distributed with this file, You can obtain one."],
        "Apache-2.0": [s["apache-header"] + " " + s["apache-use"]],
        "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"],
    }
    for width in (30, 72, 79):
        for prefix in ("", " * ", "# ", "// "):
            for end in ("\n", "\r\n"):
                wrapped = [
                    end.join(prefix + x for part in parts for x in [*textwrap.wrap(part, width, break_on_hyphens=False), ""])
                    for parts in texts.values()
                ]
                assert [g[1] for g in scan(spark, *wrapped)] == list(texts), (width, prefix, end)
    # Titles on lines that follow each other, and words that only meet across a paragraph.
    assert scan(spark, "Apache License\nVersion 2.0, January 2004\nhttp://x")[0][1] == "Apache-2.0"
    assert scan(spark, "Licensed under\n\nCC BY 4.0.", "Licensed under\nCC BY 4.0.") == [("", "", 0), ("cc-by-notice", "CC-BY-4.0", 1)]


def test_tags_headers_and_notices(spark):
    gpl2 = (
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
        "published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n"
    )
    lgpl = gpl2.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 2 ", "version 2.1 ")
    agpl = (
        "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU Affero General Public "
        "License as published by\n// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version."
    )
    want = {
        "# SPDX-License-Identifier: MIT": "MIT",
        "/* SPDX-License-Identifier: (GPL-2.0-only OR MIT) */\nint x;": "GPL-2.0-only,MIT",
        "SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0\n": "GPL-2.0-or-later",
        "SPDX-License-Identifier: Apache-2.0.\nIt and ISC are well known.": "Apache-2.0",
        "SPDX-License-Identifier: MIT and more prose on ISC": "MIT",
        "SPDX-License-Identifier: Unknown-1.0": "",
        gpl2: "GPL-2.0-or-later",
        lgpl: "LGPL-2.1-or-later",
        agpl: "AGPL-3.0-or-later",
        gpl2.replace(" as published", " version 2 as published").replace("; either version 2 of the License, or\n(at your option) any later version", ""): "GPL-2.0-only",
        "This project is licensed under the terms of the MIT license.": "MIT",
        "Code of ours. Released under the BSD 3-Clause License\n\nMore.": "BSD-3-Clause",
        "This software is provided 'as-is', without any express or implied\nwarranty. " + licenses.SENTENCES["zlib-grant"]: "Zlib",
        licenses.SENTENCES["0bsd-grant"] + "\n\n" + licenses.SENTENCES["as-is-author"]: "0BSD",
        licenses.SENTENCES["isc-grant"] + "\n\n" + licenses.SENTENCES["as-is-author"]: "ISC",
        "Eclipse Public License - v 2.0": "EPL-2.0",
        "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "LGPL-3.0",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "We read about the MIT license and version 2 of the GNU General Public License.": "",
    }
    assert [g[1] for g in scan(spark, *want)] == list(want.values())


def test_every_rule_can_match():
    ids = set(licenses._known().values()) | set(licenses._spdx().values())
    assert all(set(rule) <= ids for rules in licenses._rules().values() for rule in rules)


def test_tree_is_the_longest_known_sentence():
    draw = random.Random(2)
    known = sorted({" ".join(draw.choices("ab", k=draw.randrange(1, 6))) for _ in range(25)})
    tree = re.compile(rf"(?<=[#]){licenses._sentences(known, ' ')}(?=[#])")
    flat = re.compile(f"(?<=[#])(?:{'|'.join(sorted(known, key=lambda x: (-len(x), x)))})(?=[#])")
    for _ in range(300):
        text = "#" + "#".join(" ".join(draw.choices("abc", k=draw.randrange(1, 6))) for _ in range(4)) + "#"
        assert tree.findall(text) == flat.findall(text)


def test_sql_on_wrapped_texts(spark):
    """Sentences, tags and prose in random order, wrapped or not, with comment marks, ends of lines and odd characters."""
    draw, s = random.Random(9), list(licenses.SENTENCES.values())
    s += ["SPDX-License-Identifier: (MIT OR GPL-3.0+) AND ISC", "This work is licensed under the terms of the Apache License 2.0."]
    s += [t for f, vs in licenses.GNU_VERSIONS.items() for v in vs for t in licenses._gnu_header(f, v)[0].values()]
    prose = ["Some prose.", "copyright (c) 2020 \u00e9t\u00e9", "", "...", "x:y; z", "the\x01end\x02.", "soft\u2028", "tab\tsoftware \t."]
    texts = [None, "", "\n", "MIT License.\n", "MIT License\u2028", "MIT License. \r\n", "Apache License\rVersion 2.0, January 2004"]
    for _ in range(300):
        parts, end, mark = draw.choices(s + prose, k=draw.randrange(1, 7)), draw.choice(["\n", "\r\n", "\r", "\n\n"]), draw.choice(["", " * ", "# "])
        if draw.random() < 0.6:
            parts = [x for part in parts for x in textwrap.wrap(part, draw.choice([20, 40, 72]), break_on_hyphens=False) or [""]]
        texts.append(draw.choice(["", " "]) + end.join(mark + x for x in parts) + draw.choice(["", end, "."]))
    documents = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    connection = duckdb.connect()
    connection.register("documents", documents)
    want = {r[0]: r[1:] for r in connection.execute(licenses.oracle()).fetchall()}
    got = scan(spark, *texts)
    assert [want[i] for i in range(len(texts))] == got
    assert sum(bool(g[1]) for g in got) > 200
