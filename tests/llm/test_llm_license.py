import re

import pytest

from duosync.llm.license import Sentences, recognise
from duosync.llm.queries import op9_license

KNOWN = Sentences()
MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# Redistributions of source code must retain the above copyright notice, this
# list of conditions and the following disclaimer.
# Redistributions in binary form must reproduce the above copyright notice,
# this list of conditions and the following disclaimer in the documentation
# and/or other materials provided with the distribution.
"""
NAMES = """
Neither the name of the Example Project nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.
"""
GPL = """
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""


def licences(text):
    return [name for name, _ in KNOWN.licences(KNOWN.sentences(text))]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Released under the MIT License.", ["MIT"]),
        ("words before\nLicensed under the Apache License, Version 2.0.\nand after", ["Apache-2.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        (
            "A line. This work is licensed under the GNU General Public License, version 3. More.",
            ["GPL-3"],
        ),
        ("this work is RELEASED under the mit licence", ["MIT"]),
        ("Released under the GPL.", ["GPL"]),
        (MIT, ["MIT"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + NAMES, ["BSD-3-Clause"]),
        (BSD + "w " * 2000 + "\n" + NAMES, ["BSD-3-Clause"]),
        (BSD + "\n" + MIT + "\n" + NAMES, ["BSD-2-Clause", "MIT"]),
        (BSD + NAMES.replace("copyright holder", "a b c d e f g h i j k l m n o p q r s t Inc"), ["BSD-3-Clause"]),
        (GPL, ["GPL-3+"]),
        (MIT + "\n" + BSD + "\nReleased under the MIT License.", ["MIT", "BSD-2-Clause", "MIT"]),
        ("He said it was released under the MIT License.", []),
        ("Released under the MIT License of old days", []),
        ("Licensed under the Apache License, Version two.", []),
        ("The above copyright notice", []),
        ("no licence at all", []),
        ("", []),
    ],
)
def test_licences(text, want):
    assert licences(text) == want


def test_rules_go_in_order():
    known = Sentences(
        [("a", "one license"), ("b", "two license"), ("c", "v <v> license")], [], [],
        [("AB", ["a", "b"]), ("B", ["b"]), ("A", ["a"]), ("C-<v>", ["c"])],
    )
    text = "two license. one license. two license. one license. v 2.1 license. two license."
    found = known.sentences(text)
    assert [n for n, *_ in found] == ["b", "a", "b", "a", "c", "b"]
    assert known.licences(found) == [("B", 0), ("AB", 2), ("AB", 6), ("C-2.1", 8)]


def test_rows(spark):
    schema = "doc_id long, text string, licences string, n_sentences string"
    rows = [(1, MIT), (1, MIT), (2, None), (3, ""), (None, "Released under the MIT License."), (4, "x " * 100_000 + MIT)]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], schema)
    got = sorted((str(r.doc_id), r.licences, r.n_sentences) for r in recognise(docs).collect())
    assert got == sorted(
        [("1", ["MIT"], 3)] * 2 + [("2", [], 0), ("3", [], 0), ("None", ["MIT"], 1), ("4", ["MIT"], 2)]
    )
    assert recognise(docs.filter("false")).count() == 0


def test_given_documents(spark):
    """Against plain patterns for the four statements that the given documents hold."""
    sf = "/root/testdata/sf0.1"
    plain = {
        "MIT": r"Released under the MIT License\.",
        "Apache-2.0": r"Licensed under the Apache License, Version 2\.0\.",
        "GPL-3": r"This work is licensed under the GNU General Public License, version 3\.",
        "CC-BY-NC-4.0": r"Licensed under CC BY-NC 4\.0\.",
    }
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in op9_license(spark, sf).collect():
        want = {n for n, p in plain.items() if re.search(f"(?m)^{p}$", texts[r.doc_id])}
        assert set(filter(None, r.licences.split(", "))) == want, texts[r.doc_id][:300]
        found += bool(want)
    assert found > 50


@pytest.mark.parametrize(
    "text, want",
    [
        ("Copyright 2020 Jane Doe. Licensed under the MIT License.", ["MIT"]),
        ("Copyright 2020 Jane Doe\nLicensed under the MIT License.", ["MIT"]),
        ("Copyright 2020 J. R. Doe. All rights reserved.\nReleased under the GPL.", ["GPL"]),
        ("Copyright\nLicensed under the MIT License", ["MIT"]),
        ("// SPDX-License-Identifier: MIT", ["MIT"]),
        ("/* spdx-license-identifier:BSD-3-Clause */\nint main;", ["BSD-3-Clause"]),
        ("SPDX-License-Identifier: MIT\nLicensed under the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
        ("# SPDX-License-Identifier: (GPL-2.0-or-later OR LGPL-2.1-only) AND CC0-1.0", ["GPL-2+", "LGPL-2.1", "CC0-1.0"]),
        ("SPDX-License-Identifier: GPL-3.0-only WITH Classpath-exception-2.0", ["GPL-3 WITH classpath-exception-2.0"]),
        ("SPDX-License-Identifier: " + " OR ".join(["MIT", "ISC", "Zlib", "X11", "Ruby", "Vim"]), ["MIT", "ISC", "Zlib", "X11", "Ruby", "Vim"]),
        ("SPDX-License-Identifier: LicenseRef-Mine", ["licenseref-mine"]),
        ("SPDX-License-Identifier: see the file", []),
        ("SPDX-License-Identifier: NOASSERTION", []),
        ("SPDX-License-Identifier: MIT OR", []),
    ],
)
def test_names_end_with_their_unit(text, want):
    assert licences(text) == want


def test_copyright_takes_its_own_unit():
    found = KNOWN.sentences("Copyright 2020 Jane Doe. All rights reserved. Released under the MIT License.")
    assert [n for n, *_ in found] == ["copyright", "all-rights", "statement MIT"]
    over_lines = "You may obtain a copy of the License at\n\n  http://www.apache.org/licenses/LICENSE-2.0\n\nUnless so"
    assert [n for n, *_ in KNOWN.sentences(over_lines)] == ["apache-copy"]
