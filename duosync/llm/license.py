"""Licence recognition by sentences and rules.

1. A text is cut into units: lines, and sentences within lines. Words are normalised: lower case,
   without quotes, comment marks and final punctuation.
2. Known licence sentences stand in a tree of words, in which some places take any version, year
   or name. From the start of each unit the longest sentence that ends with a unit is
   taken, so a sentence may run over several lines. It becomes an identifier, with its version. A
   name at a sentence's end goes no further than its own unit, nor over a known sentence.
3. The identifiers, in order, are matched against the rules, also in order: a rule is a sequence
   of identifiers. Identifiers that a rule used are not used again. What stands between them
   doesn't matter, but a sentence that begins another licence ends the search.

Texts go through one pass without a shuffle; the sentences and rules travel with the code.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and notices. <v> takes a version, <y> years, <*> any
# words of the sentence, <l> a licence expression to the end of its unit; (a|b) are alternatives. Several texts may have one identifier.
SENTENCES: list[tuple[str, str]] = [
    ("copyright", "copyright <*>"),
    ("all-rights", "all rights reserved"),
    ("spdx", "spdx-license-identifier: <l>"),
    (
        "mit-grant",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the software), to deal in the software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the software, and to permit persons to whom"
        " the software is furnished to do so, subject to the following conditions",
    ),
    (
        "mit-notice",
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software",
    ),
    (
        "isc-grant",
        "permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    (
        "bsd-grant",
        "redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "bsd-source",
        "redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer",
    ),
    (
        "bsd-binary",
        "redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution",
    ),
    (
        "bsd-names",
        "neither the name of <*> nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ),
    (
        "bsd-advertising",
        "all advertising materials mentioning features or use of this software must display the"
        " following acknowledgement",
    ),
    (
        "gpl-grant",
        "this program is free software: you can redistribute it and/or modify it under the terms of"
        " the gnu general public license as published by the free software foundation, either"
        " version <v> of the license, or (at your option) any later version",
    ),
    (
        "gpl-grant",
        "this program is free software; you can redistribute it and/or modify it under the terms of"
        " the gnu general public license as published by the free software foundation; either"
        " version <v> of the license, or (at your option) any later version",
    ),
    (
        "lgpl-grant",
        "this library is free software; you can redistribute it and/or modify it under the terms of"
        " the gnu lesser general public license as published by the free software foundation; either"
        " version <v> of the license, or (at your option) any later version",
    ),
    (
        "gpl-warranty",
        "this program is distributed in the hope that it will be useful, but without any warranty;"
        " without even the implied warranty of merchantability or fitness for a particular purpose",
    ),
    (
        "apache-grant",
        "licensed under the apache license, version <v> (the license); you may not use this file"
        " except in compliance with the license",
    ),
    ("apache-copy", "you may obtain a copy of the license at <*>"),
    (
        "mpl-grant",
        "this source code form is subject to the terms of the mozilla public license, v. <v>",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "this work is (in|dedicated to|released into) the public domain"),
    (
        "cc-grant",
        "this work is licensed under a creative commons <*> <v> (international|unported|generic) license",
    ),
]

# One-line statements are these openings with each of these names.
OPENINGS = [
    "(licensed|released|distributed|available|published) under",
    "this (work|file|program|software|project|text|document|package) is"
    " (licensed|released|distributed|available|published) under",
]
NAMES: list[tuple[str, str]] = [
    ("MIT", "(the|an) mit license"),
    ("MIT", "mit"),
    ("ISC", "the isc license"),
    ("BSD", "(the|a) bsd license"),
    ("BSD-3-Clause", "the bsd 3-clause license"),
    ("BSD-2-Clause", "the bsd 2-clause license"),
    ("Apache-<v>", "the apache license, version <v>"),
    ("Apache-<v>", "the apache license <v>"),
    ("Apache-<v>", "apache <v>"),
    ("GPL-<v>", "the gnu general public license, version <v>"),
    ("GPL-<v>", "the gnu general public license <v>"),
    ("GPL-<v>", "the gpl, version <v>"),
    ("GPL-<v>", "the gpl <v>"),
    ("GPL", "the gnu general public license"),
    ("GPL", "the gpl"),
    ("LGPL-<v>", "the gnu lesser general public license, version <v>"),
    ("LGPL", "the gnu lesser general public license"),
    ("AGPL-<v>", "the gnu affero general public license, version <v>"),
    ("MPL-<v>", "the mozilla public license, version <v>"),
    ("MPL-<v>", "the mozilla public license <v>"),
    ("CC-BY-<v>", "cc by <v>"),
    ("CC-BY-SA-<v>", "cc by-sa <v>"),
    ("CC-BY-NC-<v>", "cc by-nc <v>"),
    ("CC-BY-ND-<v>", "cc by-nd <v>"),
    ("CC-BY-NC-SA-<v>", "cc by-nc-sa <v>"),
    ("CC-BY-NC-ND-<v>", "cc by-nc-nd <v>"),
    ("CC0-<v>", "cc0 <v>"),
]

# A licence, and the sentences that state it. Earlier rules go first; <v> is the
# version that one of the sentences names, <l> every licence of an expression.
RULES: list[tuple[str, list[str]]] = [
    ("<l>", ["spdx"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant"]),
    ("GPL-<v>+", ["gpl-grant", "gpl-warranty"]),
    ("GPL-<v>+", ["gpl-grant"]),
    ("LGPL-<v>+", ["lgpl-grant"]),
    ("Apache-<v>", ["apache-grant", "apache-copy"]),
    ("Apache-<v>", ["apache-grant"]),
    ("MPL-<v>", ["mpl-grant"]),
    ("Unlicense", ["unlicense"]),
    ("public-domain", ["public-domain"]),
    ("CC-<v>", ["cc-grant"]),
]

# Identifiers in their own spelling; the GNU ones as the rules above name them.
SPDX = {
    x.lower(): x
    for x in (
        "0BSD AFL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause"
        " BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-1.0"
        " CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0"
        " CC-BY-SA-4.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0"
        " CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0"
        " CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 IJG IPL-1.0"
        " ISC JSON Libpng LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL"
        " MulanPSL-2.0 NCSA OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby"
        " Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
    ).split()
}
_GNU = re.compile(r"([al]?gpl)-(\d+(?:\.\d+)*?)(?:\.0)?(\+|-or-later|-only)?\Z")
_ID = re.compile(r"[a-z0-9][a-z0-9.:-]*\+?\Z")
_SPDX = re.compile(r"spdx-licen[cs]e-identifier:")

_UNIT = re.compile(r"[\n\r\x0b\x0c]+|(?<=[.!?;:])\s+")
_WORD = re.compile(r"[^\s\"'`*#()\[\]{}<>|“”‘’«»]+")
_VERSION = re.compile(r"v?\d+(?:\.\d+)*\Z")
# Every known sentence holds one of these, so a text without them has none.
_HINT = re.compile(
    "licen[cs]e|permission|redistribution|copyright|rights reserved|public domain|free software"
    "|advertising|warranty|neither the name|(?:released|distributed|available|published) under"
)
# A sentence that ends within so many words of a wild place may be a short form in a name.
SHORT = 8
_STOPPED = re.compile(r"[.!?]\s*\Z")


def words_of(unit: str) -> list[str]:
    """Normalised words."""
    return [w for x in _WORD.findall(unit) if (w := x.strip("/\\-,.;:!?").replace("licence", "license"))]


def _expand(pattern: str) -> list[list[str]]:
    """A sentence's word sequences, one for each choice of alternatives."""
    out = [""]
    for piece in re.split(r"(\([^()]*\|[^()]*\))", pattern):
        options = piece[1:-1].split("|") if piece.startswith("(") and "|" in piece else [piece]
        out = [a + b for a in out for b in options]
    marked = [re.sub(r"<([vy*l])>", r" \\\1 ", x) for x in out]
    return [["<" + w[1] + ">" if w[:1] == "\\" else w for w in _marked_words(x)] for x in marked]


def _marked_words(text: str) -> list[str]:
    words: list[str] = []
    for part in text.split():
        words += [part] if part in ("\\v", "\\y", "\\*", "\\l") else words_of(part)
    return words


def expression(words: str) -> list[str]:
    """The licences of a lower-case SPDX expression, each once; none if it is something else.

    An exception stays with its licence. Identifiers that aren't known stay in lower case.
    """
    out: list[str] = []
    words, after = words.split(), "or"
    for word in words:
        if after in ("and", "or", "with"):
            if word in ("and", "or", "with") or not _ID.match(word):
                return []
            if after == "with":
                out[-1] += f" WITH {word}"
            elif gnu := _GNU.match(word):
                later = "+" if gnu[3] in ("+", "-or-later") else ""
                out.append(f"{gnu[1].upper()}-{gnu[2]}{later}")
            else:
                name = SPDX.get(word.rstrip("+"))
                out.append(name + word[len(name) :] if name else word)
        elif word not in ("and", "or", "with") or (word == "with" and " WITH " in out[-1]):
            return []
        after = word if after not in ("and", "or", "with") else ""
    if after or out[:1] in (["none"], ["noassertion"]):
        return []
    return list(dict.fromkeys(out))


class Sentences:
    """The tree of known sentences, and the rules in order."""

    def __init__(self, sentences=None, names=None, openings=None, rules=None):
        self.tree: dict = {}
        self.rules = list(RULES if rules is None else rules)
        for name, pattern in SENTENCES if sentences is None else sentences:
            self._add(name, pattern)
        for licence, name in NAMES if names is None else names:
            statement = f"statement {licence}"
            for opening in OPENINGS if openings is None else openings:
                self._add(statement, f"{opening} {name}")
            if (licence, [statement]) not in self.rules:
                self.rules.append((licence, [statement]))
        # Sentences that begin a licence of several.
        self.openings = {names[0] for _, names in self.rules if len(names) > 1}

    def _add(self, name: str, pattern: str) -> None:
        for words in _expand(pattern):
            node = self.tree
            for word in words:
                node = node.setdefault(word, {})
            node.setdefault("", name)

    def _match(
        self, words: list[str], at: int, starts: set[int], ends: list[int], stops: list[int]
    ) -> tuple[int, str, str] | None:
        """The longest sentence from word ``at`` that ends with a unit: (end, name, version)."""
        best = None
        # Behind any words a sentence has one place to end; 0 elsewhere.
        todo = [(self.tree, at, "", 0)]
        while todo:
            node, i, version, end = todo.pop()
            if "" in node and (best is None or i > best[0]):
                if i == end or (not end and (i in starts or i == len(words))):
                    best = (i, node[""], version)
            if i == len(words):
                continue
            if "<*>" in node or "<l>" in node:
                end = ends[bisect_right(ends, i)]
                # Any words may stand there up to the end of the sentence, which a short form like "Inc." isn't.
                stop = stops[bisect_right(stops, i)]
                if i in starts and self._match(words, i, starts, ends, stops):
                    end = -1
                if "<*>" in node:
                    last = max(min(i + SHORT, len(words)), stop)
                    todo += [(node["<*>"], n, version, end) for n in range(i + 1, last + 1)]
                if "<l>" in node and end > 0:
                    todo.append((node["<l>"], end, " ".join(words[i:end]), end))
            if words[i] in node:
                todo.append((node[words[i]], i + 1, version, 0))
            if "<v>" in node and _VERSION.match(words[i]):
                todo.append((node["<v>"], i + 1, words[i].lstrip("v"), 0))
        return best

    def sentences(self, text: str) -> list[tuple[str, str, int, int]]:
        """(identifier, version, first word, word after the last) of the text's known sentences."""
        text = text.lower()
        if not _HINT.search(text):
            return []
        words, starts, stops = [], [], []
        for unit in _UNIT.split(_SPDX.sub("spdx-license-identifier: ", text)):
            own = words_of(unit)
            if own:
                starts.append(len(words))
                words += own
            if _STOPPED.search(unit):
                stops.append(len(words))
        opening, ends = set(starts), [*starts[1:], len(words)]
        stops.append(len(words))
        out, free = [], 0
        for at in starts:
            if at >= free and (found := self._match(words, at, opening, ends, stops)):
                free, name, version = found
                out.append((name, version, at, free))
        return out

    def licences(self, found: list[tuple[str, str, int, int]]) -> list[tuple[str, int]]:
        """(licence, first word) of every rule that matches, by place."""
        left, out = list(found), []
        for licence, names in self.rules:
            at = 0
            while at < len(left):
                match = self._sequence(left, at, names)
                if match:
                    version = next((left[i][1] for i in match if left[i][1]), "")
                    if licence == "<l>":
                        names_found = expression(version)
                    elif version:
                        names_found = [licence.replace("<v>", version)]
                    else:
                        names_found = [licence.replace("-<v>", "")]
                    out += [(name, left[match[0]][2]) for name in names_found]
                    left = [x for i, x in enumerate(left) if i not in match]
                else:
                    at += 1
        return sorted(out, key=lambda x: x[1])

    def _sequence(self, left: list[tuple[str, str, int, int]], at: int, names: list[str]) -> list[int] | None:
        """Places of ``names`` in order from ``at`` on, however far, before another licence begins."""
        if left[at][0] != names[0]:
            return None
        match = [at]
        for name in names[1:]:
            i = match[-1] + 1
            while i < len(left) and left[i][0] != name and left[i][0] not in self.openings:
                i += 1
            if i == len(left) or left[i][0] != name:
                return None
            match.append(i)
        return match


FOUND = "doc_id long, n_sentences long, sentence_ids array<string>, licences array<string>"


def _recognise(known: Sentences):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, licences = [], []
            for text in batch.column(1):
                found = known.sentences(text.as_py() or "")
                ids.append([name for name, *_ in found])
                licences.append(list(dict.fromkeys(name for name, _ in known.licences(found))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(licences, pa.list_(pa.string())),
                ],
                ["doc_id", "n_sentences", "sentence_ids", "licences"],
            )

    return run


def recognise(docs: DataFrame, known: Sentences | None = None) -> DataFrame:
    """One row per document: see ``FOUND``.

    ``sentence_ids`` are the known sentences in order, ``licences`` the licences stated, each
    once, by first place. A null or empty text has none. Repeated rows and null ids are kept
    as they are; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, whole.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(_recognise(known or Sentences()), FOUND)
