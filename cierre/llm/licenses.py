"""License scans by sentences and rules.

A text is cut into sentences, and each sentence is normalised (lower case,
anything but letters and digits one blank) and looked up among known licence
sentences. What is recognised, in the text's order, is the document's sequence
of identifiers. Licence rules are sequences of identifiers, in the order of
their strength: ``full`` (the licence's own sentences), ``notice`` (its standard
notice), ``mention`` (a sentence that names it). A rule holds where its
identifiers follow each other in the sequence; other sentences may lie between. A
rule that holds only inside longer rules of other licences yields to them.

Sentences are cut in two ways, and a rule may hold in either: ``lines`` cuts at
line ends too, ``wrapped`` reads a single line end (and what marks a comment
line) as a blank, as in licence texts that are wrapped.

Defined results: null and empty texts have no sentence and no licence; null
doc_ids stay null; repeated rows are scanned each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm.ship import ship

OUT = "doc_id long, n_sentences long, n_rules long, licenses string"

#: Sentences of licences and their notices (fixed values, from the licences' texts).
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the Software), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                "portions of the Software",
    "mit-as-is": "The Software is provided as is, without warranty of any kind, express or implied, including but not "
                 "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "mit-liable": "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, "
                  "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the "
                  "Software or the use or other dealings in the Software",
    "apache-use": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                  "compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                    "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "gpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                 "option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                 "option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                   "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                   "(at your option) any later version",
    "lgpl3-free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                  "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                  "your option) any later version",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                 "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                  "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                  "your option) any later version",
    "agpl-see": "See the GNU Affero General Public License for more details",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "The software is provided as is and the author disclaims all warranties with regard to this software including "
                 "all implied warranties of merchantability and fitness",
    "isc-liable": "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any "
                  "damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence "
                  "or other tortious action, arising out of or in connection with the use or performance of this software",
    "unlicense-domain": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "cc0-domain": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                  "rights to this software to the public domain worldwide",
    "cc0-warranty": "This software is distributed without any warranty",
    "bsd-forms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                 "that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission",
}

APACHE_URL = "http://www.apache.org/licenses/LICENSE-2.0"

#: Names that licences are mentioned by (fixed values).
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "MIT": ["MIT License", "MIT"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GNU GPL v3", "GPLv3", "GPL-3.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL v2", "GPLv2", "GPL-2.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause", "3-Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause", "2-Clause BSD License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
}
CREATIVE = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
VERSIONS = ["2.0", "3.0", "4.0"]
#: What the kinds and versions are called in full.
CREATIVE_WORDS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CREATIVE_EDITIONS = {"2.0": "Generic", "3.0": "Unported", "4.0": "International"}
SUBJECTS = ["", "This work is", "This software is", "This project is", "This document is", "This file is", "This text is",
            "This code is", "This program is", "It is"]
VERBS = ["licensed", "released", "distributed", "published", "made available"]
TERMS = ["under", "under the", "under the terms of", "under the terms of the", "under a"]

#: Rules: licence, strength, identifiers in order.
LONG_RULES = [
    ("MIT", "full", ["mit-grant", "mit-keep", "mit-as-is", "mit-liable"]),
    ("MIT", "notice", ["mit-grant", "mit-keep"]),
    ("Apache-2.0", "full", ["apache-use", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", "notice", ["apache-use"]),
    ("GPL-3.0", "full", ["gpl3-free", "gpl-hope", "gpl-see"]),
    ("GPL-3.0", "notice", ["gpl3-free"]),
    ("GPL-2.0", "full", ["gpl2-free", "gpl-hope", "gpl-see"]),
    ("GPL-2.0", "notice", ["gpl2-free"]),
    ("LGPL-3.0", "full", ["lgpl3-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-3.0", "notice", ["lgpl3-free"]),
    ("LGPL-2.1", "full", ["lgpl21-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-2.1", "notice", ["lgpl21-free"]),
    ("AGPL-3.0", "full", ["agpl3-free", "gpl-hope", "agpl-see"]),
    ("AGPL-3.0", "notice", ["agpl3-free"]),
    ("MPL-2.0", "notice", ["mpl2-subject"]),
    ("ISC", "full", ["isc-grant", "isc-as-is", "isc-liable"]),
    ("ISC", "notice", ["isc-grant"]),
    ("Unlicense", "full", ["unlicense-domain", "unlicense-anyone"]),
    ("Unlicense", "notice", ["unlicense-domain"]),
    ("CC0-1.0", "full", ["cc0-domain", "cc0-warranty"]),
    ("CC0-1.0", "notice", ["cc0-domain"]),
    ("BSD-3-Clause", "full", ["bsd-forms", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", "full", ["bsd-forms", "bsd-source", "bsd-binary"]),
]
STRENGTHS = ["full", "notice", "mention"]


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def mention_names() -> dict[str, list[str]]:
    out = {k: list(v) for k, v in NAMES.items()}
    for kind in CREATIVE:
        for v in VERSIONS:
            words = "-".join(CREATIVE_WORDS[k] for k in kind.split("-"))
            out[f"CC-{kind}-{v}"] = [
                f"CC {kind} {v}", f"CC {kind} {v} License", f"Creative Commons {kind} {v} License",
                *(f"Creative Commons {words} {v}{e}{end}" for e in ("", " " + CREATIVE_EDITIONS[v]) for end in ("", " License"))]
    return out


def catalogue() -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """Known sentences (normalised to identifier) and rules (licence, strength, identifiers)."""
    known = {normalised(s): i for i, s in SENTENCES.items()}
    known[normalised(SENTENCES["apache-copy"] + " " + APACHE_URL)] = "apache-copy"
    rules = [(lic, strength, " ".join(ids)) for lic, strength, ids in LONG_RULES]
    for lic, names in mention_names().items():
        ident = f"names-{lic.lower()}"
        rules.append((lic, "mention", ident))
        for name in names:
            known[normalised(f"SPDX-License-Identifier: {name}")] = ident
            for subject in SUBJECTS:
                for verb in VERBS:
                    for term in TERMS:
                        known[normalised(f"{subject} {verb} {term} {name}")] = ident
    return known, rules


#: Where a sentence ends. Normalising makes one blank of what is left of line ends and comment marks.
CUT = {"lines": r"[.!?]+[ \t\r\f]+|[ \t\r\f]*\n[ \t\r\f\n]*",
       "wrapped": r"[.!?]+[ \t\r\f\n]+|:[ \t\r\f]*\n[ \t\r\f\n]*|[ \t\r\f]*\n[ \t\r\f#*/;-]*\n[ \t\r\f\n]*"}
_CUT = {how: re.compile(pattern) for how, pattern in CUT.items()}
#: Each known sentence has one of these words.
_HINT = re.compile(r"licen[sc]e|licensed|permi|redistribut|copyright|software|under|name|warrant", re.I | re.A)


def sentences(text: str, how: str) -> list[str]:
    """Normalised sentences of a text, in order."""
    return [normalised(p) for p in _CUT[how].split(text) if _HINT.search(p)]


def places(ids: list[str], rule: list[str]) -> list[int]:
    """Where a rule's identifiers begin in a sequence."""
    return [k for k in range(len(ids) - len(rule) + 1) if ids[k : k + len(rule)] == rule]


class Scanner:
    def __init__(self):
        self.known, rules = catalogue()
        self.rules = [(lic, strength, ids.split()) for lic, strength, ids in rules]
        self.starting: dict[str, list[tuple[str, str, list[str]]]] = {}
        for rule in self.rules:
            self.starting.setdefault(rule[2][0], []).append(rule)

    def identifiers(self, text: str, how: str) -> list[str]:
        return [self.known[s] for s in sentences(text, how) if s in self.known]

    def held(self, ids: list[str]) -> list[tuple[str, str]]:
        """(licence, strength) of the rules that hold and do not yield."""
        found = [(lic, strength, k, k + len(rule)) for first in set(ids) for lic, strength, rule in self.starting.get(first, ())
                 for k in places(ids, rule)]
        return [(lic, strength) for lic, strength, a, b in found
                if not any(c <= a and b <= d and d - c > b - a and other != lic for other, _, c, d in found)]

    def scan(self, text: str) -> tuple[int, list[tuple[str, str]]]:
        """How many sentences were recognised (in the better cut), and (licence, strongest rule) in order of names."""
        if not _HINT.search(text):
            return 0, []
        found = {how: self.identifiers(text, how) for how in CUT}
        best: dict[str, str] = {}
        for ids in found.values():
            for lic, strength in self.held(ids):
                if lic not in best or STRENGTHS.index(strength) < STRENGTHS.index(best[lic]):
                    best[lic] = strength
        return max(map(len, found.values())), sorted(best.items())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences (recognised), n_rules and licenses (``licence:strength``, joined by commas)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            got = [scanner.scan(t or "") for t in batch.column(1).to_pylist()]
            if got:
                yield X.record(OUT, batch.column(0), [n for n, _ in got], [len(b) for _, b in got],
                               [",".join(f"{lic}:{s}" for lic, s in b) for _, b in got])

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, OUT)
