from cierre.llm import licenses
from tests.llm.helpers import TEXTS, documents, empty

MIT = "\n\n".join(licenses.SENTENCES[k] + ("." if k != "mit-grant" else ":") for k in ("mit-grant", "mit-keep", "mit-as-is", "mit-liable"))
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
AGPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as published
    by the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU Affero General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
CASES = {
    BSD3: "BSD-3-Clause:full", BSD2: "BSD-2-Clause:full", BSD3 + "\n\n" + BSD2: "BSD-2-Clause:full,BSD-3-Clause:full",
    BSD2 + "\n\n" + BSD3: "BSD-2-Clause:full,BSD-3-Clause:full", BSD3 * 2: "BSD-3-Clause:full",
    MPL: "MPL-2.0:notice", LGPL: "LGPL-2.1:full", LGPL.split("\n\n")[0]: "LGPL-2.1:notice", AGPL: "AGPL-3.0:full", ISC: "ISC:full",
    UNLICENSE: "Unlicense:full",
    "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this\n"
    "software to the public domain worldwide. This software is distributed without any warranty.": "CC0-1.0:full",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0:mention",
    "Licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 License.": "CC-BY-NC-ND-4.0:mention",
    "Published under a Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0:mention",
    MIT: "MIT:full", APACHE: "Apache-2.0:full", MIT.upper() + "\n" + APACHE: "Apache-2.0:full,MIT:full",
    "no end here\nReleased under the MIT License.\nmore": "MIT:mention",
    "Text. Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3.":
        "CC-BY-NC-4.0:mention,GPL-3.0:mention",
    "// SPDX-License-Identifier: BSD-3-Clause\nint x;": "BSD-3-Clause:mention",
    licenses.SENTENCES["mit-keep"] + ". " + licenses.SENTENCES["mit-grant"]: "",  # the wrong order
    "The license of this plate is new. We released the MIT students.": "",
}


def test_rules(spark):
    rows = [(n, t) for n, t in enumerate(CASES)]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(spark, rows, long=False)).collect()}
    assert got == dict(enumerate(CASES.values()))


def test_wrapped_lines_and_order():
    s = licenses.Scanner()
    words = MIT.replace("\n\n", "\0").split(" ")
    wrapped = "".join(w + ("\n * " if n % 9 == 8 else " ") for n, w in enumerate(words)).replace("\0", "\n *\n * ")
    assert s.scan(wrapped) == (4, [("MIT", "full")])


def test_awkward_rows(spark):
    got = licenses.scan(documents(spark, TEXTS)).collect()
    assert len(got) == len(TEXTS) + 2 and {r["licenses"] for r in got} == {""}
    assert licenses.scan(empty(spark)).collect() == []
