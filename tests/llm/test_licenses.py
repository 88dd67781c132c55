import re

from evalyard.llm import licenses, queries

from .oracle import SF


def norm(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))


def brute(text):
    """Known sentences at piece boundaries, longest first, left to right; then the ordered rules."""
    pieces = [w for p in re.split(r"[.;:!?\n\r]", text or "") if (w := norm(p))]
    known = sorted(((sum((norm(p) for p in re.split(r"[.;:!?\n\r]", s)), []), k) for k, s in licenses.SENTENCES.items()), key=lambda x: -len(" ".join(x[0])))
    ids, i = [], 0
    while i < len(pieces):
        for words, k in known:
            run, j = list(pieces[i]), i + 1
            while len(run) < len(words) and j < len(pieces):
                run += pieces[j]
                j += 1
            if run == words:
                ids.append(k)
                i = j
                break
        else:
            i += 1
    free, hits = [True] * len(ids), []
    for name, run in licenses.RULES:
        for i in range(len(ids) - len(run) + 1):
            if tuple(ids[i : i + len(run)]) == run and all(free[i : i + len(run)]):
                free[i : i + len(run)] = [False] * len(run)
                hits.append((i, name))
    return [n for _, n in sorted(hits)], ids


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_licenses"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found, ids = brute(docs[r.doc_id])
        assert (r.licenses, r.sentence_ids, r.n_licenses, r.n_sentences) == (",".join(found), ",".join(ids), len(found), len(ids))
    assert sum(r.n_licenses for r in rows) > 3


def test_sequences_and_edges(spark):
    s = licenses.SENTENCES
    mit = f"MIT License\n\nCopyright (c) 2020 Someone\n\n{s['mit-grant']}\n\n{s['mit-notice']}.\n\n{s['mit-warranty']}."
    wrapped = re.sub(r"((?:\S+ ){7})", r"\1\n", s["gpl-free"] + ". " + s["gpl-hope"] + ".")
    apache = ". ".join(s[k] for k in ("apache-short", "apache-you", "apache-copy", "apache-warranty", "apache-see")) + "."
    cases = {
        1: (mit, "MIT"),
        2: (wrapped, "GPL-3.0-or-later"),
        3: (apache, "Apache-2.0"),
        4: ("word | word\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        5: ("not licensed under CC BY-NC 4.0 at all", ""),
        6: (None, ""),
        7: ("", ""),
        8: ("Released under the MIT License. Released under the MIT License.\nAll rights reserved.", "MIT,MIT,All-Rights-Reserved"),
        9: ("x " * 50000 + "\n" + mit, "MIT"),
    }
    df = spark.createDataFrame([(k, v[0], "z") for k, v in cases.items()] + [(8, cases[8][0], "z"), (None, "MIT License", None)], "doc_id bigint, text string, licenses string")
    rows = licenses.digest(licenses.scan_licenses(df)).collect()
    assert len(rows) == 11
    for r in rows:
        if r.doc_id:
            assert r.licenses == cases[r.doc_id][1], r
    assert licenses.scan_licenses(df.limit(0)).count() == 0


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD = """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")


AGPL3 = GPL3.replace("GNU General Public", "GNU Affero General Public").replace("GNU\nGeneral", "GNU\nAffero General").replace("See the\nGNU General", "See the\nGNU Affero General")
LGPL3 = GPL3.replace("This program is", "This library is").replace("GNU General", "GNU Lesser General")
LGPL21 = GPL2.replace("This program is", "This library is").replace("GNU General", "GNU Lesser General").replace("version 2 of", "version 2.1 of")
EPL2 = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""


def test_rules_name_known_sentences_and_use_all():
    used = {k for _, run in licenses.RULES for k in run}
    assert used - {licenses.ANY} == {licenses.SAME.get(k, k) for k in licenses.SENTENCES | licenses.SAID}
    assert len({" ".join(map(str, licenses.segments(v))) for v in licenses.SENTENCES.values()}) == len(licenses.SENTENCES)


def test_verbatim_public_headers():
    cases = {
        "Apache-2.0": (APACHE, 5),
        "BSD-2-Clause": (BSD + DISCLAIMER, 5),
        "BSD-3-Clause": (BSD + ENDORSE + DISCLAIMER, 6),
        "MIT": (MIT, 5),
        "GPL-3.0-or-later": (GPL3, 3),
        "GPL-2.0-or-later": (GPL2, 3),
        "AGPL-3.0-or-later": (AGPL3, 3),
        "LGPL-3.0-or-later": (LGPL3, 3),
        "LGPL-2.1-or-later": (LGPL21, 3),
        "EPL-2.0": (EPL2, 1),
        "MPL-2.0": (MPL, 2),
        "ISC": (ISC, 3),
        "Zlib": (ZLIB, 3),
    }
    scanner = licenses.Scanner()
    for name, (text, n) in cases.items():
        for mark in ("", "# ", " * ", "// "):
            found, ids, changed = scanner.scan("".join(mark + line + "\n" for line in text.split("\n")))
            assert (found, len(ids)) == ([name], n), (name, mark, ids)
    assert scanner.scan(APACHE.split("\n")[2])[0] == ["Apache-2.0"]
    # the header's first sentence and the others, one text without line breaks
    assert scanner.scan(" ".join(APACHE.split()[3:]))[1][0] == "apache-header"


GRANT, NOTICE, WARRANTY, LIABLE = (licenses.SENTENCES[f"mit-{k}"] for k in ("grant", "notice", "warranty", "liable"))
REDISTRIBUTE, SOURCE, BINARY, DISCLAIM, DAMAGES = (licenses.SENTENCES[f"bsd-{k}"] for k in ("redistribute", "source", "binary", "disclaim", "liable"))
ADVERT = licenses.SENTENCES["bsd-advert"]


def test_sentences_between_others_count():
    scan = licenses.Scanner().scan
    text = lambda *parts: "Copyright (c) 2020 Somebody\n\n" + ".\n\n".join(parts) + ".\n"
    name = "Neither the name of Some Big University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
    x11 = "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium"
    free = GRANT.split(", subject to")[0]
    cases = [
        (text(GRANT, NOTICE, WARRANTY, LIABLE), ["MIT"], []),
        (text(GRANT, NOTICE, "The Software shall be used for Good, not Evil", WARRANTY, LIABLE), ["JSON"], []),
        (text(GRANT, NOTICE, "You owe the author a beer", WARRANTY, LIABLE), [], ["MIT"]),
        (text(GRANT, NOTICE, WARRANTY, LIABLE, x11), ["X11"], []),
        (text(free, WARRANTY, LIABLE), ["MIT-0"], []),
        (text(REDISTRIBUTE, "1. " + SOURCE, "2. " + BINARY, "3. " + name, DISCLAIM, DAMAGES), ["BSD-3-Clause"], []),
        (text(REDISTRIBUTE, "1. " + SOURCE, "2. " + BINARY, "3. " + ADVERT + ": This product includes software developed by the University of Somewhere and its contributors", "4. " + name, DISCLAIM, DAMAGES), ["BSD-4-Clause"], []),
        (text(REDISTRIBUTE, "1. " + SOURCE, "2. " + BINARY, "3. " + ADVERT + ": Thanks go to all of us", "4. " + name, DISCLAIM, DAMAGES), ["BSD-4-Clause"], []),
        (text(REDISTRIBUTE, "(i) " + SOURCE, "Copyright 2020 Other", "(ii) " + BINARY, DISCLAIM, DAMAGES), ["BSD-2-Clause"], []),
        (text(REDISTRIBUTE, SOURCE, BINARY, "No use in weapons", DISCLAIM, DAMAGES), [], ["BSD-2-Clause"]),
        ("Some words. This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"], []),
        ("This library is released under the Apache License, Version 2.0.\nMore text", ["Apache-2.0"], []),
        ("We think this project is licensed under the MIT License, perhaps", [], []),
        (text(GRANT) + "Other words. " * 9 + text(NOTICE, WARRANTY, LIABLE), ["MIT"], []),
    ]
    for said, want, changed in cases:
        found, _, modified = scan(said)
        assert (found, modified) == (want, changed), said
