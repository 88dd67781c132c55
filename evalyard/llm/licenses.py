"""License scans by sentence rules.

A text becomes sentences, each normalised to lower-case words; a sentence that the table
knows becomes its identifier, and what stands between two known sentences is part of the sequence: nothing,
lines that any licence may hold (copyright lines, numbers of clauses), or foreign sentences. Ordered rules then look for
identifier sequences; whole licences come before beginnings of them and single sentences, and an earlier rule takes its sentences before a later one can. A rule says where foreign
sentences may stand (``ANY``). Where a longer rule's sentences come in order with up to ``NEAR`` foreign pieces among
them, the licence isn't reported but named as modified, and shorter rules don't get those sentences.
One ``mapInArrow`` pass, no shuffle.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import LOWER

# Sentences of public licences, by identifier.
SENTENCES = {
    "apache-short": "Licensed under the Apache License, Version 2.0",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-you": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-warranty": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-short": "Released under the MIT License",
    "mit-name": "MIT License",
    "mit-short-2": "Licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-short-2": "Licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-see": "See the GNU General Public License for more details",
    "lgpl3-free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl2-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-see": "See the GNU Affero General Public License for more details",
    "lgpl3-short": "Licensed under the GNU Lesser General Public License, version 3",
    "agpl3-short": "Licensed under the GNU Affero General Public License, version 3",
    "gpl2-short": "Licensed under the GNU General Public License, version 2",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "epl2-v": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl1": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "cc-by-nc-short": "Licensed under CC BY-NC 4.0",
    "cc-by-short": "Licensed under CC BY 4.0",
    "cc-by-sa-short": "Licensed under CC BY-SA 4.0",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-sa-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nc-nd-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "bsd-redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-disclaim": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "bsd-liable": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    "bsd-endorse-any": "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "bsd-acknowledge": "This product includes software developed by {}",
    "json-good": "The Software shall be used for Good, not Evil",
    "mit0-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so',
    "x11-liable": "IN NO EVENT SHALL THE X CONSORTIUM BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "x11-name": "Except as contained in this notice, the name of {} shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from {}",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl-copy-https": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "isc-liable": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost": "Distributed under the Boost Software License, Version 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}
# How running text names a licence; the table holds every subject, verb and ending with each name.
SUBJECTS = ("This project", "This software", "This work", "This package", "This library", "This program", "This code", "This file", "This repository", "The code", "The software")
VERBS = ("is licensed under", "is released under", "is distributed under", "is available under")
NAMES = {
    "MIT": ("the MIT License", "the MIT license terms", "MIT"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache 2.0"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License"),
    "ISC": ("the ISC License",),
    "MPL-2.0": ("the Mozilla Public License 2.0", "the MPL 2.0"),
    "GPL-3.0-only": ("the GNU General Public License v3.0", "the GPLv3"),
    "GPL-2.0-only": ("the GNU General Public License v2.0", "the GPLv2"),
}
ENDINGS = ("", " see the LICENSE file for details", " see LICENSE for details")
SAID = {f"says {name} {k}": f"{subject} {verb} {text}{end}" for name, texts in NAMES.items() for k, (subject, verb, text, end) in enumerate(product(SUBJECTS, VERBS, texts, ENDINGS))}

#: In a rule: foreign sentences may stand here, up to ``NEAR`` pieces.
ANY = "*"
NEAR = 4
# Ordered rules (license, sentence identifiers in a row); the first that fits takes the sentences.
RULES = (
    ("Apache-2.0", ("apache-header", "apache-you", "apache-copy", "apache-warranty", "apache-see")),
    ("Apache-2.0", ("apache-short", "apache-you", "apache-copy", "apache-warranty", "apache-see")),
    ("BSD-4-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-advert", ANY, "bsd-endorse", "bsd-disclaim", "bsd-liable")),
    ("BSD-4-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-advert", "bsd-acknowledge", "bsd-endorse", "bsd-disclaim", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-disclaim", "bsd-liable")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-disclaim", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-disclaim")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-disclaim")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    ("JSON", ("mit-grant", "mit-notice", "json-good", "mit-warranty", "mit-liable")),
    ("X11", ("mit-grant", "mit-notice", "mit-warranty", "x11-liable", "x11-name")),
    ("X11", ("mit-grant", "mit-notice", "mit-warranty", "mit-liable", "x11-name")),
    ("MIT-0", ("mit0-grant", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "agpl3-see")),
    ("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-program", "gpl-hope", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-2.0-or-later", ("lgpl2-free", "lgpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("MPL-2.0", ("mpl", "mpl-copy")),
    ("MPL-2.0", ("mpl", "mpl-copy-https")),
    ("ISC", ("isc", "isc-warranty", "isc-liable")),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-program",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-2.0-or-later", ("lgpl2-free",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-3.0-only", ("gpl3-short-2",)),
    ("GPL-2.0-only", ("gpl2-short",)),
    ("LGPL-3.0-only", ("lgpl3-short",)),
    ("AGPL-3.0-only", ("agpl3-short",)),
    ("EPL-2.0", ("epl2",)),
    ("EPL-2.0", ("epl2-http",)),
    ("EPL-2.0", ("epl2-v",)),
    ("EPL-1.0", ("epl1",)),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-short",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-short-2",)),
    ("MIT", ("mit-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-long",)),
    ("CC-BY-4.0", ("cc-by-short",)),
    ("CC-BY-4.0", ("cc-by-long",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-long",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-long",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-long",)),
    ("CC0-1.0", ("cc0",)),
    ("MPL-2.0", ("mpl",)),
    ("ISC", ("isc",)),
    ("BSL-1.0", ("boost",)),
    ("Unlicense", ("unlicense",)),
    ("All-Rights-Reserved", ("reserved",)),
    *((name, (f"says-{name}",)) for name in NAMES),
)
#: Identifiers that stand for another in the rules.
SAME = {"bsd-endorse-any": "bsd-endorse"} | {k: f"says-{k.split(' ')[1]}" for k in SAID}
#: Pieces that no licence minds between its sentences.
_PLAIN = re.compile(rb"copyright\b.*|c (?:19|20)[0-9]{2}\b.*|[0-9]{1,2}|[a-z]|[ivx]{1,4}")
#: Words become lower case; ASCII marks other than digits and letters part words; sentences end at these.
_ENDS = b".;:!?\n\r"
_TABLE = bytes(10 if c in _ENDS else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in LOWER)


def segments(text: str | None) -> list[bytes]:
    """Normalised pieces between end marks and line breaks, without empty ones."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return [s for part in data.translate(_TABLE).split(b"\n") if (s := b" ".join(part.split()))]
#: A clause's mark before its sentence, as in "(a) ...".
_MARKS = frozenset(str(k).encode() for k in (*range(100), *string.ascii_lowercase, "ii", "iii", "iv", "vi", "vii", "viii", "ix"))


class Scanner:
    """A known sentence must start and end at piece boundaries; breaks inside it don't matter ("Version 2.0", wrapped lines).

    ``{}`` in a known sentence stands for up to ``HOLE`` words, such as a holder's name.
    """

    HOLE = 12

    def __init__(self, known: dict[str, str] | None = None, rules=RULES):
        self.heads: dict[bytes, list[tuple[bytes, str]]] = {}
        self.holes: dict[bytes, list[tuple[re.Pattern[bytes], int, str]]] = {}
        known = SENTENCES | SAID if known is None else known
        for name, sentence in known.items():
            parts = [b" ".join(segments(part)) for part in sentence.split("{}")]
            head = parts[0].split(b" ", 1)[0]
            if len(parts) > 1:
                hole = rb"(?: \S+){1,%d} ?" % self.HOLE
                pattern = re.compile(hole.join(map(re.escape, parts)))
                self.holes.setdefault(head, []).append((pattern, sum(len(x.split()) for x in parts) + self.HOLE * (len(parts) - 1), name))
            else:
                insort(self.heads.setdefault(head, []), (parts[0], name))
        self.begins = frozenset(self.heads) | frozenset(self.holes)
        # whole rules first, then whole ones with foreign sentences, then the beginnings of others, single sentences last
        begins = {(n, r[:k]) for n, r in rules for k in range(1, len(r))}
        whole = [r for r in rules if len(r[1]) > 1 and r not in begins]
        self.steps = [(r, False) for r in whole] + [(r, True) for r in whole if len(r[1]) > 2]
        self.steps += [(r, False) for r in rules if len(r[1]) > 1 and r in begins] + [(r, False) for r in rules if len(r[1]) == 1]

    def _known(self, found: list[bytes], i: int, piece: bytes, head: bytes) -> tuple[int, str] | None:
        """(pieces, identifier) of the known sentence that begins with ``piece``, the piece ``i`` with or without its mark; ``head`` is its first word."""
        known = self.heads.get(head, ())
        run, j, best = piece, i + 1, None
        while (k := bisect_left(known, (run, ""))) < len(known) and known[k][0].startswith(run):
            if known[k][0] == run:  # the longest stays
                best = j - i, known[k][1]
            if j == len(found):
                break
            run += b" " + found[j]
            j += 1
        if best:
            return best
        for pattern, most, name in self.holes.get(head, ()):
            run, j, best = piece, i + 1, None
            while True:
                if pattern.fullmatch(run):
                    best = j - i
                if j == len(found) or run.count(b" ") + 1 >= most:
                    break
                run += b" " + found[j]
                j += 1
            if best:
                return best, name
        return None

    def identify(self, text: str | None) -> list[tuple[int, str, int]]:
        """(position among the pieces, identifier, foreign pieces since the known sentence before), in order; the longest known sentence at a position wins."""
        found = segments(text)
        hits: list[tuple[int, int, str]] = []  # from, to, identifier
        i, begins = 0, self.begins
        while i < len(found):
            piece, step = found[i], 1
            head, _, rest = piece.partition(b" ")
            hit = self._known(found, i, piece, head) if head in begins else None
            if hit is None and head in _MARKS and (second := rest.partition(b" ")[0]) in begins:
                hit = self._known(found, i, rest, second)
            if hit:
                step = hit[0]
                hits.append((i, i + step, SAME.get(hit[1], hit[1])))
            i += step
        out, end = [], 0
        for start, stop, name in hits:
            # beyond NEAR their number doesn't matter
            foreign = sum(1 for _ in islice((p for p in found[end : start if out else end] if not _PLAIN.fullmatch(p)), NEAR + 1))
            out.append((start, name, foreign))
            end = stop
        return out

    def _fits(self, ids: list[tuple[int, str, int]], i: int, run: tuple[str, ...], near: int) -> int | None:
        """The end of ``run`` from the sentence ``i`` on, with up to ``near`` foreign pieces between its sentences, or more where it says so."""
        k, room = i, None
        for want in run:
            if want == ANY:
                room = NEAR
                continue
            if k == len(ids) or ids[k][1] != want or (k > i and ids[k][2] > (near if room is None else room)):
                return None
            k, room = k + 1, None
        return k

    def scan(self, text: str | None) -> tuple[list[str], list[str], list[str]]:
        """(licenses in order of appearance, sentence identifiers in order, licenses that occur modified)."""
        ids = self.identify(text)
        if not ids:
            return [], [], []
        taken = [False] * len(ids)
        hits: list[tuple[int, str]] = []
        changed: list[tuple[int, str]] = []
        present = {k for _, k, _ in ids}
        for (name, run), loose in self.steps:
            if run[0] not in present:
                continue
            i = 0
            while i < len(ids):
                end = None if taken[i] else self._fits(ids, i, run, NEAR if loose else 0)
                if end is not None and not any(taken[i:end]):
                    taken[i:end] = [True] * (end - i)
                    (changed if loose else hits).append((i, name))
                    i = end
                else:
                    i += 1
        return [name for _, name in sorted(hits)], [k for _, k, _ in ids], [name for _, name in sorted(changed)]


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences (known ones), licenses, sentence_ids and modified (arrays in order of appearance) of every row.

    ``modified`` names licences whose sentences occur in order with foreign ones among them.

    Null, empty and unlicensed texts have empty arrays; repeated rows repeat their result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        for b in batches:
            rows = [scanner.scan(t.as_py()) for t in b.column(1)]
            cols = [b.column(0), pa.array([len(r[1]) for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.list_(pa.string())) for i in (0, 1, 2))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_sentences", "licenses", "sentence_ids", "modified"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_sentences bigint, licenses array<string>, sentence_ids array<string>, modified array<string>")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_sentences",
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.try_element_at("licenses", F.lit(1)).alias("first_license"),
        F.array_join("modified", ",").alias("modified"),
    )
