"""License scans by conditional compression (operator 2).

A candidate block is the run of words that lines a trigger word of the text up
with the same word in a template. The block is compressed alone and with the
template as a raw zstandard dictionary; templates are ranked by how much the
dictionary saves. From the best on, a winner is confirmed by its exact wording
differences: word by word, at most ``max_difference`` of the template's words
may differ, none in templates of up to ``SHORT`` words. No word that decides
the license (``DECIDING``: family, version, or-later, what is granted) may be
missing or changed, and none of ``OTHERWISE`` may be added. Winners that
overlap a better one are dropped.

Words are runs of letters and digits, with single dots or hyphens inside,
compared in lower case. Positions are code points, end exclusive.

Defined results: null and empty texts hold no license. Repeated rows are
judged alike. An empty table gives an empty result. Columns of the input keep
their values; the output's name gets an underscore where it clashes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from difflib import SequenceMatcher

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import fresh, per_text, table

# The wording of public license notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""),
    ("GPL-2.0-or-later", """This program is free software; you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
option) any later version."""),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""),
    ("BSD-3-Clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
    *[(f"{short}-{version}-or-later", f"""This {what} is free software{mark} you can redistribute it and/or modify it under the terms of
the GNU {family} Public License as published by the Free Software Foundation{comma} either version {version[:3].removesuffix(".0")} of the License, or (at your
option) any later version.""") for short, family, version, what, mark, comma in [
        ("AGPL", "Affero General", "3.0", "program", ":", ","), ("LGPL", "Lesser General", "3.0", "library", ":", ","),
        ("LGPL", "Lesser General", "3.0", "program", ":", ","), ("LGPL", "Lesser General", "2.1", "library", ";", ";"),
        ("LGPL", "Library General", "2.0", "library", ";", ";")]],
    ("GPL-2.0-only", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License version 2 as published by the Free Software Foundation."""),
    ("GPL-3.0-only", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License version 3 as published by the Free Software Foundation."""),
]
_OF = dict(reversed([t for t in TEMPLATES if len(t[1]) > 150]))
_AS_IS = """IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
_BSD_END = f"""THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. {_AS_IS}"""
_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by the organization. 4."""
# the whole texts
TEMPLATES += [
    ("MIT", _OF["MIT"] + """ THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", _OF["ISC"] + """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", f"{_OF['BSD-2-Clause']} {_BSD_END}"),
    *[(name, f"{_OF['BSD-2-Clause']} {more} {_OF['BSD-3-Clause']}{end}") for name, more in (
        ("BSD-3-Clause", "3."), ("BSD-4-Clause", _ADVERTISING)) for end in ("", f" {_BSD_END}")],
]
# Words that a notice can hardly do without.
TRIGGERS = frozenset(["license", "licensed", "licenses", "copyright", "permission", "redistribution", "rights", "unencumbered",
                      "redistribute", "waived"])
# Words of a license's templates that decide which license it is, or what it grants.
DECIDING = {
    "MIT": "permission granted without restriction use copy modify merge publish distribute sublicense sell",
    "ISC": "permission use copy modify distribute any without fee",
    "BSD-2-Clause": "redistribution source binary without modification permitted conditions",
    "BSD-3-Clause": "redistribution source binary without modification permitted conditions neither endorse promote",
    "BSD-4-Clause": "redistribution source binary without modification permitted conditions advertising acknowledgement neither endorse promote",
    "Apache-2.0": "apache 2.0 license-2.0", "MPL-2.0": "mozilla mpl 2.0", "CC0-1.0": "extent waived all copyright related rights",
    **{f"{n}-or-later": f"gnu {w} general public either {v} any later" for n, w, v in [
        ("GPL-3.0", "", "3"), ("GPL-2.0", "", "2"), ("AGPL-3.0", "affero", "3"), ("LGPL-3.0", "lesser", "3"),
        ("LGPL-2.1", "lesser", "2.1"), ("LGPL-2.0", "library", "2")]},
    **{f"GPL-{v}.0-only": f"gnu general public {v}" for v in "23"},
}
# Words whose addition makes another license, or takes back what is granted.
OTHERWISE = frozenset(["affero", "lesser", "library", "later", "only", "not", "no", "except", "commercial", "noncommercial",
                       "non-commercial", "sharealike", "noderivatives", "academic", "educational", "advertising"])
SHORT = 14
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


class Scanner:
    def __init__(self, templates=TEMPLATES, max_difference: float = 0.1, least_saving: float = 0.2):
        self.max_difference, self.least_saving = max_difference, least_saving
        self.templates, self.lined_up = [], defaultdict(list)
        self.alone = zstandard.ZstdCompressor(level=3)
        for i, (name, text) in enumerate(templates):
            tokens = [m.group().lower() for m in WORD.finditer(text)]
            raw = zstandard.ZstdCompressionDict(" ".join(tokens).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, tokens, zstandard.ZstdCompressor(level=3, dict_data=raw)))
            for k, w in enumerate(tokens):
                if w in TRIGGERS:
                    self.lined_up[w].append((i, k))

    def differences(self, template: list[str], block: list[str]) -> tuple[list[str], int]:
        """Differing words, and the words of ``block`` up to its last that
        is part of the notice."""
        out, codes, size = [], SequenceMatcher(None, template, block, autojunk=False).get_opcodes(), len(block)
        if codes and codes[-1][0] == "insert":
            size = codes.pop()[3]
        elif codes and codes[-1][0] == "replace":  # no more words than the template's
            op, a, b, c, d = codes.pop()
            size = min(d, c + b - a)
            codes.append((op, a, b, c, size))
        for op, a, b, c, d in codes:
            if op != "equal":
                out += [f"{x}>{y}" for x, y in zip([*template[a:b], *[""] * (d - c - b + a)], [*block[c:d], *[""] * (b - a - d + c)], strict=True)]
        return out, size

    def decides(self, name: str, differ: list[str]) -> bool:
        """Whether a difference makes it another license."""
        deciding = DECIDING.get(name, "").split()
        return any(x in deciding or y in OTHERWISE for x, y in (d.split(">") for d in differ))

    def scan(self, text: str | None) -> list[tuple]:
        """(license, start, end, saving, differences) by place."""
        if not text:
            return []
        found = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
        tokens = [f[0] for f in found]
        ranked = []
        for i, begin in sorted({(i, p - k) for p, w in enumerate(tokens) if w in self.lined_up for i, k in self.lined_up[w]}):
            name, template, with_template = self.templates[i]
            block = tokens[max(0, begin) : begin + len(template)]
            if len(block) < len(template) * (1 - self.max_difference):
                continue
            data = " ".join(block).encode()
            alone = len(self.alone.compress(data))
            saving = 1 - len(with_template.compress(data)) / alone
            if saving >= self.least_saving:
                ranked.append((-saving * alone, max(0, begin), begin + len(template), i, saving))
        taken, out = [], []
        for _, begin, end, i, saving in sorted(ranked):
            name, template, _ = self.templates[i]
            end = min(end, len(tokens))
            if any(a < end and begin < b for a, b in taken):
                continue
            most = 0 if len(template) <= SHORT else int(self.max_difference * len(template))
            # added words move the notice's end on
            after = min([len(tokens), end + most, *[a for a, _ in taken if a >= end]])
            differ, size = self.differences(template, tokens[begin:after])
            end = begin + size
            if len(differ) <= most and not self.decides(name, differ):
                taken.append((begin, end))
                out.append((name, found[begin][1], found[end - 1][2], round(saving, 4), differ))
        return sorted(out, key=lambda x: x[1:3])


def license_scan(df: DataFrame, text_col: str = "text", templates=None, max_difference: float = 0.1,
                 least_saving: float = 0.2, out: str = "licenses") -> DataFrame:
    """``df`` with an array column ``out``: license, start, end, saving (share
    of bytes), differences (``template>text`` words)."""
    (o,) = fresh(df, out)
    given, held = templates or TEMPLATES, {}

    def scan(text: str | None) -> tuple:
        if "scanner" not in held:  # dictionaries are made once per task
            held["scanner"] = Scanner(given, max_difference, least_saving)
        return (held["scanner"].scan(text),)

    kind = "array<struct<license:string,start:bigint,end:bigint,saving:double,differences:array<string>>>"
    return df.withColumn(o, _first(per_text(scan, f"found {kind}")(F.col(text_col))))


def _first(column):
    return column["found"]


def op2_license_scan(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(listed, ",").alias("licenses"))
