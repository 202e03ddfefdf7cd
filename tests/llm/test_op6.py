import re

import pyarrow.parquet as pq

from pubmill.llm.op6_licence_sentences import GAP, HINTS, RULES, SENTENCES, apply_rules, identifiers, licence_scan, normalise, op6_licence_sentences

SF = "/root/testdata/sf0.01"


def test_tables_agree():
    assert all(normalise(s) == s and any(h in s for h in HINTS) for s in SENTENCES)
    assert {x for _, r in RULES for x in r} <= set(SENTENCES.values())


def test_order_and_gap():
    assert apply_rules([(0, "mit-grant"), (2, "mit-notice"), (5, "as-is")]) == ([(0, "MIT")], [])
    assert apply_rules([(0, "mit-grant"), (5, "mit-notice")]) == ([], ["mit-grant", "mit-notice"])
    assert apply_rules([(3, "apache2-notice"), (1, "gpl3-work")]) == ([(1, "GPL-3.0-only"), (3, "Apache-2.0")], [])


def test_whole_documents_equal_brute_force(spark):
    want = {}
    for d in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        parts = [normalise(s) for s in re.split(r"\n+|[.!?:;]+(?=[\s\"')\]]|$)", d["text"])]
        want[d["doc_id"]] = ",".join(SENTENCES[s] for s in parts if s in SENTENCES)
    got = {r.doc_id: r.sentence_ids for r in op6_licence_sentences(spark, SF).collect()}
    assert got == want and any(want.values())


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, "A. Released under the MIT License.\nB"), (3, "A. Released under the MIT License.\nB"), (None, "Licensed under CC BY-NC 4.0. " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as licences")
    got = {(r.doc_id, len(r.licences), (r.licences or [None])[0]) for r in licence_scan(docs).collect()}
    assert got == {(1, 0, None), (2, 0, None), (3, 1, "MIT"), (None, 3000, "CC-BY-NC-4.0")}
    assert licence_scan(docs.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Person

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
APACHE = """   Copyright 2020 A. Person

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
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
BSD3 = """Copyright (c) 2020, A. Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

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
BSD2 = BSD3[: BSD3.index("3. Neither")] + BSD3[BSD3.index("THIS SOFTWARE") :]


def test_standard_texts_wrapped():
    texts = {"MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL3, "GPL-2.0-or-later": GPL2, "BSD-3-Clause": BSD3, "BSD-2-Clause": BSD2}
    for licence, text in texts.items():
        for form in (text, text.replace("\n", "\r\n"), "".join(f"# {x}\n" for x in text.splitlines()), f"def f():\n    pass\n\n{text}\nmore text"):
            found, left = apply_rules(identifiers(form))
            assert [x for _, x in found] == [licence], (licence, form)
            assert set(left) <= {"reserved"}


def test_a_blank_line_ends_a_sentence():
    assert identifiers("Released under the\nMIT License") == [(0, "mit-release")]
    assert identifiers("Released under the\n\nMIT License") == []
    assert identifiers("a\nb\nAll rights reserved\nc\nd. 1) All rights reserved") == [(1, "reserved"), (3, "reserved")]


LGPL21 = """    This library is free software; you can redistribute it and/or
    modify it under the terms of the GNU Lesser General Public
    License as published by the Free Software Foundation; either
    version 2.1 of the License, or (at your option) any later version.

    This library is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
    Lesser General Public License for more details.
"""
AGPL3 = GPL3.replace("GNU General", "GNU Affero General")
LGPL3 = GPL3.replace("GNU General", "GNU Lesser General")
GPL2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
"""
MPL2 = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
ISC = """Copyright 2020 A. Person

Permission to use, copy, modify, and/or distribute this software for any
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
ZERO_BSD = ISC.replace(", provided that the above\ncopyright notice and this permission notice appear in all copies", "")
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
CC = "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0\nInternational License.\n"
BOOST = "Distributed under the Boost Software License, Version 1.0. (See accompanying\nfile LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)\n"
EPL = "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/\n"
NAMED_BSD = BSD3.replace("the copyright holder nor the names of its\n   contributors", "Example Labs Inc. nor the names of its contributors").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "EXAMPLE LABS").replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "EXAMPLE LABS").replace("Labs Inc.", "Labs")


def test_further_licences_wrapped_and_in_one_line():
    texts = {"LGPL-2.1-or-later": LGPL21, "AGPL-3.0-or-later": AGPL3, "LGPL-3.0-or-later": LGPL3, "GPL-2.0-only": GPL2_ONLY, "MPL-2.0": MPL2, "ISC": ISC, "0BSD": ZERO_BSD, "Zlib": ZLIB, "Unlicense": UNLICENSE, "CC-BY-NC-SA-4.0": CC, "BSL-1.0": BOOST, "EPL-2.0": EPL, "BSD-3-Clause": NAMED_BSD, "MIT": MIT, "Apache-2.0": APACHE}
    for licence, text in texts.items():
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
        for form in (text, "\n\n".join(paragraphs), "".join(f"// {x}\n" for x in text.splitlines())):
            found, left = apply_rules(identifiers(form))
            assert [x for _, x in found] == [licence], (licence, found, left, form)
            assert set(left) <= {"reserved"}


def test_identifiers_alone():
    scan = lambda t: [x for _, x in apply_rules(identifiers(t))[0]]
    assert scan("// SPDX-License-Identifier: Apache-2.0\nint x;") == ["Apache-2.0"] and scan("# SPDX-License-Identifier: GPL-2.0+\n") == ["GPL-2.0-or-later"]
    assert scan("# SPDX-License-Identifier: GPL-2.0\n") == ["GPL-2.0-only"]
    assert scan("/* SPDX-License-Identifier: MIT */") == ["MIT"] and scan("SPDX-License-Identifier: Nobody-1.0") == []
    assert len({licence for licence, _ in RULES}) >= 35


def rules_brute(ids):
    """Rules by their order; each takes, from every start on, the nearest free sentence that goes on, at most GAP sentences apart."""
    used, found = set(), []
    for licence, wanted in RULES:
        for at, name in sorted(ids):
            chain = [at] if name == wanted[0] and at not in used else []
            for step in wanted[1:]:
                after = sorted(i for i, x in ids if chain and x == step and i not in used and chain[-1] < i <= chain[-1] + 1 + GAP)
                chain = chain + after[:1] if after else []
            if chain:
                used |= set(chain)
                found.append((at, licence))
    return sorted(found), [x for i, x in sorted(ids) if i not in used]


def test_rules_equal_brute_force():
    import random

    rng = random.Random(3)
    names = sorted({x for _, r in RULES for x in r})
    for _ in range(400):
        base = [x for _ in range(rng.randrange(4)) for x in rng.choice(RULES)[1]] + rng.sample(names, rng.randrange(4))
        places = sorted(rng.sample(range(60), len(base)))
        ids = list(zip(places, base, strict=True))
        assert apply_rules(ids) == rules_brute(ids)


def test_long_runs_of_marks():
    """Dot leaders and rules of any length are cut as short ones are, in linear time."""
    import time

    began = time.process_time()
    for run in ("." * 200_000, ":;" * 100_000, "!" * 200_000 + " ", "Identifier" + ":" * 100_000 + "x"):
        assert identifiers(f"Licensed under CC BY-NC 4.0. A license {run}x") == [(0, "cc-by-nc-4")]
    assert time.process_time() - began < 5


def test_cuts_at_marks():
    from pubmill.llm.op6_licence_sentences import _ENDS

    plain = re.compile(r"((?<!Identifier)[.!?:;]+(?=[\s\"')\]]|$)|\n+)")
    for text in ("a... b", "a..b", "a.", "..", "SPDX-License-Identifier: MIT", "Identifier:: MIT", "Identifier:", "Identifier::x: y", "Identifier:. \n\n", "a!?)", ".\n.\n", "x;\" y", "Identifier...\nz", "Identifier", ". Identifier: ."):
        assert _ENDS.split(text) == plain.split(text), text
