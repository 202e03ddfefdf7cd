"""Licence recognition by sentence rules.

Texts are cut into pieces at end punctuation and line breaks, each normalised
(case folded, punctuation and white space reduced to single spaces); in three
clauses of the BSD licences the holder's name is first reduced to one form. Known licence
sentences have identifiers; one is a piece, or several that only single line
breaks part (wrapped lines), the longest that fits, with or without a list number. A
blank line or end punctuation ends every sentence; other wrapped lines are one sentence.
The identifiers of a document, in order of place, are matched against ordered
rules: a rule is a sequence of identifiers that must follow one another with no
more than ``GAP`` sentences between neighbours. Rules are tried in their order
at every place; what a rule has used no later rule uses. A known sentence that
no rule used stays as an unresolved one.

Cases: null and empty texts give no sentences; texts are read whole; repeated
rows give repeated rows; an empty table gives none; further columns are not used.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map

#: Sentences that may lie between two neighbours of a rule.
GAP = 3
_OTHER = re.compile(r"[^0-9a-z]+")


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


# Licence sentences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-release",
    "licensed under the mit license": "mit-release",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "licensed under the apache license version 2 0": "apache2-notice",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at": "apache2-copy",
    "http www apache org licenses license 2 0": "apache2-address",
    "https www apache org licenses license 2 0": "apache2-address",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2-basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache2-see",
    "this work is licensed under the gnu general public license version 3": "gpl3-work",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-fitness",
    "see the gnu general public license for more details": "gpl-details",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": "bsd-endorse",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-disclaimer",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services": "bsd-liability",
    "all rights reserved": "reserved",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-grant",
    "either version 2 1 of the license or at your option any later version": "lgpl21-later",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-grant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-only",
    "you can redistribute it and or modify it under the terms of version 2 of the gnu general public license as published by the free software foundation": "gpl2-only",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "gpl3-only",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "see the gnu lesser general public license for more details": "lgpl-details",
    "see the gnu affero general public license for more details": "agpl-details",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "this software is provided as is without any express or implied warranty": "zlib-as-is",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-release",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
    "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-dedicated",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-dedicated",
    "distributed under the boost software license version 1 0": "bsl1-notice",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl1-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-notice",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl1-notice",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "wtfpl-copies",
    "licensed under the artistic license 2 0": "artistic2-notice",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "postgresql-grant",
}
# The words and codes of the Creative Commons licences, and what follows the number of a version.
CREATIVE_COMMONS = {
    "by": "attribution", "by-sa": "attribution sharealike", "by-nc": "attribution noncommercial", "by-nd": "attribution noderivatives",
    "by-nc-sa": "attribution noncommercial sharealike", "by-nc-nd": "attribution noncommercial noderivatives",
}
CC_VERSIONS = {"4 0": "international", "3 0": "unported"}
# Licences that a file may name by its identifier alone.
IDENTIFIERS = (
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Unlicense", "CC0-1.0", "WTFPL", "Artistic-2.0", "PostgreSQL",
    "GPL-2.0", "GPL-3.0",
)
# Rules in order of precedence, longer evidence first.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-copy", "apache2-address", "apache2-basis", "apache2-see")),
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-copy")),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl3-later", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl-grant", "gpl2-later", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl3-grant",)),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-grant", "gpl2-later")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-disclaimer", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-disclaimer", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("MIT", ("mit-release",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-subject",)),
    ("LGPL-3.0-or-later", ("lgpl3-grant", "gpl-hope", "gpl-fitness", "lgpl-details")),
    ("LGPL-2.1-or-later", ("lgpl-grant", "lgpl21-later", "gpl-hope", "gpl-fitness", "lgpl-details")),
    ("AGPL-3.0-or-later", ("agpl3-grant", "gpl-hope", "gpl-fitness", "agpl-details")),
    ("GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("GPL-3.0-only", ("gpl3-only", "gpl-hope", "gpl-fitness", "gpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-grant",)),
    ("LGPL-2.1-or-later", ("lgpl-grant", "lgpl21-later")),
    ("AGPL-3.0-or-later", ("agpl3-grant",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-3.0-only", ("gpl3-only",)),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant", "isc-as-is", "isc-liability")),
    ("0BSD", ("0bsd-grant",)),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant")),
    ("Unlicense", ("unlicense-release", "unlicense-grant")),
    ("Unlicense", ("unlicense-release",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("BSL-1.0", ("bsl1-grant",)),
    ("BSL-1.0", ("bsl1-notice",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-1.0", ("epl1-notice",)),
    ("WTFPL", ("wtfpl-copies",)),
    ("Artistic-2.0", ("artistic2-notice",)),
    ("PostgreSQL", ("postgresql-grant",)),
)


def _families() -> tuple[dict[str, str], list[tuple[str, tuple[str]]]]:
    """The sentences and rules that follow from CREATIVE_COMMONS and IDENTIFIERS; what the tables above name stays."""
    sentences, rules = {}, []
    for code, words in CREATIVE_COMMONS.items():
        for number, realm in CC_VERSIONS.items():
            name = f"cc-{code}-{number[0]}"
            forms = [f"licensed under cc {code.replace('-', ' ')} {number}"]
            forms += [f"this work is licensed under {which} creative commons {words} {number} {realm} license" for which in ("a", "the")]
            sentences |= {f: name for f in forms}
            rules.append((f"CC-{code.upper()}-{number.replace(' ', '.')}", (name,)))
    for spdx in IDENTIFIERS:
        sentences[f"spdx license identifier {normalise(spdx)}"] = f"spdx-{spdx}"
    old = {"GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only"}
    rules += [(old.get(spdx, spdx), (f"spdx-{spdx}",)) for spdx in IDENTIFIERS]
    return sentences, rules
#: A run of marks ends a sentence if white space or a closing sign follows; after ``Identifier``, from its second mark on. Runs are taken whole, so long ones cost no more.
_ENDS = re.compile(r"((?:(?<![.!?:;])(?<!Identifier)|(?<=Identifier[.!?:;]))[.!?:;]++(?=[\s\"')\]]|$)|\n+)")
_NUMBER = re.compile(r"(?:[0-9]{1,2}|[a-z]|i{1,3}) ")
_more, _ruled = _families()
SENTENCES = _more | SENTENCES
RULES = (*RULES, *(r for r in _ruled if r not in RULES))
#: Every known sentence holds one of these words; a text without them holds none.
HINTS = ("licens", "permi", "warrant", "copyright", "rights", "distribut", "liable", "anyone is free", "unencumbered")
#: Clauses in which a holder's name stands; it is reduced to the one in the table (names of up to 100 characters). And an identifier's old sign for later versions.
_NAMED = (
    (re.compile(r"(identifier:\s*[a-z]+-[0-9.]+)\+", re.IGNORECASE), r"\1-or-later"),
    (re.compile(r"(neither[\s/#*]+the[\s/#*]+name[\s/#*]+of[\s/#*]+)[^.;]{1,100}?([\s/#*]+nor[\s/#*]+the[\s/#*]+names[\s/#*]+of[\s/#*]+)(?:its|their)", re.IGNORECASE), r"\1the copyright holder\2its"),
    (re.compile(r"(this[\s/#*]+software[\s/#*]+is[\s/#*]+provided[\s/#*]+by[\s/#*]+)[^.;]{1,100}?(\s[\"'`\u2018\u201c]*as[\s/#*]+is\b)", re.IGNORECASE), r"\1the copyright holders and contributors\2"),
    (re.compile(r"(in[\s/#*]+no[\s/#*]+event[\s/#*]+shall[\s/#*]+)[^.;]{1,100}?([\s/#*]+be[\s/#*]+liable[\s/#*]+for[\s/#*]+any[\s/#*]+direct)", re.IGNORECASE), r"\1the copyright holder or contributors\2"),
)
_HINT = re.compile("|".join(HINTS), re.IGNORECASE)
#: What each known sentence starts with, word by word: wrapped lines are joined while they stay within these.
_STARTS = {" ".join(words[:i]) for words in map(str.split, SENTENCES) for i in range(1, len(words) + 1)}




def pieces(text: str) -> list[tuple[str, bool]]:
    """The stretches between cuts, normalised, and whether only a line break parts each from the one before."""
    cut, out, wrapped = _ENDS.split(text), [], False
    for i in range(0, len(cut), 2):
        piece = normalise(cut[i])
        if piece:
            out.append((piece, wrapped))
        if i + 1 < len(cut):
            wrapped = bool(piece) and cut[i + 1] == "\n"
    return out


def _known(parts: list[tuple[str, bool]], at: int) -> tuple[str, int] | None:
    """Identifier and end of the longest known sentence that starts at this piece."""
    first = parts[at][0]
    for joined in (first, _NUMBER.sub("", first, count=1) if _NUMBER.match(first) else ""):
        found, end = None, at + 1
        while joined in _STARTS:
            if joined in SENTENCES:
                found = SENTENCES[joined], end
            if end == len(parts) or not parts[end][1]:
                break
            joined, end = f"{joined} {parts[end][0]}", end + 1
        if found:
            return found
    return None


def identifiers(text: str) -> list[tuple[int, str]]:
    """(ordinal, identifier) of the known sentences; ordinals count all sentences."""
    if not _HINT.search(text):
        return []
    for pattern, plain in _NAMED:
        text = pattern.sub(plain, text)
    parts, out, ordinal, at, fresh = pieces(text), [], -1, 0, True
    while at < len(parts):
        found = _known(parts, at)
        if found or fresh or not parts[at][1]:
            ordinal += 1
        if found:
            out.append((ordinal, found[0]))
        at, fresh = found[1] if found else at + 1, bool(found)
    return out


def apply_rules(ids: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], list[str]]:
    """(first ordinal, licence) of each rule that matched, by place, and the identifiers left over."""
    free, found = dict(ids), []
    for licence, wanted in RULES:
        for start in [i for i, x in free.items() if x == wanted[0]]:
            used, at = [start], start
            for name in wanted[1:]:
                at = next((i for i in range(at + 1, at + 2 + GAP) if free.get(i) == name), None)
                if at is None:
                    break
                used.append(at)
            if len(used) == len(wanted):
                found.append((start, licence))
                for i in used:
                    del free[i]
    return sorted(found), [x for _, x in sorted(free.items())]


def licence_scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences (both in order of place) and unresolved of each document (doc_id, text)."""

    def per_batch(batch: pa.RecordBatch):
        ids = [identifiers(text.as_py() or "") for text in batch["text"]]
        ruled = [apply_rules(x) if x else ([], []) for x in ids]
        return batch["doc_id"], [[x for _, x in i] for i in ids], [[x for _, x in f] for f, _ in ruled], [u for _, u in ruled]

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(source, per_batch, "doc_id long, sentence_ids array<string>, licences array<string>, unresolved array<string>")


def op6_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence sentences and licences of every document."""
    joined = lambda c: F.array_join(c, ",").alias(c)
    return licence_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), joined("sentence_ids"), joined("licences"), joined("unresolved"))
