"""Licence scan: canonical digests of whole texts, hash-joined to those of known licences. DataFrame functions only.

The canonical form is lower case without copyright statements. Before the first opening of a licence, paragraphs that begin
with the word or the sign go whole, and the last one goes from its first statement (the word followed by (c), the sign, a year or
"by") on, however many holders it lists. After it, statements that run on into another opening within 300 characters go, and
lines that state one; and "all rights reserved" alone. So it does not depend on where lines are wrapped, but that a holder
without sign and year needs a paragraph.
Runs of characters other than letters and digits are one space, and spellings that licence guides hold to be equivalent
are unified. Known texts are few and fixed, so the table
of their digests is broadcast; the longer ones are listed by their digests alone. Besides whole texts, single lines are looked up in the same way: notices such as
"Released under the MIT License." Only lines with one of NOTICE_WORDS are tried; every known notice holds one.

Defined results: a null text has a null digest, no licence and no notices; an empty text has the digest of the empty
form and no licence; repeated rows are scanned each; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unless(words: list[str]) -> str:
    """A pattern of words that begin with none of the given ones, without lookahead (DuckDB has none)."""
    by_first: dict[str, list[str]] = {}
    for w in words:
        by_first.setdefault(w[0], []).append(w[1:])
    ways = [rf"[^\s{''.join(sorted(by_first))}]\S*"]
    for first, rests in sorted(by_first.items()):
        if "" not in rests:
            ways.append(f"{first}(?:{_unless(rests)})?")
    return "|".join(ways)


#: Openings of licence texts; a copyright statement ends before them, also within a line.
OPENINGS = [
    "permission is hereby granted", "permission to use", "redistribution and use", "licensed under", "everyone is permitted", "permission is granted to copy",
    "this program is free software", "this library is free software", "this program comes with", "gnomovision comes with", "this software is provided as is",
]
#: Lines that licence guides tell to ignore: statements of copyright, not lines that merely begin with that word.
_STATEMENT = r"copyrights?[ \t:,]*(?:\(c\)|©|by\b|[0-9]{4}|[<\[{][ \t]*(?:year|yyyy))|\(c\)[ \t:,]*(?:copyright\b|[0-9]{4})|©"
_REST = rf"\S*(?:[ \t\r]+(?:{_unless(sorted({o.split(' ')[0] for o in OPENINGS}))})){{0,100}}[ \t\r]*"
COPYRIGHT_LINE = rf"(?m)^[ \t>*#/-]*(?:(?:{_STATEMENT}){_REST}|all rights reserved[ \t\r.!*#/-]*)$"
#: What may lie between the words of an opening.
GAP = r"[\s'-]+"
#: Statements that an opening follows within some words, on the same line or the next ones.
RUN_ON = rf"(?s)(?:{_STATEMENT.replace('[ \\t', '[\\s')}).{{0,300}}?\b({'|'.join(o.replace(' ', GAP) for o in OPENINGS)})\b"
#: The first opening of a text; what is before it is its head.
OPENING = r"\b(?:" + "|".join(o.replace(" ", GAP) for o in OPENINGS) + r")\b"
#: What separates paragraphs, what begins a paragraph that states a copyright in any form, and a statement with all that follows.
BLANK_LINE = r"\n[ \t\r]*\n"
PLAIN = r"(?s)^[ \t\r\n>*#/-]*(?:copyrights?\b|\(c\)[ \t:,]*(?:copyright\b|[0-9]{4})|©).*"
TO_THE_END = rf"(?s)(?:{_STATEMENT.replace('[ \\t', '[\\s')}).*"
OTHER = r"[^\p{L}\p{N}]+"
#: Equivalent spellings (from, to) in the lower case.
SPELLINGS = [
    (r"licence", "license"), (r"acknowledgement", "acknowledgment"), (r"authoris", "authoriz"), (r"organis", "organiz"),
    (r"recognis", "recogniz"), (r"utilis", "utiliz"), (r"favour", "favor"), (r"fulfil\b", "fulfill"), (r"judgement", "judgment"),
    (r"\bsub license", "sublicense"), (r"\bnon infringement", "noninfringement"), (r"\bper cent\b", "percent"), (r"\bwhilst\b", "while"),
    (r"\bcopyright owner\b", "copyright holder"), (r"\bnon commercial\b", "noncommercial"),
]
NOTICE_WORDS = "licen|copyright|warrant|permission"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to """
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
""" + _ISC[_ISC.index("THE SOFTWARE IS") :]
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""


def _bulleted(text: str) -> str:
    """The same with bullets in place of numbers."""
    return re.sub(r"(?m)^[0-9]\. ", "* ", text)


#: Known texts: (licence id, text). Texts with and without their title lines are listed each.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("BSD-2-Clause", _bulleted(_BSD_HEAD + _BSD_TAIL)), ("BSD-2-Clause", _bulleted("BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL)),
    ("BSD-3-Clause", _bulleted(_BSD_HEAD + _BSD_NAMES + _BSD_TAIL)), ("BSD-3-Clause", _bulleted("BSD 3-Clause License\n" + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL)),
    ("0BSD", _0BSD), ("0BSD", "BSD Zero Clause License\n" + _0BSD), ("Zlib", _ZLIB), ("Zlib", "zlib License\n" + _ZLIB), ("Zlib", _bulleted(_ZLIB)),
    *[("MIT", title + _MIT + f"\n{scheme}://opensource.org/licenses/MIT") for title in ("", "MIT License\n", "The MIT License (MIT)\n") for scheme in ("http", "https")],
    ("Unlicense", _UNLICENSE + "<http://unlicense.org/>"), ("Unlicense", _UNLICENSE + "<https://unlicense.org/>"),
    ("BSL-1.0", _BOOST), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n" + _BOOST),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This work is licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
]


#: Digests of the canonical forms of whole published texts, with their titles and appendices.
PUBLISHED = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2-only", "8e2a709e38f777cdad4fef08ae7c15506d92bc64ce471e44d7d46055daa80704"),
    ("GFDL-1.3-only", "9419d773fceb355c7ad2538ea39326c87b714cc98d79eeb01d831ebbc3ee83c4"),
    ("GPL-1.0-only", "df6be0ef8450813e8086ffa782c39595bbed54061f3073efbe78160084f5f2f3"),
    ("GPL-2.0-only", "0c0df65a88a31c1289c333fe88eaa5a1208319c8056ca7695fe7415c79255a0b"),
    ("GPL-3.0-only", "861bd38e22ab70ae8dcfee80ab5d4466cb70842e09c5df25ffd0ff2f1661dd9c"),
    ("LGPL-2.0-only", "4401e0261a8caf4fd55eeb0e816fda06bbc9e4b2605767f5ffdf843a5c70e07e"),
    ("LGPL-2.1-only", "599d9303049b507aa89582ee08dd4ddaba298764648558e7bf8e78309807bfaa"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]


def _headless(c: Column) -> Column:
    """Text without the copyright statements before its first opening: paragraphs that begin with one, and the end of the last from one on."""
    at = F.regexp_instr(c, F.lit(OPENING))
    parts = F.split(F.regexp_replace(F.substring(c, F.lit(1), at - 1), r"\s+$", ""), BLANK_LINE)
    whole = F.filter(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: ~x.rlike(PLAIN))
    last = F.regexp_replace(F.regexp_replace(F.element_at(parts, -1), PLAIN, ""), TO_THE_END, "")
    head = F.array_join(F.concat(whole, F.array(last)), "\n\n")
    return F.when(at > 0, F.concat(head, F.lit("\n"), F.substring(c, at, F.length(c)))).otherwise(c)


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    low = F.lower(text)
    said = low.contains("copyright") | low.contains("(c)") | low.contains("©") | low.contains("all rights reserved")
    bare = F.regexp_replace(F.regexp_replace(_headless(low), RUN_ON, "$1"), COPYRIGHT_LINE, "")
    c = F.trim(F.regexp_replace(F.when(said, bare).otherwise(low), OTHER, " "))
    unified = c
    for old, new in SPELLINGS:
        unified = F.regexp_replace(unified, old, new)
    return F.when(c.rlike("|".join(old for old, _ in SPELLINGS)), unified).otherwise(c)


def canonical_text(text: str) -> str:
    """The same for the known texts, on the driver."""
    c = text.lower()
    if found := re.search(OPENING, c):
        *whole, last = re.split(BLANK_LINE, re.sub(r"\s+\Z", "", c[: found.start()]))
        last = re.sub(TO_THE_END, "", re.sub(PLAIN, "", last))
        c = "\n\n".join([*[x for x in whole if not re.search(PLAIN, x)], last]) + "\n" + c[found.start() :]
    c = re.sub(COPYRIGHT_LINE, "", re.sub(RUN_ON, r"\1", c))
    c = re.sub(r"[\W_]+", " ", c).strip()
    for old, new in SPELLINGS:
        c = re.sub(old, new, c)
    return c


def digests(known: list[tuple[str, str]] = KNOWN, published: list[tuple[str, str]] = PUBLISHED) -> dict[str, str]:
    """Digest to licence id, of known texts and of published ones that are given by their digests."""
    return {hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in known} | {d: name for name, d in published}


def scan(docs: DataFrame, text_col: str, known: list[tuple[str, str]] = KNOWN, published: list[tuple[str, str]] = PUBLISHED) -> DataFrame:
    """All columns of docs, and digest, license (of the whole text) and notices (of its lines; sorted), which replace columns of these names."""
    of = sorted(digests(known, published).items())
    docs = docs.select([c for c in docs.columns if c not in ("digest", "license", "notices")])
    key = next(c for c in ("known", *(f"known{i}" for i in range(len(docs.columns) + 1))) if c not in docs.columns)
    table = F.broadcast(docs.sparkSession.createDataFrame(of, f"{key} string, license string"))
    by_line = F.create_map(*[F.lit(x) for kv in of for x in kv])
    text = F.col(text_col).cast("string")
    lines = F.filter(F.split(text, "\n"), lambda x: F.lower(x).rlike(NOTICE_WORDS))
    named = F.transform(lines, lambda x: F.try_element_at(by_line, F.sha2(canonical(x).cast("binary"), 256)))
    found = F.when(text.rlike("(?i)" + NOTICE_WORDS), F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull())))).otherwise(F.array().cast("array<string>"))
    out = docs.withColumn("digest", F.sha2(canonical(text).cast("binary"), 256)).withColumn("notices", F.coalesce(found, F.array().cast("array<string>")))
    return out.join(table, F.col("digest") == F.col(key), "left").drop(key)
