"""Licence scans by canonical digests, with DataFrame functions only.

A text is brought to canonical form: copyright lines dropped, lower case, equivalent spellings made one
(licence/license, version/v.), everything but letters and digits turned to single spaces. The SHA-256 of the form is
joined by hash with the digests of known licence texts. Whole texts are looked up, and, as documents carry licences
inside, so is each of their lines, in the task that reads the text; the known texts are a fixed, small table
(KNOWN_ROWS at most), which is broadcast. Nothing is shuffled.

Defined results: null text counts as empty, whose digest is known to no licence; a text of any length is read whole;
lines end at a line feed; of known texts with one digest the last one names it; licences of lines are in order of their
names, each once; repeated rows are looked up one by one; null ids are carried; an empty table gives an empty
result; extra columns are not read, and output columns that would be named like the key get a leading underscore.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import beside, table

#: Equivalent spellings, in order: pattern (the same in Java, Python and RE2) and replacement. A fixed list.
SPELLINGS = (
    ("licen[cs]e([sd]?)", "license$1"),
    ("(^|[^a-z0-9])v(?:ersion|er)?[. ]*([0-9])", "$1version $2"),
    ("non-commercial", "noncommercial"),
    ("sub-license", "sublicense"),
    ("merchantibility", "merchantability"),
    ("copyright holders?", "copyright owner"),
    ("and/or", "and or"),
    ("per cent", "percent"),
)
#: Lines that name a holder or a year; they differ from copy to copy. The same in Java, Python and RE2. A fixed pattern.
COPYRIGHT_LINE = (
    "(?m)^(?:"
    "[^\\n]*(?i:copyright)[ \\t]*:?[ \\t]*(?:\\((?i:c)\\)|©|&copy;|[0-9]{4})"
    "|[^\\n]*(?:\\((?i:c)\\)|©)[ \\t]*[0-9]{4}"
    "|[^\\n]*(?i:all rights reserved)"
    "|[^A-Za-z0-9\\n]*(?:[Cc]opyright|COPYRIGHT)[ \\t]*:?[ \\t]+(?:by[ \\t]+)?[A-ZÀ-ÞΑ-ΩА-Я][a-zß-ÿα-ωа-я]"
    "|[^A-Za-z0-9\\n]*©"
    ")[^\\n]*$"
)
KNOWN_ROWS = 10_000  # digests at most that a scan takes: they are broadcast

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: (licence id, text): whole licences, headers and notices. A fixed list; a caller may give its own.
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT), ("MIT", "The MIT License\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAME + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_NAME + _BSD_TAIL),
    ("Apache-2.0", _APACHE), ("Zlib", _ZLIB), ("Zlib", "zlib License\n" + _ZLIB),
    *((name, lead + what + tail) for name, what in (
        ("MIT", "the MIT License"), ("Apache-2.0", "the Apache License, Version 2.0"), ("BSD-3-Clause", "the BSD 3-Clause License"), ("BSD-2-Clause", "the BSD 2-Clause License"),
        ("GPL-3.0", "the GNU General Public License, version 3"), ("GPL-2.0", "the GNU General Public License, version 2"), ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
        ("AGPL-3.0", "the GNU Affero General Public License, version 3"), ("MPL-2.0", "the Mozilla Public License, version 2.0"), ("ISC", "the ISC License"),
        ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC-BY-ND-4.0", "CC BY-ND 4.0"), ("CC0-1.0", "CC0 1.0"),
    ) for lead in ("Licensed under ", "Released under ", "Distributed under ", "Available under ", "This work is licensed under ", "This software is licensed under ") for tail in ("", " license")),
)


#: (licence id, digest of the canonical form): whole texts of long public licences. A fixed list.
KNOWN_DIGESTS = (
    ("Apache-2.0", "95f35d79ea3bab75c250549d6a03cef242e0547d78c99e26fcede49936fb0184"),
    ("Artistic-1.0-Perl", "6bb0017b4aa6003fd6d889cea9321e8284517a4f11d44d05cfaf198b80bd6ce6"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "dd21c1489470df7f8763c8da9d6ebad250b28e79589984a28a57cf60ae7a41be"),
    ("GFDL-1.3", "ac48f9c5ac6627cac07c42464e71743898508f6d8718a6dc0e1259a25f0c6b68"),
    ("GPL-1.0", "d283f63d5faed9cfd35bf6ea3bec3025bf3d73167689d1c936e42ccc1a589819"),
    ("GPL-2.0", "0c323dc3f9ea6cffb72eebd0059899ec9e452630c11f7a77a4d3486f9ff5ab36"),
    ("GPL-3.0", "a910f88a2fc56eaa93056f52be7f12291447b5c7608d0847eba28629a384ad1a"),
    ("LGPL-2.0", "87c83ddf13b8d772a493615bbfb7368fb6c87b179e064f6b4573dd9008cbd283"),
    ("LGPL-2.1", "4b7fd8442d92b28972b9aee4eb75166ac0ea6267095bdcdbe488d5f54b725b71"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "27d164b52dfaff4b5a631cd4eebfbb7683fe882e3057f2f2e01d54692688d985"),
    ("MPL-2.0", "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead"),
)


def canonical_text(text: str) -> str:
    """The canonical form, in Python: for the table of known digests."""
    out = re.sub(COPYRIGHT_LINE, "", text).lower()
    for pattern, new in SPELLINGS:
        out = re.sub(pattern, new.replace("$", "\\"), out)
    return re.sub("[^a-z0-9]+", " ", out).strip(" ")


def canonical_lines(text: Column) -> Column:
    """The canonical form of every line, line feeds kept between them, each with a space at most at its ends."""
    out = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, ""))
    for pattern, new in SPELLINGS:
        out = F.regexp_replace(out, pattern, new)
    return F.regexp_replace(out, "[^a-z0-9\n]+", " ")


def known_forms(known=None) -> dict[str, str]:
    """digest -> licence id of known texts (KNOWN and KNOWN_DIGESTS by default)."""
    out = {hashlib.sha256(canonical_text(text).encode()).hexdigest(): name for name, text in (KNOWN if known is None else known)}
    return out if known is not None else {**{digest: name for name, digest in KNOWN_DIGESTS}, **out}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known=None) -> DataFrame:
    """(key, digest, license, notices) of every row: the whole text's digest and licence, and the licences of
    its lines, sorted and joined by commas ('' without any). ``known`` are (licence id, text) pairs of the caller's."""
    forms = known_forms(known)
    if len(forms) > KNOWN_ROWS:
        raise ValueError(f"{len(forms)} known texts, {KNOWN_ROWS} allowed")
    names = [key, *beside(key, "digest", "license", "notices")]
    table_ = F.broadcast(docs.sparkSession.createDataFrame(sorted(forms.items()), "_digest string, _license string"))
    lined = docs.select(F.col(key).alias("_key"), canonical_lines(F.col(text).cast("string")).alias("_lines"))
    whole = F.sha2(F.trim(F.regexp_replace("_lines", "[ \n]+", " ")), 256)
    if forms:
        # Lines are looked up in the same digests, a hash set in the plan; the few that are known get their names.
        digests = F.transform(F.split("_lines", "\n"), lambda x: F.sha2(F.trim(x), 256))
        hits = F.array_distinct(F.filter(digests, lambda d: d.isin(*forms)))
        ids = F.create_map(*(F.lit(x) for row in sorted(forms.items()) for x in row))
        notices = F.when(F.size("_hits") > 0, F.array_join(F.array_sort(F.array_distinct(F.transform("_hits", lambda d: F.element_at(ids, d)))), ",")).otherwise("")
    else:
        hits, notices = F.array().cast("array<string>"), F.lit("")
    found = lined.select("_key", whole.alias("_whole"), hits.alias("_hits"))
    joined = found.join(table_, F.col("_whole") == F.col("_digest"), "left")
    return joined.select(F.col("_key").alias(names[0]), F.col("_whole").alias(names[1]), F.col("_license").alias(names[2]), notices.alias(names[3]))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of every document."""
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _oracle() -> str:
    """The same in DuckDB's SQL."""

    def form(x: str) -> str:
        out = f"lower(regexp_replace(coalesce({x}, ''), '{COPYRIGHT_LINE}', '', 'g'))"
        for pattern, new in SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{new.replace('$', chr(92))}', 'g')"
        return f"sha256(trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'), ' '))"

    known = ", ".join(f"('{d}', '{n}')" for d, n in sorted(known_forms().items()))
    return f"""
WITH known(digest, license) AS (VALUES {known}),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM (SELECT doc_id, {form('line')} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.digest, k.license, coalesce(f.notices, '') AS notices
FROM (SELECT doc_id, {form('text')} AS digest FROM documents) d LEFT JOIN known k USING (digest) LEFT JOIN found f USING (doc_id)"""


ORACLE = _oracle()
