"""Licence scans by canonical digest: case, punctuation, copyright lines and equivalent spellings are normalised, then
whole texts are hash-joined to the digests of known licences.

The texts are each row's text as a whole, each of its paragraphs and each of its lines, since corpora hold licence files,
headers of several lines and one-line notices. Everything is built-in functions; texts meet the table of known digests
by a broadcast join while that table is within BROADCAST rows, else by a shuffle join on the digest. The table is a
parameter: known_digests makes it from any licences' texts, and knows those below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

BROADCAST = 10_000
#: Equivalent words, the second of each pair replacing the first (after lower-casing).
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "acknowledgement": "acknowledgment", "analogue": "analog", "authorised": "authorized",
    "behaviour": "behavior", "catalogue": "catalog", "centre": "center", "colour": "color", "favour": "favor", "fulfil": "fulfill", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "maximise": "maximize", "modelled": "modeled", "noninfringement": "non infringement",
    "optimise": "optimize", "organisation": "organization", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines that name a holder: the word with a year, or with a sign, bracket or colon behind it; not clauses of a wrapped text
#: that begin with it. And lines of the usual phrase behind such.
COPYRIGHT = (
    r"(^|\n)[^a-z0-9\n]*((copyright[^\n]*\b(19|20)[0-9][0-9]\b|copyright[ \t]*(\(c\)|©|<|\[|\{|:|by\b)|\(c\)[ \t]*(copyright|by\b|<|\[|\{|(19|20)[0-9][0-9]))[^\n]*"
    r"|©[^\n]*|all rights reserved[. \t]*)"
)
SPELLED = "(?<![^ \n])(" + "|".join(SPELLINGS) + ")(?![^ \n])"

#: What titles stand above a licence's text.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng license"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"

#: Whole texts, without titles and copyright lines, by SPDX identifier.
TEXTS = [
    ("MIT", _MIT + """

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAME + _BSD_END),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
]

#: Notices: lines and paragraphs that place a work under a licence.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
]

#: Identifiers whose SPDX line is a notice.
SPDX = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0",
    "Unlicense", "Zlib",
]

KNOWN = [*TEXTS, *((x, f"{title}\n{text}") for x, text in TEXTS for title in TITLES[x]), *NOTICES, *((x, f"SPDX-License-Identifier: {x}") for x in SPDX)]

#: Canonical digests of long licences as published, whole and without what follows their terms.
DIGESTS = [
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a"),
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2-only", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3-only", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0-only", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0-only", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0-only", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0-only", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0-only", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.0-only", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0-only", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1-only", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1-only", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986"),
    ("MPL-2.0", "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]


def canonical_lines(text: Column) -> Column:
    """The text lower-cased (A-Z), without copyright lines, in equivalent spellings; each line's words parted by one space,
    paragraphs by an empty line."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER + "\r", LOWER + "\n")
    t = F.when(t.rlike(r"copyright|\(c\)|©|all rights"), F.regexp_replace(t, COPYRIGHT, "\n")).otherwise(t)
    t = F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " "), r" ?\n ?", "\n")
    t = F.regexp_replace(t, r"\n\n\n+", "\n\n")
    spelled = t
    for old, new in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, f"(?<![^ \n]){old}(?![^ \n])", new)
    return F.trim(F.when(t.rlike(SPELLED), spelled).otherwise(t), F.lit(" \n"))


def _whole(lines: Column) -> Column:
    return F.regexp_replace(lines, r"\n+", " ")


def known_digests(spark: SparkSession, licences: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """digest, license, of licences' texts and of digests: of equal canonical texts the smallest identifier."""
    rows = spark.createDataFrame(licences, "license string, text string").select(F.sha2(_whole(canonical_lines(F.col("text"))), 256).alias("digest"), "license")
    return rows.unionByName(spark.createDataFrame(digests, "license string, digest string")).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(df: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id, text_license (of the whole text, or null), n_notices, and notices: the identifiers of its
    lines and paragraphs of several lines that are known texts, sorted, joined by commas.

    Null and empty texts, and texts without words, have no licence. Rows with equal or null ids each give a row; of
    equal rows each has its own notices. Of licences of equal text the smallest identifier counts. Texts of any length
    are whole; other columns are not looked at.
    """
    known = known if known.count() > BROADCAST else F.broadcast(known)
    rows = df.select(F.col(id_col).alias("id"), F.spark_partition_id().alias("part"), canonical_lines(F.col(text_col)).alias("lines"))
    whole = _whole(F.col("lines"))
    each = F.filter(F.split("lines", r"\n+"), lambda x: x != "")
    several = F.transform(F.filter(F.split("lines", "\n\n"), lambda x: F.contains(x, F.lit("\n"))), _whole)
    digests = F.transform(F.concat(each, several), lambda x: F.sha2(x, 256))
    # equal rows of a part are counted together, so that a repeated task, whatever its order, makes the same groups
    same = ["id", "part", "lines_digest", "text_digest"]
    units = rows.select("id", "part", F.sha2("lines", 256).alias("lines_digest"), F.when(whole != "", F.sha2(whole, 256)).alias("text_digest"), F.posexplode_outer(digests).alias("at", "digest"))
    found = units.join(known, "digest", "left").where("at is null or at = 0 or license is not null")
    found = found.groupBy(*same, "license").agg(F.count("*").alias("c"), F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("rows"))
    own = F.array_sort(F.collect_list(F.when(F.col("license").isNotNull(), F.struct("license", "c"))))
    found = found.groupBy(*same).agg(F.sum("rows").alias("rows"), own.alias("own"))
    notices = F.flatten(F.transform("own", lambda x: F.array_repeat(x["license"], (x["c"] / F.col("rows")).cast("int"))))
    found = found.select("id", "text_digest", notices.alias("all"), F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy"))
    texts = known.withColumnsRenamed({"digest": "text_digest", "license": "text_license"})
    return found.join(texts, "text_digest", "left").select(F.col("id").alias(id_col), "text_digest", "text_license", F.size("all").cast("long").alias("n_notices"), F.array_join("all", ",").alias("notices"))


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"), known_digests(spark))


def _canonical_sql(text: str) -> str:
    t = f"translate(coalesce({text}, ''), '{UPPER}' || chr(13), '{LOWER}' || chr(10))"
    t = f"regexp_replace({t}, '{COPYRIGHT}', chr(10), 'g')"
    t = rf"regexp_replace(regexp_replace({t}, '[^a-z0-9\n\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g')"
    t = rf"regexp_replace({t}, '\n\n\n+', chr(10) || chr(10), 'g')"
    for old, new in SPELLINGS.items():
        for _ in range(2):  # words that share a space with the one before
            t = rf"regexp_replace({t}, '(^|[ \n]){old}($|[ \n])', '\1{new}\2', 'g')"
    return f"trim({t}, ' ' || chr(10))"


def _known_sql() -> str:
    quoted = lambda rows: ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in rows)
    texts = rf"SELECT sha256(regexp_replace({_canonical_sql('t')}, '\n+', ' ', 'g')) AS digest, l AS license FROM (VALUES {quoted(KNOWN)}) v(l, t)"
    return f"SELECT digest, min(license) AS license FROM ({texts} UNION ALL SELECT d, l FROM (VALUES {quoted(DIGESTS)}) v(l, d)) GROUP BY 1"


OP1_SQL = rf"""
WITH known AS ({_known_sql()}),
c AS (SELECT doc_id, {_canonical_sql("text")} AS lines FROM documents),
d AS (SELECT doc_id, list_concat(list_filter(string_split(regexp_replace(lines, '\n+', chr(10), 'g'), chr(10)), lambda x: x <> ''),
      list_transform(list_filter(string_split(lines, chr(10) || chr(10)), lambda x: contains(x, chr(10))), lambda x: replace(x, chr(10), ' '))) AS ls, regexp_replace(lines, '\n+', ' ', 'g') AS w FROM c),
u AS (SELECT doc_id, sha256(unnest(ls)) AS digest FROM d),
f AS (SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS notices FROM u JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN w <> '' THEN sha256(w) END AS text_digest, known.license AS text_license, coalesce(f.n, 0) AS n_notices, coalesce(f.notices, '') AS notices
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN known ON known.digest = sha256(w) AND w <> ''
"""
