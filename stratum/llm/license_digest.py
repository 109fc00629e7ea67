"""Licence scan by canonical digests (DataFrame operations only).

A text is brought to a canonical form line by line: lower case, every run of
characters other than letters and digits to one space, equivalent spellings to
one, copyright lines and empty lines left out, the name in "neither the name of"
to one word. Its digest (MD5 of the canonical lines joined by a space) is hash-joined
to the digests of known licence texts made in the same way, each with and without its
title. The join of whole texts gives ``license``.

``notices`` names the licences that a text says it is under, wherever in it: the
phrases of ``PHRASES`` between word boundaries of the canonical text (copyright lines
included), and the identifiers of SPDX lines as they stand. Both come from the same
canonical form, made once a row.

Known whole texts: those in ``license_texts/`` (Apache, Artistic, CC0, GFDL, GPL, LGPL
and MPL versions) and MIT, ISC, 0BSD, BSD-2-Clause and BSD-3-Clause. Only their digests
travel to the tasks; a caller's own table (``name, known``) is joined as Spark sees fit.

Defined results: null or empty text has the digest of the empty text, no licence and no
notice (null); rows are judged one by one, also where an id repeats; a null id gives a
row with a null id; extra columns are ignored; equal canonical texts in the known table
give the first name; very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (variant, canonical), replaced anywhere.
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("isation", "ization"),
    ("ising", "izing"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("fulfil ", "fulfill "),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("non commercial", "noncommercial"),
    ("https", "http"),
)
#: A copyright line: the word with a sign, "by" or a year after it. (A line of a text's
#: body may begin with "copyright holder".)
COPYRIGHT = r"^(copyright|copr)($| (c|by|year)( |$)| [0-9]| .*[0-9]{4})|^c (copyright|[0-9])|^all rights reserved( |$)"

#: The holder's name in a BSD text.
ENDORSE = (r"neither the names? of .{1,120}? nor the names? of (its|their) contributors", "neither the name of holder nor the names of its contributors")

# Texts of common short licences.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
LICENSES = {
    "MIT": "MIT License\n\nCopyright (c) year holder\n\nPermission is hereby granted, free of charge, to any person "
    'obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in "
    f"all copies or substantial portions of the Software.\n\n{_WARRANTY}",
    "ISC": "ISC License\n\nCopyright (c) year holder\n\nPermission to use, copy, modify, and/or distribute this software "
    "for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
    f"permission notice appear in all copies.\n\n{_ISC_END}",
    "0BSD": "BSD Zero Clause License\n\nCopyright (c) year holder\n\nPermission to use, copy, modify, and/or distribute "
    f"this software for any purpose with or without fee is hereby granted.\n\n{_ISC_END}",
    "BSD-2-Clause": f"BSD 2-Clause License\n\nCopyright (c) year holder\nAll rights reserved.\n\n{_BSD_HEAD}\n\n{_BSD_END}",
    "BSD-3-Clause": f"BSD 3-Clause License\n\nCopyright (c) year holder\nAll rights reserved.\n\n{_BSD_HEAD}\n\n"
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    f"products derived from this software without specific prior written permission.\n\n{_BSD_END}",
}
# How texts name the licence that they are under, in canonical form.
PHRASES = {
    "0BSD": ("under the zero clause bsd license", "under the bsd zero clause license"),
    "AGPL-3.0": ("under the gnu affero general public license version 3", "gnu affero general public license as published by the free software foundation either version 3", "under the agplv3"),
    "Apache-2.0": ("under the apache license version 2 0", "under the apache license 2 0", "under apache 2 0", "under the apache 2 0 license", "under apache license version 2 0"),
    "BSD-2-Clause": ("under the bsd 2 clause license", "under the 2 clause bsd license", "under the simplified bsd license", "under bsd 2 clause"),
    "BSD-3-Clause": ("under the bsd 3 clause license", "under the 3 clause bsd license", "under the new bsd license", "under the modified bsd license", "under bsd 3 clause"),
    "CC-BY-4.0": ("under cc by 4 0", "under a creative commons attribution 4 0 international license", "under the creative commons attribution 4 0 international license"),
    "CC-BY-NC-4.0": ("under cc by nc 4 0", "under a creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("under cc by nc sa 4 0", "under a creative commons attribution noncommercial sharealike 4 0 international license"),
    "CC-BY-ND-4.0": ("under cc by nd 4 0", "under a creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-SA-4.0": ("under cc by sa 4 0", "under a creative commons attribution sharealike 4 0 international license", "under the creative commons attribution sharealike 4 0 international license"),
    "CC0-1.0": ("under cc0 1 0", "under the creative commons zero v1 0 universal license", "under cc0"),
    "GPL-2.0": ("under the gnu general public license version 2", "gnu general public license as published by the free software foundation either version 2", "under the gplv2", "under gpl version 2", "under the terms of the gnu general public license version 2"),
    "GPL-3.0": ("under the gnu general public license version 3", "gnu general public license as published by the free software foundation either version 3", "under the gplv3", "under gpl version 3", "under the terms of the gnu general public license version 3"),
    "ISC": ("under the isc license", "under isc license"),
    "LGPL-2.1": ("under the gnu lesser general public license version 2 1", "gnu lesser general public license as published by the free software foundation either version 2 1", "under the lgplv2 1"),
    "LGPL-3.0": ("under the gnu lesser general public license version 3", "gnu lesser general public license as published by the free software foundation either version 3", "under the lgplv3"),
    "MIT": ("under the mit license", "under mit license", "under the terms of the mit license", "mit licensed"),
    "MPL-2.0": ("subject to the terms of the mozilla public license v 2 0", "under the mozilla public license version 2 0", "under the mozilla public license 2 0", "under mpl 2 0"),
    "Unlicense": ("under the unlicense", "free and unencumbered software released into the public domain"),
}
#: An SPDX line's identifier.
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*)"
# --- end of fixed values


def known_texts() -> dict[str, str]:
    """The whole texts, by name."""
    folder = resources.files("stratum.llm") / "license_texts"
    return LICENSES | {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}


def canonical(text: Column) -> Column:
    """All canonical lines of a text."""
    # one pass over the whole text; line feeds are the separators that stay
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    for variant, one in SPELLINGS:
        plain = F.replace(plain, F.lit(variant), F.lit(one))
    trimmed = F.transform(F.split(plain, "\n", -1), lambda x: F.btrim(x))
    return F.filter(trimmed, lambda x: x != "")


def digested(lines: Column) -> Column:
    """The text that the digest is made of: no copyright lines, no holder's name."""
    own = F.array_join(F.filter(lines, lambda x: ~x.rlike(COPYRIGHT)), " ")
    return F.when(F.contains(own, F.lit("neither the name")), F.regexp_replace(own, *ENDORSE)).otherwise(own)


def known(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """``name, known``: digests of known texts, with and without their first line."""
    rows = spark.createDataFrame(sorted(texts.items()), "name string, text string").select("name", canonical(F.col("text")).alias("lines"))
    short = rows.select("name", F.slice("lines", 2, F.size("lines")).alias("lines")).where(F.size("lines") > 0)
    each = rows.unionByName(short).select("name", F.md5(digested(F.col("lines"))).alias("known"))
    return each.groupBy("known").agg(F.min("name").alias("name"))


def named(lines: Column, text: Column, phrases: dict[str, tuple[str, ...]]) -> Column:
    """Sorted names of the licences that a text says it is under, comma-joined; null if none."""
    whole = F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" "))
    # a lambda's argument holds the joined text once for all phrases
    found = F.transform(F.array(whole), lambda x: F.array(*[
        F.when(reduce(Column.__or__, [F.contains(x, F.lit(f" {p} ")) for p in each]), F.lit(name))
        for name, each in sorted(phrases.items())
    ]))[0]
    spdx = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SPDX))
    every = F.array_sort(F.array_distinct(F.filter(F.concat(found, spdx), lambda x: x.isNotNull())))
    return F.when(F.size(every) > 0, F.array_join(every, ","))


def scan_licenses(
    docs: DataFrame,
    licenses: DataFrame | None = None,
    phrases: dict[str, tuple[str, ...]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, digest, license, notices`` of every row."""
    whole = F.broadcast(known(docs.sparkSession, known_texts())) if licenses is None else licenses
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), canonical(docs[text_col]).alias("lines"))
    judged = texts.select(
        "doc_id", F.md5(digested(F.col("lines"))).alias("digest"),
        named(F.col("lines"), F.col("text"), PHRASES if phrases is None else phrases).alias("notices"),
    )
    names = whole.select(F.col("known").alias("digest"), F.col("name").alias("license"))
    return judged.join(names, "digest", "left").select("doc_id", "digest", "license", "notices")
