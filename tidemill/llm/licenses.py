"""License scan by canonical digests.

A text is brought to one canonical form (lower case, one spelling, no punctuation, no copyright lines), its SHA-256 is
taken, and an equi-join with the digests of known licences names it. Compared are entire texts: the whole document, and
each of its lines as a text of its own, so that a notice line at the end of a document is found as well.

Defined results: a null text, an empty one or one without words has no licence. Equal units of a document are named
once. Of several names for one digest the first by name counts. Repeated rows are scanned each. Very long texts are
read whole. Empty tables give empty results. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence notices and short licence texts, as published.
_MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License\n\n" + _MIT_BODY),
    ("MIT", _MIT_BODY),
    ("ISC", "ISC License\n\n" + _ISC_BODY),
    ("ISC", _ISC_BODY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
)
# Digests of the canonical form of whole licence texts, as published.
KNOWN_DIGESTS = (
    ("Apache-2.0", "0ccff6cfd29d2ce67947af3c88e6b43406f0bec695d43c11ba41aa57b6ad4df7"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "e259b3e0bf831ddcd5351d255b832a3eccf42a266790e35dd570e35b737e30f2"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "557aed17f246818803a7e59ebc965e6771b9df3a92fb2f3598e38d288d65fe4c"),
    ("MPL-2.0", "2ad70b294c733e2c6f2cb0324503b9b81e060d33bc2608d3966776252c994426"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
)
#: Spellings that count as the same, as (pattern of whole words, spelling); fixed values, applied in this order.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("authorised", "authorized"),
    ("modelled", "modeled"),
    ("percent", "per cent"),
    ("v", "version"),
)
#: A sign with a year, both signs together, or the reservation alone; a wrapped line of the body may begin with these words.
_COPYRIGHT_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:(?:copyright|\(c\)|©)[^\n]*(?:19|20)[0-9][0-9][^\n]*"
    r"|copyright[^a-z0-9\n]*(?:\(c\)|©)[^\n]*|(?:\(c\)|©)[^a-z0-9\n]*copyright[^\n]*|all rights reserved[^a-z0-9\n]*)$"
)


def _plain(text: Column) -> Column:
    """Lower case, without copyright lines, every run of other characters than letters and digits as one space."""
    value = F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, "")
    return F.trim(F.regexp_replace(value, r"[^\p{L}\p{N}]+", " "))


def _spelled(plain: Column) -> Column:
    """One spelling of each word; the replacements run only on texts that hold one of them."""
    value = plain
    for pattern, spelling in SPELLINGS:
        value = F.regexp_replace(value, rf"\b{pattern}\b", spelling)
    return F.when(plain.rlike(rf"\b(?:{'|'.join(p for p, _ in SPELLINGS)})\b"), value).otherwise(plain)


def canonical_lines(text: str | Column) -> Column:
    """The lines of a text in canonical form, but for spelling."""
    lines = F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"\r\n?|\n", -1)
    return F.transform(lines, _plain)


def canonical(lines: Column) -> Column:
    """The canonical form of a text from its lines."""
    return _spelled(F.array_join(F.array_remove(lines, ""), " "))


def digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN, digests=KNOWN_DIGESTS) -> DataFrame:
    """digest and license; as many rows as there are known texts."""
    texts = spark.createDataFrame(list(known), "license string, body string")
    texts = texts.select("license", digest(canonical(canonical_lines("body"))).alias("digest"))
    listed = spark.createDataFrame(list(digests), "license string, digest string")
    return texts.unionByName(listed).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per document row: doc_id, license of the whole text, and the sorted licenses of its lines."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array(canonical_lines("text")).alias("all"))
    # The whole text and its lines share the forms of the lines, which are made once.
    units = F.element_at(
        F.transform(
            "all",
            lambda lines: F.concat(
                F.array(F.struct(F.lit(True).alias("whole"), F.array_join(F.array_remove(lines, ""), " ").alias("form"))),
                F.transform(F.array_distinct(lines), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("form"))),
            ),
        ),
        1,
    )
    units = numbered.select("row", "doc_id", F.explode(units).alias("u")).select("row", "doc_id", "u.*")
    # A unit without words has the canonical form '', which no known text has.
    found = units.select("row", "doc_id", "whole", F.sha2(_spelled(F.col("form")).cast("binary"), 256).alias("digest")).join(
        known, "digest", "left"
    )
    found = found.filter(F.col("whole") | F.col("license").isNotNull())
    return (
        found.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.min(F.when(F.col("whole"), F.col("license"))).alias("license"),
            F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))).alias("line_licenses"),
        )
        .select("doc_id", "license", F.concat_ws(",", "line_licenses").alias("line_licenses"))
    )


def _canonical_sql(column: str) -> str:
    value = f"regexp_replace(lower(coalesce({column}, '')), '\\r\\n?', chr(10), 'g')"
    value = f"regexp_replace({value}, '{_COPYRIGHT_LINE}', '', 'g')"
    value = f"trim(regexp_replace({value}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        value = f"regexp_replace({value}, '\\b{pattern}\\b', '{spelling}', 'g')"
    return value


ORACLE = f"""
WITH known AS (SELECT digest, min(license) AS license FROM (
  SELECT sha256({_canonical_sql("body")}) AS digest, license FROM (VALUES
{", ".join("('%s', '%s')" % (name, body.replace("'", "''")) for name, body in KNOWN)}) k(license, body)
  UNION ALL SELECT digest, license FROM (VALUES {", ".join(f"('{name}', '{digest}')" for name, digest in KNOWN_DIGESTS)}) h(license, digest))
  GROUP BY 1),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
u AS (SELECT row, unnest(list_distinct(string_split_regex(coalesce(text, ''), '\\r\\n?|\\n'))) AS unit FROM d),
l AS (SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS ids
  FROM u JOIN known ON sha256({_canonical_sql("unit")}) = digest GROUP BY row)
SELECT doc_id, license, coalesce(ids, '') AS line_licenses
FROM d LEFT JOIN known ON sha256({_canonical_sql("text")}) = digest LEFT JOIN l USING (row)
"""
