"""Known licences by the digest of a canonical text, with column expressions only.

The canonical form of a text: lower case; lines with a copyright notice go; `licence` and other spellings of
one word become one; every run of characters that are not letters or digits becomes one space (lines are
kept apart), ends cut off. The SHA-256 of a whole canonical text is joined with the digests of known
licences; each line of the text is looked up in the same way, for notices within other text. A whole text is also joined
without its heading (titles, `all rights reserved`, all lines of copyright, unfilled ones too) with a table of full texts,
by default those in `license_texts`; so a file as it is usually shipped is found.

Null and empty texts have the digest of the empty text and no licence. The key is only carried, so null and
repeated keys do no harm; an empty table gives an empty result; no other column is read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.binding import let

# Public licence texts and notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and \
associated documentation files (the "Software"), to deal in the Software without restriction, including without \
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the \
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of \
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO \
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE \
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, \
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE \
SOFTWARE."""
_ISC_TERMS = """PERMISSION to use, copy, modify, and/or distribute this software for any purpose with or without \
fee is hereby granted{kept}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL \
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, \
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN \
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR \
PERFORMANCE OF THIS SOFTWARE."""
KNOWN = {
    "0BSD": [_ISC_TERMS.format(kept="")],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-only"],
    "ISC": [_ISC_TERMS.format(
        kept=", provided that the above copyright notice and this permission notice appear in all copies")],
    "MIT": [MIT, "Released under the MIT License.", "SPDX-License-Identifier: MIT"],
}
# Equivalent spellings, whole words.
SPELLINGS = {"licence": "license", "licenced": "licensed", "licences": "licenses", "sublicence": "sublicense",
             "noncommercial": "non commercial", "organisation": "organization", "acknowledgement": "acknowledgment"}
COPYRIGHT_LINE = r"(?im)^[^\n]*(?:\bcopyright (?:\(c\)|©|[0-9])|©|\(c\) ?[0-9]{4})[^\n]*$"
# Lines of a canonical text that may stand above a licence, and the line to be filled in below some.
HEADING = r"copyright\b[^\n]*|all rights reserved|(?:the )?[^\n]{0,60}\blicense(?: (?:mit|isc|0bsd|bsd[^\n]{0,12}))?"
UNFILLED = r"(?m)^copyright (?:yyyy|year)\b[^\n]*\n?"
TERMS_END = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply the licence, and is often left out


def canonical(text: Column) -> Column:
    """Canonical text, its lines kept apart by single line feeds."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")
    out = F.lower(out)
    for word, spelling in SPELLINGS.items():
        # The plain search keeps texts without the word away from the regex.
        out = F.when(F.contains(out, F.lit(word)), F.regexp_replace(out, rf"\b{word}\b", spelling)).otherwise(out)
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    return F.trim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))


def whole(text: Column) -> Column:
    """A canonical text as one line."""
    return F.trim(F.replace(text, F.lit("\n"), F.lit(" ")))


def body(canon: Column) -> Column:
    """A canonical text without its heading, as one line."""
    def below(text: Column) -> Column:
        lines = F.split(text, "\n")
        begin = F.array_position(F.transform(lines, lambda line: F.trim(line).rlike(rf"\A(?:{HEADING})\z")), False)
        # Nearly no text begins with a heading; the last line is never one.
        return F.when(text.rlike(rf"\A(?:{HEADING}) ?\n"), F.array_join(
            F.slice(lines, F.greatest(begin, F.lit(1)).cast("int"), F.size(lines)), "\n")).otherwise(text)

    def filled(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("copyright y")), F.regexp_replace(text, UNFILLED, "")).otherwise(text)
    return whole(let(let(canon, below), filled))


def license_texts(spark: SparkSession) -> DataFrame:
    """The full texts that come with this package: (license_id, text)."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return spark.createDataFrame([(f.stem.split("__")[0], f.read_text(encoding="utf-8")) for f in files],
                                 "license_id string, text string")


def body_digests(texts: DataFrame) -> DataFrame:
    """(body_digest, body_id) of full texts, each also without what follows its terms."""
    ending = F.instr("text", TERMS_END)
    terms = F.when(ending > 0, F.substring(F.col("text"), F.lit(1), ending + len(TERMS_END) - 1))
    both = texts.select("license_id", F.explode(F.array("text", terms)).alias("text")).where("text IS NOT NULL")
    bodies = both.select("license_id", let(canonical(F.col("text")), body).alias("body")).where("body <> ''")
    return bodies.groupBy(F.sha2("body", 256).alias("body_digest")).agg(F.min("license_id").alias("body_id"))


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """A few rows: (license_id, digest) of the known texts, canonicalised like any other."""
    texts = spark.createDataFrame([(i, t) for i, ts in known.items() for t in ts], "license_id string, text string")
    return texts.select("license_id", F.sha2(whole(canonical(F.col("text"))), 256).alias("digest"))


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text",
                  known: dict[str, list[str]] = KNOWN, texts: DataFrame | None = None) -> DataFrame:
    """One row per row: the key, canonical_sha256, license_id (of the whole text), notices (lines found),
    notice_ids (their licences, sorted, comma-joined). `texts` (license_id, text) are full texts besides the known ones,
    those of the package if there are none."""
    spark = df.sparkSession
    given = spark.createDataFrame([(i, t) for i, ts in known.items() for t in ts], "license_id string, text string")
    bodies = body_digests(given.unionByName((license_texts(spark) if texts is None else texts).select("license_id", "text")))
    digests = known_digests(spark, known).collect()  # as many as `known` has texts
    ids = {d["digest"]: d["license_id"] for d in digests}
    table = F.broadcast(spark.createDataFrame(list(ids.items()), "digest string, license_id string"))
    rows = df.select(F.col(key).alias("key"), canonical(F.col(text)).alias("canon"))
    found = F.filter(F.transform(F.split("canon", "\n"), lambda line: F.sha2(F.trim(line), 256)),
                     lambda d: d.isin(*ids))
    hashed = rows.select("key", F.sha2(whole(F.col("canon")), 256).alias("digest"), found.alias("found"),
                         F.sha2(body(F.col("canon")), 256).alias("body_digest"))
    names = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    named = F.array_sort(F.array_distinct(F.transform("found", lambda d: F.element_at(names, d))))
    return hashed.join(table, "digest", "left").join(F.broadcast(bodies), "body_digest", "left").select(
        F.col("key").alias(key), F.col("digest").alias("canonical_sha256"),
        F.coalesce("license_id", "body_id").alias("license_id"),
        F.size("found").alias("notices"), F.array_join(named, ",").alias("notice_ids"))
