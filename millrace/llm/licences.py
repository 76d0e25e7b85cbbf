"""Licence scan by digests of canonical texts, in DataFrame functions only.

A line becomes canonical in these steps: lower case; a copyright line (it begins
with the word, (c) or the sign, and names a year or a holder mark) is dropped;
everything but letters and digits separates words; equivalent spellings become
one.  A text's canonical form is its non-empty canonical lines joined by blanks,
so wrapping, indents, comment marks and quotes do not matter.  Whole texts are
joined by digest to the digests of known licences, and single lines to those of
known notices.

Null and empty texts, and texts without letters and digits, have the digest of
the empty text and no licence.  Repeated rows get the same result; a licence
table that names a text twice yields the first name.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (left becomes right).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("https", "http"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("owner", "holder"),
    ("owners", "holders"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("non commercial", "noncommercial"), ("per cent", "percent"), ("sub license", "sublicense"),
)

# Whole licence texts.
LICENCES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
)

# One-line notices.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

# Title lines that stand above the texts of LICENCES.
TITLES = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)")),
    ("ISC", ("ISC License", "The ISC License", "ISC License (ISC)")),
    ("Zlib", ("zlib License", "The zlib License", "zlib/libpng License")),
)

#: Folder of whole licence texts with their titles, one file each, named for its licence.
TEXTS = Path(__file__).parent / "texts"


def list_texts() -> tuple[tuple[str, str], ...]:
    """All known licences: LICENCES and the files of TEXTS, each with and without its title, with and without what follows
    the end of its terms, with and without the numbers of its clauses."""
    titled = [(name, f"{title}\n{text}") for name, text in LICENCES for of, titles in TITLES if of == name for title in titles]
    out = [*LICENCES, *titled]
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text().strip("\n")
        bodies = {text, re.split(r"\n[ \t]*\n", text, maxsplit=1)[1]}
        bodies |= {re.sub(r"(END OF TERMS AND CONDITIONS).*", r"\1", x, flags=re.DOTALL) for x in bodies}
        if path.stem.startswith("BSD"):
            bodies |= {re.sub(r"(?m)^[0-9]\. ", "", x) for x in bodies}
        out += [(path.stem, x) for x in sorted(bodies)]
    return tuple(out)


def list_notices() -> tuple[tuple[str, str], ...]:
    """NOTICES, the first line of the Apache header and an SPDX line for each known licence."""
    names = sorted({name for name, _ in (*list_texts(), *NOTICES)})
    return (*NOTICES, ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
            *((name, f"SPDX-License-Identifier: {name}") for name in names))


#: A copyright line: begins with a copyright mark, and names a year or a second mark.
COPYRIGHT = r"^[^\p{L}\p{N}(©]*(copyright|\(c\)|©)[^\p{L}\p{N}]*([0-9]{4}|\(c\)|©|c\)|<year>|\[year\]|yyyy)"


def canonical_line(line: Column) -> Column:
    """Canonical form of one line."""
    low = F.lower(line)
    words = F.concat(F.lit("  "), F.regexp_replace(low, r"[^\p{L}\p{N}]+", "  "), F.lit("  "))
    for variant, usual in SPELLINGS:
        # words stand between two blanks each, so neighbours do not share one
        words = F.replace(words, F.lit(f" {variant.replace(' ', '  ')} "), F.lit(f" {usual} "))
    plain = F.trim(F.regexp_replace(words, " +", " "))
    return F.when(F.rlike(low, F.lit(COPYRIGHT)), F.lit("")).otherwise(plain)


def canonical_lines(text: Column) -> Column:
    """Canonical forms of all lines of a text."""
    return F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), r"\r\n|\r|\n", -1), canonical_line)


def digest(line: Column) -> Column:
    return F.sha2(line.cast("binary"), 256)


def whole_digest(lines: Column) -> Column:
    """Digest of the canonical text that the canonical lines make."""
    return digest(F.array_join(F.filter(lines, lambda x: x != ""), " "))


def known(spark: SparkSession, texts: tuple[tuple[str, str], ...]) -> DataFrame:
    """(digest, licence) of named texts; the smallest name where texts are alike."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(text).alias("text")) for name, text in texts]))
    named = spark.range(1, numPartitions=1).select(rows.alias("r")).select("r.licence", canonical_lines(F.col("r.text")).alias("lines"))
    return named.groupBy(whole_digest(F.col("lines")).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, key: str, text: str, licences: DataFrame, notices: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``key``, digest of the canonical text, licence (null if unknown), notices (names of those
    that stand on a line of their own, sorted, comma-joined) and n_notices (such lines)."""
    rows = docs.select(docs[key].alias("_key"), F.xxhash64(docs[text].cast("string")).alias("_text"), canonical_lines(docs[text]).alias("lines"))
    # place 0: the whole text; the digest of an empty line is left out
    each = F.concat(F.array(whole_digest(F.col("lines"))), F.transform("lines", lambda x: F.when(x != "", digest(x))))
    each = rows.select("_key", "_text", F.posexplode(each).alias("at", "digest")).filter("digest is not null")
    known_ = licences.select("digest", F.lit(True).alias("whole"), "licence").unionByName(notices.select("digest", F.lit(False).alias("whole"), "licence"))
    named = each.withColumn("whole", F.col("at") == 0).join(known_, ["digest", "whole"], "left").filter("whole or licence is not null")
    notice = F.when(~F.col("whole"), F.col("licence"))
    return named.groupBy("_key", "_text").agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"), F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.array_join(F.array_sort(F.collect_set(notice)), ",").alias("notices"), F.count(notice).alias("n"), F.count_if("whole").alias("rows"),
    ).select(F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_"), "*").select(
        F.col("_key").alias(key), "digest", "licence", "notices", F.floor(F.col("n") / F.col("rows")).cast("long").alias("n_notices"))


def scan_sql() -> str:
    """The same in DuckDB's SQL, over a view ``documents``."""
    def line(x: str) -> str:
        words = f"'  ' || regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  '"
        for variant, usual in SPELLINGS:
            words = f"replace({words}, ' {variant.replace(' ', '  ')} ', ' {usual} ')"
        return f"case when regexp_matches(lower({x}), '{COPYRIGHT}') then '' else trim(regexp_replace({words}, ' +', ' ', 'g'), ' ') end"

    def lines(x: str) -> str:
        return f"list_transform(regexp_split_to_array(coalesce({x}, ''), '\\r\\n|\\r|\\n'), lambda v: {line('v')})"

    def values(texts: tuple[tuple[str, str], ...]) -> str:
        quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in texts)
        return f"select sha256(array_to_string(list_filter(lines, lambda v: v <> ''), ' ')) digest, min(licence) licence from " \
               f"(select licence, {lines('body')} lines from (values {quoted}) t(licence, body)) group by 1"

    return f"""
    with licences as ({values(LICENCES)}), notices as ({values(NOTICES)}),
    docs as (select doc_id, {lines('text')} lines from documents),
    found as (select doc_id, array_to_string(list_sort(list_distinct(list(licence))), ',') names, count(*) n
              from (select doc_id, unnest(lines) l from docs) x join notices on sha256(l) = notices.digest where l <> '' group by 1)
    select d.doc_id, sha256(array_to_string(list_filter(d.lines, lambda v: v <> ''), ' ')) as digest, licences.licence,
           coalesce(found.names, '') as notices, coalesce(found.n, 0) as n_notices
    from docs d left join licences on sha256(array_to_string(list_filter(d.lines, lambda v: v <> ''), ' ')) = licences.digest
    left join found on d.doc_id = found.doc_id
    """
