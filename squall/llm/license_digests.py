"""License scans: canonical digest lookup.

Known licence texts and every scanned text are brought to one canonical form
(case, punctuation and blanks, copyright lines, equivalent spellings) and
digested; entire texts are then hash-joined to the known digests.  Three kinds
of entire text are looked up: the document, each of its paragraphs and each of
its lines, so a licence file, an embedded licence block and a one-line notice
are all found.  Only built-in functions are used.

The known digests are a bounded table (``max_known`` rows, checked), so they
are broadcast; unmatched units never leave their task, and only matches are
grouped by document.

Defined cases: a null text is empty and matches nothing; empty units match
nothing; rows with the same ``doc_id`` share one result row per input row (each row
gets the matches of its own text); a null ``doc_id`` is kept as null; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm.common import text_or_empty

# Spellings that licence matching treats as equal.
EQUIVALENT = [
    ("acknowledgment", "acknowledgement"), ("analog", "analogue"), ("analyze", "analyse"),
    ("artifact", "artefact"), ("authorization", "authorisation"), ("authorized", "authorised"),
    ("caliber", "calibre"), ("canceled", "cancelled"), ("capitalizations", "capitalisations"),
    ("catalog", "catalogue"), ("categorize", "categorise"), ("center", "centre"),
    ("emphasized", "emphasised"), ("favor", "favour"), ("favorite", "favourite"),
    ("fulfill", "fulfil"), ("fulfillment", "fulfilment"), ("initialize", "initialise"),
    ("judgment", "judgement"), ("labeling", "labelling"), ("labor", "labour"),
    ("license", "licence"), ("licensed", "licenced"), ("licenses", "licences"),
    ("maximize", "maximise"), ("modeled", "modelled"), ("modeling", "modelling"),
    ("noncommercial", "non commercial"), ("offense", "offence"), ("optimize", "optimise"),
    ("organization", "organisation"), ("organize", "organise"), ("practice", "practise"),
    ("program", "programme"), ("realize", "realise"), ("recognize", "recognise"),
    ("signaling", "signalling"), ("sublicense", "sub license"), ("sublicense", "sublicence"),
    ("utilization", "utilisation"), ("while", "whilst"), ("percent", "per cent"),
    ("copyright owner", "copyright holder"), ("gnu gpl", "gnu general public license"),
    ("cc by nc", "creative commons attribution noncommercial"),
]

# words stand between blanks of their own, so neighbours never share one
_PAIRS = [tuple(f" {x.replace(' ', '  ')} " for x in pair) for pair in EQUIVALENT]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_ZERO_BSD = _ISC.replace(""", provided that the above
copyright notice and this permission notice appear in all copies.""", ".")

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

# Licence id and entire text.  Short notices are entire texts of
# their own lines.  A caller passes a table of its own for more.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _ZERO_BSD),
    ("Apache-2.0", _APACHE_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
]
MAX_KNOWN = 20_000

# copyright lines say who holds the rights, not which licence
_COPYRIGHT = (r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t:]*(\(c\)|©|[0-9]{4}|[<\[{])|\(c\)[ \t]|©"
              r"|all rights reserved)[^\n]*$")


def canonical(text: Column) -> Column:
    """Lower case without copyright lines, every word between two blanks,
    equivalent spellings made one; line breaks are kept."""
    t = F.regexp_replace(F.lower(text), _COPYRIGHT, "")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", "  ")
    t = F.replace(t, F.lit("\n"), F.lit(" \n "))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for to, frm in _PAIRS:
        t = F.replace(t, F.lit(frm), F.lit(to))
    return t


def digest(unit: Column) -> Column:
    """Digest of one canonical unit, whose line breaks count as blanks."""
    return F.sha2(F.trim(F.regexp_replace(unit, r"[ \n]+", " ")), 256)


def _units(text: Column) -> Column:
    """Distinct (kind, digest) of the document, its paragraphs and lines."""
    def digests(parts: Column) -> Column:
        parts = F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"[ \n]+", " ")))
        return F.transform(F.array_distinct(F.filter(parts, lambda x: x != "")), lambda x: F.sha2(x, 256))
    # a paragraph ends at a blank line; with one paragraph or one line the
    # unit is the larger one as well, so it is looked up once more only there
    paragraphs = F.split(text, r"\n[ \n]*\n")
    return F.concat(
        F.transform(digests(F.array(text)), lambda x: F.struct(F.lit("text").alias("kind"), x.alias("digest"))),
        F.transform(digests(paragraphs), lambda x: F.struct(F.lit("paragraph").alias("kind"), x.alias("digest"))),
        F.transform(digests(F.split(text, "\n")), lambda x: F.struct(F.lit("line").alias("kind"), x.alias("digest"))))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None,
                  max_known: int = MAX_KNOWN) -> DataFrame:
    """(license_id, digest), one row each, from (id, entire text) pairs."""
    known = KNOWN if known is None else known
    if len(known) > max_known:
        raise ValueError(f"{len(known)} known texts; the broadcast table holds {max_known}")
    df = spark.createDataFrame(known, "license_id string, body string")
    return (df.select("license_id", digest(canonical(F.coalesce("body", F.lit("")))).alias("digest"))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def license_scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 known: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``whole_license`` (null if the
    entire document is no known text), ``licenses`` (sorted ids found in any
    unit), ``n_paragraph_hits`` and ``n_line_hits`` (distinct texts)."""
    table = F.broadcast(known_digests(docs.sparkSession, known))
    # the raw text's hash leads matches back to their row, so the canonical form is made once
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("__t"),
                       F.xxhash64(text_or_empty(text)).alias("__h"))
    found = (rows.select("doc_id", "__h", canonical(F.col("__t")).alias("__c"))
             .select("doc_id", "__h", F.explode(_units(F.col("__c"))).alias("u"))
             .select("doc_id", "__h", "u.*").join(table, "digest")
             .groupBy("doc_id", "__h")
             .agg(F.min(F.when(F.col("kind") == "text", F.col("license_id"))).alias("whole_license"),
                  F.sort_array(F.collect_set("license_id")).alias("licenses"),
                  F.count_distinct(F.when(F.col("kind") == "paragraph", F.col("digest"))).alias("n_paragraph_hits"),
                  F.count_distinct(F.when(F.col("kind") == "line", F.col("digest"))).alias("n_line_hits")))
    a, b = rows.select("doc_id", "__h").alias("a"), found.alias("b")
    zero = F.lit(0).cast("long")
    return (a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.__h") == F.col("b.__h")), "left")
            .select("a.doc_id", "whole_license",
                    F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
                    F.coalesce("n_paragraph_hits", zero).alias("n_paragraph_hits"),
                    F.coalesce("n_line_hits", zero).alias("n_line_hits")))


def _sql_canonical(text: str) -> str:
    t = f"regexp_replace(lower({text}), '{_COPYRIGHT}', '', 'g')"
    t = rf"regexp_replace({t}, '[^\p{{L}}\p{{N}}\n]+', '  ', 'g')"
    t = f"' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' '"
    for to, frm in _PAIRS:
        t = f"replace({t}, '{frm}', '{to}')"
    return t


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql(known: list[tuple[str, str]] = KNOWN) -> str:
    flat = lambda x: rf"trim(regexp_replace({x}, '[ \n]+', ' ', 'g'))"
    rows = ", ".join(f"({_quoted(i)}, {_quoted(b)})" for i, b in known)
    return rf"""
WITH k AS (SELECT sha256({flat("c")}) AS digest, min(id) AS license_id
           FROM (SELECT id, {_sql_canonical("body")} AS c FROM (VALUES {rows}) v(id, body)) GROUP BY 1),
c AS (SELECT doc_id, {_sql_canonical("coalesce(text, '')")} AS c FROM documents),
u AS (SELECT doc_id, 'text' AS kind, c AS x FROM c
      UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(c, '\n[ \n]*\n')) FROM c
      UNION ALL SELECT doc_id, 'line', unnest(string_split(c, chr(10))) FROM c),
h AS (SELECT doc_id, kind, digest, license_id FROM
      (SELECT DISTINCT doc_id, kind, sha256({flat("x")}) AS digest FROM u WHERE {flat("x")} <> '') JOIN k USING (digest))
SELECT d.doc_id, min(license_id) FILTER (kind = 'text') AS whole_license,
  coalesce(list_sort(list(DISTINCT license_id) FILTER (license_id IS NOT NULL)), []) AS licenses,
  count(*) FILTER (kind = 'paragraph') AS n_paragraph_hits,
  count(*) FILTER (kind = 'line') AS n_line_hits
FROM documents d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id
"""
