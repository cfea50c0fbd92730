"""Line dedup: distinct-site spread.

Each normalised line (lower case, blanks collapsed) is hashed; HyperLogLog
sketches of the sites it occurs on are merged by aggregation, and lines whose
estimate lies near the limit get an exact distinct count.  Lines on
``min_sites`` sites or more are cross-site boilerplate: every occurrence goes
except the one in the document with the smallest id, so no content is lost
altogether.  With ``fold_digits`` every run of digits counts as 0 as well: lines that differ only in their numbers are then one
line, and those of other documents than the first are lost.

The sketches merge map-side, so a line that a third of all documents share
reaches its reducer as one small sketch per map task.  Only lines that may be
boilerplate go on: they meet their occurrences in an equi-join (broadcast by
Spark when few, split when hot).

Defined cases: a null text is empty; a null site counts as one site of its
own; a null ``doc_id`` is larger than every id; rows with the same ``doc_id``
count as one document when the first is chosen (all its rows keep the line);
lines without a word stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import BLANKS, cut_lineage, null_safe, text_or_empty
from squall.llm.quality_lines import normalise_lines

MIN_SITES = 12
LG_K = 12

_OUT = ["n_lines", "n_removed_lines", "kept_text"]


def _normalised(text: Column, fold_digits: bool) -> Column:
    return normalise_lines(text) if fold_digits else F.regexp_replace(F.lower(text), r"[ \t\x0B\f\r]+", " ")


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _keys(text: Column, fold_digits: bool) -> Column:
    # transform would hand F.trim the line's number as the characters to trim
    lines = F.transform(F.split(_normalised(text, fold_digits), "\n", -1), lambda x: F.trim(x))
    return F.transform(F.array_distinct(F.filter(lines, lambda x: x != "")), lambda x: F.xxhash64(x))


def boilerplate_lines(docs: DataFrame, *, doc_id: str, text: str, site: str, min_sites: int,
                      lg_k: int = LG_K, fold_digits: bool = False) -> DataFrame:
    """(key, doc_id) of every occurrence of a boilerplate line beyond its
    first document."""
    # the site's hash stands for it: sketches take longs, null has its own
    rows = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(F.struct(site)).alias("site"),
                       F.explode(_keys(text_or_empty(text), fold_digits)).alias("key"))
    # no estimate is off by more than six standard errors of its sketch
    slack = math.ceil(6 * 1.04 / math.sqrt(2 ** lg_k) * min_sites)
    spread = (rows.groupBy("key")
              .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"),
                   F.min("__id").alias("first_id"))
              .filter(F.col("sites") >= min_sites - slack))
    spread = cut_lineage(spread)
    near = spread.filter(F.col("sites") <= min_sites + slack).select("key")
    exact = (rows.select("key", "site").join(near, "key").groupBy("key", "site").agg(F.lit(1).alias("one"))
             .groupBy("key").agg(F.count("one").alias("exact")))
    wide = (spread.join(exact, "key", "left")
            .filter(F.coalesce("exact", "sites") >= min_sites).select("key", "first_id"))
    return (rows.select("__id", "key").join(wide, "key")
            .filter(~null_safe(F.col("__id"), F.col("first_id"))).select("__id", "key"))


def line_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", site: str = "source",
               min_sites: int = MIN_SITES, lg_k: int = LG_K, fold_digits: bool = False) -> DataFrame:
    """All columns of ``docs`` plus ``n_lines`` (lines with a word),
    ``n_removed_lines`` and ``kept_text``."""
    rest = [c for c in docs.columns if c not in _OUT]
    gone = (boilerplate_lines(docs, doc_id=doc_id, text=text, site=site, min_sites=min_sites, lg_k=lg_k,
                              fold_digits=fold_digits)
            .groupBy("__id").agg(F.collect_set("key").alias("__gone")))
    df = docs.select(*rest, F.col(doc_id).alias("__doc"))
    df = df.join(gone, null_safe(df["__doc"], gone["__id"]), "left")
    lines = F.split(text_or_empty(text), "\n", -1)
    worded = lambda x: F.translate(x, BLANKS, "") != ""
    kept = F.when(F.col("__gone").isNull(), lines).otherwise(F.filter(lines, lambda x: ~(
        worded(x) & F.array_contains("__gone", _key(_normalised(x, fold_digits))))))
    df = df.withColumn("__kept", kept)
    return (df.withColumn("n_lines", F.size(F.filter(lines, worded)).cast("long"))
            .withColumn("n_removed_lines", (F.size(lines) - F.size("__kept")).cast("long"))
            .withColumn("kept_text", F.array_join("__kept", "\n"))
            .select(*rest, *_OUT))


SQL = rf"""
WITH l AS (SELECT doc_id, source, i, ls[i] AS line,
    trim(regexp_replace(lower(ls[i]), '[ \t\x0B\f\r]+', ' ', 'g')) AS k
  FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
s AS (SELECT k, min(doc_id) AS first_id, count(DISTINCT coalesce(source, chr(0))) AS n FROM l WHERE k <> '' GROUP BY 1),
j AS (SELECT l.*, coalesce(n >= {MIN_SITES} AND l.doc_id <> first_id, false) AS gone FROM l LEFT JOIN s USING (k))
SELECT doc_id, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_removed_lines,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
