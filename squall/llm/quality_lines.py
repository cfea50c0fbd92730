"""Quality rules: cross-document line frequency per host.

Every line is normalised and hashed together with its host; distinct
documents per (host, line) are counted, lines above the limit are removed,
and a document that loses too much of its text is rejected.  The limit is a
share of the host's documents, so a verdict does not depend on the size of the
table, with a least number of documents below which a share says little.  Only built-in
functions are used.

A document contributes each of its distinct lines once, so the counts are
sums with map-side combining: a line that a third of all documents of a host
share arrives at its reducer as one partial sum per map task.  The frequent
lines go back to their documents by a plain equi-join that Spark broadcasts
when they are few and splits when a line is hot.  Document texts are never
shuffled.

Defined cases: a null text is an empty one (no words, base rules fail, not
kept); a null host is a host of its own; rows with the same ``doc_id`` count
as documents each, and each is judged on its own lines; a null ``doc_id`` is
an id like any other; lines without a word are ignored; an empty table gives
an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import BLANKS, WORD, null_safe, text_or_empty

SYMBOLS = "#*$%&|<>"
MAX_DOCS_PER_HOST, MAX_SHARE = 10, 0.05  # whichever is more
MIN_KEPT_SHARE = 0.5
MIN_WORDS = 50

_OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_line_words", "n_kept_line_words", "n_frequent_lines", "kept", "clean_text"]


def normalise_lines(text: Column) -> Column:
    """Lower case, digit runs as 0, blanks collapsed (line breaks stay)."""
    t = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    return F.regexp_replace(t, r"[ \t\x0B\f\r]+", " ")


def _line_key(host: Column, line: Column) -> Column:
    return F.xxhash64(host, F.trim(line))


def line_structs(host: Column, text: Column) -> Column:
    """Array of (key, words) of the distinct normalised lines with a word."""
    lines = F.transform(F.split(normalise_lines(text), "\n", -1), lambda x: F.trim(x))
    lines = F.array_distinct(F.filter(lines, lambda x: x != ""))
    return F.transform(lines, lambda x: F.struct(
        F.xxhash64(host, x).alias("key"), F.size(F.split(x, " ")).alias("w")))


def base_metrics(docs: DataFrame, text: str) -> DataFrame:
    """Adds the per-text counts; reads nothing but ``text``."""
    t = F.col(text)
    # a window is its three words' hash and its place; sorting brings equal
    # windows together, so a repeated one has an equal neighbour
    win = lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2))
    df = (docs.withColumn("__words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
          .withColumn("n_words", F.size("__words").cast("long"))
          .withColumn("__hash", F.when(F.size("__words") >= 4, F.slice(
              F.transform("__words", win), F.lit(1), F.size("__words") - 2))))
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__hash")) < F.size("__hash"),
        F.sort_array(F.transform("__hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("__at", F.sort_array(F.transform(F.filter(
        "__sorted",
        lambda x, k: (x["h"] == F.get("__sorted", k - 1)["h"]) | (x["h"] == F.get("__sorted", k + 1)["h"])),
        lambda x: x["i"])))
    covered = F.aggregate(
        "__at", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])
    worded = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    return (df
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .withColumn("word_chars", F.length(F.translate(t, BLANKS, "")).cast("long"))
            .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
            .withColumn("__lines", worded)
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
            .drop("__words", "__hash", "__sorted", "__at", "__lines"))


def frequent_lines(docs: DataFrame, limit: int, share: float, *, doc_id: str, text: str, host: str) -> DataFrame:
    """(key) of the (host, line) pairs in more than ``limit`` documents and
    more than ``share`` of the host's."""
    at = F.xxhash64(F.struct(host)).alias("at")
    keys = docs.select(at, F.explode(line_structs(F.col(host), text_or_empty(text))["key"]).alias("key"))
    many = keys.groupBy("key", "at").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > limit)
    hosts = docs.groupBy(at).agg(F.count(F.lit(1)).alias("n_host"))
    return many.join(hosts, "at").filter(F.col("n_docs") > share * F.col("n_host")).select("key")


def line_frequency_rules(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                         host: str = "source", max_docs_per_host: int = MAX_DOCS_PER_HOST, max_share: float = MAX_SHARE,
                         min_kept_share: float = MIN_KEPT_SHARE,
                         min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` plus the base counts, the line verdict and
    ``clean_text`` (the text without its frequent lines).

    ``kept`` is false when the base rules fail or when less than
    ``min_kept_share`` of the words in distinct lines survive.
    """
    rest = [c for c in docs.columns if c not in _OUT]
    own = docs.select(*rest)
    over = frequent_lines(docs, max_docs_per_host, max_share, doc_id=doc_id, text=text, host=host)
    rows = docs.select(F.col(doc_id).alias("__id"), F.explode(
        line_structs(F.col(host), text_or_empty(text))["key"]).alias("key"))
    hits = (rows.join(over.select("key"), "key").groupBy("__id")
            .agg(F.collect_set("key").alias("__over")))
    base = base_metrics(
        own.withColumn("__text", text_or_empty(text))
        .withColumn("__keys", line_structs(F.col(host), F.col("__text"))), "__text")
    df = (base.join(hits, null_safe(base[doc_id], hits["__id"]), "left").drop("__id")
          .withColumn("__over", F.coalesce("__over", F.array().cast("array<bigint>"))))
    words = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["w"])
    left = F.filter("__keys", lambda x: ~F.array_contains("__over", x["key"]))
    clean = F.array_join(F.filter(
        F.split("__text", "\n", -1),
        lambda x: ~F.array_contains("__over", _line_key(F.col(host), normalise_lines(x)))), "\n")
    df = (df.withColumn("n_line_words", words(F.col("__keys")))
          .withColumn("n_kept_line_words", words(left))
          .withColumn("n_frequent_lines", (F.size("__keys") - F.size(left)).cast("long"))
          .withColumn("base_failed", (F.col("n_words") < min_words)
                      | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
          .withColumn("kept", ~F.col("base_failed")
                      & (F.col("n_kept_line_words") >= min_kept_share * F.col("n_line_words")))
          .withColumn("clean_text", clean))
    return df.select(*rest, *_OUT)


# lower() and the blanks are the same in both engines; the key is the pair itself
SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i+1], ws[i+2]) AS n FROM pos),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM
        (SELECT doc_id, unnest([i, i+1, i+2]) AS j FROM win WHERE n > 1) GROUP BY 1),
ln AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM ln
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
nl AS (SELECT DISTINCT doc_id, source, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'),
        '[ \t\x0B\f\r]+', ' ', 'g')) AS l FROM ln),
nw AS (SELECT *, len(string_split(l, ' ')) AS w FROM nl WHERE l <> ''),
hs AS (SELECT source AS host, count(*) AS n_host FROM documents GROUP BY 1),
fr AS (SELECT nw.*, n > {MAX_DOCS_PER_HOST} AND n > CAST({MAX_SHARE} AS DOUBLE) * n_host AS often
       FROM (SELECT *, count(*) OVER (PARTITION BY source, l) AS n FROM nw) nw JOIN hs ON source IS NOT DISTINCT FROM host),
ag AS (SELECT doc_id, sum(w)::BIGINT AS n_line_words,
       coalesce(sum(w) FILTER (NOT often), 0)::BIGINT AS n_kept_line_words,
       count(*) FILTER (often) AS n_frequent_lines FROM fr GROUP BY 1),
b AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
      length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      coalesce(n_line_words, 0)::BIGINT AS n_line_words,
      coalesce(n_kept_line_words, 0)::BIGINT AS n_kept_line_words,
      coalesce(n_frequent_lines, 0)::BIGINT AS n_frequent_lines
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN ag USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
    AND n_kept_line_words >= {MIN_KEPT_SHARE} * n_line_words AS kept,
  n_line_words, n_kept_line_words, n_frequent_lines
FROM b
"""
