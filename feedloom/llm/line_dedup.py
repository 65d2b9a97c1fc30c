"""Op 2: site-relative line de-duplication, in DataFrame functions only.

A page is a distinct text of a host (a column): a group of exact copies is one page, so that it makes none of its own
lines boilerplate. Near copies are pages of their own. For each (host, line) the pages that contain the line are counted
once each. A line is boilerplate of its host, and is dropped from the host's pages, if the share of the *other* pages that
have it too is above ``ratio``: (pages with the line - 1) / (pages of the host - 1). A page is thus no evidence against its own
lines, and one rule holds for hosts of every size. Lines are compared without the blanks around them (as 128-bit digests);
blank lines are never dropped.

Scale: each page's lines are made distinct in its own row, copies are combined by 128-bit text digest (only
line digests move with it, never the text), and counts are combined before the shuffle, so a host with a third of all pages is
spread over its lines. A host has at most about (mean distinct lines of its pages / ratio) boilerplate lines, so each host's set is
small whatever its size. The sets are written to the shared folder; Spark sees their size there and broadcasts them only
under its threshold, else it joins by host and splits a skewed host at run time (pages are the streamed side).

Null text stays null (a host's null texts count as one page); null hosts are one host; a page that loses all lines keeps
an empty text; a host of one page loses none. Repeated rows count once and are all cut. Very long texts are cut whole, in one
row's expressions, at a few times their size in memory. Empty tables give empty results; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import col, others, stored, table

RATIO = 0.05
FIELDS = ["text", "dropped_lines"]


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(" \t\r")).cast("binary")))


def boilerplate(pages: DataFrame, ratio: float) -> DataFrame:
    """Rows (host, lines): the digests of each host's boilerplate lines. ``pages`` has host and text."""
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\r")) != ""), line_key))
    page = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))), F.col("text").isNull()
    pages = pages.select("host", keys.alias("keys"), F.struct(*page).alias("page"))
    per_host = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("total"))
    once = pages.groupBy("host", "page").agg(F.first("keys").alias("keys"))
    counts = once.select("host", F.explode("keys").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter("n > 1")
    found = counts.join(per_host, counts["host"].eqNullSafe(per_host["host"])).filter(F.col("n") - 1 > F.lit(ratio) * (F.col("total") - 1))
    return found.groupBy(counts["host"]).agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(df: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO) -> DataFrame:
    """Replace ``text`` by the text without its host's boilerplate lines; add ``dropped_lines``."""
    sets = stored(boilerplate(df.select(col(host).alias("host"), col(text).alias("text")), ratio), "boilerplate")
    sets = sets.select(F.col("host").alias("of_host"), "lines")
    rows = df.select(F.struct("*").alias("row"), col(host).alias("host"), col(text).alias("text"))
    joined = rows.join(sets, F.col("host").eqNullSafe(F.col("of_host")), "left")
    split = F.split("text", "\n")
    kept = F.filter(split, lambda x: ~F.array_contains("lines", line_key(x)))
    cut = joined.withColumn("kept", F.when(F.col("lines").isNull(), split).otherwise(kept))
    gone = F.coalesce(F.size(split) - F.size("kept"), F.lit(0)).cast("long")
    return cut.select(
        *[F.array_join("kept", "\n").alias(c) if c == text else F.col("row")[c].alias(c)
          for c in df.columns if c.lower() != "dropped_lines"],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(gone).cast("long").alias("dropped_lines"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs).select("doc_id", "text", "dropped_lines")


ORACLE = f"""
    WITH page AS (SELECT DISTINCT source, text FROM documents),
    line AS (SELECT source, text, trim(l, E' \\t\\r') AS line
             FROM (SELECT source, text, unnest(string_split(text, E'\\n')) AS l FROM page) WHERE trim(l, E' \\t\\r') <> ''),
    had AS (SELECT source, line, count(DISTINCT text) AS n FROM line GROUP BY source, line),
    total AS (SELECT source, count(*) AS total FROM page GROUP BY source),
    bad AS (SELECT had.source, line FROM had JOIN total ON had.source IS NOT DISTINCT FROM total.source
            WHERE n - 1 > {RATIO}::DOUBLE * (total - 1)),
    sets AS (SELECT source, list(line) AS lines FROM bad GROUP BY source),
    cut AS (SELECT doc_id, text, string_split(text, E'\\n') AS all_lines, coalesce(lines, []) AS lines
            FROM documents LEFT JOIN sets ON documents.source IS NOT DISTINCT FROM sets.source),
    kept AS (SELECT *, list_filter(all_lines, lambda x: NOT list_contains(lines, trim(x, E' \\t\\r'))) AS k FROM cut)
    SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(k, E'\\n'), '') END AS text,
           coalesce(len(all_lines) - len(k), 0)::BIGINT AS dropped_lines FROM kept"""


def stage_line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their source's boilerplate lines; ``n_chars`` follows the text."""
    out = drop_boilerplate(docs.drop("dropped_lines")).drop("dropped_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return out.select(*others(docs, []))
