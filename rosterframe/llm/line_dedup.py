"""Line dedup by site-relative frequency.

A line that stands on more than ``max_ratio`` of a site's pages is boilerplate of
that site and is dropped from its pages.  Counting is one map-side combined
aggregate over (site, line digest), each page counting once.  A site with L lines a
page on average has fewer than L / max_ratio such lines, so one row per site holds
them; pages meet that row by an equi-join on the site, which Spark broadcasts when
the stored rows are small and otherwise splits for a hot site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterframe.llm.common import materialize, same

_BLANK = " \t\n\r\x0b\f"


def host_of(url: Column) -> Column:
    """Host name of a URL, lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def drop_site_lines(docs: DataFrame, max_ratio: float = 0.1, min_pages: int = 2, site_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with boilerplate lines dropped from ``text_col``, plus ``n_lines_dropped``.

    A line's digest is taken without the white space around it; blank lines are neither
    counted nor dropped.  It is dropped when its pages are more than ``max_ratio`` of
    all pages (rows) of its site and at least ``min_pages``.  The other lines keep
    their order and text.

    - Null text stays null, empty text empty; both count as pages of their site.
    - Null site: no site is known, nothing is dropped.
    - Repeated rows are pages like any other.  Empty table: no rows.
    - An input column named n_lines_dropped is replaced; no other name can clash.
    """
    site, text = docs[site_col], docs[text_col]
    lines = F.split(text, "\n", -1)
    digests = F.transform(F.filter(F.transform(lines, _stripped), lambda x: x != ""), F.md5)
    known = docs.select(site.alias("site"), F.array_distinct(digests).alias("digests")).where("site is not null")
    counts = (known.select("site", F.explode("digests").alias("digest"))
              .groupBy("site", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages))
    totals = docs.select(site.alias("site")).groupBy("site").agg(F.count("*").alias("pages"))
    frequent = (counts.join(totals, "site").where(F.col("n") > F.lit(float(max_ratio)) * F.col("pages"))
                .groupBy("site").agg(F.collect_list("digest").alias("boilerplate")))
    frequent = materialize(frequent, "boilerplate")

    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    met = docs.select(row).join(frequent, same(F.col("row")[site_col], F.col("site")), "left")
    lines = F.split(F.col("row")[text_col], "\n", -1)
    hits = F.array_intersect(F.transform(lines, lambda x: F.md5(_stripped(x))), F.col("boilerplate"))
    met = met.select("row", F.coalesce(hits, F.array().cast("array<string>")).alias("hits"))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col("hits"), F.md5(_stripped(x))))
    met = met.select("row", F.when(F.size("hits") > 0, kept).alias("kept"))
    return met.select(
        *(F.coalesce(F.array_join("kept", "\n"), F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c)
          for c in docs.columns if c.lower() != "n_lines_dropped"),
        F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).alias("n_lines_dropped"))


def oracle(max_ratio: float = 0.1, min_pages: int = 2) -> str:
    """DuckDB SQL for drop_site_lines over ``documents`` (whose doc_id is unique)."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, trim(line, {blank}) AS k FROM lines),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
boiler AS (
  SELECT k.source, k.k FROM keyed k JOIN pages p ON p.source = k.source WHERE k.k <> ''
  GROUP BY k.source, k.k, p.pages
  HAVING count(DISTINCT doc_id) >= {min_pages} AND count(DISTINCT doc_id) > CAST({max_ratio} AS DOUBLE) * p.pages),
left_over AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM boiler b WHERE b.source = k.source AND b.k = k.k) GROUP BY doc_id),
sizes AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(l.text, '') END AS text,
       CAST(coalesce(s.n, 0) - coalesce(l.n, 0) AS INTEGER) AS n_lines_dropped
FROM documents d LEFT JOIN left_over l USING (doc_id) LEFT JOIN sizes s USING (doc_id)"""
