"""Line deduplication by site-relative frequency, in DataFrame expressions only.

A page's lines are what its block elements hold as text. For every host, the number of pages that
hold a line is divided by the number of the host's pages; lines above ``ratio`` that at least ``LEAST``
pages hold are boilerplate and leave all pages of that host, whatever their place or count in a page. The
size of the host plays no other part.

Scale: pages are read and parsed once; what is stored of them is their lines with digests. Their text is
never shuffled: (host, line digest) is counted once per page and combined before the shuffle, so neither
a host nor a line with a third of all rows is a hot group. A host's boilerplate has at most (lines per
page / ratio) entries, as each is on more than ``ratio`` of its pages; this list of one row per host is
stored and joined, by broadcast only while its file is below Spark's threshold. Lines are known by their
SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trolley.llm.common import few, stored, table

RATIO, LEAST = 0.1, 2

# The same patterns serve both engines of the SQL check, so they use only what RE2 knows.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
HIDDEN = r"(?is)<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|<!--.*?-->"
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
TAG, BLANK, BREAKS = r"<[^>]*>", r"[ \t\x0B\f\r]+", r" ?\n[ \n]*"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    """Lower-case host; empty for a null address or one without a host."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def lines_of(html: Column) -> Column:
    """Non-empty text lines of a page, white space collapsed; none for null."""
    text = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    text = F.trim(F.regexp_replace(F.regexp_replace(text, BLANK, " "), BREAKS, "\n"))
    return F.filter(F.split(text, "\n"), lambda line: F.length(line) > 0)


def _digest(line: Column) -> Column:
    return F.unhex(F.sha2(line, 256))


def parsed(pages: DataFrame) -> DataFrame:
    """The stored lines of every page with their digests: page_id, host, lines, digests."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
    return stored(rows.withColumn("digests", F.transform("lines", _digest)), "lines")


def boilerplate(rows: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, common): digests of the lines on more than ``ratio`` of a host's pages, and on ``least``."""
    # The page itself is counted as the null line, so one aggregation gives both numbers.
    entries = F.concat(F.array_distinct("digests"), F.array(F.lit(None).cast("binary")))
    counts = rows.select("host", F.explode(entries).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.filter((F.col("n") >= least) | F.col("line").isNull()), "line-counts")  # most lines end here
    sizes = stored(counts.filter("line is null").select("host", F.col("n").alias("pages")), "hosts")
    common = counts.filter("line is not null").join(few(sizes), "host").filter(F.col("n") > ratio * F.col("pages"))
    return stored(common.groupBy("host").agg(F.collect_list("line").alias("common")), "boilerplate")


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """One row per page: page_id, host, lines, kept (the lines that stay, in order).

    Null or empty pages have no lines; a null address belongs to the empty host, which is a group
    like any other. Repeated rows count as pages of their own. An empty table gives an empty result.
    """
    rows = parsed(pages)
    found = boilerplate(rows, ratio, least)
    kept = F.transform(F.filter(F.arrays_zip("lines", "digests"), lambda e: ~F.array_contains("common", e["digests"])), lambda e: e["lines"])
    return rows.join(found, "host", "left").select("page_id", "host", "lines", F.when(F.col("common").isNull(), F.col("lines")).otherwise(kept).alias("kept"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = drop_boilerplate(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                        F.sha2(F.concat_ws("\n", "kept"), 256).alias("kept_sha256"))


def _sql_text() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    text = f"regexp_replace(coalesce(html, ''), {quoted(HIDDEN)}, '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {quoted(BLOCK)}, chr(10), 'g'), {quoted(TAG)}, '', 'g')"
    for entity, sign in ENTITIES:
        text = f"replace({text}, {quoted(entity)}, {quoted(sign)})"
    return f"trim(regexp_replace(regexp_replace({text}, {quoted(BLANK)}, ' ', 'g'), {quoted(BREAKS)}, chr(10), 'g'))"


SQL = f"""WITH p AS (SELECT row_number() OVER () AS r, page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
    list_filter(string_split({_sql_text()}, chr(10)), lambda x: length(x) > 0) AS lines FROM pages),
  l AS (SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM p),
  h AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
  common AS (SELECT host, line FROM l JOIN h USING (host) GROUP BY host, line, pages
    HAVING count(DISTINCT r) >= {LEAST} AND count(DISTINCT r) > {RATIO} * pages),
  k AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS kept FROM l ANTI JOIN common USING (host, line) GROUP BY r)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM p LEFT JOIN k USING (r)"""
