"""Line dedup by site-relative frequency.

A line of visible text is boilerplate of a host if more than a ratio of the
host's pages hold it. Such lines are dropped from that host's pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Lines on more than this share of a host's pages go.
RATIO = 0.5
#: A line on a single page is no repetition: a host's only page keeps its lines.
LEAST_PAGES = 2

# Patterns over HTML, the same in both SQL dialects.
HIDDEN = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
TAG = r"(?s)<[^>]*>"
BLOCKS = r"[ \t\r\f]*\n[ \t\r\n\f]*"


def host_of(url: Column) -> Column:
    """The lower-cased host of an address, '' if it has none or is null."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)), F.lit(""))


def visible_lines(html: Column) -> Column:
    """Lines of visible text: what stands between tags, trimmed, without empty ones."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), TAG, "\n")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(F.regexp_replace(plain, BLOCKS, "\n"), "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, n_lines, n_dropped, text: one row for each row of ``pages``.

    Null or unparsable addresses share the host ''. A null or empty page has no
    lines and the text ''. A line that a page repeats counts once for the page;
    all its places go. Equal rows are pages of their own and count as such. With
    ``least`` 1 the ratio alone decides, and a host of one page loses all lines.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), visible_lines(F.col(html_col)).alias("lines"))
    # pages that agree in all of this lose the same lines
    own = written(rows.withColumn("page", F.md5(F.concat_ws("\n", F.col("host"), F.array_join("lines", "\n")))), "lines")
    # written, so that the joins are free to split a host, or a page with many copies
    totals = written(own.groupBy("host").agg(F.count("*").alias("n_pages")), "totals")
    # a page gives each of its lines once: counts come together before the shuffle
    counts = own.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    common = written(counts.join(totals, "host").filter(F.col("n") > ratio * F.col("n_pages")).select("host", "line"), "common")
    # of each page only its boilerplate travels
    hits = own.select("page", "host", F.explode(F.array_distinct("lines")).alias("line")).join(common, ["host", "line"]).groupBy("page").agg(F.collect_set("line").alias("drop"))
    hits = written(hits, "hits")
    joined = own.join(hits, "page", "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("drop"), x)))
    return joined.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(kept)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("text"))
