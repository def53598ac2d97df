"""Links and embedded JSON in landed web pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_tags

ANCHOR = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']+)[\"'][^>]*>"
ASSET = r"(?i)[\"']((?:https?:)?/[^\"'\s]+\.(?:xlsx?|xlsb|zip|csv|pdf))[\"']"
YEAR_OR_LINK = r"(?is)<h[1-6][^>]*>[^<]*20\d\d[^<]*</h[1-6]>|<a\b[^>]*?href\s*=\s*[\"'][^\"']+[\"'][^>]*>.*?</a>"


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))


def assets(html: Column) -> Column:
    """Quoted addresses of files, from markup or embedded scripts."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(ASSET), F.lit(1)))


def embedded_json(html: Column, name: str) -> Column:
    """The text of a script's JSON by the element's id or the variable's name."""
    by_id = F.regexp_extract(html, rf"(?is)<script[^>]*id\s*=\s*[\"']{name}[\"'][^>]*>(.*?)</script>", 1)
    by_name = F.regexp_extract(html, rf"(?s)\b(?:const|let|var)\s+{name}\s*=\s*(\[.*?\]|\{{.*?\}})\s*;", 1)
    return F.coalesce(F.nullif(by_id, F.lit("")), F.nullif(by_name, F.lit("")))


def absolute(base: Column, link: Column) -> Column:
    """A link against its page's address, spaces in its path as %20."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]+.*/)[^/]*$|(://[^/]+)$", "$1$2")
    full = F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("/"), F.concat(origin, link)).otherwise(F.concat(F.regexp_replace(folder, "/$", ""), F.lit("/"), link))
    return F.replace(full, F.lit(" "), F.lit("%20"))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href) of every anchor."""
    return pages.select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))


def links_with_year(pages: DataFrame) -> DataFrame:
    """Anchors with their text and the year of the heading above them."""
    parts = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(YEAR_OR_LINK), F.lit(0))).alias("pos", "part"))
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    head = ~F.lower(F.substring("part", 1, 2)).eqNullSafe(F.lit("<a"))
    year = F.when(head, F.regexp_extract("part", r"(20\d\d)", 1))
    return parts.withColumn("year", F.last(year, ignorenulls=True).over(w)).where(~head).select("page_id", "pos", "year", F.regexp_extract("part", ANCHOR, 1).alias("href"), strip_tags(F.col("part")).alias("label"))


def labelled(labels: Column, urls: Column) -> Column:
    """Labels and addresses zipped by position."""
    return F.arrays_zip(labels.alias("label"), urls.alias("url"))
