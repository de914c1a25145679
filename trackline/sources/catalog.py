"""Archive catalog: parse crawled index pages into years, archive files, sizes, URLs.

Input is a table of pages (``page_id``, ``url``, ``html``); the crawl itself
(HTTP) is not part of this library.  A tag scanner (``mapInArrow``) finds the
links of every whole page as a browser would: attributes in any order and
quoting, entities undone, comments and scripts skipped, and the address
resolved against the page's own.  Names are classified with native functions.
Listing order is (month, day) with missing parts as 0, then file name and
page id as tie-breaks; ordered picks use ``orderBy().offset().limit()``
(a bounded top-k), never a global row number.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name and size patterns.
YEAR_PATTERN = r"^([0-9]{4})/?$"
DAILY_PATTERN = r"^AIS_([0-9]{4})_([0-9]{2})_([0-9]{2})[.]zip$"
ZONE_PATTERN = r"^AIS_([0-9]{4})_Zone([0-9]{2})_([0-9]{2})[.]zip$"
REGIONAL_PATTERN = r"^AIS_([0-9]{4})_([A-Za-z0-9_]+)[.]zip$"
UNIT_BYTES = {"K": 1024, "M": 1024 ** 2, "G": 1024 ** 3, "T": 1024 ** 4}
DEFAULT_ZONE = "01_01"
DEFAULT_BASE_URL = "https://archive.example/ais/"


# Comments, elements whose content is no markup, and tags; possessive, so that no page makes the scan go back.
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b[^>]*+>.*?(?:</\1\s*>|\Z)|"""
                     r"""<(/?[a-z][^\s/>]*+)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)>""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
# A size follows its link at once, or in the next cell.
_SIZE = re.compile(r"""(?:\s|</?(?:td|th|span|font|tt|b|i)\b[^>]*+>)*+([0-9]++(?:[.][0-9]++)?)[ \t]*+([KMGT])B?""", re.I)


def page_links(html: str) -> Iterator[tuple[str, str | None, str | None]]:
    """(href, size, unit) of the links of a page, in order."""
    href = None
    for tag in _MARKUP.finditer(html):
        name = (tag.group(2) or "").lower()
        if name not in ("a", "/a"):
            continue
        if href is not None:  # the end of the link before
            size = _SIZE.match(html, tag.end()) if name == "/a" else None
            yield (href, size.group(1), size.group(2).upper()) if size else (href, None, None)
            href = None
        if name == "a":
            for key, *values in _ATTRIBUTE.findall(tag.group(3)):
                if key.lower() == "href":
                    href = entities.unescape(next((v for v in values if v), "")).strip()
                    break
    if href is not None:
        yield href, None, None


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            for href, value, unit in page_links(html or ""):
                try:
                    full = urljoin(url or "", href)
                    name = urlsplit(href).path
                except ValueError:  # no address, such as an unclosed IPv6 host
                    full, name = None, href
                size = None if value is None else int(float(value) * UNIT_BYTES[unit])
                rows.append((page, href, name.rstrip("/").rsplit("/", 1)[-1] + "/" * name.endswith("/"), full,
                             None if value is None else value + unit, size if size is None or size < 2 ** 63 else None))
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["page_id", "href", "filename", "url", "size_text", "size_bytes"])


def links(pages: DataFrame) -> DataFrame:
    """One row per link: page_id, href, filename (last part of its path), url, size text (may be NULL), size in bytes."""
    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return columns.mapInArrow(_links, "page_id long, href string, filename string, url string, size_text string, size_bytes long")


def index_years(pages: DataFrame) -> DataFrame:
    """Year folders linked from the pages (``2024/``), newest first, with the number of pages."""
    years = links(pages).where(F.col("filename").rlike(YEAR_PATTERN)).select(
        "page_id", F.regexp_extract("filename", YEAR_PATTERN, 1).alias("year"))
    return (years.groupBy("year").agg(F.count_distinct("page_id").alias("pages"))
            .orderBy(F.col("year").desc()))


def classify(name: Column) -> dict[str, Column]:
    """Archive type and fields from a file name; type NULL when no pattern matches."""
    daily, zone, regional = name.rlike(DAILY_PATTERN), name.rlike(ZONE_PATTERN), name.rlike(REGIONAL_PATTERN)
    typ = F.when(daily, "daily").when(zone, "zone").when(regional, "regional")
    return {
        "type": typ,
        "year": F.when(daily, F.regexp_extract(name, DAILY_PATTERN, 1))
                 .when(zone, F.regexp_extract(name, ZONE_PATTERN, 1))
                 .when(regional, F.regexp_extract(name, REGIONAL_PATTERN, 1)),
        "month": F.when(daily, F.regexp_extract(name, DAILY_PATTERN, 2).cast("int")),
        "day": F.when(daily, F.regexp_extract(name, DAILY_PATTERN, 3).cast("int")),
        "zone": F.when(zone, F.regexp_extract(name, ZONE_PATTERN, 2)),
        "sequence": F.when(zone, F.regexp_extract(name, ZONE_PATTERN, 3)),
        "region": F.when(regional & ~daily & ~zone, F.regexp_extract(name, REGIONAL_PATTERN, 2)),
    }


def archive_names(names: DataFrame, column: str = "filename") -> DataFrame:
    """Classify archive names: ``daily`` (Y_M_D), ``zone`` (Y_ZoneNN_SS), ``regional`` (Y_NAME); others dropped."""
    parts = classify(F.col(column))
    return names.select("*", *[c.alias(k) for k, c in parts.items()]).where(F.col("type").isNotNull())


def index_files(pages: DataFrame) -> DataFrame:
    """Archive links (``*.zip`` containing ``AIS``) with type, date/zone/region, size and the URL they lead to."""
    ls = links(pages).where(F.col("filename").endswith(".zip") & F.col("filename").contains("AIS"))
    return archive_names(ls).select(
        "page_id", "filename", "type", "year", "month", "day", "zone", "sequence", "region",
        "size_text", "size_bytes", "url",
    )


def listing_order() -> list[Column]:
    return [F.coalesce(F.col("month"), F.lit(0)).asc(), F.coalesce(F.col("day"), F.lit(0)).asc(),
            F.col("filename").asc(), F.col("page_id").asc()]


def size_to_bytes(pages: DataFrame) -> DataFrame:
    """Every link that carries a size, with the size in bytes (K/M/G/T = 1024^n)."""
    return links(pages).where(F.col("size_text").isNotNull()).select("page_id", "href", "size_text", "size_bytes")


def _fmt1(x: Column, unit: str) -> Column:
    """``x`` with one decimal (half-up) and a unit, e.g. ``12.5 MB``."""
    return F.concat(F.round(x.try_cast("decimal(38,12)"), 1).cast("decimal(38,1)").cast("string"), F.lit(f" {unit}"))


def pretty_size(size: Column) -> Column:
    """GB above 1 GiB, MB above 1 MiB, KB otherwise; ``unknown`` when missing or 0."""
    s = size.cast("double")
    return (F.when(size.isNull() | (size == 0), F.lit("unknown"))
            .when(s > 1024.0 ** 3, _fmt1(s / F.lit(1024.0 ** 3), "GB"))
            .when(s > 1024.0 ** 2, _fmt1(s / F.lit(1024.0 ** 2), "MB"))
            .otherwise(_fmt1(s / F.lit(1024.0), "KB")))


def details(typ: Column | None = None) -> Column:
    typ = F.col("type") if typ is None else typ
    return (F.when(typ == "daily", F.concat(F.lit("Date: "), F.col("year"), F.lit("-"),
                                            F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("-"),
                                            F.lpad(F.col("day").cast("string"), 2, "0")))
            .when(typ == "zone", F.concat(F.lit("Zone: "), F.col("zone"), F.lit(", Sequence: "), F.col("sequence")))
            .when(typ == "regional", F.concat(F.lit("Region: "), F.col("region"))))


def pretty_total(size: Column) -> Column:
    """Total of a listing: GB above 1 GiB, else MB."""
    s = size.cast("double")
    return F.when(s > 1024.0 ** 3, _fmt1(s / F.lit(1024.0 ** 3), "GB")).otherwise(_fmt1(s / F.lit(1024.0 ** 2), "MB"))


def archive_listing(files: DataFrame, max_files: int = 5) -> DataFrame:
    """The first ``max_files`` archives in listing order, with display size and details.

    Each row also carries the listing's footer: the number of archives not
    shown, and the total of the known sizes of the shown ones (bytes and
    display text) -- scalar subqueries over the full list and the shown rows.
    """
    first = files.orderBy(*listing_order()).limit(max_files)
    n_all = files.agg(F.count(F.lit(1))).scalar()
    shown_bytes = first.agg(F.sum(F.when(F.col("size_bytes") > 0, F.col("size_bytes")))).scalar()
    return first.select(
        "page_id", "filename", "type", pretty_size(F.col("size_bytes")).alias("size_display"),
        details().alias("details"), "size_bytes",
        F.greatest(n_all - F.lit(max_files), F.lit(0)).alias("more_files"),
        F.coalesce(shown_bytes, F.lit(0)).alias("listed_known_bytes"),
        F.when(shown_bytes > 0, pretty_total(shown_bytes)).alias("listed_total_display"),
    )


def archive_select(files: DataFrame, position: int | None = None, pattern: str | None = None) -> DataFrame:
    """Archives picked by 1-based listing position and/or by a name substring."""
    picks = []
    if position is not None:
        if position < 1:
            raise ValueError("position is 1-based")
        picks.append(files.orderBy(*listing_order()).offset(position - 1).limit(1)
                     .withColumn("selected_by", F.lit(f"position {position}")))
    if pattern is not None:
        picks.append(files.where(F.col("filename").contains(pattern))
                     .withColumn("selected_by", F.lit(f"pattern {pattern}")))
    if not picks:
        raise ValueError("give a position or a pattern")
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    return out


def archive_urls(requests: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """URL per (year, zone) request; a missing zone means the default ``01_01``."""
    zone = F.coalesce(F.col("zone"), F.lit(DEFAULT_ZONE))
    return requests.select("year", "zone", F.concat(F.lit(base_url), F.col("year"), F.lit("/AIS_"), F.col("year"),
                                                   F.lit("_"), zone, F.lit(".zip")).alias("url"))
