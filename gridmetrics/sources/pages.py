"""Data-link discovery over a table of landed web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import absolutize, extract_link

CSV_LINK = r'href="([^"]+\.csv)"'


def page_data_links(pages: DataFrame, pattern: str = CSV_LINK, html_col: str = "html",
                    url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """First matching link per page (case-insensitive); site-relative links
    get the page's own scheme and host. Pages without a match are dropped."""
    link = extract_link(html_col, pattern)
    out = pages.select(F.col(id_col), F.col(url_col), link.alias("_link"))
    return (out.where(F.col("_link").isNotNull())
               .select(id_col, absolutize(F.col("_link"), F.col(url_col)).alias("data_url")))
