"""Saved tracking pages: event rows from result tables and text cards from
list items, extracted with JVM-side regular expressions (no HTML parser, no
browser).  Whole page texts are processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import strip_tags, trim_ws

ROW_RE = r"(?s)<tr(?:\s[^>]*)?>(.*?)</tr>"
CELL_RE = r"(?s)<td(?:\s[^>]*)?>(.*?)</td>"
ITEM_RE = r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"
TABLE_FIELDS = ("status", "place_of_activity", "date", "time", "transport")


def event_table_pages(events: DataFrame, rows_per_page: int = 4) -> DataFrame:
    """Render carrier-H events as saved result pages: one <table> row of five
    padded cells per event (the transport cell is missing when
    ordinal % 13 = 0), `rows_per_page` consecutive events per page.  The
    per-page collect is bounded by `rows_per_page`."""
    def cell(c):
        return F.concat(F.lit("<td> "), F.coalesce(F.col(c), F.lit("")), F.lit(" </td>"))

    row = F.concat(F.lit("<tr>"), cell("status"), cell("place_of_activity"), cell("date"), cell("time"),
                   F.when(F.col("ordinal") % 13 == 0, F.lit("")).otherwise(cell("transport")), F.lit("</tr>"))
    per = events.select(F.floor(F.col("ordinal") / (2 * rows_per_page)).cast("bigint").alias("page_id"),
                        "ordinal", row.alias("row"))
    g = per.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "row"))).alias("rows"))
    html = F.concat(F.lit("<html><body><table>"),
                    F.array_join(F.transform("rows", lambda x: x["row"]), ""),
                    F.lit("</table></body></html>"))
    return g.select("page_id", html.alias("html"))


def extract_table_rows(pages: DataFrame, min_cells: int = 5) -> DataFrame:
    """Every table row with at least `min_cells` cells -> (status, place,
    date, time, transport), each cell stripped; shorter rows are dropped."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(ROW_RE), 1)).alias("row_no", "tr"))
    cells = rows.select("page_id", "row_no", F.regexp_extract_all("tr", F.lit(CELL_RE), 1).alias("cells"))
    cells = cells.filter(F.size("cells") >= min_cells)
    return cells.select("page_id", F.col("row_no").cast("bigint").alias("row_no"),
                        *[trim_ws(F.get("cells", i)).alias(n) for i, n in enumerate(TABLE_FIELDS)])


def extract_list_items(pages: DataFrame) -> DataFrame:
    """Every non-empty list item of a page -> its text (tags removed,
    stripped) and its lines, as tracking cards are read."""
    items = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(ITEM_RE), 1))
                         .alias("item_no", "li"))
    text = trim_ws(strip_tags("li"))
    out = items.select("page_id", F.col("item_no").cast("bigint").alias("item_no"), text.alias("raw_data"))
    out = out.filter(F.col("raw_data") != "")
    return out.select("page_id", "item_no", "raw_data",
                      F.size(F.split("raw_data", "\n")).cast("bigint").alias("n_parts"))
