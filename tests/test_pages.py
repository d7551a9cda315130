"""Saved-page extraction edge cases."""

from quayside.sources import pages as PG


def test_list_items_ignore_link_tags_and_keep_lines(spark):
    html = ('<html><head><link rel="x" href="/a"></head><body><ul>'
            '<li class="ev"><span>Port A</span>\n<b>Gate in</b>\n06 Oct 2025 20:19</li>'
            '<li>   </li><li><a href="/b">Port B</a></li></ul></body></html>')
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    rows = PG.extract_list_items(df).orderBy("item_no").collect()
    assert [(r.item_no, r.raw_data, r.n_parts) for r in rows] == [
        (0, "Port A\nGate in\n06 Oct 2025 20:19", 3), (2, "Port B", 1)]


def test_table_rows_need_five_cells_and_are_stripped(spark):
    html = ('<table><tr><td> Gate in </td><td>Busan</td><td>2024-01-05</td><td>06:00</td>'
            '<td class="t">\tEVER 1 </td></tr>'
            '<tr><td>Discharge</td><td>Busan</td><td>2024-01-06</td><td>07:00</td></tr>'
            '<tr><th>h</th></tr></table>')
    df = spark.createDataFrame([(7, html)], "page_id bigint, html string")
    rows = PG.extract_table_rows(df).collect()
    assert [(r.row_no, r.status, r.place_of_activity, r.transport) for r in rows] == [(0, "Gate in", "Busan", "EVER 1")]
