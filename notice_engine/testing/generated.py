"""List pages, detail pages and extractor JSON made of the synthetic tables, as large as those are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_engine.session import dealt

#: Notices on a list page.
PER_PAGE = 20


def _when(k: Column, by: int, rest: int, then: str, otherwise: str = "") -> Column:
    return F.when(k % by == rest, F.lit(then)).otherwise(F.lit(otherwise))


def list_pages(customer: DataFrame) -> DataFrame:
    """(page_number, html): a row of the list table for each customer; some rows too short, blank or without results."""
    k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    td = lambda *c: F.concat(F.lit("<td>"), *c, F.lit("</td>"))
    link = F.concat(F.lit(' <a href="/view.do?seq_id='), text, F.lit('&amp;p=1"> Lot  '), text, F.lit(" &amp; more </a> "))
    file = F.when(k % 3 == 0, F.concat(F.lit('<a href="'), text, F.lit('.pdf">file</a>'))).otherwise(F.lit('<a href="">none</a>'))
    cells = F.concat(td(text), td("c_mktsegment"), td(F.lit(" "), "c_name", F.lit("<br>\t"), F.lit("trustee ")), td(link, file), td((k % 7).cast("string")))
    extra = F.when(k % 4 == 0, F.concat(td(F.lit("more  \n"), text), td(F.lit("a​b"))))
    row = (
        F.when(k % 11 == 0, F.concat(td(text), td(F.lit("short"))))
        .when(k % 13 == 0, F.concat(*[td(F.lit(x)) for x in ("", " ", "&nbsp;", "\n", "<b></b>")]))
        .when(k % 17 == 0, F.concat(td(text), td(F.lit("x")), td(F.lit("검색 결과가 없습니다.")), td(F.lit("x")), td(F.lit("x"))))
        .otherwise(F.concat(cells, F.coalesce(extra, F.lit(""))))
    )
    page = F.floor(k / PER_PAGE).cast("int")
    rows = dealt(customer.withColumn("page_number", page), "page_number").groupBy("page_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", F.concat(F.lit("<tr>"), row, F.lit("</tr>\n")).alias("html")))), lambda x: x["html"]), "").alias("rows"))
    n = F.col("page_number")
    field = F.when(n % 5 == 4, F.lit("")).when(n % 7 == 3, F.lit('<input name="nowpage" value="x">')).otherwise(F.concat(F.lit('<input name="nowpage" value="'), n.cast("string"), F.lit('">')))
    bar = F.concat(F.lit('<div class="paging">'), _when(n, 3, 0, "", "<a href='#'><b>다음</b></a>"), _when(n, 4, 1, "<a>&lt;</a>", "<a>1<i>2</i></a>"), F.lit("</div>"))
    html = F.concat(F.lit("<html><body>"), field, F.lit('<table><tr><td>1</td></tr></table><table class="wide tableHor"><tbody>'), "rows", F.lit("</tbody></table>"), bar, F.lit("<p>end"))
    return rows.select("page_number", html.alias("html"))


def detail_pages(part: DataFrame) -> DataFrame:
    """(sequence_number, html): a detail page for each part, of four layouts."""
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    body = F.concat("p_name", F.lit("<br> second  line "), text)
    layout = (
        F.when(k % 4 == 0, F.concat(F.lit('<div class="board-content">'), body, F.lit('</div><div class="xcontenty">no</div>')))
        .when(k % 4 == 1, F.concat(F.lit('<table><tr><td>'), "p_brand", F.lit("</td></tr></table><table><tr><td>"), F.repeat(F.concat(F.col("p_name"), F.lit(" ")), F.lit(12)), F.lit("</td></tr></table>")))
        .when(k % 4 == 2, F.concat(F.lit('<td class="content-cell">cell</td><div class="my-content">'), body, F.lit("</div>")))
        .otherwise(F.lit('<div class="content"></div>'))
    )
    date = F.when(k % 3 == 0, F.concat(F.lit("<p>2024-1-"), (k % 28 + 1).cast("string"), F.lit(" and 2023년 5월 1일</p>"))).when(k % 3 == 1, F.lit("<p>2023년  5월 1일</p>")).otherwise(F.lit(""))
    case = F.when(k % 5 == 0, F.concat(F.lit("<p>사건번호 : A-"), text, F.lit(" x</p>"))).when(k % 5 == 1, F.concat(F.lit("<p>2024하합"), text, F.lit(" 사건: z</p>"))).otherwise(F.lit(""))
    court = F.when(k % 6 == 0, F.concat(F.lit("<p>\n 서울 법원  "), text, F.lit(" \n안양지원</p>"))).otherwise(F.lit(""))
    contact = F.when(k % 7 == 0, F.concat(F.lit("<p>전화:\n 02-"), text, F.lit(" \n</p>"))).otherwise(F.lit(""))
    deadline = F.when(k % 8 == 0, F.concat(F.lit("<p>기한 "), text, F.lit("일\n</p>"))).otherwise(F.lit(""))
    pairs = F.concat(F.lit("<table><tr><th> size </th><td>"), F.col("p_size").cast("string"), F.lit("</td></tr><tr><td>type</td><td>"), "p_type", F.lit("</td><td>more</td></tr><tr><td>type</td><td>last "), text, F.lit("</td></tr><tr><td></td><td>x</td></tr></table><dl><dt>k</dt><dd>v"), text, F.lit("</dd><dt>lone</dt></dl>"))
    links = F.concat(
        F.lit("""<a href="javascript:download('"""), text, F.lit("""_1.pdf','Lot%20"""), text, F.lit("""%ZZ+a.hwp')">script</a>"""),
        F.when(k % 2 == 0, F.concat(F.lit('<a href="/files/'), text, F.lit('.docx?x=1"> form </a>'))).otherwise(F.lit("")),
        F.when(k % 9 == 0, F.lit('<a href="http://h/p/B.XLS">upper</a>')).otherwise(F.lit("")),
        F.when(k % 10 == 0, F.lit("""<button onclick="Download(1)">b</button><a onclick="download(2)">c</a>""")).otherwise(F.lit("")),
    )
    return dealt(part).select(text.alias("sequence_number"), F.concat(layout, date, case, court, contact, deadline, pairs, links, F.lit("<script>법원 1999-01-01</script>")).alias("html"))


def json_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(doc_key, json): a document for each order: a heading, a paragraph for each line within a list, a table of the lines and images."""
    line = F.col("l_linenumber")
    paragraph = F.struct(F.lit("Paragraph").alias("type"), line.alias("page number"), F.array(F.lit(10) * line, F.lit(0), F.lit(100), F.col("l_quantity")).alias("bounding box"), F.concat(F.lit(" "), "l_returnflag", F.lit(" "), F.col("l_partkey").cast("string"), F.lit("\n")).alias("content"), F.when(line % 2 == 0, F.lit("9.5")).otherwise(F.lit("big")).alias("font size"))
    said = F.struct(F.lit("x").alias("type"), F.col("l_returnflag").alias("content"), F.array(F.struct(F.col("l_linestatus").alias("content"))).alias("kids"))
    three = (F.struct(F.array(said).alias("kids")), F.struct(F.lit(3).alias("column number"), F.array(F.struct(F.col("l_partkey").cast("string").alias("content"))).alias("kids")), F.struct(F.lit(9).alias("column number"), F.array(said).alias("kids")))
    cells = F.concat(F.lit('{"cells":['), F.concat_ws(",", *[F.to_json(c) for c in three]), F.lit("]}"))
    # texts are made line by line, before lines are grouped: one list for each order, of which only keys are compared
    made = F.struct(line, "l_partkey", "l_suppkey", "l_quantity", F.to_json(paragraph).alias("p"), cells.alias("c"))
    listed = lambda n: F.concat(F.lit("["), F.array_join(F.transform("made", lambda x: x[n]), ","), F.lit("]"))
    lines = dealt(lineitem, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(made)).alias("made")).select("l_orderkey", listed("p").alias("p"), listed("c").alias("rows"))
    k = F.col("o_orderkey")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    text = F.concat(
        F.lit('{"file name":'), quoted(F.concat(F.lit("o"), k.cast("string"), F.lit(".pdf"))), F.lit(',"number of pages":'), (k % 3).cast("string"), F.lit(',"page count":"7","title":'), quoted(F.col("o_orderpriority")),
        F.lit(',"kids":[{"type":"HEADING","page number":1,"heading level":2,"bounding box":[1,2,3],"content":'), quoted(F.col("o_orderstatus")), F.lit(',"font":"F"},{"type":"list","kids":'), F.coalesce("p", F.lit("[]")),
        F.lit('},{"type":"table","rows":[]},{"type":"table","page number":2,"number of columns":3,"rows":'), F.coalesce("rows", F.lit("[]")), F.lit(',"kids":[{"type":"paragraph","content":"hidden"}]}'),
        F.when(k % 2 == 0, F.lit(',{"type":"image","page number":2,"bounding box":[1,2,3,4.5],"path":"a.png"},{"type":"Image"}')).otherwise(F.lit("")), F.lit("]"),
        F.when(k % 50 == 0, F.lit("")).otherwise(F.lit("}")),
    )
    return dealt(orders, "o_orderkey").join(lines, k == F.col("l_orderkey"), "left").select(k.alias("doc_key"), text.alias("json"))
