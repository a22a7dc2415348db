from pyspark.sql import functions as F

from notice_engine.functions import html as H
from notice_engine.operators import notices as N
from notice_engine.testing import fixtures


def test_list_rows(spark):
    rows = {(r["page_number"], r["row_number"]): r for r in N.list_rows(fixtures.list_pages(spark)).collect()}
    assert set(rows) == {(1, 1), (1, 3), (2, 1)}
    assert rows[1, 1]["bankruptcy_trustee"] == "김관재" and rows[1, 1]["notice_title"] == "부동산 매각"
    assert [tuple(x) for x in rows[1, 1]["links"]] == [("부동산  매각", "/view.do?seq_id=12&p=1")]
    assert rows[1, 3]["additional_fields"] == {"additional_field_5": "추가 1", "additional_field_6": "추가2"}
    assert [x["href"] for x in rows[1, 3]["links"]] == ["/view.do?seq_id=11", "b.pdf"]
    assert rows[2, 1]["links"] is None and rows[2, 1]["notice_title"] == "동산매각2차"


def test_page_information(spark):
    info = {r["page_number"]: r for r in N.page_info(fixtures.list_pages(spark)).collect()}
    assert (info[1]["current_page"], info[1]["has_next"], info[1]["has_previous"]) == (1, True, True)
    assert (info[2]["current_page"], info[2]["has_next"]) == (2, False) and info[4]["current_page"] == 1
    assert {r["page_number"]: r["has_data"] for r in N.has_data(fixtures.list_pages(spark)).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_details(spark):
    d = {r["sequence_number"]: r for r in N.details(fixtures.detail_pages(spark)).collect()}
    one = d["12"]
    assert one["notice_content"] == "공고 내용 둘째 줄" and one["notice_date"] == "2024.3.5" and one["case_details"] == "2024하합101142"
    assert one["jurisdiction_full"] == "서울회생법원 제1부" and one["contact_info"] == "02-123-4567" and one["deadline_info"] == "2024년 4월 1일 17시"
    assert one["additional_info"] == {"매각기관": "을", "담당": "병"}
    kinds = [(x["type"], x["file_extension"] or x["file_id"]) for x in one["attachment_links"]]
    assert kinds == [("javascript_download", "17_1.pdf"), ("direct_link", ".pdf"), ("direct_link", ".doc"), ("direct_link", ".docx"), ("direct_link", ".xlsx"), ("direct_link", ".xls"), ("onclick_download", None)]
    assert d["11"]["notice_content"].startswith("채권자와") and d["11"]["jurisdiction_full"].endswith("지원 안내 051-111-2222 기한 :") and d["11"]["deadline_info"] == ""
    assert d["9"]["notice_content"] == "" and d["9"]["additional_info"] == {} and d["9"]["attachment_links"] == []


def test_live_links(spark):
    rows = N.attachment_rows(N.details(fixtures.detail_pages(spark), live=True)).where("sequence_number = '12'").orderBy("position").collect()
    assert [(r["type"], r["display_name"] or r["filename"]) for r in rows] == [("javascript_download", "공고 문+1.pdf"), ("direct_link", rows[1]["filename"]), ("direct_link", "b.xlsx")]
    assert rows[0]["planned_name"] == "01_공고 문+1.pdf"


def test_merge_and_targets(spark):
    out = {r["sequence_number"]: r for r in N.merged(N.list_rows(fixtures.list_pages(spark)), N.details(fixtures.detail_pages(spark))).collect()}
    assert not out["12"]["detail_processing_failed"] and out["10"]["detail_processing_failed"] and out["12"]["notice_title"] == "부동산 매각"
    captured = spark.createDataFrame([("/view.do?seq_id=12&p=1", "exact"), ("/other?seq_id=11&x", "id"), ("/open/77/x", "inside")], "href string, html string")
    wanted = spark.createDataFrame([("/view.do?seq_id=12&p=1",), ("/view.do?seq_id=11",), ("/v?seq_id=77",), ("/none",)], "href string")
    assert {r["href"]: r["html"] for r in N.detail_targets(wanted, captured).collect()} == {"/view.do?seq_id=12&p=1": "exact", "/view.do?seq_id=11": "id", "/v?seq_id=77": "inside"}


def test_recovery_of_broken_html():
    root = H.parse("<div><p>a<b>b</i></div>c<br/>d</nothing>")
    assert root.text() == "abcd" and root.first("div").text() == "ab" and root.first("b").parent.name == "p"
    assert H.parse(None).text() == "" and H.detail("")[1] == ""


def test_last_of_equal_keys(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "3")],), ([],)], "p array<struct<key:string,value:string>>")
    assert [r[0] for r in df.select(N.last_wins(F.col("p"))).collect()] == [{"a": "3", "b": "2"}, {}]


def test_generated_pages_are_dealt(spark):
    from notice_engine.testing import generated

    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")
    assert generated.detail_pages(read("part")).rdd.getNumPartitions() >= 4 and generated.list_pages(read("customer")).rdd.getNumPartitions() >= 4
