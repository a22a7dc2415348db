import urllib.parse

import pytest
from pyspark.sql import functions as F

from notice_engine.functions import text as X

SPACES = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def python_clean(s):
    return " ".join((s or "").split()).replace("​", "").strip()


def run(spark, f, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, s string").select("k", f(F.col("s")).alias("r")).orderBy("k").collect()
    return [r["r"] for r in rows]


def test_clean_text_is_that_of_python(spark):
    assert len(SPACES) == 29
    values = [None, "", "  ", "a ​ b", "​ a", "a\xa0　b", *[f"{c}x{c}{c}y{c}" for c in SPACES], "\x1cq\x1f", "ok"]
    assert run(spark, X.clean_text, values) == [python_clean(v) for v in values]
    assert run(spark, X.clean_text, ["a ​ b"]) == ["a  b"]


def test_sanitize_filename(spark):
    cases = {
        "": "",
        "a<b>:c": "a_b__c",
        " x \t y .pdf ": "x y .pdf",
        "n" * 250: "n" * 200,
        "n" * 250 + ".pdf": "n" * 196 + ".pdf",
        "." + "n" * 250: "." + "n" * 199,
        ".." + "n" * 250 + ".b": ".." + "n" * 196 + ".b",
        "a." + "e" * 230: "." + "e" * 230,
        "a" * 60 + "." + "e" * 230: "a" * 29 + "." + "e" * 230,
    }
    assert run(spark, X.sanitize_filename, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (X.notice_date, {"2024.3.5 then 2023년 1월 2일": "2024.3.5", "on 2023년 12월  1일": "2023년 12월  1일", "1/2/2024": "1/2/2024", "2024. 3. 5": "", "none": "", "": "", "٢٠٢٤-1-2": "٢٠٢٤-1-2"}),
        (X.contact, {"연락처:\n02-1": "02-1", "문의 : 갑\n전화 을": "을", "x 051-111-2222": "051-111-2222", "담당자": "", "연락처:   ": "", "": ""}),
        (X.deadline, {"마감: 4월 1일": "4월 1일", "기한 :   ": "", "접수기간\n오늘": "오늘", "까지": "", "": ""}),
        (X.case_number, {"2024하합101142": "2024하합101142", "사건번호: A-1": "A-1", "사건 B": "B", "사건": "", "": ""}),
    ],
)
def test_first_matching_pattern(spark, f, cases):
    assert run(spark, f, list(cases)) == list(cases.values())


def test_court_line_and_ids(spark):
    assert run(spark, X.jurisdiction_line, ["a\n  서울 지원 b \nc 법원 d", "지청", "x"]) == ["c 법원 d", "지청", ""]
    assert run(spark, X.seq_id, ["/v?seq_id=12&p=1", "/v?seq_id=", "/v", "a?seq_id=1&seq_id=2"]) == ["12", "", None, "1"]
    assert run(spark, X.staged_notice_id, ["notice_12__0001__a", "notice_12", "notice_x__a", "n"]) == ["12", "12", None, None]


def test_names_and_urls(spark):
    name = lambda c: X.planned_name(F.lit(3), c, F.lit("17_1.hwp"))
    assert run(spark, name, ["a/b", "x.PDF", "dir.docx"]) == ["03_a_b.hwp", "03_x.PDF", "03_dir.docx"]
    texts = ["a%20b+c", "100%", "%EA%B0%80", "%zz%41%4", "", "%FF", "가%41나", "%%41", "%e9%20x"]
    assert run(spark, X.unquote, texts) == [urllib.parse.unquote(t) for t in texts]
    join = lambda c: X.join_url(F.lit("https://h.kr:1/a/b?c"), c)
    assert run(spark, join, ["/x/y", "z", "http://o/"]) == ["https://h.kr:1/x/y", "z", "http://o/"]
