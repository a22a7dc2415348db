"""Fixtures of list pages, detail pages and extractor JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def _page(*rows: str, bar: str = "", number: int = 1) -> str:
    return f'<html><body><input name="nowpage" value="{number}"><table class="other"><tr><td>x</td></tr></table><table class="wide tableHor"><thead><tr><th>번호</th></tr></thead><tbody>{"".join(rows)}</tbody></table><div class="paging">{bar}</div></body></html>'


def _row(*cells: str) -> str:
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


LIST_PAGES = {
    1: _page(
        _row("12", "서울회생법원", "김<br>관재", ' <a href="/view.do?seq_id=12&p=1"> 부동산  매각 </a> ', "7"),
        _row("too", "few", "cells"),
        _row("11", "부산회생법원", "이관재", '차량 매각<a href="/view.do?seq_id=11">열기</a><a href="">no</a><a href="b.pdf">첨부</a>', "9", "추가 1", "추가​2"),
        _row("", " ", "", "&nbsp;", ""),
        bar='<a href="#">이전</a><a href="#"><b>다음</b></a>',
    ),
    2: _page(_row("10", "대구지방법원", "박관재", "동산<p>매각<p><b>2차", "3"), bar="<a>1</a>", number=2),
    3: _page('<tr><td colspan="5">검색 결과가 없습니다</td></tr>', number=3),
    4: "<html><body>no table</body></html>",
}

_LONG = "채권자와 입찰자는 아래의 내용을 확인하시기 바랍니다. " * 5

DETAIL_PAGES = {
    "12": f"""<div class="board-content">공고 내용<br>둘째 줄</div><p>공고일: 2024.3.5
사건번호: 2024하합101142
서울회생법원 제1부
연락처:
02-123-4567
마감: 2024년 4월 1일 17시</p><script>var x = "법원 2020-01-01";</script>
<table><tr><th>매각기관</th><td>갑</td></tr><tr><td>매각기관</td><td>을</td></tr><tr><td>{"k" * 60}</td><td>long key</td></tr><tr><td></td><td>no key</td></tr></table>
<dl><dt>담당</dt><dd>병</dd><dt>비고</dt></dl>
<a href="javascript:download('17_1.pdf','공고%20문+1.pdf')">공고문</a><a href="/files/a.DOCX?x=1">서식</a><a href="/files/b.xlsx">표</a><button onclick="Download('z')">받기</button>""",
    "11": f"<table><tr><td>{_LONG}</td></tr></table><p>2023년 12월 1일, 지원 안내 051-111-2222 기한 :   </p>",
    "9": "<p>nothing here",
}

TREE = {
    "file name": "a.pdf", "number of pages": 2, "author": "갑", "title": None, "creation date": "D:2024",
    "kids": [
        {"type": "heading", "page number": 1, "bounding box": [50, 700, 300, 720], "font": "F", "font size": 14, "heading level": 1, "content": " 제목 "},
        {"type": "list", "kids": [{"type": "paragraph", "page number": 1, "bounding box": [50, 600, 300, 620], "font size": "x", "content": "항목", "kids": [{"type": "caption", "page number": 1, "content": "안쪽"}]}]},
        {"type": "paragraph", "page number": 1, "content": "   "},
        {"type": "table", "page number": 1, "number of rows": 2, "number of columns": 2, "rows": [{"cells": [{"row number": 1, "column number": 1, "kids": [{"type": "paragraph", "content": "가"}, {"type": "x", "kids": [{"content": "나"}]}]}, {"column number": 9, "kids": []}]}, {"cells": [{"column number": 2, "kids": [{"content": "다"}]}, {"column number": 2, "kids": [{"content": "라"}]}]}]},
        {"type": "table", "page number": 2, "rows": []},
        {"type": "Table", "page number": 2, "number of rows": 1, "number of columns": 1},
        {"type": "image", "page number": 2, "bounding box": [1, 2, 3], "path": "i.png", "kids": [{"type": "paragraph", "content": "hidden"}]},
        {"type": "footer", "page number": 2, "bounding box": [300, 20, 400, 40], "content": "오른쪽"},
        {"type": "footer", "page number": 2, "bounding box": [50, 20, 100, 40], "content": "왼쪽"},
    ],
}

DOCUMENTS = {"a": json.dumps(TREE, ensure_ascii=False), "empty": json.dumps({"file name": "e.pdf", "number of pages": 0, "page count": 3}), "broken": "{", "bad": json.dumps({"kids": [{"type": "image", "bounding box": ["x", 1, 2, 3]}]})}


def list_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LIST_PAGES.items()), "page_number int, html string")


def detail_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DETAIL_PAGES.items()), "sequence_number string, html string")


def json_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DOCUMENTS.items()), "doc_key string, json string")
