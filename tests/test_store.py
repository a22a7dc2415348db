import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from notice_engine.operators import analytics as A
from notice_engine.operators import pdf_tree as P
from notice_engine.operators.store import SnapshotStore, numbered, point_lookup
from notice_engine.sources import captured
from notice_engine.testing import fixtures

IN = "notice_id string, file_path string, file_name string, file_size bigint, page_count int, ord int"


def now():
    return F.lit(datetime(2024, 1, 1, 0, 0, 0, 600000)).cast("timestamp_ntz")


def test_upsert_keeps_ids_and_spelling(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.upsert(spark.createDataFrame([("1", "/a", "A.pdf", 5, 2, 1), ("1", "/b", "b.pdf", 6, 1, 2), ("1", "/a2", "a.PDF ", 7, 3, 3)], IN), now())
    rows = {r["id"]: r for r in store.read("pdf_documents").collect()}
    assert {k: (r["file_name"], r["file_path"], r["page_count"]) for k, r in rows.items()} == {1: ("A.pdf", "/a2", 3), 2: ("b.pdf", "/b", 1)}
    assert rows[1]["processed_at"] == datetime(2024, 1, 1, 0, 0, 1)
    store.upsert(spark.createDataFrame([("1", "/c", "c.pdf", 1, 1, 1), ("1", "/b9", "B.pdf", 9, 9, 2)], IN), now())
    rows = {r["id"]: r["file_path"] for r in store.read("pdf_documents").collect()}
    assert rows == {1: "/a2", 2: "/b9", 3: "/c"}
    assert point_lookup(store.read("pdf_documents"), "1", "á.pdf").first()["id"] == 1
    assert point_lookup(store.read("pdf_documents"), "1", "x.pdf").first() is None


def test_save_append_delete_and_summary(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    docs = P.documents(fixtures.json_documents(spark)).withColumns({"notice_id": F.lit("7"), "source_path": F.lit("/x"), "file_size": F.lit(10), "ord": F.col("doc_key")})
    counts = {r["document_id"]: r.asDict() for r in store.save(docs).collect()}
    full = next(r for r in counts.values() if r["pdf_text_content"])
    assert (full["pdf_text_content"], full["pdf_tables"], full["pdf_images"]) == (5, 2, 1) and len(counts) == 2
    assert store.read("pdf_images").first()["width"] == 0 and store.read("pdf_tables").orderBy("id").first()["table_data"]["row_count"] == 2
    view = {r["file_name"]: r for r in A.store_summary(store.tables()).collect()}
    assert (view["a.pdf"]["pages_with_text"], view["a.pdf"]["total_tables"], view["a.pdf"]["total_file_size_bytes"]) == (2, 2, 10 * 5 * 2 * 1)
    assert view["e.pdf"]["total_file_size_bytes"] == 10
    store.save(docs)  # again: children double, the document does not
    assert store.read("pdf_text_content").count() == 10 and store.read("pdf_documents").count() == 2
    store.save(docs, replace_children=True)
    assert store.read("pdf_text_content").count() == 5
    found = A.search(store.read("pdf_text_content"), store.read("pdf_documents"), "왼쪽")
    assert [r["text_content"] for r in found.collect()] == ["왼쪽"]
    gone = store.read("pdf_documents").where("file_name = 'a.pdf'").select("id")
    assert store.delete(gone) == 1 and store.read("pdf_text_content").count() == 0 and store.read("pdf_documents").count() == 1
    assert store.delete(spark.createDataFrame([(999,)], "id bigint")) == 0
    with pytest.raises(ValueError):
        store.save(docs.withColumn("notice_id", F.lit(None).cast("string")))


def test_numbers_are_consecutive(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("o")).repartition(7)
    out = numbered(rows, ["o"], F.lit(5).cast("bigint")).orderBy("o").collect()
    assert [r["id"] for r in out] == list(range(6, 1006))


def test_summary_equals_the_naive_join(spark):
    rng = random.Random(1)
    parents = spark.createDataFrame([(k, rng.choice([None, 0, 3, 11])) for k in range(12)], "id int, size int")
    child = lambda: spark.createDataFrame([(rng.randrange(14), rng.randrange(4), k) for k in range(25)], "parent_key int, page int, row int")
    children = [("a", child(), F.col("page")), ("b", child(), F.col("row")), ("c", child(), F.col("row"))]
    key = lambda df: sorted(map(tuple, df.select("id", "a", "b", "c", "total_size").collect()))
    assert key(A.processing_summary(parents, "id", F.col("size"), children)) == key(A.naive_summary(parents, "id", F.col("size"), children))


def test_search_terms():
    assert A.search_terms("ab c de") == ["ab", "de"] and A.search_terms("x") == [] and A.search_terms("ABA") == ["ab", "ba"]


def test_index_and_scan_agree(spark):
    texts = spark.createDataFrame([(1, 1, 1, "Hello w"), (2, 1, 1, "o w"), (3, 1, 2, "lower"), (4, 2, 1, None)], "id int, document_id int, page_number int, text_content string").withColumns({"font_size": F.lit(1.0), "font_name": F.lit("f")})
    docs = spark.createDataFrame([(1, "n", "f", datetime(2024, 1, 1)), (2, "n", "g", datetime(2024, 1, 2))], "id int, notice_id string, file_name string, processed_at timestamp_ntz")
    for term in ("LO", "o w", "we", "h"):
        scan = [r["text_content"] for r in A.search(texts, docs, term).collect()]
        assert scan == [r["text_content"] for r in A.search_indexed(A.bigram_index(texts), texts, docs, term).collect()]
    assert [r["text_content"] for r in A.search(texts, docs, "lo").collect()] == ["Hello w", "lower"]


def test_discovery_and_outcome(spark, tmp_path):
    for folder, names in {"notice_378_a": ["01_x.pdf"], "notice_379": ["02_b.pdf", "01_a.pdf", "c.PDF", "n.txt"], "other": ["z.pdf"], "notice_x": ["q.pdf"]}.items():
        (tmp_path / "d" / folder).mkdir(parents=True)
        for n in names:
            (tmp_path / "d" / folder / n).write_bytes(b"%PDF")
    found = captured.discovered(captured.pdf_listing(spark, str(tmp_path / "d")))
    assert [(r["notice_id"], r["file"], r["idx"], r["length"]) for r in found.collect()] == [("378", "01_x.pdf", 0, 4), ("379", "01_a.pdf", 0, 4), ("379", "02_b.pdf", 1, 4)]
    assert captured.pdf_listing(spark, str(tmp_path / "missing")).count() == 0
    staged = spark.createDataFrame([("a", "1"), ("broken", "1"), ("gone", "2")], "stem string, notice_id string")
    outputs = fixtures.json_documents(spark).withColumnRenamed("doc_key", "stem")
    got = {r["stem"]: r["status"] for r in captured.conversion_outcome(staged, outputs).collect()}
    assert got == {"a": "ok", "broken": "failed", "gone": "failed"}
    assert A.batch_totals(captured.conversion_outcome(staged, outputs)).first().asDict() == {"notices": 1, "documents": 1, "failed": 2}


def test_statements():
    assert captured.split_statements("") == [] and captured.split_statements("  \n ") == []
    assert captured.split_statements("CREATE A;\n\nCREATE B;\n") == ["CREATE A", "CREATE B"] and captured.split_statements("-- only\n;\nX") == ["X"]
    assert captured.split_statements("SELECT 1") == ["SELECT 1"]


def test_an_array_file_is_extended(spark, tmp_path):
    from notice_engine.sources import sinks

    new = spark.createDataFrame([(2, "나")], "a int, b string")
    for name, text, first in (("l", '[{"a": 1}]', [{"a": 1}]), ("o", '{"a": 1}', [{"a": 1}])):
        path = tmp_path / f"{name}.json"
        path.write_text(text, encoding="utf-8")
        assert sinks.append(new, str(path))
        assert json.loads(path.read_text(encoding="utf-8")) == [*first, {"a": 2, "b": "나"}]
    assert not sinks.append(new, str(tmp_path / "none.json"))


def test_tables_of_a_database(spark, tmp_path):
    from notice_engine.sources import captured

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    rows.write.format("jdbc").option("url", url).option("dbtable", "t").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").save()
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    assert captured.jdbc(spark, url, "t", **options).count() == 2
    assert captured.probe(spark, url, "SELECT 1 AS one FROM sysibm.sysdummy1", **options)
