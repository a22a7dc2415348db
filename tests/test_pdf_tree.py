import json
import random

from pyspark.sql import functions as F

from notice_engine.operators import pdf_tree as P
from notice_engine.testing import fixtures


def docs(spark):
    return P.documents(fixtures.json_documents(spark))


def test_headers_and_failures(spark):
    h = {r["doc_key"]: r for r in P.headers(docs(spark)).collect()}
    assert (h["a"]["file_name"], h["a"]["page_count"], h["a"]["metadata"]["author"], h["a"]["metadata"]["title"]) == ("a.pdf", 2, "갑", None)
    assert h["empty"]["page_count"] == 3 and h["broken"]["error"] and h["bad"]["error"] and h["a"]["error"] is None


def test_elements(spark):
    rows = P.texts(docs(spark)).orderBy("ord").collect()
    assert [(r["element_type"], r["text"]) for r in rows] == [("heading", "제목"), ("paragraph", "항목"), ("caption", "안쪽"), ("footer", "오른쪽"), ("footer", "왼쪽")]
    assert rows[0]["heading_level"] == 1 and rows[1]["font_size"] is None and tuple(rows[2]["bbox"]) == (0.0, 0.0, 0.0, 0.0)
    assert P.headings(P.texts(docs(spark))).count() == 1 and P.paragraphs(P.texts(docs(spark))).count() == 1
    tables = P.tables(docs(spark)).orderBy("table_index").collect()
    assert [(t["table_index"], t["row_count"], t["col_count"], t["data"]) for t in tables] == [(0, 2, 2, [["가 나", ""], ["", "라"]]), (2, 1, 1, [[""]])]
    image = P.images(docs(spark)).collect()
    assert len(image) == 1 and image[0]["image_path"] == "i.png" and tuple(image[0]["bbox"]) == (0.0,) * 4


def test_reading_order(spark):
    assert {r["doc_key"]: r["full_text"] for r in P.full_text(docs(spark)).collect()}["a"] == "제목\n항목\n안쪽\n왼쪽\n오른쪽"


def test_scanned_document(spark):
    per_page = {1: 12, 2: 6, 3: 7, 4: 20, 5: 50, 6: 14, 7: 5, 8: 3, 9: 4}
    kids = [{"type": "image", "id": k, "page number": p, "bounding box": [0, 0, 1, 1]} for p, n in per_page.items() for k in range(n)]
    source = spark.createDataFrame([(json.dumps({"file name": "s.pdf", "number of pages": 9, "kids": kids}),)], "json string")
    found = P.documents(source)
    images = P.images(found).orderBy("image_index").collect()
    assert [i["image_index"] for i in images] == list(range(121)) and all(i["image_path"] is None for i in images)
    assert P.texts(found).count() == 0 and P.tables(found).count() == 0


def _tree(rng, depth):
    node = {"type": rng.choice(["paragraph", "list", "Heading", "table", "image", "footer"]), "content": rng.choice(["x", " ", "y z"])}
    if depth and rng.random() < 0.8:
        node["kids"] = [_tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return node


def _texts(node, path):
    """What a walk in the order of the tree should give."""
    kind = node["type"].lower()
    if kind in ("table", "image"):
        return []
    own = [(path, kind, node["content"].strip())] if kind in P.TEXT_TYPES and node["content"].strip() else []
    return own + [x for k, kid in enumerate(node.get("kids", [])) for x in _texts(kid, (*path, k))]


def test_walk_follows_the_order_of_the_tree(spark):
    rng = random.Random(3)
    trees = {str(k): [_tree(rng, 4) for _ in range(3)] for k in range(12)}
    source = spark.createDataFrame([(k, json.dumps({"kids": kids})) for k, kids in trees.items()], "doc_key string, json string")
    want = {k: [x for i, kid in enumerate(kids) for x in _texts(kid, (i,))] for k, kids in trees.items()}
    got = {k: [] for k in trees}
    for r in P.texts(P.documents(source)).orderBy("doc_key", "path").collect():
        got[r["doc_key"]].append((tuple(r["path"]), r["element_type"], r["text"]))
    assert got == want


def test_misfits_are_errors(spark):
    bad = ['[1]', '{"kids": 3}', '{"kids": ["x"]}', '{"number of pages": "many"}', '{"kids": [{"type": "paragraph", "content": "a", "page number": "x"}]}', '{"kids": [{"type": "table", "rows": 7}]}', None, '{"kids": [], "x": 1}']
    rows = P.documents(spark.createDataFrame(list(enumerate(bad)), "k int, json string")).select("k", "doc.error", F.col("doc").isNull().alias("none"), "doc.elements").orderBy("k").collect()
    assert all(r["error"] and r["elements"] is None for r in rows[:6]) and rows[6]["none"] and rows[7]["error"] is None and rows[7]["elements"] == []


def test_whole_numbers_as_text_and_with_fractions(spark):
    tree = {"number of pages": "4", "kids": [{"type": "heading", "content": "a", "page number": 2.7, "heading level": "2.5", "font size": "9"}, {"type": "image", "bounding box": [1, "2", 3.5, 4, 5]}]}
    found = P.documents(spark.createDataFrame([(json.dumps(tree),)], "json string"))
    text, image = P.texts(found).first(), P.images(found).first()
    assert P.headers(found).first()["page_count"] == 4 and (text["page_number"], text["heading_level"], text["font_size"]) == (2, None, 9.0)
    assert tuple(image["bbox"]) == (1.0, 2.0, 3.5, 4.0)


def test_matrices_overwrite_and_fill(spark):
    cells = spark.createDataFrame([(1, 1, 1, 1, "a"), (1, 1, 1, 2, "b"), (1, 2, 3, 1, "c")], "g int, r int, c int, ord int, text string")
    assert P.matrices(cells, ["g"]).collect()[0]["data"] == [["b", "", ""], ["", "", "c"]]


def test_documents_run_no_job_of_their_own(spark):
    source = spark.createDataFrame([("a", '{"kids": [{"type": "list", "kids": [{"type": "image"}]}]}')], "k string, json string")
    spark.sparkContext.setJobGroup("shred", "")
    try:
        found = P.images(P.documents(source))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("shred")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and [tuple(r["image_index"] for r in found.collect())] == [(0,)]


def test_generated_documents_are_dealt(spark):
    from notice_engine.testing import generated

    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")
    assert generated.json_documents(read("orders"), read("lineitem")).rdd.getNumPartitions() >= 4


def test_casts_are_those_of_variants(spark):
    from notice_engine.functions import tree

    values = ["1", "-0", "-2.7", "1.50", "-0.0", "1e2", "1e400", "9223372036854775808", "9.223372036854775807e18", "123456789012345678901234567890123456789", "2147483648", "true", "null", '" 4 "', '"4.5"', '"1d"', '"-Infinity"', '"NaN"', '"0x1p3"', '{"b":1.50,"a":"\\u001f\\""}', '[1,[]]', '"\\ud800"', '"\\ud83d\\ude00"']
    texts = [f'{{"k":{v}}}' for v in values] + ['{"k":1,"k":2}', '{"k":1} x', '{"k":NaN}', '{"k":01}', "", '{"k":1,}']
    at = lambda kind: F.try_variant_get("v", "$.k", kind)
    parsed = spark.createDataFrame(list(enumerate(texts)), "i int, j string").select("i", F.try_parse_json("j").alias("v"))
    want = parsed.select("i", F.col("v").isNotNull(), at("bigint"), at("int"), at("double"), at("string")).orderBy("i").collect()
    for row, text in zip(want, texts, strict=True):
        try:
            value, ok = tree.loads(text).get("k"), True
        except ValueError:
            value, ok = None, False
        assert repr(tuple(row[1:])) == repr((ok, tree.whole(value), tree.whole(value, 32), tree.real(value), tree.string(value))), text


def test_numbers_over_32_bits_are_errors(spark):
    bad = ['{"number of pages": 3000000000}', '{"kids": [{"type": "image", "page number": 3000000000}]}']
    rows = P.documents(spark.createDataFrame([(x,) for x in bad], "json string")).select("doc.error").collect()
    assert all(r["error"] for r in rows)


def test_deep_trees(spark):
    text = '{"kids":[' + '{"type":"list","kids":[' * 400 + '{"type":"heading","content":"x"}' + "]}" * 400 + "]}"
    rows = P.texts(P.documents(spark.createDataFrame([(text,)], "json string"))).collect()
    assert [(r["text"], len(r["path"])) for r in rows] == [("x", 401)]
