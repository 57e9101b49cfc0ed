import hashlib

import pytest
from pyspark.sql import functions as F

from leafline.sources import files, providers
from leafline.streaming import arrivals


@pytest.fixture
def folder(tmp_path):
    for owner, names in {"teacher": ["page_2.jpg", "page_10.jpg", "扫描_1.jpg", "notes.txt"], "student1": ["1.png"]}.items():
        (tmp_path / "math" / owner).mkdir(parents=True)
        for n in names:
            (tmp_path / "math" / owner / n).write_bytes(n.encode())
    return tmp_path


def test_discovery_and_fingerprint(spark, folder):
    pages = files.discover(spark, str(folder))
    got = [(r["role"], r["page_index"], r["name"]) for r in pages.orderBy("role", "page_index").collect()]
    assert got == [("student", 1, "1.png"), ("teacher", 1, "page_2.jpg"), ("teacher", 2, "page_10.jpg")]
    marks = {r["owner"]: r["fingerprint"] for r in files.document_fingerprint(pages, ["owner"]).collect()}
    assert marks["teacher"] == hashlib.sha256(b"page_2.jpgpage_2.jpgpage_10.jpgpage_10.jpg").hexdigest()
    docs = pages.select("subject", "owner", "role").distinct()
    assert files.selected(docs, student="student1").count() == 2
    assert files.selected(docs, limit=1).first()["role"] == "teacher"


def test_block_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"image": "x", "blocks": [{"text": "t", "bbox": [0, 0, 1, 1], "confidence": 0.5}]}\n\n')
    assert files.read_blocks(spark, str(tmp_path / "a.jsonl")).first()["blocks"][0]["text"] == "t"
    (tmp_path / "b.jsonl").write_text("{broken\n")
    with pytest.raises(Exception):
        files.read_blocks(spark, str(tmp_path / "b.jsonl")).collect()


def test_headings_and_sinks(spark, tmp_path):
    (tmp_path / "k.md").write_text("# one\n## two\ntext\n#### four\n##### five\n")
    assert [(r["level"], r["title"]) for r in files.read_headings(spark, str(tmp_path / "k.md")).orderBy("ord").collect()] == [(2, "two"), (4, "four")]
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("m", 1)], "subject string, n int")
    files.write_documents(df, out)
    with pytest.raises(Exception):
        files.write_documents(df, out)
    files.write_json({"a": 1}, str(tmp_path / "x.json"))
    assert (tmp_path / "x.json").read_text().startswith("{")


def test_model_json():
    assert files.model_json('text ```json\n{"a": {"b": 1}}\n``` {"a": {"b": 1}}') == {"a": {"b": 1}}
    for bad in ("none", '{"a": 1} {"a": 2}'):
        with pytest.raises(ValueError):
            files.model_json(bad)


def test_providers(spark):
    asked = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q")], "key string, prompt string")
    assert {r["status"] for r in providers.none(asked).collect()} == {"UNAVAILABLE"}
    recorded = spark.createDataFrame([("a", "{}")], "key string, response string")
    assert {r["key"]: r["status"] for r in providers.replayed(asked, recorded).collect()} == {"a": "OK", "b": "MISSING", "c": "MISSING"}

    def call(prompt):
        if prompt == "q":
            raise ValueError
        return prompt.upper()

    assert {r["key"]: (r["status"], r["response"]) for r in providers.called(asked, call).collect()} == {"a": ("OK", "P"), "b": ("OK", "P"), "c": ("FAILED", None)}
    expected = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "batch int, slot_id string")
    got = spark.createDataFrame([(1, "x"), (2, "z"), (2, "odd")], "batch int, slot_id string")
    assert {r["slot_id"]: r["outcome"] for r in providers.checked_batch(got, expected).collect()} == {"x": "ACCEPTED", "y": "RETRY", "z": "REJECTED"}


def test_new_pages_in_a_stream(spark, folder):
    query = arrivals.new_pages(arrivals.arriving_pages(spark, str(folder))).writeStream.format("memory").queryName("pages").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("pages").select("fingerprint").distinct().count() == 5


def test_new_work(spark):
    pages, cache = spark.createDataFrame([("a",), ("b",)], "fingerprint string"), spark.createDataFrame([("b",)], "fingerprint string")
    assert [r[0] for r in files.new_work(pages, cache).collect()] == ["a"]
    items = spark.createDataFrame([(1, ["s"]), (2, None)], "i int, slots array<string>")
    assert files.expand_slots(items).filter(F.col("slot").isNull()).count() == 1
