import pytest

from leafline.operators import contamination
from leafline.plans import catalog

ITEMS = [(1, "What is the capital of France?"), (2, "Name the largest planet 🙂 of all."), (3, "abc"), (4, None), (5, "what IS the capital of france, and why?")]
DOCS = [
    (1, "Some long introduction. " * 30 + "What is the capital of France? And more."), (2, "the largest planet 🙂"), (3, "nothing of it"), (4, None), (5, ""), (6, "abcd"),
    (7, "Name the largest planet of any kind"), (8, "What is the capital of France?"), (9, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 the largest planet 🙂 of all"), (10, "xyz"),
]


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(DOCS, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def grams(t):
    t = (t or "").lower()
    return {t[i : i + 4] for i in range(len(t) - 3)}


def test_contamination(spark, tables):
    want = set()
    for d, t in DOCS:
        for i, u in ITEMS:
            a, b = grams(t), grams(u)
            if a and b and max(len(a & b) / len(a), len(a & b) / len(b)) > 0.4:
                want.add((d, i, round(len(a & b) / len(b), 6), round(len(a & b) / len(a), 6)))
    assert {(1, 1), (2, 2), (8, 1), (9, 2)} <= {w[:2] for w in want}
    assert {tuple(r) for r in catalog.QUERIES["q23b_document_contamination"](spark, tables).collect()} == want


def test_best_with_margin(spark, tables):
    want = set()
    for d, t in DOCS:
        if t is None:
            continue
        a = set(t.split(" "))
        shares = sorted(((len(a & set(u.split(" "))) / len(a), -i) for i, u in ITEMS if u is not None and a & set(u.split(" "))), reverse=True)
        if shares and shares[0][0] >= 0.2 and (len(shares) == 1 or shares[0][0] - shares[1][0] >= 0.02):
            want.add((d, -shares[0][1], round(shares[0][0], 6)))
    assert len(want) >= 3
    assert {tuple(r) for r in catalog.QUERIES["q30b_document_best_with_margin"](spark, tables).collect()} == want


def test_a_large_benchmark_is_taken_in_parts(spark, tables, monkeypatch):
    names = ("q23b_document_contamination", "q30b_document_best_with_margin")
    whole = [sorted(map(tuple, catalog.QUERIES[q](spark, tables).collect())) for q in names]
    monkeypatch.setattr(contamination, "MOST_BYTES", 30)
    assert [sorted(map(tuple, catalog.QUERIES[q](spark, tables).collect())) for q in names] == whole
