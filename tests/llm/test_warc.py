from leafline.llm.warc import PERMITTED, canonical_url, resolve_revisits
from pyspark.sql import functions as F

SCHEMA = "record_id bigint, kind string, url string, at bigint, status int, etag string, last_modified bigint, headers map<string,string>, payload_sha256 string, payload_bytes bigint, canonical string"


def test_canonical_urls(spark):
    urls = {"http://WWW.a.org:80/x/?b=2&a=1&utm_x=3#f": "a.org/x?a=1&b=2", "https://a.org": "a.org", "//A.org/": "a.org", None: None, "": "", "https://a.org:443/X?ref=z": "a.org/X"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r["u"]: r["c"] for r in df.select("u", canonical_url(F.col("u")).alias("c")).collect()} == urls


def records():
    out = []
    for i in range(400):
        page, at = f"http://{'www.' * (i % 2)}h.org/{0 if i % 3 else i % 5}", i * 977 % 5000
        tag = [None, "a", "W/a", "b"][i % 4]
        if i % 5 < 2:
            out.append((i, "response", page, at, 200 if i % 7 else 206, tag, i % 2, {"etag": tag or "-", "server": str(i)}, f"sha{i}", i))
        else:
            out.append((i, "revisit", page, at, 304, tag, None if i % 6 else i % 2, {"date": str(at), "server": "no"}, None, None))
    out += [(1000, "revisit", None, 5, 304, "a", None, None, None, None), (1001, "revisit", "http://h.org/0", None, 304, "a", None, {}, None, None)]
    return out + out[:3]


def brute(rows):
    import re

    place = lambda u: None if u is None else re.sub(r"/+$", "", u.replace("http://", "").replace("www.", ""))
    full = [r for r in rows if r[1] == "response" and r[4] == 200]
    out = []
    for r in (r for r in rows if r[1] == "revisit"):
        before = [f for f in full if r[3] is not None and place(f[2]) == place(r[2]) and (f[3], f[0]) < (r[3], r[0])]
        of = max(before, key=lambda f: (f[3], f[0]), default=None)
        if of is None:
            what = "no_earlier_response"
        elif r[5] is None and r[6] is None:
            what = "no_validator"
        elif (r[5] is not None and of[5] is not None and r[5].removeprefix("W/") == of[5].removeprefix("W/")) or (r[5] is None and r[6] == of[6]):
            what = "resolved"
        else:
            what = "validator_mismatch"
        good = what == "resolved"
        merged = of[7] | {k: v for k, v in (r[7] or {}).items() if k in PERMITTED} if good else r[7]
        out.append(str((r[0], what, of[0] if good else None, None if merged is None else sorted(merged.items()), of[8] if good else None)))
    return sorted(out)


def test_as_brute_force_at_any_span(spark):
    rows = records()
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    for span in (86_400, 100, 1):
        done = resolve_revisits(df, span).collect()
        assert sorted(str((r["record_id"], r["outcome"], r["refers_to"], None if r["headers"] is None else sorted(r["headers"].items()), r["payload_sha256"])) for r in done) == brute(rows)


def test_empty_table(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []
