import hashlib
import re

from pyspark.sql import functions as F

from lendlens.llm.pii import KINDS, find_pii, op1_pii, redact

from . import cases
from ..conftest import SF_SMALL

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TRICKY = [
    "a@b.c_d@e.f x@y@z.w .@-.- a@b. a@b", "1.2.3.4.5.6.7.8 255.255.255.255 256.1.1.1 0000001.2.3.4 1.2.3",
    "4111 1111-1111 1111 4111111111111112 1 2 3", "+1 (234) 567-8901. +12 +1(2)3 + 1 +49 30 1234 5678 90123456",
    "é\U0001F600 +1 234 567 8901 \x01 4111111111111111\x02 a@b.co", "9" * 30 + " " + "5-" * 20, "a" * 5000 + "@", "a.b" * 400 + "@x.y",
    "1 " * 3000, "x@y.zz " * 700,
]


def luhn(d):
    v = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in v) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            out.append((KINDS.index(kind), m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def test_base_spans_of_tricky_texts(spark):
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(TRICKY)], cases.SCHEMA)
    for r in find_pii(df).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["pii"] if s["base"]] == brute(r["text"]), r["text"][:60]


def test_query_against_brute_force_without_python(spark):
    texts = {r["doc_id"]: r["text"] for r in cases.documents(spark).collect()}
    found = op1_pii(spark, SF_SMALL)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(b).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == i for s in b) for i in range(4)]
        assert set(listed(b).split(",")) <= set(r["spans"].split(",")) or not b


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(k, f"some words then call me +1 ({200 + k}) 555-{1000 + k} soon", "en", "a", 0) for k in range(20)]
    rows += [(100, "other words then call me 555-77123 soon", "en", "a", 0),  # no base shape
             (101, "please call me +49-30-77123456 soon", "en", "a", 0), (102, "room number 555-77123 soon", "en", "a", 0)]
    rows += [(200 + k, f"reach me via mail user{k}@host{k}.org today", "en", "a", 0) for k in range(20)]
    rows += [(300, "reach me via mail someone77@intranet today", "en", "a", 0), (301, "his handle is someone77@intranet today", "en", "a", 0)]
    # cards after "pay with"; a number that fails the Luhn test is a known negative
    rows += [(400, "pay with 4111111111111112 now", "en", "a", 0)]
    out = {r["doc_id"]: r["pii"] for r in find_pii(spark.createDataFrame(rows, cases.SCHEMA)).collect()}
    new = {i: [(KINDS[s["kind"]], s["value"]) for s in p if not s["base"]] for i, p in out.items()}
    assert new[300] == [("email", "someone77@intranet")] and not new[301]
    assert new[100] == [("phone", "555-77123")] and not new[400] and not new[102]


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é x a@b.co and +1 234 567 8901.", "en", "a", 0), (2, "clean", "en", "a", 0), (3, None, "en", "a", 0)], cases.SCHEMA)
    got = {r[0]: r[1] for r in find_pii(df).select("doc_id", redact(F.col("text"), F.col("pii"))).collect()}
    assert got == {1: "é x <EMAIL> and <PHONE>.", 2: "clean", 3: None}


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "pii", "pii_row", "pii_base", "new_row")
    rows = find_pii(df).collect()
    assert len(rows) == df.count() and all(r["pii"] == "own pii" and r["pii_"] is not None for r in rows)
    assert find_pii(cases.empty(spark)).count() == 0


def test_identifiers_written_with_blanks_and_many_unseen_instances(spark):
    rows = [(k, f"office {k % 7} phone: +44 20 7946 {1000 + k} today", "en", "a", 0) for k in range(10)]
    unseen = ["020 7946 0958", "01632960 983", "(020) 7946 0959", "020 - 7946 0957", "020-7946-0956", "0207946 0955"]
    rows += [(100 + k, f"office phone: {v}, today", "en", "a", 0) for k, v in enumerate(unseen)]
    rows += [(200, "office phone: 020 7946 0951abc", "en", "a", 0), (201, "in 2019, 2020 and 020 7946 0958", "en", "a", 0),
             (202, "server 10.0.0.1 8080 up", "en", "a", 0), (203, "1 " * 5000, "en", "a", 0)]
    # three seeds among many instances are no evidence
    rows += [(300 + k, f"order code +44 20 7946 {2000 + k} sent", "en", "a", 0) for k in range(3)]
    rows += [(400 + k, f"order code {7000000 + k} sent", "en", "a", 0) for k in range(60)]
    df = find_pii(spark.createDataFrame(rows, cases.SCHEMA)).select("doc_id", "pii", redact(F.col("text"), F.col("pii")).alias("clean"))
    out = {r["doc_id"]: r for r in df.collect()}
    for k in range(len(unseen)):
        assert out[100 + k]["clean"] == "office phone: <PHONE>, today", (unseen[k], out[100 + k])
    assert "7946" not in out[200]["clean"] or out[200]["clean"].endswith("0951abc")
    assert out[201]["clean"] == "in 2019, 2020 and 020 7946 0958" and out[202]["clean"] == "server <IP> 8080 up"
    assert not any(out[400 + k]["pii"] for k in range(60))
