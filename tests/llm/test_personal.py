"""Anchor expansion against the patterns themselves."""

from __future__ import annotations

import hashlib
import os
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from membervane.llm import personal
from membervane.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(digits[::-1]))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    kinds = list(PATTERNS)
    spans = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def of_base(text):
    return [s for s in personal.find(text) if s[0] in PATTERNS]


PIECES = st.sampled_from(["@", ".", "+", "-", " ", "(", ")", "a", "b.c", "x@y.de", "1", "25", "255", "256", "0.0", "4111 1111 1111 1111", "4111-1111", "+1 (743) 555-3824", "é", "İ", "😀", "\n", "_", "%", "٣", "00", "mailto:", "IBAN "])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert of_base(text) == base(text)


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="@.+- 0149ab(", max_size=60))
def test_base_spans_of_random_characters(text):
    assert of_base(text) == base(text)


def test_spans_beyond_the_base():
    text = "See http://anna:pw@host.example/x, http://10.0.0.7:80/a. and (tel:+49-30-1234567), IBAN: DE89 3704 0044 0532 0130 00; Account no. 12-345678."
    found = {(k, text[a:b]) for k, a, b in personal.find(text)}
    assert {("address", "http://anna:pw@host.example/x"), ("address", "http://10.0.0.7:80/a"), ("address", "tel:+49-30-1234567"), ("ip", "10.0.0.7"),
            ("account", "DE89 3704 0044 0532 0130 00"), ("account", "12-345678")} <= found
    clean = "On account of this, see https://example.com/page?id=12345678. IBAN DE89 3704 0044 0532 0130 01, account 12, accounts 1234567, subaccount 12345678x."
    assert personal.find(clean) == []


def test_long_texts_take_linear_time():
    """The patterns themselves would take minutes on these; shortened ones are compared."""
    for unit in ("@", "1.", "a@", "1 ", "+1", "+1(", "iban ", "http://", "a.b@c"):
        assert of_base(unit * 400) == base(unit * 400)
        begun = time.process_time()
        personal.find(unit * 60_000)
        assert time.process_time() - begun < 5


def test_documents(spark):
    texts = ["mail a@b.cd", None, "", "no data", "x" * 100_000 + " +1 (743) 555-3824", "mail a@b.cd"]
    rows = [(k if k < 5 else 0, t, "own") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(2)
    found = personal.find_spans(df).select("doc_id", personal.as_text(F.col("spans")).alias("s")).collect()
    assert sorted((r.doc_id, r.s) for r in found) == [(0, "email:5:11"), (0, "email:5:11"), (1, ""), (2, ""), (3, ""), (4, "phone:100001:100018")]
    assert personal.find_spans(df.where("false")).count() == 0
    told = {r.doc_id: r.text for r in personal.redact(df).collect()}
    assert told[0] == "mail <email>" and told[1] is None and told[4].endswith("x <phone>")


@pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are not there")
def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in llm_queries()["op12_anchor_expansion"](spark, SF).collect()}
    assert len(found) == len(docs) and sum(r.n_email for r in found.values()) > 0
    for doc in docs:
        spans, row = base(doc.text or ""), found[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in PATTERNS]
