from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brokerflow.llm import fim
from brokerflow.llm.queries import fim_digests
from brokerflow.llm.text import utf8
from tests.llm.samples import empty, frame, rows

ODD = [
    "", None, "a", "é", "\U0001f600", "ab cd", "<P> is taken", "a<S>b", "x<M>", "<<S", "<P", "S><P", "a\x00b\n\r\n\x1c c", "漢字かな 12", "aé" * 40 + "\U0001f600b" * 30,
    "letters" * 3000, "<" * 50, "<S<P<M" * 9,
]


def slow(doc_id, text, unit="pieces"):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text) if unit == "pieces" else list(text)
    n = len(units)
    if doc_id is None:
        return None, n, "plain", None, None, text
    h = [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def held():
    return rows() + [(2000 + 17 * i + k, t) for i, t in enumerate(ODD) for k in range(12)] + [(None, "no id"), (7, "same id, other text")]


@pytest.mark.parametrize("unit", ["pieces", "chars"])
def test_output_equals_brute_force(spark, unit):
    got = fim.arrange(frame(spark, held()), unit).collect()
    wanted = [slow(i, t, unit) for i, t in held()]
    key = lambda r: tuple(map(repr, r))
    assert sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got], key=key) == sorted(wanted, key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        if r["form"] != "plain":
            text = r["output"][3:] if r["form"] == "psm" else r["output"].split("<P>")[1]
            assert r["prefix_bytes"] == len(text[: r["prefix_chars"]].encode())
            assert r["middle_bytes"] == len(r["output"].split("<M>")[1].encode())


def test_digests_are_of_output_and_of_the_text_again(spark):
    got = fim_digests(fim.arrange(frame(spark, held()))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = sorted((repr(i), sha(slow(i, t)[5]), sha(t or "")) for i, t in held())
    assert sorted((repr(r["doc_id"]), r["output_sha256"], r["restored_sha256"]) for r in got) == wanted


def test_index_holds_exceptions_alone_and_converts_both_ways():
    texts = [t or "" for t in ODD]
    data, offsets = utf8(pa.array(texts))
    index = fim.Exceptions(data)
    whole = "".join(texts)
    assert len(index.at) == sum(ord(c) > 127 for c in whole) and not len(fim.Exceptions(np.frombuffer(b"plain", np.uint8)).at)
    places = np.arange(len(whole) + 1)
    wanted = np.array([len(whole[:k].encode()) for k in places])
    assert (index.bytes(places) == wanted).all() and (index.chars(wanted) == places).all()


def test_bytes_that_are_no_utf8_do_not_end_the_run(spark):
    broken = frame(spark, [(i, "x") for i in range(40)]).withColumn("text", F.expr("cast(X'61FFE28061C3' as string)"))
    assert fim.arrange(broken.select("doc_id", "text")).select("n").distinct().count() == 1


def test_empty_table_and_other_marks(spark):
    assert fim.arrange(empty(spark)).count() == 0
    marks = fim.Marks("[[pre]]", "[[suf]]", "[[mid]]")
    docs = frame(spark, [(i, f"some <P> text é {i}") for i in range(60)])
    out = fim.arrange(docs, shares=fim.Shares(100, 50), marks=marks)
    assert {r["form"] for r in out.collect()} == {"psm", "spm"}
    back = out.select("doc_id", fim.restored(F.col("output"), F.col("form"), marks).cast("string").alias("text"))
    assert {tuple(r) for r in back.collect()} == {(i, f"some <P> text é {i}") for i in range(60)}
