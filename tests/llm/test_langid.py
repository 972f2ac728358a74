from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from brokerflow.llm import langid
from tests.llm.samples import empty, frame, rows

SYLLABLES = {"aa": ["ka", "to", "mi", "re", "su"], "bb": ["bran", "gel", "ost", "urd"], "cc": ["zha", "qy", "xo", "vyj"]}


def prose(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(1)
    held = [(i, prose(r, lang, 60), lang) for i, lang in enumerate(list(SYLLABLES) * 40)] + [(900, None, "aa"), (901, "ka to", None)]
    return langid.fit(spark.createDataFrame(held, "doc_id long, text string, lang string"))


def guesses(spark, model, held):
    return {r["doc_id"]: r for r in langid.predict(frame(spark, held), model).collect()}


def test_pure_and_mixed_texts(spark, model):
    r = random.Random(2)
    held = [(i, prose(r, lang, 40)) for i, lang in enumerate(SYLLABLES)]
    held.append((10, prose(r, "aa", 60) + " " + prose(r, "bb", 30)))
    held += [(11, None), (12, ""), (13, "123 !? \n"), (14, "ЖЩ ЮЭ ЪЬ " * 30), (15, prose(r, "cc", 9000)), (15, prose(r, "cc", 9000))]
    got = guesses(spark, model, held)
    assert [got[i]["lang_pred"] for i in range(3)] == ["aa", "bb", "cc"] and all(got[i]["score"] > 0.95 for i in range(3))
    assert got[10]["lang_pred"] == "aa" and 0.45 < got[10]["score"] < 0.75 and "bb" in got[10]["shares"]
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (11, 12, 13))
    assert got[14]["unknown"] > 0.5 and got[14]["lang_pred"] in SYLLABLES
    assert got[15]["lang_pred"] == "cc"


def test_batched_em_equals_one_document_at_a_time(model):
    langs, table = model
    r = random.Random(4)
    texts = [prose(r, lang, r.randint(1, 30)) + " " + prose(r, other, r.randint(0, 20)) for lang in SYLLABLES for other in SYLLABLES]
    pairs, n = langid.ngrams(texts)
    doc, bucket = pairs // langid.BUCKETS, pairs % langid.BUCKETS
    together, _ = langid.select(doc, n.astype(np.float32), table.T[bucket], len(texts))
    for i, text in enumerate(texts):
        own, count = langid.ngrams([text])
        p, shares = table[:, own].astype(float), None
        best = None
        full = slow_em(p, count, list(range(len(langs) + 1)))
        order = np.argsort(-full, kind="stable").tolist()
        for k in range(1, len(order) + 1):
            shares = slow_em(p, count, order[:k])
            fit = (count * np.log(shares @ p)).sum()
            if best is None or fit > best[0] + 0.5 * np.log(max(2, count.sum())):
                best = (fit, shares)
            else:
                break
        assert np.allclose(best[1], together[i], atol=2e-3)


def slow_em(p, count, allowed):
    shares = np.zeros(len(p))
    shares[allowed] = 1 / len(allowed)
    for _ in range(langid.PASSES):
        joint = shares[:, None] * p
        shares = (joint / joint.sum(axis=0) * count).sum(axis=1) / count.sum()
    return shares


def test_a_text_in_no_language_gets_its_likeliest_one():
    """Where "no language" alone is selected, the name isn't that of the first language in the alphabet."""
    table = np.full((3, langid.BUCKETS), 1e-7, np.float32)
    table[1], table[2] = 2e-7, 1 / langid.BUCKETS
    text = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": ["ЖЩ ЮЭ ЪЬ " * 30]})
    (got,) = langid._guess(["aa", "bb"], table)(iter([text]))
    assert got.column("lang_pred").to_pylist() == ["bb"] and got.column("unknown")[0].as_py() > 0.99


def test_only_texts_in_a_known_language_stay(spark, model):
    r = random.Random(5)
    held = [(1, prose(r, "aa", 20)), (2, None), (3, "... 12"), (4, "ЖЩ ЮЭ ЪЬ " * 30), (None, prose(r, "bb", 3))]
    docs = frame(spark, held)
    got = langid.known(docs, model)
    assert got.columns == docs.columns and sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1]


def test_awkward_rows_and_no_model(spark, model):
    assert langid.predict(frame(spark, rows()), model).count() == len(rows())
    assert langid.predict(empty(spark), model).count() == 0
    none = langid.fit(empty(spark))
    assert none[0] == [] and {r["lang_pred"] for r in langid.predict(frame(spark, rows()), none).collect()} == {"und"}
