"""Held-out accuracy, the shrinkage by hand, and defined results in odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, p double, host_posterior string"
LABELS = "doc_id long, quality int, toxic int, text string"


def made(n=240):
    """Prose in even rows, shouting in every fourth odd one; a rude word in every tenth row."""
    docs, labels = [], []
    for i in range(n):
        words = [f"w{(i * 7 + k * k) % 97}" for k in range(60)]
        text = " ".join(words) + "."
        bad = i % 4 == 1
        if bad:
            text = "!! ".join(w.upper() for w in words) + " %%% ### %%%"
        rude = i % 10 == 4
        if rude:
            text += " rudeness " * 3
        docs.append((i, text, "en", f"s{i % 3}", 0.5, "x"))
        labels.append((i, 0 if bad else 1, 1 if rude else 0, "x"))
    return docs, labels


def test_held_out_rows(spark, frame):
    docs, labels = made()
    got = {r.doc_id: r for r in quality.classify(frame(SCHEMA, docs), frame(LABELS, labels[:160])).collect()}
    assert len(got) == len(docs)
    for i, good, rude, _ in labels:
        assert got[i].keep == (good == 1 and rude == 0), (i, got[i])
    kept = quality.keep_good(frame(SCHEMA, docs), frame(LABELS, labels[:160]))
    assert kept.columns == frame(SCHEMA, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in got if got[i].keep]


def test_accuracy_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    train = F.crc32(F.col("doc_id").cast("string")) % 3 != 0
    got = quality.classify(docs, labels.where(train)).join(labels.where(~train), "doc_id").toPandas()
    wanted = (got.quality == 1) & (got.toxic == 0)
    assert len(got) > 100
    assert (got.keep == wanted).mean() > 0.88
    assert got.keep[wanted].mean() > 0.95


def test_shrinkage(spark, frame):
    rows = [(f"h{h}", f"p{k}", p) for h, n, p in ((0, 200, 0.9), (1, 200, 0.2), (2, 1, 0.0)) for k in range(2) for _ in range(n)]
    rows += [(None, None, 0.7)] * 5
    sites, mean = quality.site_posteriors(frame("h string, k string, p double", rows), "h", "k")
    got = {(r[0], r[1]): (r.host_posterior, r.path_posterior) for r in sites.collect()}
    assert mean == pytest.approx((np.sum([p for *_, p in rows]) + 0.5) / (len(rows) + 1))
    assert got["h0", "p0"][1] == pytest.approx(0.9, abs=0.02) and got["h1", "p1"][1] == pytest.approx(0.2, abs=0.02)
    assert 0.0 < got["h2", "p0"][1] < mean and got["h2", "p0"][1] > 0.05
    assert len(got) == 7 and (None, None) in got


def test_odd_rows(spark, frame):
    docs, labels = made(60)
    odd = [(900, None, None, None, 1.0, None), (901, "", "en", None, 1.0, None), (902, "?! ...", None, "s1", 1.0, None)]
    odd += [(None, docs[0][1], "en", "s0", 1.0, None), docs[0], (903, docs[0][1] * 400, "en", "s0", 1.0, None)]
    got = quality.classify(frame(SCHEMA, docs + odd), frame(LABELS, labels + [(None, 1, 1, "x"), (5, None, 0, "x")])).collect()
    assert len(got) == len(docs + odd)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert not any(by_id[i][0].keep for i in (900, 901, 902))
    assert [r.keep for r in by_id[0]] == [True, True] and by_id[None][0].keep


def test_no_labels_and_no_rows(spark, frame):
    docs, labels = made(12)
    assert all(r.keep for r in quality.classify(frame(SCHEMA, docs), frame(LABELS, [])).collect())
    assert quality.classify(frame(SCHEMA, []), frame(LABELS, labels)).count() == 0
    assert quality.keep_good(frame(SCHEMA, []), frame(LABELS, [])).count() == 0
