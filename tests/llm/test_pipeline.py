"""The stages one by one against plain versions of what each decides."""

import os

import pytest

import corpus_pipeline
from millrace.llm import decontamination, quality
from millrace.session import materialise
from tests.llm.test_decontamination import plain_fit
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash import plain_fingerprint

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def linked_groups(docs):
    """Least id of the component of each document, by comparing all fingerprints."""
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    label = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and label[a] != label[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    return label


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
        left[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == columns
    good, single, clean, redacted, pieces = left.values()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    assert {r.doc_id for r in good} == {r.doc_id for r in judged.collect() if r.keep}
    assert all(r == before[r.doc_id] for r in good)
    assert {r.doc_id for r in single} == set(linked_groups(good).values())
    items = [decontamination.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = {r.doc_id: decontamination.words_of(r.text) for r in single}
    known = {r.doc_id for r in single} - {r.doc_id for r in clean}
    for i, own in words.items():
        joined = b" " + b" ".join(own) + b" "
        exact = any(b" " + b" ".join(item) + b" " in joined for item in items)
        assert (i in known) >= exact
        if i in known and not exact:
            assert any(plain_fit(item, own) <= 0.2 * len(item) for item in items)
    assert {r.doc_id for r in redacted} == {r.doc_id for r in clean}
    for r in redacted:
        assert not plain_base(r.text)
        assert r.text == before[r.doc_id].text or plain_base(before[r.doc_id].text)
        assert r.n_chars == len(r.text)
    tokens = {r.doc_id: r.doc_tokens for r in pieces}
    assert set(tokens) == {r.doc_id for r in redacted}
    assert sum(tokens.values()) == sum(r.length for r in pieces)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[0] == "doc_id"
