"""The pipeline's stages, each against what its operator says by itself or by brute force."""

import pytest
import xxhash

import __spark_entry__
import corpus_pipeline
from vacancia.llm import language
from vacancia.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = stored(table(spark, FOLDER, "documents"), "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), "step"))
    return out


def test_columns_and_counts(steps):
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns and step.schema == steps[0].schema
    counts = [s.count() for s in steps]
    assert all(a >= b > 0 for a, b in zip(counts, counts[1:], strict=False)) and counts[-1] == counts[-2]


def test_language_keeps_what_it_knows(steps):
    found = language.classify(steps[0], language.train(steps[0]))
    assert {r.doc_id for r in found.where("not rejected").collect()} == {r.doc_id for r in steps[1].collect()}


def test_near_copies_by_brute_force(steps):
    def bits(t):
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))

    prints = {r.doc_id: bits(r.text) for r in steps[2].collect()}
    root = {i: i for i in prints}
    near = [(a, b) for a, x in prints.items() for b, y in prints.items() if a < b and (x ^ y).bit_count() <= 2]
    for _ in prints:
        before = dict(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert {r.doc_id for r in steps[3].collect()} == set(root.values()) < set(prints)


def test_no_verbatim_item_is_left(spark, steps):
    items = [r.text.strip() for r in table(spark, FOLDER, "benchmark").collect()]
    dirty = {r.doc_id for r in steps[3].collect() if any(x in r.text for x in items)}
    assert {r.doc_id for r in steps[4].collect()} == {r.doc_id for r in steps[3].collect()} - dirty


def test_registered():
    found = __spark_entry__.queries()
    assert all(any(name.startswith(f"op{n}_") for name in found) for n in range(1, 14)) and "pipeline" in found
