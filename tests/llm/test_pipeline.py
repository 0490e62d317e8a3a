"""The stages of the corpus pipeline on a small folder of tables."""

import pytest
from test_llm_ops import ODD, SF, classes_by_force, docs, secrets_by_force, shingles

import corpus_pipeline as cp
from tidemark.llm.common import table


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    have = table(spark, SF, "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in have.collect()] + [(i and i + 6000, t) for i, t in ODD] + [(7001, "token = abcdef123456 stays out"), (7002, "plain words only here")]
    docs(spark, rows).write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        table(spark, SF, t).write.parquet(f"{d}/{t}.parquet")
    return d, rows


def test_stages(spark, folder):
    d, _ = folder
    now = table(spark, d, "documents")
    columns = now.columns
    labels = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    items = [set(shingles(r.text)) for r in table(spark, d, "benchmark").collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, d)
        out.write.parquet(f"{d}/out-{name}")
        before, after = now.collect(), (out := spark.read.parquet(f"{d}/out-{name}")).collect()
        if name != "mix":
            assert out.columns == columns
        if name == "quality":
            good = [r for r in before if labels.get(r.doc_id) == 1]
            left = {r.doc_id for r in after}
            assert sum(r.doc_id in left for r in good) > 0.95 * len(good)
        if name == "neardup":
            rows = [(r.doc_id, r.text) for r in before if r.text and r.text.strip()]
            want = {}
            for (i, _), c in zip(rows, classes_by_force(rows)):
                want[c] = min((x for x in (want.get(c), i) if x is not None), default=None)
            assert sorted(map(str, want.values())) == sorted(str(r.doc_id) for r in after if r.text and r.text.strip())
            assert sum(not (r.text and r.text.strip()) for r in before) == sum(not (r.text and r.text.strip()) for r in after)
        if name == "decontaminate":
            bad = lambda t: any(len(s & set(shingles(t or ""))) >= 0.8 * len(s) for s in items)
            assert sorted(str(r.doc_id) for r in after) == sorted(str(r.doc_id) for r in before if not bad(r.text))
        if name == "secrets":
            old = {(r.doc_id, r.lang): r for r in before}
            assert len(after) == len(before)
            for r in after:
                was = old[r.doc_id, r.lang]
                assert r.n_chars == (None if r.text is None else len(r.text)) or r.text == was.text
                assert (r.text == was.text) or secrets_by_force(was.text)
                assert not secrets_by_force(r.text or "")
        if name == "mix":
            assert {r.doc_id for r in after} <= {r.doc_id for r in before} and out.columns[:5] == columns and after
        now = out
    assert k == 4


def test_run_and_empty(spark, folder, tmp_path):
    d, _ = folder
    for t in ("documents", "labels", "benchmark"):
        table(spark, d, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
