"""The pipeline against brute force, stage by stage."""

import re

import corpus_pipeline
from farelane.llm import language_id, pii
from tests.llm.test_small import HARD, brute_classes, brute_exact, check_packing, library
from tests.llm.test_small import docs as small

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    rejected = dict(zip(rows.doc_id, model.predict([t or "" for t in rows.text])[2], strict=True))
    left = {i: t for i, t in zip(rows.doc_id, rows.text, strict=True) if not rejected[i]}
    assert len(left) >= 0.97 * len(rows)
    groups = brute_exact(left.items())
    left = {i: t for i, t in left.items() if any(min(g) == i for g in [groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")]])}
    kept = {min(ids) for ids in brute_classes(left.items()).values()}
    field = pii.trained()
    texts = {i: pii.redacted(t, pii.all_spans(t, field)[1]) for i, t in left.items() if i in kept}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == kept
    check_packing(out, texts)


def through(spark, docs, stages, at):
    for name, stage in stages:
        columns = docs.columns
        stage(spark, docs, None).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        assert name == "best_fit_packing" or docs.columns == columns
    return docs


def test_stages_on_hard_rows(spark, tmp_path):
    """Nulls, repeated ids and rows, empty and very long texts, a clashing column; no label, so the first stage has nothing to learn from."""
    rows = [*HARD, (50, "mail me@x.org now"), (51, "mail me@x.org now!")]
    docs = small(spark, rows, ["kept"])
    out = through(spark, docs, corpus_pipeline.STAGES[1:], str(tmp_path / "a")).collect()
    first = lambda groups: [min(ids, key=lambda i: (i is None, i)) for ids in groups]
    exact = brute_exact(rows)
    left = list(zip(first(exact.values()), exact, strict=True))
    assert sorted(map(str, {r["doc_id"] for r in out})) == sorted(map(str, set(first(brute_classes(left).values()))))
    assert sum(r["length"] for r in out if r["doc_id"] == 50) == len(library().encode("mail [EMAIL] now").ids) + 1
    assert through(spark, docs, corpus_pipeline.STAGES, str(tmp_path / "b")).count() == 0  # all are rejected
    assert through(spark, small(spark, []), corpus_pipeline.STAGES, str(tmp_path / "c")).count() == 0


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "pii", "best_fit_packing"]
