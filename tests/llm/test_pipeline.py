"""The pipeline's stages against plain Python, each judged on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
from loanscope.llm import queries
from tests.llm.test_near_dedup import brute
from loanscope.llm.signature_join import Rule

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen, by_name = docs, dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]
    score = {r.doc_id: r.predicted for r in queries.quality(spark, sf_dir).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen.collect()
        seen = stage(spark, seen, sf_dir).cache()
        assert seen.columns == COLUMNS
        after = {r.doc_id: r.text for r in seen.collect()}
        if name == "quality":
            want = {r.doc_id for r in before if score[r.doc_id]}
        elif name == "exact_dedup":
            groups = {}
            for r in before:
                groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
            want = {min(g)[1] for g in groups.values()}
        elif name == "near_dedup":
            want = {i for i, (_, c) in brute([(r.doc_id, r.text) for r in before], Rule(5, 80)).items() if i == c}
        else:
            items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            want = {r.doc_id for r in before if not any(t in " ".join(re.findall(r"\w+", r.text.lower())) for t in items)}
        assert set(after) == want and len(after) == seen.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == len(after)


def test_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a word", None, None, None), (3, "word " * 30000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, sf_dir).collect()
