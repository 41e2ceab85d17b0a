from __future__ import annotations

import corpus_pipeline
from helpers import components, documents, prose, shingles
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, pieces, quality, secret_scan
from tallyloom.llm.tables import table


def test_stages_on_the_test_tables(spark, sf_dir):
    """The pipeline's rows against its operators used plainly, with the near-duplicate groups
    found by comparing all pairs."""
    docs = table(spark, sf_dir, "documents").filter("doc_id < 250")
    benchmark = table(spark, sf_dir, "benchmark")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.schema == docs.schema
    rows = {r.doc_id: r for r in kept.collect()}

    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] >= 0.3}
    roots = components({i: shingles(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    left = docs.filter(F.col("doc_id").isin(list(texts)))
    leaked = {r.doc for r in decontaminate.contaminations(left, benchmark).collect()}
    assert set(rows) == set(texts) - leaked
    for i, row in rows.items():
        base, more = secret_scan.scan(texts[i], secret_scan.EntropyRule())
        assert (row.text == texts[i]) == (not base and not more)
        assert row.n_chars == len(row.text)

    encoded = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    decoded = pieces.decode_ids(encoded, corpus_pipeline.PIECE_MODEL)
    assert {r.doc_id: r.text for r in decoded.collect()} == {i: r.text for i, r in rows.items()}


def test_odd_rows_pass_every_stage(spark, sf_dir):
    rows = [(1, None), (2, ""), (3, prose(1, 60)), (3, prose(1, 60)), (None, prose(2, 60)), (5, "é " * 30_000)]
    for frame in (documents(spark, rows, extra=True), documents(spark, [], extra=True)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, frame, sf_dir)
            assert made.schema == frame.schema
            assert {r.doc_id for r in made.collect()} <= {r.doc_id for r in frame.collect()}
        assert corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).count() == frame.count()
    # Rows without an id are no copy of anything and hold no leak that could be named.
    deduped = corpus_pipeline.near_dedup_stage(spark, documents(spark, rows), sf_dir)
    assert deduped.filter("doc_id is null").count() == 1
    clean = corpus_pipeline.decontamination_stage(spark, documents(spark, rows), sf_dir)
    assert clean.count() == len(rows)


def test_run_returns_encoded_documents(spark):
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert made.columns == ["doc_id", "ids", "n_ids", "round_trip"]
    assert made.filter("not round_trip").isEmpty() and made.count() > 50
