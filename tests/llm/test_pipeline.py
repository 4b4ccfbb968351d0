"""The pipeline's stages against brute force on a small table."""

from test_near_dedup import expected as components
from test_exact_dedup import normal
from test_tokens import check_packing, plain  # noqa: F401

import corpus_pipeline
from ledgerloom.llm import language


def staged(docs, spark, upto):
    for name, stage in corpus_pipeline.STAGES[:upto]:
        docs = stage(spark, docs, "")
    return docs


def test_stages(docs_of, odd_rows, spark, plain):  # noqa: F811
    docs = docs_of(odd_rows + [(200 + i, f"satz nummer {i} mit worten " + "und noch mehr " * (i % 5), "de", "abc"[i % 3]) for i in range(40)])
    columns, rows = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = rows.collect()
        rows = stage(spark, rows, "").cache()
        after = rows.collect()
        assert rows.columns == columns, name
        texts = [r.text for r in after]
        if name == "language_id":
            lettered = [r.text for r in before if r.text and any(c.isalpha() for c in r.text)]
            gone = set(lettered) - set(texts)
            assert set(texts) <= set(lettered)
            scores = {r.doc_id: r.score for r in language.identify(docs).collect()}
            by_text = {r.text: r.doc_id for r in before}
            assert all(scores[by_text[t]] < language.LEAST_SCORE for t in gone) and len(gone) <= 2
        elif name == "exact_dedup":
            assert sorted(map(normal, texts)) == sorted({normal(r.text) for r in before})
        elif name == "near_dedup":
            stay = {c for _, n, c in components([(r.doc_id, r.text) for r in before])}
            assert {r.doc_id for r in after} == stay
        else:
            assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before}
            words = sum(len((r.text or "").split()) for r in before)
            largest = max(len((r.text or "").split()) for r in before)
            # whole documents up to the budget: what is left is less than the document that did not fit
            assert words - largest <= sum(len(t.split()) for t in texts) <= words
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
    assert sum(r.piece == 0 for r in packed) == rows.count()
    check_packing([(r.doc_id, r.text) for r in rows.collect()], packed, plain, 1024)


def test_run(spark):
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert made.count() > 0 and "sequence_id" in made.columns
