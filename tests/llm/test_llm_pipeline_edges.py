"""The pipeline's stages on an empty table and on rows without text, given as frames that no file holds."""

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLEAN = "the first of the words that stand in a clean text are not the same as those of another one, " \
        "and so it is kept with all that it has to say about the things that it was written for"


def _run(spark, rows):
    docs, kept = spark.createDataFrame(rows, SCHEMA), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
        rows = [r.asDict() for r in docs.collect()]
        kept.append(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            docs = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    return kept


def test_pipeline_on_an_empty_table(spark):
    assert _run(spark, []) == [[]] * 5


def test_pipeline_on_nulls_and_copies(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, CLEAN, "en", "a", 1), (None, CLEAN, None, None, None), (2, CLEAN + " again", "en", "a", 1)]
    quality, exact, near, mixed, packed = _run(spark, rows)
    assert [r["text"] for r in quality].count(None) == 0 and len(quality) == 3
    assert sorted(str(r["doc_id"]) for r in exact) == ["2", "2"] and len(near) in (1, 2)
    assert {r["text"] for r in mixed} <= {r["text"] for r in near} and len(packed) >= len({r["text"] for r in mixed})
