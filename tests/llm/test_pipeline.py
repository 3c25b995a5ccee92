"""The pipeline: each stage on what the one before kept, against what its operator says."""

import corpus_pipeline
from compare import SMALL

from sedimenta.llm import line_quality, simhash, suffix_dedup, toxicity
from sedimenta.llm.common import read_table, written


def test_each_stage_takes_effect_on_what_is_left(spark):
    docs = read_table(spark, SMALL, "documents")
    labels = read_table(spark, SMALL, "labels")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality classifier", "SimHash near-dedup", "suffix-array dedup", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    calm = written(stages["toxicity"](spark, docs, SMALL))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert ids(calm) == ids(scored.where(f"{toxicity.SCORE} < 0.5"))
    good = written(stages["quality classifier"](spark, calm, SMALL))
    scored = line_quality.score(calm, line_quality.fit(calm, labels))
    assert ids(good) == ids(scored.where(f"{line_quality.SCORE} >= 0.3"))
    single = written(stages["SimHash near-dedup"](spark, good, SMALL))
    assert ids(single) == ids(simhash.simhash_components(good).where("doc_id = component_id"))
    cut = written(stages["suffix-array dedup"](spark, single, SMALL))
    assert ids(cut) == ids(single) and cut.columns == docs.columns == single.columns
    sizes = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.digest(single).collect()}
    assert all(0 <= sizes[r.doc_id] - len((r.text or "").encode()) <= 6 for r in cut.collect())
    pieces = stages["packing"](spark, cut, SMALL).collect()
    assert sorted({p.doc_id for p in pieces}) == ids(cut)
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert {(p.doc_id, p.doc_tokens) for p in whole} == {(p.doc_id, p.doc_tokens) for p in pieces}
    assert sum(p.length for p in whole) == sum(p.length for p in pieces)


def tables(spark, folder, rows, labels):
    """A folder with documents, of columns that the stages use inside too, and their labels."""
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row long, spans string, fp long, "
                                "score double").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_nulls_repeats_and_clashing_columns(spark, lake):
    passage = "this long passage is in more than one of the texts and goes on and on " * 4
    texts = [None, "", " \n ", "alone here " * 30, passage + "first end of it", "second start " + passage, "=" * 900, "word", "same text twice",
             "same text twice"]
    rows = [(n, t, "en", "s", n, 7, "x", 8, 0.5) for n, t in enumerate(texts)]
    rows += [(None, "no id at all", None, None, None, None, None, None, None), rows[3], rows[3]]
    tables(spark, lake, rows, [(n, 1, 0) for n in range(8)] + [(None, 1, 0), (3, None, None), (77, 0, 1)])
    docs, kept = read_table(spark, lake, "documents"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, lake))
        kept = docs.collect()
        assert docs.columns == read_table(spark, lake, "documents").columns, name
        assert {r.doc_id for r in kept} <= {None, *range(10)}
    pieces = corpus_pipeline.run(spark, lake).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept}
    assert not {8, 9} <= {r.doc_id for r in kept}


def test_an_empty_table_gives_no_piece(spark, lake):
    tables(spark, lake, [], [])
    assert corpus_pipeline.run(spark, lake).count() == 0
