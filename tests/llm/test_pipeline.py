import corpus_pipeline as c
from tidemark.llm import mixing, ngram_join, quality
from tidemark.llm.common import documents, saved

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, SF)
    columns, kept = docs.columns, {}
    for name, stage in c.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF), "test")
        assert docs.columns == columns or name == c.STAGES[-1][0]
        kept[name] = (before, docs)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = kept["quality classifier"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = ids(before.join(labels.filter("quality = 1"), "doc_id"))
    assert ids(after) < ids(before) and len(good & ids(after)) >= 0.95 * len(good)
    before, after = kept["n-gram Jaccard join"]
    classes = ngram_join.ngram_classes(before).collect()
    assert ids(after) == {r.doc_id for r in classes if r.doc_id == r.component_id}
    before, after = kept["mixing sources to target weights"]
    assert after.count() == sum(len(r.draws) for r in mixing.mix(before).collect())
    before, after = kept["BPE encoding and decoding"]
    assert after.count() == before.count() == c.run(spark, SF).count()
    assert quality.THRESHOLD == 0.3


KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_removed bigint, draws array<int>, component_id bigint"


def through(spark, rows):
    """Doc_ids after each stage, of rows (doc_id, text, source); further columns clash with names that stages use."""
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), 0.5, 7, [1], 9) for i, t, s in rows], KIND)
    out = []
    for name, stage in c.STAGES:
        columns, docs = docs.columns, saved(stage(spark, docs, SF), "test")
        assert docs.columns == columns or name == c.STAGES[-1][0]
        if name != c.STAGES[-1][0]:
            assert all((r.score, r.n_removed, r.draws, r.component_id) == (0.5, 7, [1], 9) for r in docs.collect())
        out.append(sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is None, x or 0)))
    return out


def test_stages_over_odd_tables(spark):
    assert through(spark, []) == [[]] * 5
    assert all(len(ids) <= 2 for ids in through(spark, [(None, None, None)] * 2))
    good = [r.text for r in documents(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").orderBy("doc_id").limit(6).collect()]
    rows = [(i, t, "s") for i, t in enumerate(good)] + [(0, good[0], "s"), (0, good[0], "s"), (None, good[1], None), (50, None, "s"), (51, "", "s"), (52, " \n ", None)]
    scored, lined, joined, mixed, encoded = through(spark, rows)
    assert set(range(6)) <= set(scored) and scored.count(0) in (2, 3)
    # of the copies of text 1 the one of the least id stays, and null is the least
    assert joined.count(0) == 1 and {0, 2, 3, 4, 5} <= set(joined) and joined.count(None) == 1 and 1 not in joined
    assert set(mixed) <= set(joined) and encoded == mixed
