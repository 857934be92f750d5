"""The pipeline on the smallest tables, each stage against what it promises."""

import corpus_pipeline as c
from pitfeat.checkpoints import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = c.table(spark, SF, "documents")
    columns, before = docs.columns, docs
    for name, stage in c.STAGES:
        after = cut_lineage(stage(spark, before, SF))
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name != c.STAGES[-1][0]:
            assert after.columns == columns
            assert after.exceptAll(before).count() == 0
        before = after
    assert before.where("not exact").count() == 0


def test_empty_table(spark):
    docs = c.table(spark, SF, "documents").limit(0)
    for name, stage in c.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_null_texts_and_repeated_rows(spark):
    docs = c.table(spark, SF, "documents")
    odd = spark.createDataFrame([(-1, None, None, None, None), (None, None, "en", "s", 0), (-2, "", "en", "s", 0)], docs.schema)
    before = docs.unionByName(docs.limit(30)).unionByName(odd)
    for name, stage in c.STAGES:
        after = cut_lineage(stage(spark, before, SF))
        assert after.count() <= before.count(), name
        before = after
    assert before.where("not exact").count() == 0
    kept = [r.doc_id for r in before.select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and not {-1, -2, None} & set(kept)
