"""The pipeline stage by stage on a small table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import factors, jaccard
from lodestone.llm._common import table, written


@pytest.fixture(scope="module")
def stages(spark):
    sf, out = "/root/testdata/sf0.001", {}
    docs = out["documents"] = table(spark, sf, "documents")
    for name, f in corpus_pipeline.STAGES:
        docs = out[name] = written(f(spark, docs, sf), name)
    return out


def test_columns(stages):
    for name in ("quality_rules", "near_duplicates", "repeated_passages", "mix"):
        assert stages[name].columns == stages["documents"].columns
    assert stages["encode"].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_near_duplicates_are_gone(stages):
    members, _ = jaccard.similar(stages["near_duplicates"])
    assert members.where("doc_id <> component_id").count() == 0
    before, after = ({r.doc_id for r in stages[n].select("doc_id").collect()} for n in ("quality_rules", "near_duplicates"))
    keepers = {r.component_id for r in jaccard.similar(stages["quality_rules"])[0].collect()}
    assert after == keepers <= before


def test_passages_stay_once(stages):
    before, n = stages["near_duplicates"], factors.PASSAGE
    assert factors.deduplicated(before, min_length=n).agg({"n_removed": "sum"}).first()[0] > 0
    kept = {r.doc_id: r.text for r in stages["repeated_passages"].collect()}
    seen, left = set(), 0
    for r in sorted(before.collect(), key=lambda r: r.doc_id):
        raw = r.text.encode()
        own = {raw[i : i + n] for i in range(len(raw) - n + 1)}
        if not own & seen and len(own) == max(0, len(raw) - n + 1):
            left += 1
            assert kept[r.doc_id] == r.text
        seen |= own
    assert left > 50
    assert stages["repeated_passages"].where("n_chars <> length(text)").count() == 0


def test_a_text_goes_through_the_workers_once(stages):
    docs = stages["near_duplicates"]
    names = [*docs.columns, "c0", "kept_text"]
    docs = docs.withColumns({"c0": F.lit("a"), "kept_text": F.lit("b")}).select(names)
    out = factors.deduplicated(docs, min_length=factors.PASSAGE, keep="first", whole_rows=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert f"c{len(names) - 2}#" in plan and f"c{len(names) - 1}#" not in plan  # columns without the text
    assert out.columns == names
    assert {(r.c0, r.kept_text) for r in out.select("c0", "kept_text").distinct().collect()} == {("a", "b")}


def odd(spark):
    """Rows of one doc_id with two texts, repeated rows, null keys and texts, empty and blank texts, a long text, and clashing columns."""
    rng = random.Random(3)
    a, b, c = (" ".join(f"{x}{rng.randrange(900)}" for _ in range(60)) for x in "abc")
    long = " ".join(f"l{rng.randrange(9000)}" for _ in range(20_000))
    rows = [(1, a), (5, a), (5, b), (6, b + " tail"), (7, c), (7, c), (None, c), (None, long), (8, ""), (9, ""), (10, None), (11, " \n"), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("id", "name", "row", "times", "first", "spans", "c0", "kept", "_row", "copy", "digest"):
        df = df.withColumn(name, F.lit("x"))
    return df, (a, b, c, long)


def test_near_duplicates_keep_other_texts_of_a_doc_id(spark):
    df, (a, b, c, long) = odd(spark)
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter([(1, a), (5, b), (7, c), (None, long), (8, ""), (9, ""), (10, None), (11, " \n"), (None, None)])
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


def test_other_stages_on_odd_rows(spark, tmp_path):
    df, (a, b, c, long) = odd(spark)
    spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, df, str(tmp_path))
    assert kept.columns == df.columns and {r.text for r in kept.collect()} <= {a, b, b + " tail", c, long}
    cut = corpus_pipeline.repeated_passages(spark, df, str(tmp_path))
    assert cut.columns == df.columns
    # Whole later copies go; of 6, what follows the copy of b stays; empty texts have nothing left. The null doc_id comes first.
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == Counter([(1, a), (5, b), (6, " tail"), (None, c), (None, long), (11, " \n")])
    mixed = corpus_pipeline.mix(spark, df, str(tmp_path))
    assert mixed.columns == df.columns and {(r.doc_id, r.text) for r in mixed.collect()} <= {(r.doc_id, r.text) for r in df.collect()}
    assert corpus_pipeline.encode(spark, df, str(tmp_path)).count() == 13
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0, name


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == stages["encode"].count() == stages["mix"].count()
