import corpus_pipeline as cp
from fogline.llm import toxicity
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup
from tests.test_session import gone, shuffle_files


def test_stages_equal_brute_force_on_the_rows_before_them(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    steps = {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF).cache()
        steps[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == list(cp.COLUMNS)
            assert docs.where("n_chars <> length(text)").count() == 0
    start = spark.read.parquet(f"{SF}/documents.parquet")

    lexicon = toxicity.learn(start, spark.read.parquet(f"{SF}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    assert sorted(text(steps["toxicity"])) == sorted((d, t) for d, t in text(start) if lexicon.score(t) < toxicity.THRESHOLD)

    before = text(steps["toxicity"])
    assert sorted(text(steps["line_dedup"])) == sorted((d, t) for d, _, _, t in test_line_dedup.brute(before, 40, 5))

    before = text(steps["line_dedup"])
    kept = {d for d, n, c in test_jaccard_join.brute(before) if d == c}
    assert sorted(text(steps["jaccard_join"])) == sorted(x for x in before if x[0] in kept)

    before = text(steps["jaccard_join"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    shared = {s for _, t in items for s in test_decontaminate.runs(test_decontaminate.words(t))}
    near = [x for x in before if shared & test_decontaminate.runs(test_decontaminate.words(x[1]))]
    bad = {d for d, _ in test_decontaminate.brute(near, items)}
    assert sorted(text(steps["decontaminate"])) == sorted(x for x in before if x[0] not in bad)

    mixed = steps["mix_sources"].collect()
    assert len(mixed) == steps["decontaminate"].count() and all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)


def test_odd_and_empty_tables(spark, odd, empty, tmp_path):
    for name, docs in (("odd", odd.select(*cp.COLUMNS)), ("empty", empty)):
        folder = f"file://{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(4, 1, 0), (10, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "no such words here at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = cp.run(spark, folder)
        assert got.count() == (0 if name == "empty" else len({c for d, n, c in test_jaccard_join.brute([(r["doc_id"], r["text"]) for r in docs.collect()]) if n}) + 4)


def test_a_written_stage_leaves_no_shuffle_files(spark, tmp_path):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), shuffle_files(spark)
    frame = cp.drop_near_copies(spark, docs, SF)
    frame.write.parquet(f"file://{tmp_path}/out")
    assert gone(spark, shuffle_files(spark) - before)
    assert frame.count() == len(frame.collect()) == len(frame.collect()) == spark.read.parquet(f"file://{tmp_path}/out").count()
