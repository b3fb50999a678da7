import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fogline.llm import language
from fogline.llm.queries import op4_language
from tests.conftest import SF

SOUNDS = {"aa": ["ka", "ru", "mi", "ton"], "bb": ["schl", "ung", "eit", "ver"], "cc": ["ció", "ado", "ñes", "que"]}


def made(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        words = ["".join(rnd.choices(SOUNDS[lang], k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(3, 60))]
        rows.append((i, " ".join(words), lang if i % 9 else None))
    return rows


def test_kernel_equals_brute_force():
    data = ["Abc abd", "abc abd!", "xyz", ""]
    sets = [
        np.unique(np.concatenate([s[v] for s, v in language.slots(*language.utf8(pa.array([t])))])).astype(np.int64) for t in data
    ]
    model = language.fit(["p", "p", "q"], sets[:3])
    got = model.kernel(model.presence(pa.array(data)))
    for i, a in enumerate(sets):
        a = a[np.isin(a, model.known)]
        for j, b in enumerate(sets[:3]):
            want = len(np.intersect1d(a, b)) / max(np.sqrt(len(a) * len(b)), 1)
            assert abs(got[i, j] - want) < 1e-5
    # N-grams stop at the end of a text.
    assert len(sets[2]) == 3 and got[0, 1] > 0.4


def test_held_out_accuracy(spark):
    rows = made(600, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language.learn(df, F.col("doc_id") % 3 != 1, sample=40)
    got = {r["doc_id"]: r for r in language.predict_language(df, model).collect()}
    asked = [r for r in rows if r[0] % 3 == 1 and r[2]]
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in asked) >= 0.95 * len(asked)
    again = {r["doc_id"]: r for r in language.predict_language(df, language.learn(df.coalesce(1), F.col("doc_id") % 3 != 1, sample=40)).collect()}
    assert {i: r["lang_pred"] for i, r in got.items()} == {i: r["lang_pred"] for i, r in again.items()}


def test_query_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op4_language(spark, SF).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.max("score").alias("m")).first()
    assert right["a"] >= 0.9 and right["m"] <= 1


def test_odd_rows(spark, odd, empty):
    model = language.learn(odd, F.lit(True))
    got = language.predict_language(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert all(r["lang_pred"] in ("en", "de", "fr", "es") for r in got if r["doc_id"] not in (None, 1, 2, 3))
    assert language.learn(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in language.predict_language(odd, None).collect()} == {"und"}
    assert language.predict_language(empty, model).count() == 0
