import random

from fogline.llm import toxicity as tx
from pyspark.sql import functions as F


def corpus(seed=4, n=900):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices(["ba", "do", "ki", "lu", "ne"], k=rnd.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        body = [word() for _ in range(rnd.randrange(10, 120))]
        bad = rnd.random() < 0.2
        if bad:
            for _ in range(rnd.randrange(1, 5)):
                body.insert(rnd.randrange(len(body)), rnd.choice(["gronk", "ZORT", "fleb" + word()]))
        docs.append((i, " ".join(body), rnd.choice(["en", "de"])))
        labels.append((i, int(bad)))
    return docs, labels


def test_folding():
    assert tx.folded_words("You 1d10t! м0rоn $tup1d tr4sh### 2024") == ["you", "idiot", "moron", "stupid", "trash"]
    assert tx.folded_words("") == [] and tx.folded_words("...") == []


def test_held_out_documents(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = tx.learn(df, marks, F.col("doc_id") % 3 != 1)
    assert {" gron", " zort", " fleb"} & set(lexicon.weights)
    got = {r["doc_id"]: r for r in tx.score_toxicity(df, lexicon).collect()}
    asked = [(i, t) for i, t in labels if i % 3 == 1]
    assert sum(got[i]["predicted"] == t for i, t in asked) >= 0.97 * len(asked)
    assert all((r["score"] >= tx.THRESHOLD) == bool(r["predicted"]) for r in got.values())


def test_weight_per_length_exceptions_and_disguise():
    lexicon = tx.Lexicon({" gronk": 5.0, " gronkle ": 7.0}, exceptions=("gronk stone",), curve=(-6.0, 1.0, 2.0))
    assert lexicon.hits("a GRONK b") == (5.0, 3)
    assert lexicon.hits("gronkle") == (7.0, 1) and lexicon.hits("xgronk") == (0.0, 1)
    assert lexicon.hits("the gronk stone, gr0nk") == (5.0, 4)
    assert lexicon.score("gronk a b") > lexicon.score("gronk" + " a" * 500) > lexicon.score("a " * 500)
    assert lexicon.score("") == lexicon.score("a") < 0.01


def test_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    marks = spark.createDataFrame([(None, 1, "x"), (4, 1, "x"), (4, 1, "x"), (5, None, "x"), (6, 3, "x"), (10, 0, "x"), (99, 1, "x")], "doc_id long, toxic int, text string")
    lexicon = tx.learn(odd, marks, F.lit(True))
    got = tx.score_toxicity(odd, lexicon, carry=("text", "lang", "label"))
    assert got.columns == ["doc_id", "text", "lang", "label", "score", "predicted"]
    assert got.count() == odd.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    for table in (odd, empty):
        assert tx.learn(table, none, F.lit(True)).weights == {}
    assert tx.score_toxicity(odd, tx.Lexicon({})).where("predicted = 1").count() == 0
    assert tx.score_toxicity(empty, lexicon).count() == 0
