from pyspark.sql import functions as F

from tidepool.llm import langid
from tidepool.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op10_language_id"](spark, sf).join(docs, "doc_id")
    rows = found.filter("held_out AND lang_pred <> 'und'").agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert rows[0] > 150 and rows[1] >= 0.97 * rows[0]
    assert found.filter("score < 0 OR score > 1").count() == 0


def brute(text, model):
    """Word by word in plain Python."""
    words, logs = model["words"]
    names, gram_logs = model["grams"]
    known, total = dict(zip(words, logs)), [0.0] * len(model["langs"])
    by_gram = dict(zip(names, gram_logs))
    for w in langid.letter_words(text):
        row = known.get(w)
        for n in range(langid.LONGEST_GRAM, 0, -1):
            if row is None and (own := [by_gram[g] for g in langid.grams(w, n) if g in by_gram]):
                row = sum(own) / len(own)
        if row is not None:
            total = [a + float(b) for a, b in zip(total, row)]
    return model["langs"][max(range(len(total)), key=total.__getitem__)]


def test_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.train(docs.filter("doc_id % 2 = 0"), entries=3000)   # few entries, so that many words fall back
    rows = langid.predict(docs, model, keep=[F.col("doc_id"), F.col("text")]).collect()
    assert len(rows) == docs.count()
    assert all(r["lang_pred"] == brute(r["text"], model) for r in rows if r["has_letter"])


def test_fallback_to_shorter_grams():
    import numpy as np
    logs = np.array([[-1.0, -5.0]], "float32")
    model = {"langs": ["a", "b"], "words": (["known"], logs), "grams": (["xyz", "q"], np.array([[-9.0, -2.0], [-2.0, -9.0]], "float32"))}
    score = langid._Scorer(model)
    assert score("known")[0] == "a" and score("wxyzw")[0] == "b" and score("qq")[0] == "a"
    assert score("known wxyzw wxyzw")[0] == "b"
    assert score("ööö")[1] == 0.5            # nothing known: a tie goes to the first language
    assert score(None) == ("und", 0.0, False) == score("12 34 !") and score("")[0] == "und"


def test_edges(spark, edges, no_rows):
    model = langid.train(edges)
    found = langid.predict(edges, model, keep=[F.col("doc_id"), F.col("text")]).collect()
    assert len(found) == edges.count()
    und = sorted(r["doc_id"] for r in found if r["lang_pred"] == "und")
    assert und == [3, 4, 5, 6]
    assert langid.predict(edges, model).select("row.*").columns == edges.columns
    nothing = langid.train(no_rows)
    assert {r["lang_pred"] for r in langid.predict(edges, nothing).collect()} == {"und"}
    assert langid.predict(no_rows, model).count() == 0


def test_chosen_words_keep_their_counts_in_every_language(spark):
    """A word over the bound in one language has its true count in another where it is under it."""
    import numpy as np
    rows = [("both " * 90 + "hot " * 10, "a")] * 10 + [("both own own", "b")] * 3
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), entries=100)
    words, logs = model["words"]
    share = np.exp(logs[list(words).index("both")])
    assert abs(share[0] - 0.9) < 0.01 and abs(share[1] - 1 / 3) < 0.03


def test_small_language_keeps_its_words(spark):
    """The bound of the head is a share of each language's own words."""
    hot = " ".join(f"hot{c}{d}" for c in "abcdefgh" for d in "abcdefgh")
    rows = [(hot, "a")] * 400 + [("peto peta peti petu petu zaqu", "b")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), entries=20)
    assert "petu" in model["words"][0] and len(model["words"][0]) <= 20


def test_rare_words_count_as_words(spark):
    """lele was seen once, in b; its characters are those of a. Words outside the head are joined, unseen ones go by n-grams."""
    rows = [("le " * 50 + "hot", "a"), ("un " * 50 + "pet", "b")] * 40 + [("zaqa zaqe zaqi zaqo", "a")] * 3 + [("lele" + " un" * 11, "b")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), entries=4)
    assert "lele" not in model["words"][0]
    new = [("lele", "b"), ("zaqa", "a"), ("zaqy", "a"), ("zaqy lele un un", "b"), ("le", "a"), (None, "und"), ("!", "und")]
    found = langid.predict(spark.createDataFrame(new, "text string, want string"), model, keep=[F.col("want"), F.col("text")]).collect()
    assert len(found) == 7 and all(r["lang_pred"] == r["want"] for r in found), found


def test_both_ways_give_equal_rows(spark, small, monkeypatch):
    """Everything in the heads, or little of it and the rest joined, in one block or many."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    teach = docs.filter("doc_id % 3 <> 0")
    rows = lambda model: {r["doc_id"]: (r["lang_pred"], round(r["score"], 9), r["has_letter"])
                          for r in langid.predict(docs, model, keep=[F.col("doc_id")]).collect()}
    whole = langid.train(teach)
    assert whole["tables"] is None
    few = langid.train(teach, entries=400)
    assert few["tables"] is not None
    assert few["tables"][1] is not None       # n-grams are joined, too
    assert rows(few) == rows(whole)
    grams_only = {**few, "grams": whole["grams"], "tables": (few["tables"][0], None)}   # the head has all n-grams
    assert rows(grams_only) == rows(whole)
    blocks = langid._Blocks(3)
    monkeypatch.setattr(langid, "BLOCK_WORDS", 3)
    from collections import Counter
    assert blocks(Counter("a b a c".split())) == (3 << 32, 0, ["a", "b", "c"], [0, 1, 2], [2, 1, 1])
    assert blocks(Counter("d a".split())) == (3 << 32 | 1, 0, ["d", "a"], [0, 1], [1, 1])
    assert blocks(Counter("a e e".split())) == (3 << 32 | 1, 2, ["e"], [1, 2], [1, 2])
