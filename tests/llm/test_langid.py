import pytest
from conftest import AWKWARD, SF_SMALL
from pyspark.sql import functions as F

from sitelens.llm import langid
from sitelens.llm.textops import remainder


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    apart = remainder("doc_id", 4) == 2
    model = langid.train(docs.filter(~apart))
    got = langid.predict(docs.filter(apart), model)
    n, right = got.count(), got.filter("lang = lang_pred").count()
    assert n > 20 and right >= 0.95 * n
    assert (model.table == 0).mean() > 0.5  # the first penalty keeps the weights sparse
    assert got.filter("lang_score < 0 OR lang_score > 1").isEmpty()


def test_prediction_reads_only_the_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs)
    plain = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    blind = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("lang_pred", F.lit("own"))
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(blind, model).collect()} == plain


def test_awkward_rows(spark, frame):
    docs = frame(AWKWARD).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))
    got = langid.predict(docs, langid.train(docs)).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        blank = not (r["text"] or "").strip()
        assert (r["lang_pred"] == "und") == blank and (r["lang_score"] == 0) == blank
    assert langid.accepted(langid.predict(docs, langid.train(docs))).filter("text IS NULL").isEmpty()


@pytest.mark.parametrize("labels", [[], [None, None], ["aa", "aa"]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(i, f"some text {i}", x) for i, x in enumerate(labels)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    new = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    r = langid.predict(new, model).first()
    assert (r["lang_pred"], r["lang_score"]) == (("aa", 1.0) if labels[:1] == ["aa"] else ("und", 0.0))
    assert langid.predict(new.limit(0), model).count() == 0


def test_temperature_lowers_the_loss():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.integers(0, 3, 500)
    logits = 8 * np.eye(3)[np.where(rng.random(500) < 0.7, truth, rng.integers(0, 3, 500))]
    assert langid.fitted_temperature(logits, truth) > 2


def test_every_label_is_learnt(spark, monkeypatch):
    rows = [(i, f"{chr(0x4E00 + i % 120) * 30} text", f"l{i % 120:03}") for i in range(120 * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert sorted(model.labels) == sorted({x for _, _, x in rows})
    monkeypatch.setattr(langid, "MOST_LABELS", 100)
    with pytest.raises(ValueError, match="labels"):
        langid.train(docs)


def plain_terms(text):
    """Counts of a text's n-grams by bucket, one n-gram after the other."""
    points, out = [ord(c) for c in text.lower()], {}
    for i in range(len(points)):
        h = 0
        for order in range(min(langid.ORDERS, len(points) - i)):
            h = (h * 31 + points[i + order] * int(langid._FACTORS[order])) % 2 ** 32
            bucket = (h ^ h >> 15) * int(langid._SALTS[order]) % 2 ** 32 >> 16
            out[bucket] = out.get(bucket, 0) + 1
    return out


def plain_model(docs, labels, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.1):
    """TF-IDF and follow-the-regularised-leader coordinate by coordinate; ``docs``: (label, text) in the order of the fit.
    Gives the logits of a text."""
    import math

    df = {}
    for _, text in docs:
        for t in plain_terms(text):
            df[t] = df.get(t, 0) + 1

    def vector(text):
        counts = plain_terms(text)
        total = sum(counts.values())
        return {t: c / total * (math.log((1 + len(docs)) / (1 + df.get(t, 0))) + 1) * langid._SCALE for t, c in counts.items()}

    z, n = {}, {}

    def weight(at, one=l1, two=l2):
        a = z.get(at, 0.0)
        return 0.0 if abs(a) <= one else ((1 if a > 0 else -1) * one - a) / ((beta + math.sqrt(n.get(at, 0.0))) / alpha + two)

    def logits(x):
        return [sum(v * weight((k, t)) for t, v in x.items()) + weight((k, None), 0.0, 0.0) for k in range(len(labels))]

    fit = [(label, vector(text)) for i, (label, text) in enumerate(docs) if i % 5]
    for _ in range(epochs):
        for label, x in fit:
            scores = logits(x)
            e = [math.exp(s - max(scores)) for s in scores]
            for k in range(len(labels)):
                error = e[k] / sum(e) - (labels[k] == label)
                for t, v, one, two in [*((t, v, l1, l2) for t, v in x.items()), (None, 1.0, 0.0, 0.0)]:
                    g, w, old = v * error, weight((k, t), one, two), n.get((k, t), 0.0)
                    z[k, t] = z.get((k, t), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                    n[k, t] = old + g * g
    return lambda text: logits(vector(text))


def test_model_equals_the_definition(spark):
    import math
    import random

    rng = random.Random(3)
    letters = {"aa": "abcdef ", "bb": "cdefgh ", "cc": "efghij 日"}
    text = lambda lang: "".join(rng.choices(letters[lang], k=rng.randint(5, 25))) + "."
    rows = [(i, text(lang), lang) for i, lang in enumerate(rng.choices(list(letters), k=40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 30))
    order = [(r["lang"], r["text"]) for r in docs.withColumn("draw", draw).orderBy("draw").collect()]
    labels = sorted(letters)
    model, plain = langid.train(docs), plain_model(order, labels)
    assert model.labels == labels
    new = [text(lang) for lang in labels for _ in range(10)] + [t for _, t, _ in rows]
    got = langid.predict(spark.createDataFrame(list(enumerate(new)), "doc_id long, text string"), model).collect()
    for r in got:
        logits = [s / model.temperature for s in plain(r["text"])]
        e = [math.exp(s - max(logits)) for s in logits]
        assert r["lang_pred"] == labels[e.index(max(e))] and r["lang_score"] == pytest.approx(max(e) / sum(e), abs=1e-4)


def test_texts_longer_than_a_slab(monkeypatch):
    import numpy as np

    text = "Zażółć 日本語 𝄞 abc" * 9
    whole = langid.term_counts(text)
    assert {int(t): int(whole[t]) for t in np.flatnonzero(whole)} == plain_terms(text)
    for slab in (1, 2, 7, len(text)):
        monkeypatch.setattr(langid, "_SLAB", slab)
        assert (langid.term_counts(text) == whole).all()


def test_all_terms_of_long_training_texts_count(spark):
    long = "".join(chr(0x4E00 + i * 7 % 20000) for i in range(40_000))
    docs = spark.createDataFrame([(i, long if i == 1 else f"plain words {i}", "aa" if i % 2 else "bb") for i in range(20)],
                                 "doc_id long, text string, lang string")
    import numpy as np

    _, rows = langid.training_sample(docs, "doc_id", "text", "lang", np.ones(langid.BUCKETS), langid.SAMPLE)
    assert sorted(len(at) for _, at, _ in rows)[-1] == (langid.term_counts(long) > 0).sum() > 20_000
