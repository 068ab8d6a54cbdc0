"""Held-out accuracy of the trained models, and their behaviour at the edges."""

import zlib

import numpy as np
import pytest

from tagloom.llm import language, quality, toxicity

from .conftest import SF

def held(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.fixture(scope="module")
def larger(spark):
    return "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark, larger):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = quality.op2_quality(spark, larger).collect()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    test = [r["predicted"] == labels[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(test) > 50 and np.mean(test) > 0.93


def test_quality_chunks_cover_the_whole_text(monkeypatch):
    network = quality.Network()
    text = "plain words here " * 40 + "odd!! odd!! odd!! odd!! " + "plain words here " * 40
    whole = network.pooled(text)[0]
    monkeypatch.setattr(quality, "CHUNK", 512)
    assert len(list(quality._chunks(text))) > 3
    assert np.allclose(network.pooled(text)[0], whole, rtol=0.2, atol=0.2)
    assert 0 <= network.score("") <= 1


def test_quality_messy_and_empty(messy, none):
    network = quality.Network().fit(["good words", "bad!! BAD!!"], [1, 0], epochs=1)
    got = quality.with_scores(messy, network)
    assert got.columns.count("score") == 1 and got.count() == 9
    assert got.where("score IS NULL").count() == 0
    assert quality.with_scores(none, network).count() == 0


def test_training_without_labels(spark, messy):
    labels = spark.createDataFrame([(3, None), (None, 1)], "doc_id long, quality int")
    assert 0 <= quality.train(messy, labels).score("text") <= 1
    assert toxicity.train(messy, labels.withColumnRenamed("quality", "toxic")).severity("text") < 1


def test_ordinal_thresholds_share_weights():
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for _ in range(600):
        grade = int(rng.integers(0, 3))
        text = " ".join([*rng.choice([f"w{i}" for i in range(200)], 40), *["awful"] * min(grade, 1), *["vile"] * (grade == 2)])
        rows.append(toxicity.features(text))
        grades.append(grade)
    cells, weights, thresholds, _ = toxicity.fit(toxicity.Rows.of(rows), np.array(grades), np.ones(600))
    model = toxicity.OrdinalModel(cells, weights, thresholds)
    assert thresholds[0] <= thresholds[1]
    assert model.severity("w1 w2") < 0.5 < model.severity("w1 awful") < 1.5 < model.severity("w1 awful vile")
    above = model.above("w1 awful")
    assert above[0] >= above[1] and model.severity("w1 awful") == pytest.approx(above.sum())


def test_features_of_long_texts(monkeypatch):
    text = "One two, two three; " * 50
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "STRETCH", 17)
    cut = toxicity.features(text)
    assert sorted(zip(*map(list, whole))) == sorted(zip(*map(list, cut)))
    assert len(toxicity.features("")[0]) == 0


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = {r["doc_id"]: r for r in toxicity.op5_toxicity(spark, folder).collect()}
    assert len(got) == len(langs) and all(r["held_out"] == held(i, 5, 0) and 0 <= r["severity"] <= 2 for i, r in got.items())
    test = [i for i, r in got.items() if r["held_out"] and labels.get(i) is not None]
    for lang in set(langs.values()):
        assert np.mean([got[i]["predicted"] for i in test if labels[i] == 1 and langs[i] == lang]) > 0.7
    assert np.mean([got[i]["predicted"] for i in test if labels[i] == 0]) < 0.02


def test_ordinal_fit_equals_a_plain_one(monkeypatch):
    """The plain version: dense arrays, ordinary proximal steps, the loss of each boundary written out."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(toxicity, "LIFT", 0.0)
    monkeypatch.setattr(toxicity, "RARE", 1)
    x = (rng.random((90, 12)) < 0.4) * rng.uniform(0.5, 2.0, (90, 12))
    grades = np.clip(np.round(x[:, 0] + x[:, 1] - x[:, 2] * 0.2 + rng.normal(0, 0.3, 90)), 0, 2).astype(int)
    rows = toxicity.Rows.of([(np.flatnonzero(r).astype(np.int32), r[r > 0].astype(np.float32)) for r in x])
    penalty = 5e-3
    cells, weights, thresholds, raw = toxicity.fit(rows, grades, np.ones(90), penalty, 4000)
    importance = 1.0 / np.bincount(grades)[grades] / 3
    w, cut = np.zeros(12), np.zeros(2)
    for _ in range(30_000):
        error = np.stack([(1 / (1 + np.exp(-(x @ w - c))) - (grades > k)) * importance for k, c in enumerate(cut)], axis=1)
        w = np.maximum(w - 0.1 * (x.T @ error.sum(axis=1)) - 0.1 * penalty, 0.0)
        cut = cut + 0.1 * error.sum(axis=0)
    full = np.zeros(12)
    full[cells] = weights
    assert np.allclose(full, w, atol=0.02) and np.allclose(thresholds, cut, atol=0.02) and np.allclose(raw, x @ full, atol=1e-4)


def test_best_cut_does_least_harm():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.3, 1.0):
        toxic = (rng.random(400) < 0.2).astype(int)
        severity = np.round(rng.random(400) * 0.6 + toxic * (rng.random(400) < share), 2)
        weight = rng.choice([0.25, 1.0], 400)

        def harm(cut):
            bad, clean = (weight[(toxic == k) & (severity >= cut)].sum() / weight[toxic == k].sum() for k in (1, 0))
            return (toxicity.WRONGED * clean - bad, clean)

        cuts = [c - 1e-9 for c in set(severity)] + [severity.max() + 1]
        least = min(harm(c)[0] for c in cuts if harm(c)[1] <= toxicity.REJECTED)
        got = harm(toxicity.best_cut(severity, toxic, weight))
        assert got[1] <= toxicity.REJECTED and got[0] == pytest.approx(least)


def test_toxicity_messy_and_empty(messy, none):
    model = toxicity.OrdinalModel(np.zeros(0, np.int32), np.zeros(0), np.array([1.0, 2.0]))
    got = toxicity.with_severity(messy.selectExpr("*", "doc_id AS scored"), model)
    assert got.where("NOT scored <=> doc_id").count() == 0
    assert got.count() == 9 and got.columns.count("score") == 1 and got.where("severity IS NULL").count() == 0
    assert toxicity.accepted(messy, model).columns == messy.columns
    assert toxicity.accepted(messy, model).count() == 9 and toxicity.accepted(none, model).count() == 0


def test_language_on_held_out_rows(spark, larger):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang").collect()}
    got = language.op9_language(spark, larger).collect()
    assert len(got) == len(langs) and all(r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in got if r["held_out"]]) > 0.98


def test_gram_vectors_bind_rotated_letters():
    space = language.Space(64)
    codes = [ord(c) for c in "the"]
    gram = codes[2] | codes[1] << 21 | codes[0] << 42
    expected = space.letter(codes[2]) * np.roll(space.letter(codes[1]), 1) * np.roll(space.letter(codes[0]), 2)
    assert (space.grams(np.array([gram]))[0] == expected).all()
    bundle = language.text_vector("the", space)
    assert (bundle % 2 == np.array([3 % 2] * 64)).all()  # three grams, each +1 or -1


def test_forgetful_space_gives_the_same_vectors(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog, ЖЗИ 日本語"
    whole = language.text_vector(text, language.Space(128))
    monkeypatch.setattr(language, "KEPT", 16)
    monkeypatch.setattr(language, "STRETCH", 10)
    assert (language.text_vector(text, language.Space(128)) == whole).all()


def test_language_messy_and_empty(spark, messy, none):
    profiles = language.train(messy, messy["doc_id"].isNotNull())
    assert profiles.names == ["de", "en"]
    got = {(r["doc_id"], r["text"]): r for r in language.identify(messy, profiles).collect()}
    assert got[5, None]["lang_pred"] == got[6, ""]["lang_pred"] == got[None, "   \t\n "]["lang_pred"] == "und"
    assert language.identify(messy, profiles).columns.count("score") == 1
    assert language.identify(none, profiles).count() == 0
    nothing = language.train(none, none["doc_id"].isNotNull())
    assert language.identify(messy, nothing).where("lang_pred = 'und'").count() == 9


def test_a_rare_language_of_a_large_table_has_a_profile(spark):
    late = spark.range(200_000).where("pmod(xxhash64(id), 1000000) > 990000").limit(3)  # a sample by hash would leave these out
    rare = late.selectExpr("id AS doc_id", "'zq kxw vrj qqx zzk xvw' AS text", "'rare' AS lang")
    docs = rare.union(spark.range(30_000).selectExpr("id + 1000000", "'these are common words'", "'en'"))
    profiles = language.train(docs, docs["doc_id"].isNotNull())
    assert profiles.names == ["en", "rare"]
    assert profiles.predict("kxw vrj zq", language.Space())[0] == "rare"
