"""Nothing is cut off: many languages, all scripts, small hosts."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioscale.llm import langid, linededup, topk, toxicity


def test_text_model_by_loops():
    rng = np.random.default_rng(3)
    words = {"a": "the of and", "b": "der die und", "c": "日本語 の 文", "d": "é è ê"}
    texts = {k: [" ".join(rng.choice(v.split(), 6)) for _ in range(5)] for k, v in words.items()}
    model = langid.TextModel(sorted(texts), texts)
    rows = [None, "", "xy", "the und 日本", "12 3", "die of é" * 300, "日本語"]
    got, n = model.score(pa.array(["skipped", *rows], pa.string()).slice(1))
    counts = {k: np.bincount(np.concatenate([langid._features(np.frombuffer(x.encode(), np.uint8)) for x in v]), minlength=langid.FEATURES) + langid.UNSEEN for k, v in texts.items()}
    for i, text in enumerate(rows):
        data = np.frombuffer((text or "").encode(), np.uint8)
        f = langid._features(data) if len(data) > 2 else np.zeros(0, np.int64)
        own = np.array([any(langid._FOLD[data[j : j + 3]] != 0x20) for j in range(len(f))], bool)
        assert n[i] == own.sum()
        for k, name in enumerate(model.languages):
            assert abs(got[i, k] - np.log(counts[name] / counts[name].sum())[f[own]].sum()) < 1e-3


def test_as_many_languages_as_there_are(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = np.random.default_rng(1)
    lexicon = {f"l{i:03d}": ["".join(rng.choice(list(letters), 7)) for _ in range(12)] for i in range(250)}
    rows = [(i * 1000 + j, " ".join(rng.choice(v, 25)), k) for i, (k, v) in enumerate(lexicon.items()) for j in range(8 if i else 400)]
    rows.append((999999, "zzqx zzqy zzqx", "once"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, sample=5, most=1255)
    assert len(model.languages) == 251
    none = F.lit(None).cast("string")
    got = langid.identify(df, model, F.col("doc_id"), F.col("text"), none, none, none, none)
    assert got.join(df.select("doc_id", F.col("lang").alias("own")), F.col("row_id") == F.col("doc_id")).filter("text_lang <> own or text_lang is null").count() == 0


def test_terms_of_all_scripts(spark):
    toxic = {"hi": "बेवकूफ", "zh": "混蛋", "th": "ไอ้โง่", "ru": "придурок", "en": "numbskull"}
    plain = {"hi": "यह एक अच्छा दिन है और हम", "zh": "今天天气很好我们去公园", "th": "วันนี้อากาศดีมาก", "ru": "сегодня хорошая погода и мы", "en": "what a lovely day it is"}
    rng, docs, labels = np.random.default_rng(2), [], []
    for i in range(600):
        lang = list(toxic)[i % 5]
        words = list(rng.permutation(plain[lang].split(" ")))
        bad = i % 3 == 0
        if bad:
            if lang in ("zh", "th"):  # inside a run of letters
                words[0] = words[0][:3] + toxic[lang] + words[0][3:]
            else:
                words.insert(int(rng.integers(0, len(words))), toxic[lang])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs.append((9000, "придурак"))  # one letter other
    docs.append((9001, "混" + "蛋" * 1))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score_toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(out[i].predicted == y for i, y in labels)
    assert out[9000].n_misspelled == 1 and out[9001].n_hits == 1


def test_a_host_of_two_pages_loses_its_menu(spark):
    pages = [(1, "http://two/a", "<p>menu</p><p>first</p>"), (2, "http://two/b", "<p>menu</p><p>second</p>"), (3, "http://one/a", "<p>menu</p><p>only</p>"), (4, "http://three/a", "<p>x</p><p>menu</p>"), (5, "http://three/b", "<p>y</p>"), (6, "http://three/c", "<p>y</p>")]
    got = {r.page_id: r.text for r in linededup.drop_boilerplate(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "first", 2: "second", 3: "menu\nonly", 4: "x\nmenu", 5: "", 6: ""}


def test_top_k_of_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i % 40), [float(x) for x in rng.integers(-3, 4, 2 + i % 2 * (i > 60))]) for i in range(160)]
    ints = [(i, [int(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q in (0, 20):
        own = min((len(v), v) for i, v in ints if i == q)[1]
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in ints if i != q and len(v) == len(own))[:6]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for n in (1, 3, 7):
        got = topk.top_k(df.repartition(n, "embedding"), k=6, every=20, pivots=4, part=30)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
