"""The ten operators and the pipeline: brute force on whole small tables, and hard rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioscale.llm import decontam, langid, license, linededup, mixing, neardup, pii, queries, sharding, tokens, topk, toxicity

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HARD = [None, "", " \n\t ", "a", "a b", "A  B", "É é a-b_c 1.5", "x" * 3000, "tie tie tie tie", "tie tie tie tie", " end"]


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="module")
def t(spark, small):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")


@pytest.mark.parametrize("kind, pattern", [("space", brute.SPACE), ("alnum", brute.ALNUM)])
def test_words(kind, pattern):
    column = pa.array(HARD * 3, pa.string())
    seen = {}
    for a, b, w in tokens.pieces(column, kind, most_bytes=50):
        h = w.hashes()
        for i in range(a, b):
            own = slice(w.rows[i - a], w.rows[i - a + 1])
            want = pattern.findall((column[i].as_py() or "").translate(brute.UP))
            got = [w.data[x:y].tobytes().decode() for x, y in zip(w.starts[own], w.ends[own], strict=True)]
            assert [g.translate(brute.UP) for g in got] == want
            for word, x in zip(want, h[own].tolist(), strict=True):
                assert seen.setdefault(word, x) == x
    assert len(set(seen.values())) == len(seen)


# 1


def test_topk(spark, small, t):
    vectors = rows(t("embeddings"), "vec_id", "embedding")
    assert rows(queries.op1_topk(spark, small)) == sorted(brute.top_k(vectors, 10, 100, 1024), key=repr)


def test_topk_hard(spark):
    random.seed(1)
    data = [(i, [random.choice([-0.5, 0.0, 0.5]) for _ in range(4)]) for i in range(150)] + [(i, [0.25] * 4) for i in range(150, 300)]
    data += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4), (304, [float("inf")] * 4), (None, [0.0] * 4), (400, [1.0, 2.0])]
    df = spark.createDataFrame([(a, b, 1) for a, b in data], "vec_id long, embedding array<float>, id int")
    assert rows(topk.top_k(df, k=7, every=20, pivots=5, part=40)) == sorted(brute.top_k(data, 7, 20, 1024), key=repr)
    assert topk.top_k(df.filter("vec_id < 0")).count() == 0
    assert rows(topk.top_k(df.filter("vec_id in (0, 3)"), k=5, every=100), "query_id", "vec_id") == [(0, 3)]


def test_mtree_avoids_distances():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.05, (300, 3)) for c in range(10)])
    tree = topk.MTree(x, np.arange(len(x)), page=16)
    q = np.full(3, 4.0)
    got = tree.search(q, 5, None, lambda r: -((x[r] - q) ** 2).sum(axis=1), -np.inf, lambda d: -(np.maximum(0, d) ** 2))
    assert [i for _, i in got] == np.argsort(((x - q) ** 2).sum(axis=1), kind="stable")[:5].tolist()
    assert tree.computed < len(x) / 4 and tree.avoided > 0


# 2


def test_neardup(spark, small, t):
    want = brute.near_duplicates(rows(t("documents"), "doc_id", "text"), 3, 85)
    assert rows(queries.op2_neardup(spark, small)) == sorted(want, key=repr)


def near_copies(n, words, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        c = list(base)
        for _ in range(rng.randint(0, max(1, words // 30))):
            c[rng.randrange(words)] = f"z{rng.randint(0, 9)}"
        out.append(" ".join(c))
    return out


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_neardup_hard(spark, k, percent):
    shared = " ".join(f"p{i}" for i in range(30))
    texts = HARD + near_copies(60, 12, 1) + near_copies(60, 90, 2) + near_copies(60, 300, 3) + [f"{shared} {' '.join(near_copies(1, 25, 50 + i))}" for i in range(60)]
    data = [(i, x) for i, x in enumerate(texts)] + [(None, texts[20]), (None, None), (5, "other text of five"), (20, texts[20]), (999, texts[-1])]
    df = spark.createDataFrame([(*d, 1, 2) for d in data], "doc_id long, text string, id int, root int")
    assert rows(neardup.near_duplicates(df, k, percent)) == sorted(brute.near_duplicates(data, k, percent), key=repr)


def test_neardup_links_of_large_groups(spark):
    """Clusters that drift from one base link by members whose roots share no open band."""
    rng, drifted = random.Random(0), []
    for c in range(8):
        order = rng.sample(range(300), 300)
        for i in range(14):
            n, words = rng.randint(11, 75) if i else 75, [f"b{p}" for p in range(300)]
            for p in order[:n]:
                words[p] = f"c{c}p{p}"
            drifted.append((-n, c, i, " ".join(words)))
    data = list(enumerate(x[-1] for x in sorted(drifted)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(neardup.near_duplicates(df, 1, 85)) == sorted(brute.near_duplicates(data, 1, 85), key=repr)


def test_neardup_short_texts_with_empty_bands(spark):
    rng, texts = random.Random(9), []
    for _ in range(2500):
        w = [f"v{rng.randint(0, 10**9)}" for _ in range(22)]
        texts += [" ".join(w[:19]), " ".join(w)]
    got = dict(rows(neardup.near_duplicates(docs_of(spark, texts), 3, 85), "doc_id", "component_id"))
    assert [i for i in range(0, 5000, 2) if got[i] != got[i + 1]] == []


def test_neardup_empty(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert neardup.drop_near_duplicates(docs_of(spark, ["a b c d e f", "a b c d e f", None])).count() == 2


def test_estimate_is_close():
    rng = np.random.default_rng(5)
    a, b, c = (rng.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2) for _ in range(3))
    x, y = np.unique(np.concatenate([a, b])), np.unique(np.concatenate([a, c]))
    j, n = neardup.estimate(neardup.registers(x)[None], neardup.registers(y)[None], np.array([len(x)]), np.array([len(y)]))
    assert abs(j[0] - 1 / 3) < 0.15 and n[0] == 128


def test_connected(spark):
    random.seed(2)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if find(x) != x}
    assert {r.id: r.root for r in neardup.connected(spark.createDataFrame(edges, "a long, b long")).collect()} == want


# 3


def test_license(spark, t):
    texts = HARD + ["MIT License, mit licenses. GNU General Public-License", "cc by cc by", "Licensed under the brand new Apache License, Version 2.0", "released under the mit license"]
    df = t("documents").select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + i, x) for i, x in enumerate(texts)], "doc_id long, text string"))
    df = df.unionByName(df.filter("doc_id >= 5000"))
    got = license.license_scan(df.withColumn("label", F.lit(1)).withColumn("h", F.lit(2)))
    want = []
    for d, x in rows(df, "doc_id", "text"):
        n, starts, labels = brute.base_places(x, license.BASE)
        want.append((d, n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    assert rows(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    by = {r.doc_id: r for r in got.collect()}
    at = 5000 + len(HARD)
    assert by[at + 2].labels == "apache,apache-2.0-notice" and 0.8 <= by[at + 2].score <= 1
    assert by[at + 3].labels == "mit,mit-notice" and by[5000].score == 0
    changed = docs_of(spark, [
        "released under some mit license",
        "Permission is hereby granted, gratis, to any person obtaining a copy of this software",
        "Redistribution and use in source and object forms, with or without modification, are permitted",
        "permission is hereby granted " + "and then some more words " * 4 + "free of charge to any person",
        "licensed under the license of the license under licensed",
    ])
    assert [r.labels for r in license.license_scan(changed).orderBy("doc_id").collect()] == ["mit,mit-notice", "mit-grant", "bsd-grant", "", ""]
    assert license.license_scan(spark.createDataFrame([], DOCS)).count() == 0


# 4


def test_mixing(spark, small, t):
    got = queries.op4_mixing(spark, small)
    assert rows(got) == rows(queries.op4_mixing(spark, small))
    docs = rows(t("documents"), "doc_id", "text", "source")
    size = {d: len(brute.SPACE.findall(x or "")) for d, x, _ in docs}
    source = {d: s for d, _, s in docs}
    sizes = collections.Counter()
    for d, s in source.items():
        sizes[s] += size[d]
    target, taken = brute.targets(sizes), collections.Counter()
    for r in got.collect():
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert -1e-6 <= target[s] - taken[s] <= 0.5 * max(x for d, x in size.items() if source[d] == s)


def test_mixing_hard(spark):
    texts = HARD + ["w " * n for n in (1, 1, 5, 40, 400)]
    df = docs_of(spark, texts).unionByName(docs_of(spark, ["q q q q"] * 5, 8)).withColumn("size", F.lit(1)).withColumn("target", F.lit(1))
    got = mixing.mix(df, weight=F.when(F.col("doc_id") % 2 == 0, 5.0))
    assert got.count() == df.count() and got.filter("taken > 3 * size or taken < 0").count() == 0
    sizes = {r.source: r.source_size for r in got.collect()}
    assert {r.source: round(r.target, 6) for r in got.collect()} == {s: round(x, 6) for s, x in brute.targets(sizes).items()}
    plain = df.drop("size", "target")
    copies = collections.Counter(r.doc_id for r in mixing.mixed(plain).collect())
    assert mixing.mixed(plain).columns == plain.columns and max(copies.values()) <= 6
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_targets_are_capped(spark):
    df = docs_of(spark, ["w " * 10, "w " * 1000, "w " * 5, None])
    got = {r.source: (r.source_size, r.target) for r in mixing.mix(df).collect()}
    want = brute.targets({s: x for s, (x, _) in got.items()})
    assert all(abs(y - want[s]) < 1e-6 for s, (_, y) in got.items())


# 5


def test_langid_held_out(spark, t):
    d = t("documents").filter("n_chars > 40")
    train, test = d.filter("doc_id % 3 <> 0"), d.filter("doc_id % 3 = 0")
    none = F.lit(None).cast("string")
    got = langid.identify(test, langid.fit(train), F.col("doc_id"), F.col("text"), none, none, none, none).join(test, F.col("row_id") == F.col("doc_id"))
    assert got.filter(F.col("text_lang") == test["lang"]).count() >= 0.97 * got.count()


def test_langid_pages(spark, t):
    got = langid.identify_pages(t("pages"), t("documents"))
    assert got.count() == t("pages").count() and got.filter("lang = declared").count() >= 0.9 * got.count()


def posterior(model, text_rows, declared, host):
    """What the operator says, by loops."""
    k = len(model.languages)
    ll, n = model.score(pa.array(text_rows, pa.string()))
    ll = ll / (1 + n / langid.EVIDENCE)[:, None]
    best = [int(x.argmax()) if m else None for x, m in zip(ll, n, strict=True)]
    count = lambda keep: np.array([sum(1 for i, b in enumerate(best) if b == c and keep(i)) for c in range(k)], float)
    every = (count(lambda i: True) + 1) / (sum(b is not None for b in best) + k)
    smooth = lambda c, p, w: (c + w * p) / (c.sum() + w)
    out = []
    for i in range(len(text_rows)):
        if best[i] is None:
            out.append(None)
            continue
        domain = smooth(count(lambda j: True), every, langid.DOMAIN_WEIGHT)
        log = ll[i] + np.log(smooth(count(lambda j: host[j] == host[i]), domain, langid.HOST_WEIGHT))  # noqa: B023
        for keep in (lambda j: (declared[j] or "") == (declared[i] or ""), lambda j: True):  # noqa: B023
            log = log + np.log(smooth(count(keep), every, langid.TABLE_WEIGHT) / every)
        p = np.exp(log - log.max())
        out.append((model.languages[int(p.argmax())], 1 / p.sum()))
    return out


def test_langid_fusion(spark, t):
    d = [tuple(r) for r in t("documents").orderBy("doc_id").limit(40).select("text", "lang").collect()]
    texts = [x[:60] for x, _ in d] + [None, "", "123 !!", "e"]
    declared = [la if i % 5 else None for i, (_, la) in enumerate(d)] + ["en"] * 4
    host = [f"h{i % 4}" for i in range(len(texts))]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(zip(texts, declared, host, strict=True))], "i int, t string, d string, h string")
    model = langid.fit(t("documents"), sample=50)
    none = F.lit(None).cast("string")
    got = {r.row_id: r for r in langid.identify(df, model, F.col("i"), F.col("t"), F.col("d"), none, F.col("h"), none).collect()}
    for i, want in enumerate(posterior(model, texts, declared, host)):
        assert got[i].lang == (want and want[0]) and abs(got[i].confidence - (want[1] if want else 0)) < 1e-6
        assert got[i].accepted == bool(want and want[1] >= langid.ACCEPT)
    empty = langid.identify(df.filter("i < 0"), model, F.col("i"), F.col("t"), F.col("d"), none, F.col("h"), none)
    assert empty.count() == 0
    assert langid.identify(df, langid.fit(t("documents").limit(0)), F.col("i"), F.col("t"), F.col("d"), none, F.col("h"), none).filter("accepted").count() == 0


# 6


def check_shards(plan, docs, shards):
    text = collections.Counter((d, zlib.crc32((x or "").encode()), len((x or "").encode()) + 16) for d, x in docs)
    assert collections.Counter((r.doc_id, r.text_crc32, r.size) for r in plan) == text
    slots = collections.defaultdict(list)
    for r in plan:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


def test_sharding(spark, small, t):
    plan = queries.op6_sharding(spark, small).collect()
    check_shards(plan, rows(t("documents"), "doc_id", "text"), 40)
    by = collections.Counter((r.shard, r.source) for r in plan)
    n = collections.Counter(r.source for r in plan)
    assert all(abs(by[(s, x)] - n[x] / 40) < 2 for s in range(40) for x in n)


def test_sharding_hard(spark, tmp_path):
    df = docs_of(spark, HARD).unionByName(docs_of(spark, ["same"] * 7)).unionByName(docs_of(spark, ["same"]))
    df = df.withColumn("rank", F.lit(1)).withColumn("n", F.lit(1)).withColumn("f", F.lit(1))
    for shards in (3, 40):
        check_shards(sharding.shard(df, shards).collect(), rows(df, "doc_id", "text"), shards)
    assert sharding.shard(spark.createDataFrame([], DOCS)).count() == 0
    plain = df.drop("rank", "n", "f")
    sharding.write_shards(plain, str(tmp_path / "out"), 3)
    assert rows(spark.read.parquet(str(tmp_path / "out")), *plain.columns) == rows(plain)


# 7


def kept_lines(pages, ratio, least):
    n, held, parsed = collections.Counter(), collections.Counter(), []
    for p, url, html in pages:
        m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", url or "")
        host, lines = (m[1].lower() if m else ""), brute.page_lines(html)
        n[host] += 1
        held.update((host, x) for x in set(lines))
        parsed.append((p, host, lines))
    out = []
    for p, host, lines in parsed:
        keep = [x for x in lines if not (held[(host, x)] >= least and held[(host, x)] > ratio * n[host])]
        out.append((p, host, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_linededup(spark, small, t):
    want = kept_lines(rows(t("pages"), "page_id", "url", "html"), linededup.RATIO, linededup.LEAST_PAGES)
    assert rows(queries.op7_linededup(spark, small)) == sorted(want, key=repr)


def test_linededup_hard(spark):
    html = "<p>Menu</p><script>x<y</script><p> a &amp; b </p>\n<p>Menu</p>"
    data = [(i, f"http://U@Host.com:80/{i}", html + f"<i>{i}</i>") for i in range(5)] + [(9, "http://other.com/", html), (10, None, None), (11, "nonsense", ""), (None, "http://host.com", "<b>Menu"), (4, "http://host.com/4", html + "<i>4</i>")]
    df = spark.createDataFrame([(*d, 1) for d in data], "page_id long, url string, html string, page int")
    assert rows(linededup.drop_boilerplate(df)) == sorted(kept_lines(data, 0.5, 3), key=repr)
    assert linededup.drop_boilerplate(df.limit(0)).count() == 0


# 8

DIGEST = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match")


def test_decontam(spark, small, t):
    want = brute.contamination(rows(t("documents"), "doc_id", "text"), rows(t("benchmark"), "item_id", "text"))
    assert rows(queries.op8_decontam(spark, small), *DIGEST) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_decontam_hard(spark, block):
    random.seed(4)
    word = lambda: random.choice("abcd")
    items = [(i, " ".join(word() for _ in range(random.choice([1, 2, 13, 14, 20])))) for i in range(12)] + [(90, None), (91, ""), (None, "zz yy"), (3, "extra words here")]
    texts = HARD + [" ".join(word() for _ in range(random.randint(0, 120))) for _ in range(40)] + ["x " + items[2][1] + ", y"] * 3
    d = [(i, x) for i, x in enumerate(texts)] + [(0, None), (2, "c"), (None, "a b")]
    docs = spark.createDataFrame([(*x, 1) for x in d], "doc_id long, text string, matches int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs, bench, block_bytes=block, shard_bytes=400)
    assert rows(got, *DIGEST) == sorted(brute.contamination(d, items), key=repr)
    assert decontam.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    # every match stands where it says, in both texts, and could not be longer
    words = lambda x: brute.ALNUM.findall((x or "").translate(brute.UP))
    for r in decontam.contamination(docs.filter("doc_id >= 11"), bench.filter("item_id <> 3"), block_bytes=block).collect():
        w = words(texts[r.doc_id])
        for m in r.matches:
            v = words(dict(items)[int(m.item)])
            assert w[m.at : m.at + m.words] == v[m.item_at : m.item_at + m.words]
            assert not (m.at and m.item_at and w[m.at - 1] == v[m.item_at - 1]) or len(v) < 13
            assert w[m.at + m.words : m.at + m.words + 1] != v[m.item_at + m.words : m.item_at + m.words + 1] or m.at + m.words == len(w) or m.item_at + m.words == len(v)


def test_decontam_keeps_rows_apart(spark):
    """Rows are judged by their own texts, whatever their ids."""
    bad = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, bad, 0), (1, "clean words", 1), (None, bad, 2), (None, "clean too", 3), (None, None, 4)], "doc_id long, text string, _key int")
    kept = decontam.drop_contaminated(docs, spark.createDataFrame([(7, bad)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r._key for r in kept.collect()) == [1, 3, 4]


def test_suffix_array():
    rng = np.random.default_rng(3)
    for depth in (1, 3, 40):
        sizes = rng.integers(0, 60, 12)
        words = rng.integers(0, 3, sizes.sum()).astype(np.uint64) + np.uint64(9)
        ends = np.repeat(np.cumsum(sizes), sizes)
        order, known, number = decontam.suffix_array(words, ends, depth)
        suffix = [tuple(number[p : min(ends[p], p + depth)]) for p in order]
        assert sorted(order.tolist()) == list(range(len(words))) and suffix == sorted(suffix) and (known[number] == words).all()


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens.Words, "hashes", lambda self: np.ones(len(self.starts), np.uint64))
    column = pa.array(["a b c", "x y z", "A-B-c"])
    test = decontam.TestSuffixes(["1"], ["a b c"], 2)
    _, _, words = next(tokens.pieces(column, "alnum"))
    # all words share a hash here, so only those of the test word that keeps it are left
    assert {r for r in decontam.matches(words, test)[0].tolist()} == set()


# 9


def test_toxicity(spark):
    """Only rows whose labels were never learned from are judged."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    r = toxicity.score_toxicity(docs, labels).collect()
    label = {}
    for d, y in rows(labels, "doc_id", "toxic"):
        label[d] = max(y, label.get(d, 0))
    assert len(r) == docs.count() and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in r)
    judged = [(x.predicted, label[x.doc_id]) for x in r if x.held_out and x.doc_id in label]
    assert len(judged) > 40 and sum(a == b for a, b in judged) >= 0.9 * len(judged)
    # the held-out labels change nothing
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows(toxicity.score_toxicity(docs, other), "doc_id", "score") == rows(toxicity.score_toxicity(docs, labels), "doc_id", "score")


def test_toxicity_hits_by_brute_force(t):
    """Plain, misspelled and quoted hits of whole texts, by comparing every word with every entry."""
    entries = ["idiot", "moron", "worthless", "vile*", "scum"]
    long = "fine words " * 20_000 + "you idoit and " + "more fine words " * 20_000 + "worthles scum"
    texts = [x for x, in rows(t("documents").filter("text is not null"), "text")][:60] + ["", None, "idiot", long, 'they said "total moron" there', "vilest mroon, MORON; (scum)", "scum " * 3]
    _, counts = toxicity.Scorer(entries, np.ones(5)).features(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        want = [0, 0, 0]
        low = (text or "").translate(brute.UP)
        for m in brute.ALNUM.finditer(re.sub("[\u2000-\u206f\u00a0-\u00bf]", " ", low)):
            w = m[0].lower()
            near = min(((brute.edit_distance(w, e), e) for e in entries if not e.endswith("*") and abs(len(e) - len(w)) <= 1 and (len(e) >= 5 or w == e)), default=(9, ""))
            begun = any(w.startswith(e[:-1]) for e in entries if e.endswith("*"))
            if near[0] > 1 and not begun:
                continue
            before = brute.ALNUM.split(low[: m.start()])[-7:]
            behind = brute.ALNUM.split(low[m.end() :])[:7]
            cited = "".join(before).count('"') % 2 == 1 and '"' in "".join(behind)
            want[2 if cited else 1 if near[0] == 1 else 0] += 1
        assert counts[n].tolist() == want, text


def test_toxicity_hard(spark):
    docs = docs_of(spark, [*HARD, "you idiot", "you idiot"]).unionByName(docs_of(spark, ["you idiot", None], 11))
    labels = spark.createDataFrame([(i, 0, int(i in (11, 12))) for i in range(13)] + [(11, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs.withColumn("score", F.lit(1)), labels)
    assert got.count() == docs.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    by = {r.doc_id: set() for r in got.collect()}
    for r in got.collect():
        by[r.doc_id].add(r.score)
    assert len(by[11]) == 1 and by[0] == by[1] == by[2]
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_automaton():
    entries = ["idiot", "moron", "scum", "worthless", "vile*"]
    auto = toxicity.Automaton(entries)
    random.seed(7)
    words = {"idiot", "vilest", "scums", "vil", "idiotic", ""} - {""}
    for w in entries:
        for _ in range(300):
            x = list(w.rstrip("*"))
            for _ in range(random.randint(0, 2)):
                i, kind = random.randrange(len(x) + 1), random.randint(0, 3)
                if kind == 0:
                    x.insert(i, random.choice("abcdioé"))
                elif kind == 1 and i < len(x):
                    x.pop(i)
                elif kind == 2 and i < len(x):
                    x[i] = random.choice("xyz1é")
                elif i + 1 < len(x):
                    x[i], x[i + 1] = x[i + 1], x[i]
            if x:
                words.add("".join(x))
    words = sorted(words)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    w = tokens.Words(data, np.array([0, len(data)]), "space")
    codes, before = toxicity.char_codes(data)
    hit, entry, edits = auto.run(codes, before[w.starts], before[w.ends])
    got = {words[i]: (entries[e], int(d)) for i, e, d in zip(hit, entry, edits, strict=True)}
    for x in words:
        near = [(brute.edit_distance(x, e), n, e) for n, e in enumerate(entries) if not e.endswith("*") and (x == e or len(e) >= toxicity.FUZZY_FROM)]
        near = [v for v in near if v[0] <= 1]
        begun = next((e for e in entries if e.endswith("*") and x.startswith(e[:-1])), None)
        assert got.get(x) == ((min(near)[2], min(near)[0]) if near else (begun, 0) if begun else None), x


def test_learned_terms_match_misspelled():
    texts = [f"you {w} go away" for w in ("idiot", "moron", "stupid", "trash") for _ in range(5)] + ["they went for a walk"] * 60
    entries, weights = toxicity.learn_entries(texts, np.array([1.0] * 20 + [0.0] * 60))
    _, counts = toxicity.Scorer(entries, weights).features(pa.array(["idoit", "mroon", "sutpid", "tarsh", "stpuid", "walk", "idiot"]))
    assert counts[:, 1].tolist() == [1, 1, 1, 1, 1, 0, 0] and counts[6, 0] == 1


def test_quotation(spark):
    texts = ['he said "you idiot" to them', "you idiot go away", "“what an idiot” they wrote", "idiot", None, ""]
    scorer = toxicity.Scorer(["idiot"], np.array([3.0]))
    _, counts = scorer.features(pa.array(texts, pa.string()))
    assert counts[:, 2].tolist() == [1, 0, 1, 0, 0, 0] and counts[:, 0].tolist() == [0, 1, 0, 1, 0, 0]
    docs = docs_of(spark, texts)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, none).collect()
    assert len(got) == 6 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)


# 10


def luhn_ok(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def test_pii_round_trip(spark, t):
    texts = HARD + ["4111 1111 1111 1111 and 4111111111111112", "call +1 (499) 555-6503.", "10.0.0.255, 300.1.1.1", "078-05-1120 000-12-3456", "2024-02-29 2023-02-30 31.12.1999 12/31/1999 25/12/2020", "a 4111 1111 1111 1111\nb"]
    df = t("documents").select("doc_id", "text").unionByName(spark.createDataFrame([(7000 + i, x) for i, x in enumerate(texts)], "doc_id long, text string"))
    out = pii.pseudonymize(df.withColumn("found", F.lit(1)), "key").cache()
    back = pii.pseudonymize(out.select("doc_id", "text"), "key", back=True)
    assert rows(back, "doc_id", "text") == rows(df, "doc_id", "text")
    r = {x.doc_id: x for x in out.collect()}
    at = 7000 + len(HARD)
    assert (r[at].n_card, r[at].n_found) == (1, 1) and r[at].text.endswith("4111111111111112") and luhn_ok(r[at].text[:19]) and not r[at].text.startswith("4111 1111 1111 1111")
    assert r[at].text[:19] == r[at + 5].text[2:21]
    assert r[at + 1].n_phone == 1 and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}\.", r[at + 1].text)
    assert r[at + 2].n_ip == 1 and r[at + 2].text.endswith(", 300.1.1.1") and all(int(x) < 256 for x in r[at + 2].text.split(",")[0].split("."))
    assert r[at + 3].n_ssn == 1 and r[at + 3].text.endswith(" 000-12-3456")
    assert r[at + 4].n_date == 4 and " 2023-02-30 " in r[at + 4].text
    assert pii.pseudonymize(df.limit(0), "key").count() == 0


def test_dates_are_permuted_in_their_form(spark):
    """Every date of a form turns into another of that form, no two into one, and back."""
    days = spark.range(0, pii.DAYS, 7).select(F.date_add(F.to_date(F.lit(pii.DATE_FROM)), F.col("id").cast("int")).alias("day"))
    forms = [f"concat({a}, '{mark}', {b}, '{mark}', date_format(day, 'yyyy'))" for mark in "./" for a in ("date_format(day, 'd')", "date_format(day, 'dd')", "date_format(day, 'M')", "date_format(day, 'MM')") for b in ("date_format(day, 'M')", "date_format(day, 'MM')", "date_format(day, 'd')", "date_format(day, 'dd')") if ("d" in a.split(",")[1]) != ("d" in b.split(",")[1])]
    texts = days.select(F.explode(F.array(*[F.expr(f) for f in [*forms, "date_format(day, 'yyyy-MM-dd')"]])).alias("text")).distinct().union(spark.createDataFrame([("29.2.2024",), ("29/2/2000",), ("2/29/2096",), ("02/29/1804",)], "text string")).distinct()
    docs = texts.select(F.xxhash64("text").alias("doc_id"), "text")
    out = pii.pseudonymize(docs, "key").cache()
    assert out.filter("n_date = 1").select("text").distinct().count() == out.filter("n_date = 1").count() > 100_000
    assert out.join(docs.withColumnRenamed("text", "was"), "doc_id").filter("regexp_replace(text, '[0-9]', '9') <> regexp_replace(was, '[0-9]', '9') or n_date = 0 and text <> was").count() == 0
    assert pii.pseudonymize(out.select("doc_id", "text"), "key", back=True).select("doc_id", "text").exceptAll(docs).count() == 0


def test_national_phone_numbers(spark):
    docs = docs_of(spark, ["call 212-555-0100 now", "212.555.0100", "(212) 555-0100", "212 555 0100 9", "1212-555-0100", "4111 1111 1111 1111"])
    got = {r.doc_id: r for r in pii.pseudonymize(docs, "key").collect()}
    assert [got[i].n_phone for i in range(6)] == [1, 1, 1, 1, 0, 0] and re.fullmatch(r"call \d{3}-\d{3}-\d{4} now", got[0].text)


def plain_feistel(left, right, a, b, key, kind):
    """The network by plain arithmetic."""
    import hashlib

    digest = lambda r, v: int(hashlib.sha256(f"{key}|{kind}|{r}|{v}".encode()).hexdigest()[:15], 16)
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            left = (left + digest(r, right) % a) % a
        else:
            right = (right + digest(r, left) % b) % b
    return left, right


def test_pii_by_brute_force(spark):
    import datetime

    values = ["4111111111111111", "5500005555555559", "10.0.0.255", "255.255.255.255", "078-05-1120", "667-01-0001", "2024-02-29", "1800-01-01", "2199-12-31", "(212) 555-0100"]
    want = []
    for v in values:
        d = re.sub(r"\D", "", v)
        if len(d) == 16:
            l, r = plain_feistel(int(d[:7]), int(d[7:15]), 10**7, 10**8, "key", "card")
            p = f"{l:07d}{r:08d}"
            want.append(next(p + c for c in "0123456789" if luhn_ok(p + c)))
        elif "." in v:
            o = list(map(int, v.split(".")))
            l, r = plain_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "key", "ip")
            want.append(f"{l // 256}.{l % 256}.{r // 256}.{r % 256}")
        elif v.startswith("("):
            l, r = plain_feistel(int(d[:5]), int(d[5:]), 10**5, 10**5, "key", "phone")
            p = f"{l:05d}{r:05d}"
            want.append(f"({p[:3]}) {p[3:6]}-{p[6:]}")
        elif re.match(r"\d{3}-", v):
            areas = [x for x in range(1, 900) if x != 666]
            l, r = plain_feistel(areas.index(int(d[:3])) * 99 + int(d[3:5]) - 1, int(d[5:]) - 1, 898 * 99, 9999, "key", "ssn")
            want.append(f"{areas[l // 99]:03d}-{l % 99 + 1:02d}-{r + 1:04d}")
        else:
            first = datetime.date(1800, 1, 1)
            n = (datetime.date.fromisoformat(v) - first).days
            l, r = plain_feistel(n // 773, n % 773, 189, 773, "key", "date")
            want.append((first + datetime.timedelta(l * 773 + r)).isoformat())
    got = {r.doc_id: r.text for r in pii.pseudonymize(docs_of(spark, values), "key").collect()}
    assert [got[i] for i in range(len(values))] == want
    long = "word " * 30_000 + "10.0.0.255" + " word" * 30_000
    twice = docs_of(spark, [long]).unionByName(docs_of(spark, [long]))
    assert {(r.n_ip, r.text.count(want[2])) for r in pii.pseudonymize(twice, "key").collect()} == {(1, 1)}


def test_feistel_is_a_permutation(spark):
    n = spark.range(627 * 5).select(pii.feistel(F.floor(F.col("id") / 5), F.col("id") % 5, F.lit(627).cast("long"), F.lit(5).cast("long"), "k", "x").alias("y"))
    assert n.distinct().count() == 627 * 5
    other = spark.range(200).select(pii.permute_digits(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "x").alias("a"), pii.permute_digits(F.lpad(F.col("id").cast("string"), 3, "0"), "q", "x").alias("b"))
    assert other.filter("a = b").count() < 20 and other.select("a").distinct().count() == 200


# the pipeline


def test_pipeline(spark, small, t):
    """Each stage against what it was given."""
    docs = t("documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "mix_sources", "shard"]
    first = corpus_pipeline.language_id(spark, docs, small)
    assert first.columns == docs.columns and first.count() >= 0.95 * docs.count()
    second = corpus_pipeline.near_dedup(spark, first, small)
    data = rows(first, "doc_id", "text")
    assert rows(second, "doc_id") == sorted([(d,) for d, _, _, kept in brute.near_duplicates(data, 5, 80) if kept], key=repr)
    third = corpus_pipeline.decontaminate(spark, second, small)
    clean = [(r[0],) for r in brute.contamination(rows(second, "doc_id", "text"), rows(t("benchmark"), "item_id", "text")) if not r[5]]
    assert rows(third, "doc_id") == sorted(clean, key=repr)
    fourth = corpus_pipeline.mix_sources(spark, third, small)
    copies = {r.doc_id: r.copies for r in mixing.mix(third).collect()}
    assert collections.Counter(r.doc_id for r in fourth.collect()) == collections.Counter({d: n for d, n in copies.items() if n})
    final = corpus_pipeline.shard(spark, fourth, small).collect()
    check_shards(final, rows(fourth, "doc_id", "text"), 40)
    assert len(corpus_pipeline.run(spark, small).collect()) == len(final)


def test_stages_with_repeated_rows_and_clashing_columns(spark, small):
    """Rows of equal id and text keep their copies; user columns keep their values, whatever they are called."""
    names = "_k _n _id _u _copies _key _gone row k copies turn copy size target weight q extra rank before".split()
    texts = ["words of the mix go on and on " * 3, "one two three four five six seven eight", "short one here now", "words of the mix go on and on " * 9]
    data = [(d, x, "en", s, len(x), *[f"{n}{i}" for n in names]) for i, (d, x, s) in enumerate([(d, x, s) for d, x in enumerate(texts) for s in ("a", "b") for _ in range(d + 1)] + [(None, texts[0], None)] * 2)]
    df = spark.createDataFrame(data, f"{DOCS}, {', '.join(f'{n} string' for n in names)}")
    plan, got = mixing.mix(df).collect(), mixing.mixed(df)
    key = lambda r: (r.doc_id, r.source)
    want = collections.Counter()
    for r in plan:
        want[key(r)] += r.copies
    assert got.columns == df.columns and collections.Counter(map(key, got.collect())) == +want
    assert all([r[n][: len(n)] for n in names] == names for r in got.collect())
    for stage in (lambda d: langid.keep_identified(d), lambda d: decontam.drop_contaminated(d, spark.createDataFrame([(1, texts[1])], "item_id long, text string")), neardup.drop_near_duplicates):
        out = stage(df)
        assert out.columns == df.columns and set(map(tuple, out.collect())) <= set(map(tuple, df.collect()))
    assert decontam.drop_contaminated(df, spark.createDataFrame([(1, texts[1])], "item_id long, text string")).filter("doc_id = 1").count() == 0


def test_oracles(spark, small):
    from ..compare import duck, table

    con = duck(small)
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, small)
        found = con.execute(sql)
        assert table(df.columns, df.collect()) == table([d[0] for d in found.description], found.fetchall()), name


def test_nothing_is_lost_in_math():
    assert math.prod(pii.DAY_PARTS) == pii.DAYS
