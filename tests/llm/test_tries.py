"""Operators 11 to 13: brute force on hard rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from folioscale.llm import merkle, queries, radix, trie, winnow

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ranks


def test_ranks_of_sparse_and_repeated_keys(spark):
    rng = random.Random(4)
    keys = [("a", rng.choice([None, -(2**63), 2**63 - 1, 0, 7, rng.randint(-(2**62), 2**62)]), hashlib.md5(str(i).encode()).hexdigest(), rng.randint(1, 3)) for i in range(3000)]
    keys += [("b", i, "ff", 2) for i in range(1500)] + [("c", 9, hashlib.md5(str(i).encode()).hexdigest(), 1) for i in range(900)]
    df = spark.createDataFrame(keys, "g string, k long, tie string, n long")
    want = []
    for g in "abc":
        at = 0
        for x in sorted((x for x in keys if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2])):
            want.append((*x, at))
            at += x[3]
    for most in (16, 1024):
        assert rows(radix.ranked(df, ["g"], "k", "tie", "n", most)) == sorted(want, key=repr)
    cut, h = radix.measure(df, ["g"], "k", "tie", "n", 16)
    assert cut.tie_bits > 0 and h.agg(F.max("_entries")).first()[0] < 200
    cut, _ = radix.measure(df.filter("g = 'b'"), ["g"], "k", "tie", "n", 1600, coarse=True)
    assert cut.whole


# 11


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    return sha(*[field(x) for x in (r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"])])


def tree(nodes, fanout):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // fanout * fanout :][:fanout]
            paths[i].append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1 :])))
            at[i] = p // fanout
        nodes = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def merkle_brute(docs, fanout):
    by = {}
    for r in docs:
        by.setdefault(r["lang"], []).append(r)
    made = {}
    for lang, own in by.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made[lang] = (own, *tree([leaf(r) for r in own], fanout))
    langs = sorted(made, key=lambda x: b"" if x is None else b"+" + x.encode())
    root, over = tree([made[x][1] for x in langs], fanout)
    out = []
    for lang, upper in zip(langs, over, strict=True):
        own, sub, paths = made[lang]
        for r, p in zip(own, paths, strict=True):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            h = leaf(r, int(tampered))
            for before, after in p + upper:
                h = sha(before, h, after)
            out.append((r["doc_id"], leaf(r), sub, root, sha(*[a + b for a, b in p + upper]), h, h == root))
    return out


@pytest.mark.parametrize("fanout", [2, 3])
def test_merkle(spark, fanout):
    rng = random.Random(3)
    ids = [None, -5, 0, 1, 7, 2**63 - 1, -(2**63)]
    data = [(rng.choice([*ids, rng.randint(-(10**6), 10**6)]), rng.choice([None, "", "a", "é" * 3, "x y"]), rng.choice([None, "", "en", "é", "e", "-", "+"]), rng.choice([None, "s"]), rng.choice([None, 2**63 - 1, 5]), 1, "x") for _ in range(1500)]
    data += [(3, "same", "en", "s", 4, 1, "x")] * 700 + [(11, "x" * 200000, "long", None, 1, 1, "x")]
    df = spark.createDataFrame(data, DOCS + ", rank int, g string")
    got = merkle.verify(df, fanout)
    want = merkle_brute([r.asDict() for r in df.collect()], fanout)
    assert rows(got, "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified") == sorted(want, key=repr)
    assert {x[-1] for x in want} == {True, False}


def test_merkle_small(spark):
    empty = spark.createDataFrame([], DOCS)
    assert merkle.verify(empty).count() == 0
    one = merkle.verify(spark.createDataFrame([(5, None, None, None, None)], DOCS)).first()
    assert one.leaf == one.subroot == one.root == sha("1:5", "----") and one.proof_sha256 == sha() and one.verified


def test_merkle_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert rows(queries.op11_merkle(spark, small)) == sorted(merkle_brute([r.asDict() for r in docs.collect()], 2), key=repr)


# 12

UNSPACED = "฀-໿က-႟ក-៿⺀-鿿豈-﫿\U00020000-\U0002ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\x00-\x2f\x3a-\x60\x7b-\x7f{UNSPACED}]{{1,32}}")


def winnowed(text, k, window):
    words = WORD.findall(text.translate(brute.UP))
    grams = [hashlib.md5(" ".join(words[i : i + k]).encode()).hexdigest()[:12] for i in range(max(len(words) - k, 0) + 1)] if words else []
    kept = set()
    for i in range(max(len(grams) - window, 0) + 1 if grams else 0):
        least = min(grams[i : i + window])
        kept.add(max(j for j in range(i, min(i + window, len(grams))) if grams[j] == least))
    return [(grams[j], j) for j in sorted(kept)]


def alike(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_brute(docs, k, window):
    text = lambda t: t or ""
    line = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5(text(d[1]).encode()).hexdigest()), reverse=True)
    out = []
    for i, (d, t) in enumerate(line):
        t, after = text(t), text(line[(i + 1) % len(line)][1])
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        own, changed, theirs = (winnowed(x, k, window) for x in (t, edited, after))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f"{h}@{p}" for h, p in own), ",".join(f"{h}@{p}" for h, p in changed), alike(own, changed), alike(own, theirs)))
    return out


@pytest.mark.parametrize("k, window", [(5, 4), (2, 7), (1, 1)])
def test_winnow(spark, k, window):
    rng = random.Random(8)
    texts = [None, "", " \n", "a", "A b", "日本語の文章です 犬", "é É \U0001f600 x", "y" * 500, "tie tie tie tie tie tie tie tie", "to be or not " * 400]
    texts += [" ".join(rng.choice("abcdef") * rng.randint(1, 2) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    data = [(rng.choice([None, 0, -9, 2**63 - 1, i, i]), t) for i, t in enumerate(texts)] + [(4, "same row here") for _ in range(40)] + [(None, "null id") for _ in range(30)] + [(4, "same row here too")]
    df = spark.createDataFrame([(*d, 1, "x") for d in data], "doc_id long, text string, mark int, fp string")
    assert rows(winnow.edited_likeness(df, k=k, window=window)) == sorted(edited_brute(data, k, window), key=repr)


def test_winnow_small_and_sparse(spark):
    df = spark.createDataFrame([(3, "one two three four five six")], "doc_id long, text string")
    assert rows(winnow.edited_likeness(df)) == sorted(edited_brute([(3, "one two three four five six")], 5, 4), key=repr)
    assert winnow.edited_likeness(df.limit(0)).count() == 0
    rng = random.Random(1)
    data = [(rng.randint(-(2**63), 2**63 - 1), f"text number {i} of some") for i in range(1500)]
    assert rows(winnow.edited_likeness(spark.createDataFrame(data, "doc_id long, text string"))) == sorted(edited_brute(data, 5, 4), key=repr)


def test_winnow_finds_shared_passages(spark):
    rng = random.Random(2)
    data = []
    for i in range(40):
        shared = [f"s{i}w{j}" for j in range(winnow.K + winnow.WINDOW - 1)]
        for side in (0, 1):
            around = lambda: [f"r{rng.randint(0, 10**9)}" for _ in range(rng.randint(0, 30))]
            data.append((2 * i + side, " ".join(around() + shared + around())))
    held = {}
    for d, h, _ in rows(winnow.fingerprints(spark.createDataFrame(data, "doc_id long, text string"))):
        held.setdefault(d, set()).add(h)
    assert all(held[2 * i] & held[2 * i + 1] for i in range(40))


# 13


def trie_brute(data):
    by = {}
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            tok = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by.setdefault(c, []).append((turn is not None, turn or 0, tok, (role, text)))
    turns = {c: [x[3] for x in sorted(own, key=lambda x: x[:3])] for c, own in by.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - (abs(c) % 20) * (1 if c > 0 else -1), [])[:h] + own[h:])
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(built[c][:d], []).append(c)
    kids, saved, leaves = {}, {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p in sorted(nodes, key=len, reverse=True):
        words = len(brute.SPACE.findall(p[-1][1])) if p else 0
        saved[p] = saved.get(p, 0) + (len(nodes[p]) - 1) * words
        leaves[p] = leaves.get(p, 0) or 1
        if p:
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
    return [(nodes[p][0], len(p), nodes[p[:-1]][0] if p else None, len(nodes[p]), kids.get(p, 0), leaves[p], saved[p], sha(",".join(str(c) for c in nodes[p] if built[c] == p))) for p in nodes]


TURNS = "conv_id long, turn long, role string, text string, node string, depth int"


@pytest.mark.parametrize("piece, stretch", [(64, 4096), (3, 5)])
def test_trie(spark, monkeypatch, piece, stretch):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "STRETCH", stretch)
    rng = random.Random(6)
    data = []
    for c in [*range(-45, 200), 10**9 + 3, -(2**63), 2**63 - 1]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 30])):
            data.append((c, rng.choice([t, t, t, None, 2**62]), rng.choice(["user", "user", None, "", "assistant"]), rng.choice(["hi", "hi", "hi there", None, "", "A b\tc"])))
    data += [(None, 1, "user", "lost")] * 3 + [(400, 1, "user", "same")] * 5 + [(500 + 20 * i, t, "user", f"go {t} on") for i in range(300) for t in range(12)]
    df = spark.createDataFrame([(*d, "x", 1) for d in data], TURNS)
    assert rows(trie.conversation_trie(df)) == sorted(trie_brute(data), key=repr)


def test_trie_of_one_and_none(spark):
    df = spark.createDataFrame([(7, 0, "user", "hello you", "x", 1)], TURNS)
    assert rows(trie.conversation_trie(df)) == sorted(trie_brute([(7, 0, "user", "hello you")]), key=repr)
    assert trie.conversation_trie(df.limit(0)).count() == 0


def test_trie_query(spark, small):
    data = rows(spark.read.parquet(f"{small}/conversations.parquet"), "conv_id", "turn", "role", "text")
    assert rows(queries.op13_trie(spark, small)) == sorted(trie_brute(data), key=repr)
