"""Every registered query against its SQL, on the smallest tables."""

import pytest

from folioscale import catalogue

from .compare import duck, table


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_as_sql(spark, small, con, name):
    df = catalogue.queries()[name](spark, small)
    found = con.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert table(df.columns, df.collect()) == table(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, small, name):
    assert catalogue.queries()[name](spark, small).collect() is not None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100


def close(a, b):
    return min(len(a), len(b)) >= 0.7 * max(len(a), len(b)) and ratio(a, b) >= 90


def test_fuzzy_pairs_by_brute_force(spark, small, con):
    parts = con.execute("select p_partkey, p_size, p_name from part").fetchall()
    want = sorted((i, j) for i, s, a in parts for j, z, b in parts if i < j and s == z and close(a, b))
    assert sorted(map(tuple, catalogue.queries()["fuzzy_indel_pairs"](spark, small).collect())) == want

    from folioscale.operators import joins

    names = ["fireball", "fire ball", "fireballs", "Fireball", "ball fire", "", "a", "b", "aa", "magic missile", "magic missle", "mgaic missile", "zzzz zzzz zz", "zzzz zzzz zzz", "aaaaabbbbb", "bbbbbaaaaa"]
    df = spark.createDataFrame([(1, x) for x in names], "k int, a string")
    got = sorted(tuple(r) for r in joins.fuzzy_pairs(df, df.withColumnRenamed("a", "b"), ["k"], "a", "b").select("a", "b").collect())
    assert got == sorted((a, b) for a in names for b in names if close(a, b))


def test_spell_crosscheck_by_brute_force(spark, small, con):
    parts = con.execute("select p_type, p_brand, lower(p_name), p_partkey from part").fetchall()
    listed = {}
    for t, b, n, k in parts:
        if k % 2 == 0:
            listed.setdefault((t, b), []).append(n)
    lost = {t: set() for t, *_ in parts}
    count = dict.fromkeys(lost, 0)
    for t, b, n, _ in parts:
        if not any(close(n, o) for o in listed.get((t, b), [])):
            count[t] += 1
    want = sorted((t, "warn" if n else "pass", f"{n} names without a match") for t, n in count.items())
    assert sorted(map(tuple, catalogue.queries()["dq_spell_crosscheck"](spark, small).collect())) == want


def test_containment_by_brute_force(spark, small, con):
    turns = {}
    for c, n, text in sorted(con.execute("select conv_id, turn, text from conversations").fetchall()):
        turns.setdefault(c, []).append(text)
    want = []
    for c, texts in turns.items():
        kept = []
        for x in sorted(texts, key=lambda x: -len(x)):
            if not any(x[:100] in k for k in kept):
                kept.append(x)
        want.append((c, len(kept)))
    assert sorted(map(tuple, catalogue.queries()["containment_dedupe"](spark, small).collect())) == sorted(want)


def test_entry_builder_by_brute_force(spark, small, con):
    """Whole texts cut at the first heading place of each title behind the one before, on its page or the next."""
    import re

    want = []
    for doc, text in con.execute("select doc_id, text from documents where doc_id < 60 and text is not null").fetchall():
        lines = text.split("\n")
        if any(x.strip().isdigit() for x in lines) or re.search(r"-[ \t]*\n|[^\x00-\xff]|[\xa0-\xbf]|!\[", text):
            continue
        titles = [(m[1], n + 1) for n, x in enumerate(lines) if n % 4 == 1 and (m := re.match(r"^([^\W\d_]+ [^\W\d_]+ [^\W\d_]+)(?: |$)", x))]
        whole, starts = "", {}
        for n, x in enumerate(lines):
            starts[n + 1] = len(whole) + (2 if whole else 0)
            whole = f"{whole}\n\n{x}" if whole else x
        cuts, behind = [], 0
        for title, page in titles:
            end = starts.get(page + 1, starts.get(page + 2, len(whole) + 1))
            places = [m.start() for m in re.finditer(rf"(?<![^\W_]){re.escape(title)}(?![^\W_])", whole, re.IGNORECASE) if max(behind, starts[page]) <= m.start() < end]
            if places:
                best = [p for p in places if p == 0 or whole[p - 1] == "\n"] or places
                cuts.append((best[0], title))
                behind = best[0] + len(title)
        parts = [(None, whole[: cuts[0][0] if cuts else len(whole)])] + [(t, whole[a:b]) for (a, t), b in zip(cuts, [c[0] for c in cuts[1:]] + [len(whole)])]
        want += [(str(doc), t) for t, x in parts if len(x.strip()) >= 10]
    got = catalogue.queries()["entry_builder"](spark, small).select("source_file", "entry_title").distinct().collect()
    books = {d for d, _ in want}
    assert len(books) > 20 and sorted({tuple(r) for r in got if r.source_file in books}, key=repr) == sorted(set(want), key=repr)
