"""Postings are packed by block, and a table without partitions is written once."""

import uuid

from pyspark.sql import functions as F

from folioscale.plans import trigrams
from folioscale.sources.catalog import Catalog


def test_a_trigram_has_one_row_for_a_block(spark, monkeypatch):
    monkeypatch.setattr(trigrams, "BLOCK", 100)
    made = trigrams.TextIndex(Catalog(spark), f"s_{uuid.uuid4().hex[:8]}", "t", "doc", "body")
    rows = spark.createDataFrame([(f"k{i}", f"fire {i} and fire") for i in range(40)], "doc string, body string").coalesce(1)
    found = made.postings(rows).filter(F.col("gram") == int(trigrams.grams("fire")[0])).collect()
    assert sorted(k for r in found for k in r["keys"]) == sorted(f"k{i}" for i in range(40))
    assert 4 < len(found) < 20 and all(len(trigrams.unpack(bytes(r.n))) == len(r["keys"]) and trigrams.unpack(bytes(r.n)).tolist() == list(range(2, 2 * len(r["keys"]) + 1, 2)) for r in found)
    made.build(rows)
    assert {r.doc: r.places for r in made.candidates("fire").collect()} == {f"k{i}": [0, 10 + len(str(i))] for i in range(40)}


def test_a_plain_table_is_not_written_twice(spark, monkeypatch):
    cat, space = Catalog(spark), f"s_{uuid.uuid4().hex[:8]}"
    wrote = []
    plain = Catalog._writer
    monkeypatch.setattr(Catalog, "_writer", lambda self, df: wrote.append(1) or plain(self, df))
    cat.replace(space, "t", spark.range(5))
    assert len(wrote) == 1 and cat.read(space, "t").count() == 5 and cat.tables(space) == ["t"]
    cat.replace(space, "t", spark.range(3).withColumn("x", F.lit(1)))
    assert len(wrote) == 2 and cat.read(space, "t").count() == 3 and cat.recover(space, "t") is None
