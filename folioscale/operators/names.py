"""Many names looked for in many texts, each text read once."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import ship
from .titles import all_places, automaton_of, stands_alone

#: Characters of text, and names, that one automaton's task holds at a time; a longer text is alone.
TEXTS, NAMES = 16_000_000, 50_000


def lowered(text: str) -> str:
    """Lower case with every character in its place: one whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x.lower()) != 1 else x.lower() for x in text)


def apart(places: list[int], length: int) -> list[int]:
    """Of ascending places those that do not begin within the one kept before."""
    out: list[int] = []
    for p in places:
        if not out or p >= out[-1] + length:
            out.append(p)
    return out


def occurrences(names: DataFrame, texts: DataFrame, group: list[str], name: str = "name", key: str = "doc_id", text: str = "text", whole: bool = True, overlapping: bool = True) -> DataFrame:
    """group, name, key, place: every place (from 0) of each of a group's names in each of its texts, whatever the case.

    With ``whole`` no letter or digit may go on before or behind. Without
    ``overlapping`` a name is looked for behind the place before it, whole or not. Names and texts
    of a group are dealt into parts, so that large groups are many tasks: each name
    travels once to each part of its group's texts, each text once to each part of
    its group's names. Null groups, names and texts have no places, nor has an
    empty name. Repeated names count once, repeated rows of texts each.
    """
    own = names.select(*group, name).dropna().filter(F.col(name) != "").distinct()
    rows = texts.select(*group, key, text).filter(F.col(text).isNotNull()).dropna(subset=group)
    # a few numbers for each group; dealt once more, so that a large group's side of the join can be split
    sizes = rows.groupBy(*group).agg(F.ceil(F.sum(F.length(text)) / TEXTS).alias("_slices")).repartition(*group)
    counts = own.groupBy(*group).agg(F.ceil(F.count("*") / NAMES).alias("_chunks")).repartition(*group)
    parts = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1))
    dealt = lambda of, n: F.pmod(F.xxhash64(of), F.greatest(n, F.lit(1)))
    left = own.join(counts, group).join(sizes, group).withColumns({"_chunk": dealt(name, F.col("_chunks")), "_slice": parts(F.col("_slices"))})
    right = rows.join(sizes, group).join(counts, group).withColumns({"_slice": dealt(text, F.col("_slices")), "_chunk": parts(F.col("_chunks"))})
    keys = [*group, "_slice", "_chunk"]
    fields = [StructField(c, texts.schema[c].dataType) for c in group] + [StructField(name, names.schema[name].dataType), StructField(key, texts.schema[key].dataType), StructField("place", IntegerType())]
    kind = to_arrow_schema(StructType(fields))
    size = len(group)

    def found(held: pa.Table, read: pa.Table) -> pa.Table:
        written: dict[str, list[str]] = {}
        for n in held.column(name).to_pylist():
            written.setdefault(lowered(n), []).append(n)
        automaton, out = automaton_of(list(written)), [[] for _ in fields]
        group_values = [read.column(c)[0].as_py() for c in group] if len(read) and len(held) else []
        for a in range(len(read) if written else 0):
            low = lowered(read.column(text)[a].as_py())
            for n, places in all_places(automaton, low).items():
                places = [p for p in (places if overlapping else apart(places, len(n))) if not whole or stands_alone(low, p, p + len(n))]
                for shown in written[n]:
                    for i, v in enumerate(group_values):
                        out[i] += [v] * len(places)
                    out[size] += [shown] * len(places)
                    out[size + 1] += [read.column(key)[a].as_py()] * len(places)
                    out[size + 2] += places
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(out, kind, strict=True)], schema=kind)

    ship(texts.sparkSession)
    left = left.select(*keys, name)
    # names and texts may come from one table
    return left.toDF(*left.columns).groupBy(*keys).cogroup(right.select(*keys, key, text).groupBy(*keys)).applyInArrow(found, StructType(fields))
