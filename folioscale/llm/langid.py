"""Language ID by Bayesian evidence fusion.

The evidence for each language is the likelihood of the text (hashed byte
trigrams, naive Bayes), of the language that the markup declares, and of the
address suffix, and a prior for the host. Declared-language and suffix tables
and the priors are grouped counts over all rows of what the text alone says;
a host's prior is smoothed toward its domain's, that toward everything's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import arrow_map, written

#: Labelled texts for the text model, for each language, about; a sample by hash.
SAMPLE = 400
#: Labelled texts for the text model, of all languages, about.
MOST = 80_000
#: What a trigram that a sample lacks counts.
UNSEEN = 0.05
FEATURES = 1 << 16
#: A text's trigrams, which overlap and depend on each other, weigh as n / (1 + n / EVIDENCE) independent ones.
EVIDENCE = 60
HOST_WEIGHT, DOMAIN_WEIGHT, TABLE_WEIGHT = 5.0, 20.0, 1.0
#: A row is accepted from this posterior on.
ACCEPT = 0.5

_FOLD = np.full(256, 0x20, dtype=np.uint8)  # what is no letter is a space
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _features(data: np.ndarray) -> np.ndarray:
    """A feature for each byte but the last two."""
    x = _FOLD[data].astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class TextModel:
    """Log likelihoods of trigrams under each language.

    A trigram that a language's sample lacks has that language's least
    likelihood; only the others are held, by trigram, so that the model grows
    with the sample and not with the number of languages.
    """

    def __init__(self, languages: list[str], texts: dict[str, list[str]]):
        self.languages = languages
        least, held = np.zeros(len(languages)), []
        for k, name in enumerate(languages):
            counts = np.zeros(FEATURES, np.int64)
            for text in texts[name]:
                data = np.frombuffer(text.encode(), np.uint8)
                if len(data) > 2:
                    counts += np.bincount(_features(data), minlength=FEATURES)
            least[k] = np.log(UNSEEN / (counts.sum() + UNSEEN * FEATURES))
            own = np.flatnonzero(counts)
            held.append((own, np.full(len(own), k), np.log1p(counts[own] / UNSEEN)))
        feature, language, more = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.argsort(feature, kind="stable")
        self.least, self.language, self.more = least, language[order], more[order].astype(np.float32)
        self.begin = np.searchsorted(feature[order], np.arange(FEATURES + 1))

    def score(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihoods (rows by languages) and the number of trigrams that hold a letter."""
        data, off = tokens.text_buffers(column)
        size = len(self.languages)
        out = np.zeros((len(off) - 1, size))
        n = np.zeros(len(off) - 1, np.int64)
        # a piece has few enough trigrams for all its likelihoods, whatever the number of languages; nothing is held for every byte of a batch
        step = max(1 << 14, (1 << 21) // max(8, size))
        for a in range(int(off[0]), int(off[-1]), step):
            part = data[a : min(a + step + 2, int(off[-1]))]
            if len(part) < 3 or not size:
                continue
            first_row = int(np.searchsorted(off, a, side="right")) - 1
            last_row = int(np.searchsorted(off, a + len(part) - 2, side="left"))
            ends = np.clip(off[first_row : last_row + 1] - a, 0, len(part) - 2)
            row = np.repeat(np.arange(first_row, last_row), np.diff(ends))
            letters = _FOLD[part] != 0x20
            # trigrams of a row end before the next row
            own = (letters[:-2] | letters[1:-1] | letters[2:]) & (np.arange(a, a + len(part) - 2) + 2 < off[row + 1])
            row, feature = row[own], _features(part)[own]
            first, count = self.begin[feature], self.begin[feature + 1] - self.begin[feature]
            at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(feature) else first
            low = int(row[0]) if len(row) else 0
            span = (int(row[-1]) - low + 1) if len(row) else 0
            added = np.bincount(np.repeat(row - low, count) * size + self.language[at], weights=self.more[at], minlength=span * size) if span else np.zeros(0)
            out[low : low + span] += added.reshape(span, size)
            n += np.bincount(row, minlength=len(n))
        return out + n[:, None] * self.least, n


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, most: int = MOST) -> TextModel:
    """A text model of every language, from about ``sample`` texts of each, and about ``most`` of all, one of each at least.

    Rows are chosen by a hash of all their columns, so that copies with other
    ids do not come together; null labels and texts take no part.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), ((F.pmod(F.xxhash64(*labelled.columns), F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))).alias("u")).filter("text is not null and lang is not null")
    # one row for each language, with the least hash of its texts
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("u").alias("least")), "languages")
    names = sorted(r.lang for r in counts.select("lang").collect())
    texts: dict[str, list[str]] = {n: [] for n in names}
    if names:
        each = max(1, min(sample, most // len(names)))
        # the place of a row among those of its language, about; its first row always comes
        near = rows.join(counts, "lang").withColumn("place", F.col("u") * F.col("n")).filter((F.col("place") <= 2 * each) | (F.col("u") == F.col("least")))
        for r in near.orderBy(F.col("u") != F.col("least"), "place", "lang", "text").limit(each * len(names)).collect():
            texts[r.lang].append(r.text)
    return TextModel(names, texts)


def identify(rows: DataFrame, model: TextModel, row_id: Column, text: Column, declared: Column, suffix: Column, host: Column, domain: Column) -> DataFrame:
    """row_id, lang, confidence, text_lang, declared, host, accepted: one row for each of ``rows``.

    ``lang`` is null where there are no letters at all; such rows, and those
    whose best posterior is under ``ACCEPT``, are not accepted. Null evidence
    says nothing: a null declared language, suffix, host or domain counts as a
    value of its own, with the table of all rows that lack it. Repeated rows are
    judged alike. Without languages in the model nothing is accepted.
    """
    k = len(model.languages)
    missing = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ll, n = model.score(batch.column(5))
            # the text alone must not drown all else
            ll = ll / (1 + n / EVIDENCE)[:, None]
            best = np.where(n > 0, ll.argmax(axis=1), -1) if k else np.full(len(n), -1)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(n) + 1, max(k, 1))[: len(n) + 1] if k else np.zeros(len(n) + 1, np.int64), pa.int32()), pa.array(ll.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), flat, pa.array(best.astype(np.int32))], names=["row_id", "declared", "suffix", "host", "domain", "ll", "best"])

    kind = rows.select(row_id.alias("x")).schema["x"].dataType.simpleString()
    given = rows.select(row_id.alias("row_id"), F.lower(missing(declared)).alias("declared"), missing(suffix).alias("suffix"), missing(host).alias("host"), missing(domain).alias("domain"), text.cast("string").alias("text"))
    scored = written(arrow_map(given, score, f"row_id {kind}, declared string, suffix string, host string, domain string, ll array<double>, best int"), "language")

    def shares(keys: list[str], name: str) -> DataFrame:
        """For each value: how often the text alone says each language."""
        counted = scored.filter("best >= 0").groupBy(*keys, "best").agg(F.count("*").cast("double").alias("n"))
        held = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("held"))
        return held.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0.0))).alias(name))

    if not k:
        return scored.select("row_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"), "declared", "host", F.lit(False).alias("accepted"))
    base = {r.best: r["count"] for r in scored.filter("best >= 0").groupBy("best").count().collect()}
    total = sum(base.values()) + k
    overall = [(base.get(i, 0) + 1) / total for i in range(k)]
    every = F.array(*[F.lit(x) for x in overall])
    none = F.array_repeat(F.lit(0.0), k)
    summed = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    smooth = lambda counts, toward, w: F.zip_with(counts, toward, lambda c, p: (c + w * p) / (summed(counts) + w))

    # hosts meet their domains before the rows meet their hosts
    domains = shares(["domain"], "dc").select("domain", smooth(F.col("dc"), every, DOMAIN_WEIGHT).alias("dp"))
    hosts = shares(["host", "domain"], "hc")
    # written, so that the join of the rows is free to split a host that holds much of them
    priors = written(hosts.join(domains, "domain").select("host", "domain", smooth(F.col("hc"), F.col("dp"), HOST_WEIGHT).alias("prior")), "priors")
    out = scored.join(priors, ["host", "domain"], "left").join(written(shares(["declared"], "mc"), "declared"), "declared", "left").join(written(shares(["suffix"], "sc"), "suffix"), "suffix", "left")

    def likelihood(counts: Column) -> Column:
        """P(value | language) up to a factor that all languages share: P(language | value) / P(language)."""
        return F.zip_with(smooth(F.coalesce(counts, none), every, TABLE_WEIGHT), every, lambda a, b: F.log(a / b))

    log = F.col("ll")
    for part in (F.transform(F.coalesce(F.col("prior"), every), lambda x: F.log(x)), likelihood(F.col("mc")), likelihood(F.col("sc"))):
        log = F.zip_with(log, part, lambda a, b: a + b)
    out = out.withColumn("log", log).withColumn("top", F.array_max("log"))
    names = F.array(*[F.lit(x) for x in model.languages])
    out = out.withColumn("confidence", F.when(F.col("best") >= 0, 1 / summed(F.transform("log", lambda x: F.exp(x - F.col("top"))))).otherwise(F.lit(0.0)))
    lang = F.when(F.col("best") >= 0, F.element_at(names, F.array_position("log", F.col("top")).cast("int")))
    return out.select("row_id", lang.alias("lang"), "confidence", F.when(F.col("best") >= 0, F.get(names, F.col("best"))).alias("text_lang"), "declared", "host", (F.col("confidence") >= ACCEPT).alias("accepted"))


def identify_pages(pages: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host, accepted: of pages (page_id, url, html).

    The declared language is the html tag's lang, up to a hyphen; the suffix is
    the last part of the host, the domain its last two.
    """
    from .linededup import HIDDEN, TAG, host_of

    host = host_of(F.col("url"))
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), HIDDEN, " "), TAG, " ")
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<html[^>]*\slang\s*=\s*[\"']?([a-z]+)", 1)
    out = identify(pages, fit(labelled, sample=sample), F.col("page_id"), plain, declared, F.regexp_extract(host, r"\.([^.]+)$", 1), host, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    return out.withColumnRenamed("row_id", "page_id")


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source) whose language is accepted; ``lang`` is the declared language, ``source`` the host.

    Each row is judged by its own text, lang and source, whatever its doc_id.
    """
    nothing = F.lit(None).cast("string")
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    key = F.md5(F.concat_ws("|", part("lang"), part("source"), part("text")))
    found = identify(docs, fit(docs.select("doc_id", "text", "lang"), sample=sample), key, F.col("text"), F.col("lang"), nothing, F.col("source"), nothing)
    gone = found.filter(~F.col("accepted")).select(F.col("row_id").alias("_key")).distinct()
    # the row travels as one value, so that no column of it can clash
    packed = docs.filter(F.coalesce(F.trim("text"), F.lit("")) != "").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("_key"))
    return packed.join(gone, "_key", "left_anti").select("row.*")
