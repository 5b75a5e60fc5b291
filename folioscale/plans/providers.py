"""Outside services behind small interfaces; the defaults need no network and always answer alike."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship


class StubModel:
    """Answers with the first sentence of what it is asked."""

    def generate(self, prompt: str) -> str | None:
        return prompt.strip().split("\n")[-1].split(". ")[0][:200]


class WordModel:
    """Judges by words alone: a JSON object of whether each name's word stands in the prompt."""

    def __init__(self, words: dict[str, str]):
        self.words = words

    def generate(self, prompt: str) -> str | None:
        return json.dumps({name: word.lower() in prompt.lower() for name, word in self.words.items()})


@dataclass
class HttpModel:
    """A text model behind an HTTP endpoint that takes and gives JSON."""

    url: str
    model: str
    tries: int = 3
    pause: float = 5.0
    temperature: float = 0.0
    max_tokens: int = 512

    def generate(self, prompt: str) -> str | None:
        body = json.dumps({"model": self.model, "prompt": prompt, "stream": False, "options": {"temperature": self.temperature, "num_predict": self.max_tokens}}).encode()
        for n in range(self.tries):
            try:
                request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=300) as answer:
                    return json.loads(answer.read()).get("response")
            except (OSError, ValueError):
                if n + 1 < self.tries:
                    time.sleep(self.pause)
        return None

    def available(self, list_url: str) -> bool:
        """Whether the endpoint lists the model."""
        with urllib.request.urlopen(list_url, timeout=30) as answer:
            return any(m.get("name") == self.model for m in json.loads(answer.read()).get("models", []))


class HashEmbedder:
    """Unit vectors from hashed words, the same everywhere."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.dim
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % self.dim] += 1.0 if h >> 63 else -1.0
            n = sum(x * x for x in v) ** 0.5 or 1.0
            out.append([x / n for x in v])
        return out


def generated(df: DataFrame, prompt: str, model: object, name: str = "response") -> DataFrame:
    """Ask the model for each row's prompt, in batches on the executors."""
    ship(df.sparkSession)
    schema = df.schema if name in df.columns else StructType([*df.schema.fields, StructField(name, StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: [model.generate(p) if p else None for p in pdf[prompt]]})

    return df.mapInPandas(run, schema)


def embedded(df: DataFrame, text: str, embedder: object, name: str = "embedding", batch: int = 100) -> DataFrame:
    """Vectors of a text column; nulls count as empty texts."""
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            yield pdf.assign(**{name: [v for i in range(0, len(texts), batch) for v in embedder.embed(texts[i : i + batch])]})

    return df.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"{name} array<float>"]))


def vector_rows(chunks: DataFrame, toc: DataFrame, files: DataFrame) -> DataFrame:
    """id, document and metadata of every chunk, as a vector collection holds them; nulls are ''."""
    meta = ["source_file", "toc_id", "section_title", "entry_title", "page_numbers", "chunk_type", "toc_title", "game_system", "content_type"]
    j = chunks.join(toc.select("toc_id", F.col("title").alias("toc_title")), "toc_id", "left").join(files.select("source_file", "game_system", "content_type"), "source_file", "left")
    pairs = [x for c in meta for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return j.select(F.col("chunk_id").cast("string").alias("id"), F.col("content").alias("document"), F.create_map(*pairs).alias("metadata"))
