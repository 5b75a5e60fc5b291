"""Files as tables: CSV, Markdown caches, PDF pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

SALES = "order_id string, customer_id string, order_date string, product string, quantity int, amount double, region string"


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales records with a header line."""
    return spark.read.csv(path, header=True, schema=SALES)


def load_sales(spark: SparkSession, path: str, table: str = "raw.sales") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")
    read_sales(spark, path).write.mode("overwrite").saveAsTable(table)


def _path() -> Column:
    """The path of the file that a row is read from, as its name is written: Spark gives it encoded."""
    return F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """source_file (the stem) and markdown_text of every .md file, read whole."""
    df = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return df.select(F.regexp_extract(_path(), r"([^/]+)\.md$", 1).alias("source_file"), F.col("value").alias("markdown_text"), F.length("value").cast("long").alias("char_count"))


def read_markdown_pages(spark: SparkSession, folder: str) -> DataFrame:
    """source_file (the folder), page_index and page_text of page_*.md files."""
    df = spark.read.option("pathGlobFilter", "page_*.md").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    name = _path()
    return df.select(F.regexp_extract(name, r"([^/]+)/page_[0-9]+\.md$", 1).alias("source_file"), F.regexp_extract(name, r"page_([0-9]+)\.md$", 1).cast("int").alias("page_index"), F.col("value").alias("page_text"))


def require_files(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (source_file) without text: what has to be extracted first."""
    return wanted.join(found.select("source_file").distinct(), "source_file", "left_anti")


def read_pdf_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Layout spans of every PDF. Needs pymupdf on the executors."""

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("reading PDF files needs pymupdf on the executors") from e
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                for number, page in enumerate(fitz.open(stream=content, filetype="pdf")):
                    height = page.rect.height
                    seq = 0
                    for b, block in enumerate(page.get_text("dict")["blocks"]):
                        for line in block.get("lines", []):
                            for s in line["spans"]:
                                rows.append((path.rsplit("/", 1)[-1], number, float(height), b, seq, s["font"], float(s["size"]), bool(s["flags"] & 16), *map(float, s["bbox"]), s["text"]))
                                seq += 1
                yield pd.DataFrame(rows, columns=["source_file", "page_index", "page_height", "block_idx", "idx", "font", "size", "bold", "x0", "y0", "x1", "y1", "text"])

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return files.mapInPandas(spans, "source_file string, page_index int, page_height double, block_idx int, idx int, font string, size double, bold boolean, x0 double, y0 double, x1 double, y1 double, text string")


def printed_page_numbers(spans: DataFrame, pattern: str = r"^[0-9]{1,4}$", low: float = 0.92, high: float = 0.98) -> DataFrame:
    """source_file, page_index, printed_page_num: the last number between 92 and 98 % of the page's height, else the index."""
    text = F.trim("text")
    inside = (F.col("y0") >= low * F.col("page_height")) & (F.col("y0") <= high * F.col("page_height")) & text.rlike(pattern)
    best = F.max_by(F.when(inside, text.try_cast("int")), F.when(inside, F.col("idx")))
    return spans.groupBy("source_file", "page_index").agg(F.coalesce(best, F.col("page_index")).cast("int").alias("printed_page_num"))


def printed_number_in_text(df: DataFrame, text: str, index: str, pattern: str = r"^[0-9]{1,4}$", first: int = 5) -> DataFrame:
    """The same from page text: the last line that is a number, else one of the first five, else the index."""
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.trim(x))
    numbers = F.filter(lines, lambda x: x.rlike(pattern))
    top = F.filter(F.slice(lines, 1, first), lambda x: x.rlike(pattern))
    found = F.coalesce(F.try_element_at(numbers, F.lit(-1)), F.try_element_at(top, F.lit(1)))
    return df.withColumn("printed_page_num", F.coalesce(found.try_cast("int"), F.col(index).cast("int")))
