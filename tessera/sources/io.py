"""Readers and writers of manifests, line files, tables, archives and subtitles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.functions.values import srt_time

TEST_LIST = "id string, text string, ref_audio string, ref_text string, language_id string, language_name string, duration double, speed double, instruct string"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; filters and columns reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_lines(spark: SparkSession, path: str, schema: str = TEST_LIST) -> DataFrame:
    """Blank and malformed lines are skipped, missing fields null."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of exactly four fields: tar, labels, number of items, seconds; another count is an error."""
    f = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(F.trim("value") != "")
    ok = F.when(F.size(f) == 4, f).otherwise(F.raise_error(F.concat(F.lit("not four fields: "), F.col("value"))))
    return lines.select(ok.alias("f")).select(F.get("f", F.lit(0)).alias("tar"), F.get("f", F.lit(1)).alias("labels"), F.get("f", F.lit(2)).cast("int").alias("items"), F.get("f", F.lit(3)).cast("double").alias("seconds"))


def manifest_entries(config: DataFrame) -> DataFrame:
    """language_id, manifest_path[], repeat: a row for each path and repetition."""
    d = config.select("language_id", F.explode("manifest_path").alias("path"), F.coalesce("repeat", F.lit(1)).alias("repeat"))
    return d.select("language_id", "path", F.explode(F.sequence(F.lit(1), F.col("repeat"))).alias("turn"))


def lines_with_file(spark: SparkSession, path: str) -> DataFrame:
    """S11."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S15; with a schema nothing is inferred."""
    r = spark.read.option("sep", "\t").option("header", True).option("quote", "")
    return (r.schema(schema) if schema else r).csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).mode("overwrite").csv(path)


def language_map(spark: SparkSession, path: str) -> DataFrame:
    """iso, language_id of a TSV of language_id, language_name, iso_639_3_id, train_data_duration; of a code that repeats the last line counts."""
    d = tsv(spark, path, "language_id string, language_name string, iso string, duration double")
    d = d.withColumn("at", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    return d.groupBy("iso").agg(F.max_by("language_id", "at").alias("language_id"))


def as_json_lines(df: DataFrame) -> DataFrame:
    """A JSON object for each row, null fields left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def symbol_table(spark: SparkSession, path: str) -> DataFrame:
    """symbol, id."""
    f = F.split("value", r"\s+")
    return spark.read.text(path).select(F.get(f, F.lit(0)).alias("symbol"), F.get(f, F.lit(1)).cast("int").alias("id"))


def glossary(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of terms."""
    return spark.read.option("multiLine", True).schema("source_terms array<string>, canonical string, kind string, wrong_translations array<string>, variants array<string>, priority boolean").json(path)


def text_with_fallback(rows: DataFrame, content: str, files: DataFrame, path: str) -> DataFrame:
    """The content column, else the file's text (S4, Z16). files: path, value."""
    j = rows.join(files.select(F.col("path").alias(path), F.col("value").alias("_file")), path, "left")
    own = F.nullif(F.col(content), F.lit(""))
    return j.withColumn("origin", F.when(own.isNotNull(), "db").when(F.col("_file").isNotNull(), "file").otherwise("none")).withColumn("effective", F.coalesce(own, F.col("_file"), F.lit(""))).drop("_file")


def shard_summary(df: DataFrame, shard: str, seconds: str) -> DataFrame:
    """The manifest of a sharded table."""
    return df.groupBy(shard).agg(F.count("*").alias("items"), F.sum(seconds).alias("seconds"))


def write_shards(df: DataFrame, shard: str, path: str) -> None:
    df.write.partitionBy(shard).mode("overwrite").json(path)


def srt_items(order: Column, start: Column, end: Column, text: Column) -> Column:
    """One numbered subtitle."""
    return F.concat(order.cast("string"), F.lit("\n"), srt_time(start), F.lit(" --> "), srt_time(end), F.lit("\n"), text, F.lit("\n"))


# --- HTML ---


def visible_text(html: Column) -> Column:
    """Text without scripts, styles, navigation and tags, a line for each block."""
    x = F.regexp_replace(html, r"(?is)<(script|style|nav|noscript|header|footer|aside|form)\b[^>]*>.*?</\1\s*>", " ")
    x = F.regexp_replace(x, r"(?is)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?i)<br\s*/?>|</(p|div|h[1-6]|li|tr|section|article)\s*>", "\n")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", "")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    lines = F.transform(F.split(x, "\n"), lambda s: F.trim(F.regexp_replace(s, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n\n")


def links(html: Column) -> Column:
    """Targets of links, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"'#]+)[\"']"), 1))


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


# --- a numbered-line source, as an example of a source of one's own ---


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class LineBlocks(DataSource):
    """Text files read in blocks of bytes, each line with its place: path, offset, line."""

    @classmethod
    def name(cls) -> str:
        return "line_blocks"

    def schema(self) -> str:
        return "path string, offset bigint, line string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _LineReader(self.options)


class _LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.block = options["path"].split(","), int(options.get("block", 1 << 20))

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        out = []
        for p in self.paths:
            store, at = fs.FileSystem.from_uri(p) if "://" in p else (fs.LocalFileSystem(), p)
            size = store.get_file_info(at).size
            out += [_Range(p, i, min(size, i + self.block)) for i in range(0, size, self.block)]
        return out

    def read(self, partition: InputPartition):
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(partition.path) if "://" in partition.path else (fs.LocalFileSystem(), partition.path)
        with store.open_input_file(at) as f:
            first = max(0, partition.start - 1)
            data, size = f.read_at(partition.end - first, first), f.size()
            while not data.endswith(b"\n") and first + len(data) < size:  # the last line may end in a later block
                more = f.read_at(1 << 16, first + len(data))
                stop = more.find(b"\n")
                data += more if stop < 0 else more[: stop + 1]
        place = 0
        if partition.start:
            place = data.find(b"\n") + 1 or len(data)  # a line that an earlier block has begun belongs to it
        while place < len(data) and first + place < partition.end:
            stop = data.find(b"\n", place)
            stop = len(data) if stop < 0 else stop
            yield partition.path, first + place, data[place:stop].rstrip(b"\r").decode("utf-8", "replace")
            place = stop + 1
