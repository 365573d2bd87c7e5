"""Readers. Every reader takes any path that Spark can read and names its schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanmill.functions import urls
from gleanmill.operators.setops import keep_first

PAGES_STATE = "uuid string, url string, domaine string, type string, date_crawl timestamp, profondeur int, score double, mots_cles_trouves array<string>"
ERRORS = "url string, domaine string, code_http string, message string, date timestamp"
JOURNAL = "url string, status string, code int, year int, file string, message string"
LISTINGS = "url string, articles array<string>, pagination array<string>"
DOWNLOAD_LOG = "timestamp timestamp, query string, rank int, engine string, url string, final_url string, status string, content_type string, file_path string, message string"
SITE = T.StructType(
    [
        T.StructField("name", T.StringType()), T.StructField("start_urls", T.ArrayType(T.StringType())),
        *[T.StructField(n, T.StringType()) for n in ("article_url_pattern", "pagination_pattern", "date_selector", "date_regex", "date_format")],
        T.StructField("disable_nav_filter", T.BooleanType()),
    ]
)


def lines(spark: SparkSession, path: str, comments: bool = True, lower: bool = False) -> DataFrame:
    """(pos, value): stripped lines without blank ones, and without # lines where comments are allowed.

    ``pos`` grows with the place in the file, and over several files in the order
    of their names, whichever tasks read them.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    out = spark.read.text(path).select("value", place.alias("pos")).withColumn("value", F.trim("value")).filter("value <> ''")
    out = out.filter(~F.col("value").startswith("#")) if comments else out
    return out.select("pos", F.lower("value").alias("value") if lower else "value")


def keywords(spark: SparkSession, path: str) -> list[str]:
    """Keywords of a file in order, in lower case; repeated ones stay. An empty file is an error."""
    found = [r["value"] for r in lines(spark, path, lower=True).orderBy("pos").collect()]  # a configuration file
    if not found:
        raise ValueError(f"no keywords in {path}")
    return found


def sources(spark: SparkSession, path: str) -> DataFrame:
    """(pos, source): clean source URLs, the first of equal ones; no comment rule."""
    rows = lines(spark, path, comments=False).withColumn("source", urls.source_form(F.col("value"))).filter("source <> ''")
    return keep_first(rows, F.col("source"), "pos").select("pos", "source")


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table, empty where none was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.sql("SELECT 1").limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(schema).fields])


def seen_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url_key): one normal form per line, empty where there is no file."""
    try:
        return spark.read.text(path).select(F.trim("value").alias("url_key")).filter("url_key <> ''").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.sql("SELECT CAST(NULL AS STRING) AS url_key").limit(0)


def sites(spark: SparkSession, text: str) -> DataFrame:
    """Site table from YAML text: defaults fill gaps, the name defaults to the first start URL, sites without any go."""
    import yaml

    loaded = yaml.safe_load(text) or {}
    defaults, rows = loaded.get("defaults") or {}, []
    for site in loaded.get("sites") or []:
        starts = site.get("start_urls") or []
        if starts:
            patterns = [site.get(k) for k in ("article_url_pattern", "pagination_pattern", "date_selector")]
            rows.append((site.get("name") or starts[0], starts, *patterns, site.get("date_regex") or defaults.get("date_regex"), site.get("date_format") or defaults.get("date_format"), bool(site.get("disable_nav_filter", False))))
    return spark.createDataFrame(rows, SITE)


def practitioners(spark: SparkSession, path: str) -> DataFrame:
    """(place, name) of a file separated by semicolons, without a header."""
    return spark.read.csv(path, sep=";", header=False, schema="place string, name string").select(F.trim("place").alias("place"), F.trim("name").alias("name"))


def journal(spark: SparkSession, path: str, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(article rows, listing rows) of a JSON journal; two kinds of entries never share a table.

    A journal has one object per line, as ``sinks.write_journal`` leaves it, or is
    one object as a ``whole``.
    """
    entry = "struct<status:string,code:int,year:int,file:string,message:string,articles:array<string>,pagination:array<string>>"
    parsed = spark.read.text(path, wholetext=whole).select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("k", "v"))
    articles = parsed.filter(~F.col("k").startswith("__listing__")).select(F.col("k").alias("url"), "v.status", "v.code", "v.year", "v.file", "v.message")
    listings = parsed.filter(F.col("k").startswith("__listing__")).select(F.substring("k", 12, 2147483647).alias("url"), "v.articles", "v.pagination")
    return articles, listings


def to_score(pages: DataFrame) -> DataFrame:
    """Pages without a score, oldest first; the filter and the five columns reach the scan."""
    return pages.filter("score IS NULL").select("uuid", "url", "domaine", "type", "profondeur", "date_crawl").orderBy("date_crawl")


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """(uuid, type, content) of files named uuid.type."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract(name, r"^(.*)\.([^.]*)$", 1).alias("uuid"), F.regexp_extract(name, r"^(.*)\.([^.]*)$", 2).alias("type"), "content")
