"""Writers. Nothing is updated in place or deleted: outcomes are written side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmill.functions import text
from gleanmill.operators import history
from gleanmill.operators.setops import unseen


def with_columns_of(rows: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Rows with every column of a newer schema; missing ones are null."""
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in schema.items() if c not in rows.columns})


def write_outcomes(rows: DataFrame, path: str, outcome: str = "outcome") -> None:
    """All rows, one folder per outcome, replacing what was there."""
    rows.write.mode("overwrite").partitionBy(outcome).parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def blob_ids(rows: DataFrame) -> DataFrame:
    """A name for each blob that depends on its URL alone, so that a rerun writes the same names."""
    return rows.withColumn("uuid", F.sha2("url", 256))


def append_seen(visited: DataFrame, known: DataFrame, path: str, large: bool = False) -> DataFrame:
    """Append the keys of successes, of the first and the final URL, that are new; returns them.

    A ``large`` history is asked behind a Bloom filter, so that surely new keys don't meet it.
    """
    ok = visited.filter("status = 'SUCCESS'")
    keys = ok.select("url_key").union(ok.select(F.col("final_key").alias("url_key"))).filter("url_key IS NOT NULL AND url_key <> ''").distinct()
    new = history.unseen(keys, "url_key", known) if large else unseen(keys, "url_key", known)
    new.write.mode("append").text(path)
    return new


def write_markdown(articles: DataFrame, path: str) -> None:
    """Articles as Markdown, in order, with a rule between them."""
    body = text.markdown(*[F.col(c) for c in ("title", "date", "authors", "url", "description", "text")])
    ordered = articles.orderBy("pos").withColumn("value", F.concat(F.when(F.col("pos") > articles.agg(F.min("pos")).scalar(), F.lit("---\n\n")).otherwise(F.lit("")), body, F.lit("\n")))
    ordered.select("value").write.mode("overwrite").text(path)


def write_delimited(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").csv(path, sep=";", header=False)


def write_log(entries: DataFrame, path: str) -> None:
    """Log blocks, appended."""
    block = text.log_block({c: F.col(c) for c in entries.columns})
    entries.select(block.alias("value")).write.mode("append").text(path)


def updated(state: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """The state with new values of a column where there are any; keys that the state does not have are left out."""
    new = values.select(F.col(key).alias("__gm_key"), F.col(column).alias("__gm_value"))
    joined = state.join(new, F.col(key) == F.col("__gm_key"), "left")
    return joined.withColumn(column, F.coalesce("__gm_value", column)).select(*state.columns)


def write_journal(articles: DataFrame, listings: DataFrame, path: str) -> None:
    """A journal as JSON objects, one entry per line and file part, replacing what was there.

    ``articles`` has url, status, code, year, file and message, ``listings`` url,
    articles and pagination; a listing's key says that it is one.
    """
    entry = lambda key, columns: F.to_json(F.map_from_arrays(F.array(key), F.array(F.struct(*columns)))).alias("value")
    rows = articles.select(entry(F.col("url"), ["status", "code", "year", "file", "message"]))
    more = listings.select(entry(F.concat(F.lit("__listing__"), F.col("url")), ["articles", "pagination"]))
    rows.unionByName(more).write.mode("overwrite").text(path)


def write_contents(rows: DataFrame, path: str) -> None:
    """Contents (binary) as files called ``name``, through the file system that the path names; a rerun writes the same files."""
    target = path
    settings = {e.getKey(): e.getValue() for e in rows.sparkSession.sparkContext._jsc.hadoopConfiguration().iterator() if e.getKey() == "fs.defaultFS"}

    def put(batches):
        import pyarrow as pa
        import pyarrow.fs

        where = target if "://" in target or target.startswith(("/", "file:")) else f"{settings['fs.defaultFS']}/{target}"
        system, base = pyarrow.fs.FileSystem.from_uri(where.replace("file:/", "file:///", 1) if where.startswith("file:/") and not where.startswith("file://") else where)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write(content.as_py() or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["written"])

    rows.select("name", "content").mapInArrow(put, "written long").write.format("noop").mode("overwrite").save()
