"""Load the delivered CSV files with declared schemas.

A value that does not fit its column, a row with the wrong number of fields, or a header with
other names stops the job instead of turning into NULL. Spark converts only the columns a
query reads, so ``import_tables`` is what checks a file whole: it writes every
column to parquet, which the plans then scan by column and more than once.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buyerlens.operators.cleaning import strip_bom
from buyerlens.operators.keep_latest import keep_latest
from buyerlens.sources.schemas import ORDER_REVIEWS, TABLES, TRANSLATIONS, Table

# Quotes inside a quoted field are doubled. An unquoted empty field is NULL and
# a quoted one an empty string, so the NULL marker is a character no file holds.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\u0000",
    "mode": "FAILFAST",
    "enforceSchema": "false",
}
SPLITS = "file string, block long, split long, odd long, begun_0 long, begun_1 long"
PIECES = "file string, block long, record long, text string"
_RECORD_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}


def read_csv(spark: SparkSession, table: Table, path: str | list[str], multiline: bool | None = None) -> DataFrame:
    """One table as delivered, typed but not cleaned.

    Only a table with free text allows line breaks inside quotes by default
    (``read_records``). A stray line break elsewhere fails the load.
    """
    if table.multiline if multiline is None else multiline:
        return read_records(spark, table, path)
    return spark.read.schema(table.schema).options(**CSV_OPTIONS).csv(path)


def _runs(split: np.ndarray):
    """First and next row of each stretch of one split."""
    cuts = np.concatenate(([0], np.flatnonzero(split[1:] != split[:-1]) + 1, [len(split)]))
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def _split_quotes(batches):
    """Of each split whether its quotes are odd in number, and how many records begin in it if it begins outside quotes, and if inside."""
    found = None
    for batch in batches:
        split, odd = (batch.column(k).to_numpy() for k in (2, 3))
        for a, b in _runs(split) if len(split) else ():
            if found is None or found[2] != split[a]:
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(_names(SPLITS), found))], _SPLITS)
                found = [batch.column(0)[a].as_py(), batch.column(1)[a].as_py(), int(split[a]), 0, 0, 0]
            inside = (found[3] + np.cumsum(odd[a:b]) - odd[a:b]) % 2
            begun = int(np.count_nonzero(inside))
            found[3] = int((inside[-1] + odd[b - 1]) % 2)
            found[4] += b - a - begun
            found[5] += begun
    if found:
        yield pa.RecordBatch.from_pylist([dict(zip(_names(SPLITS), found))], _SPLITS)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_SPLITS = pa.schema([("file", pa.string()), *((n, pa.int64()) for n in _names(SPLITS)[1:])])


def _put_together(crossing: bool):
    """Records from lines: those that begin and end in a split, or with ``crossing`` the pieces of the others."""
    def rows(file, block, record, texts) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(record, pa.int64()), texts.cast(pa.string())],
            names=_names(PIECES))

    def run(batches):
        now = None  # split, file, block
        inside = record = 0
        held, entered = [], False  # lines of the record that is being read, and whether it began in a split before

        def finished(crosses: bool):
            if held and crosses == crossing:
                yield rows(now[1], now[2], [record], pa.array(["\n".join(x for h in held for x in h.to_pylist())], pa.string()))

        for batch in batches:
            split, odd, begins, before = (batch.column(k).to_numpy() for k in (2, 3, 4, 5))
            for a, b in _runs(split) if len(split) else ():
                if now is None or now[0] != split[a]:
                    yield from finished(entered or inside == 1)
                    now = (split[a], batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
                    inside, record = int(begins[a]), int(before[a])
                    held, entered = [], inside == 1
                within = (inside + np.cumsum(odd[a:b]) - odd[a:b]) % 2
                first = np.flatnonzero(within == 0)
                lines = batch.column(6).slice(a, b - a)
                inside = int((within[-1] + odd[b - 1]) % 2)
                if not len(first):
                    held.append(lines)
                    continue
                if first[0]:
                    held.append(lines.slice(0, first[0]))
                yield from finished(entered)
                if len(first) > 1 and not crossing:
                    whole = lines.slice(first[0], first[-1] - first[0])
                    ends = pa.array(first - first[0], pa.int32() if pa.types.is_string(lines.type) else pa.int64())
                    kind = pa.ListArray if pa.types.is_string(lines.type) else pa.LargeListArray
                    texts = whole if len(whole) == len(first) - 1 else pc.binary_join(kind.from_arrays(ends, whole), "\n")
                    yield rows(now[1], now[2], record + 1 + np.arange(len(first) - 1), texts)
                record += len(first)
                held, entered = [lines.slice(first[-1])], False
        yield from finished(entered or inside == 1)

    return run


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, text) of every CSV record; line breaks inside quotes belong to the record.

    Spark's own reader takes a file with such breaks in one task. Here files are
    split into lines as any text. A line is inside quotes if an odd number of quotes came before it in its
    file, and doubled quotes do not change that; so each split needs from those before it only
    the parity of their quotes and the number of records begun, in one row per split, broadcast. Records within a split
    are put together where the split is read; only pieces of those that cross into the next one meet by a shuffle.
    """
    odd = F.expr("(LENGTH(value) - LENGTH(REPLACE(value, '\"', ''))) % 2").cast("long")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
    ).withColumn("split", F.xxhash64("file", "block"))
    splits = lines.select("file", "block", "split", odd.alias("odd")).mapInArrow(_split_quotes, SPLITS)
    by_split = Window.partitionBy("file").orderBy("block")
    splits = splits.withColumn("entered", (F.sum("odd").over(by_split) - F.col("odd")) % 2)
    begun = F.when(F.col("entered") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))
    splits = splits.withColumn("before", F.sum(begun).over(by_split) - begun).select("split", "entered", "before")
    known = lines.join(F.broadcast(splits), "split").select("file", "block", "split", odd.alias("odd"), "entered", "before", "value")
    pieces = known.mapInArrow(_put_together(True), PIECES)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n")
    crossing = pieces.groupBy("file", "record").agg(text.alias("text"))
    return known.mapInArrow(_put_together(False), PIECES).select("file", "record", "text").unionByName(crossing)


def read_records(spark: SparkSession, table: Table, path: str | list[str]) -> DataFrame:
    """One table as delivered, from files with line breaks inside quotes, each file read by several tasks.

    Lines may end in one sign or two. Empty lines are no records.
    """
    names = ",".join(f.name for f in table.schema)
    text = F.regexp_replace("text", "\r$", "")
    records = csv_records(spark, path).select("record", text.alias("text")).where("text <> ''")
    header = F.translate(F.regexp_replace("text", "^\ufeff", ""), '"', "")
    wrong = F.raise_error(F.concat(F.lit("[MALFORMED_HEADER] expected "), F.lit(names), F.lit(", found "), "text")).cast("boolean")
    rows = records.where(F.when(F.col("record") > 1, True).when(header == names, False).otherwise(wrong))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    parsed = rows.select(F.from_csv("text", ddl, _RECORD_OPTIONS).alias("row")).select("row.*")
    return parsed.select(*(F.col(f.name).alias(f.name, metadata=f.metadata) for f in table.schema))


def load_table(spark: SparkSession, name: str, path: str | list[str], multiline: bool | None = None) -> DataFrame:
    """One table ready for use: translations without BOM, reviews one row per id."""
    table = TABLES[name]
    df = read_csv(spark, table, path, multiline)
    if name == TRANSLATIONS.name:
        return strip_bom(df, "product_category_name")
    if name == ORDER_REVIEWS.name:
        return latest_reviews(df)
    return df


def load_tables(
    spark: SparkSession, paths: Mapping[str, str | list[str]], multiline: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Every table named in ``paths`` (table name to CSV path, folder or glob), read when used.

    The tables in ``multiline`` may have line breaks inside quotes, besides those that may by declaration.
    """
    return {name: load_table(spark, name, path, True if name in multiline else None) for name, path in paths.items()}


def import_tables(
    spark: SparkSession, paths: Mapping[str, str | list[str]], folder: str, multiline: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Load every table into parquet under a new folder; a bad file stops the import."""
    imported = {}
    for name, df in load_tables(spark, paths, multiline).items():
        target = f"{folder}/{name}"
        df.write.parquet(target)
        imported[name] = spark.read.schema(TABLES[name].schema).parquet(target)
    return imported


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The newest version of each review; remaining ties go to the later answer, then the lower order id."""
    return keep_latest(
        reviews,
        keys=["review_id"],
        newest_by=["review_creation_date", "review_answer_timestamp"],
        tie_break=["order_id", "review_score", "review_comment_title", "review_comment_message"],
    )
