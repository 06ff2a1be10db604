"""Exact deduplication with two-pass Bloom filtering.

Texts are equal when they are after deleting every ``[\\x20\\x09-\\x0D]``; the
SHA-256 of what is left stands for them. The first pass over the digests marks
``HASHES`` bits of each in a filter of fixed size and keeps the bits that two or
more rows have marked. The second pass looks every row up: a row with a bit that
nobody else marked has a text of its own and passes straight through; only the
others are shuffled by digest and compared. Bits shared by chance cost a shuffle of
the row and nothing else. The filter's size bounds what is broadcast; with far more
rows than bits it fills up, more rows are shuffled, and the result stays the same -
raise ``filter_bits`` with the input (about eight bits a row).

Defined results: null counts as empty, and all texts without other characters are
equal. Of equal texts the one with most code points stays, then the smallest doc_id;
a null doc_id comes last, and rows that agree in both go by the MD5 of the original text, the
largest staying. Rows that repeat id and text are one document and are kept
or dropped alike by ``exact_groups``; ``without_copies`` keeps one of them. Other
columns are passed through whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import table, written

FILTER_BITS = 1 << 26
HASHES = 2
_WORD = 32  # bits in one row of the filter

DELETED = " \t\n\x0b\x0c\r"


def normalised(text):
    """The text without white space; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for character in DELETED:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _digests(text):
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def _slots(digest, filter_bits: int):
    """The row of the filter that a digest uses, and the mask of its bits there."""
    row = F.pmod(F.xxhash64(digest), F.lit(filter_bits // _WORD))
    bits = [F.shiftrightunsigned(F.xxhash64(digest, F.lit(k + 1)), 59) for k in range(HASHES)]
    return row, F.array_distinct(F.array(*bits))


def repeated_bits(digests: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """First pass: (row, mask) of the bits that at least two rows mark; at most ``filter_bits / 32`` rows."""
    row, bits = _slots(F.col("text_sha256"), filter_bits)
    marked = digests.select(row.alias("row"), F.explode(bits).alias("bit")).groupBy("row", "bit").agg(F.count("*").alias("n"))
    marked = marked.where("n > 1").groupBy("row").agg(F.expr("bit_or(shiftleft(1L, CAST(bit AS INT)))").alias("mask"))
    return written(marked, "bloom")


def _suspicious(rows: DataFrame, bloom: DataFrame, filter_bits: int) -> DataFrame:
    """Second pass: ``rows`` with ``maybe``, false where no other row can have the same text."""
    row, bits = _slots(F.col("text_sha256"), filter_bits)
    own = F.aggregate(bits, F.lit(0).cast("long"), lambda m, b: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int"))))
    found = rows.withColumn("_row", row).withColumn("_own", own).join(
        F.broadcast(bloom.select(F.col("row").alias("_row"), F.col("mask").alias("_mask"))), "_row", "left"
    )
    return found.withColumn(
        "maybe", F.coalesce(F.col("_mask").bitwiseAND(F.col("_own")) == F.col("_own"), F.lit(False))
    ).drop("_row", "_own", "_mask")


def _winners(maybe: DataFrame) -> DataFrame:
    """Of each text: the row that stays, and how many rows have it."""
    best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("order"), "original"))
    groups = maybe.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))
    return written(groups.select(
        "text_sha256", (-F.col("best.order")).alias("keep_id"), F.col("best.n_points").alias("keep_points"),
        F.col("best.original").alias("keep_original"), "group_size",
    ), "winners")


def _is_winner(doc_id):
    return doc_id.eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")) & (
        F.col("original") == F.col("keep_original"))


def _marks(text):
    """What tells the rows of one text apart besides their ids."""
    text = F.coalesce(text, F.lit(""))
    return [F.char_length(text).cast("long").alias("n_points"), F.md5(F.encode(text, "UTF-8")).alias("original")]


def _digest_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *_marks(F.col("text")), _digests(F.col("text")).alias("text_sha256"))


def exact_groups(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = written(_digest_rows(docs), "digests")
    marked = _suspicious(digests, repeated_bits(digests, filter_bits), filter_bits)
    maybe = marked.where("maybe").drop("maybe")
    judged = maybe.join(_winners(maybe), "text_sha256", "left")
    alone = marked.where("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return alone.unionByName(judged.select(
        "doc_id", "keep_id", "group_size", _is_winner(F.col("doc_id")).alias("kept"), "text_sha256"))


def without_copies(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; only rows that stay are brought together by text."""
    columns = docs.columns
    digests = written(_digest_rows(docs), "digests")
    bloom = repeated_bits(digests, filter_bits)
    winners = _winners(_suspicious(digests, bloom, filter_bits).where("maybe")).withColumnRenamed("text_sha256", "_digest")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"))
    packed = packed.select("doc", *_marks(F.col("doc.text")), _digests(F.col("doc.text")).alias("text_sha256"))
    marked = _suspicious(packed, bloom, filter_bits)
    # A copy meets its winner by id and original text too, so the copies of one text spread.
    own = (F.col("text_sha256") == F.col("_digest")) & _is_winner(F.col("doc.doc_id").cast("long"))
    kept = marked.where("maybe").join(winners, own, "left_semi").dropDuplicates(["text_sha256"])
    return marked.where("NOT maybe").select("doc.*").unionByName(kept.select("doc.*"))


def op9_exact_dedup(spark, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_points, md5(coalesce(text, '')) AS original,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, count(*) AS group_size FROM d GROUP BY 1
), w AS (
    SELECT text_sha256, doc_id AS keep_id, n_points AS keep_points, original AS keep_original FROM d
    QUALIFY row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST, original DESC) = 1
)
SELECT doc_id, keep_id, group_size, text_sha256,
       doc_id IS NOT DISTINCT FROM keep_id AND n_points = keep_points AND original = keep_original AS kept
FROM d JOIN g USING (text_sha256) JOIN w USING (text_sha256)
"""
