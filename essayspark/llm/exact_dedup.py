"""Exact deduplication by progressive refinement (operator 12), DataFrame functions only.

Rows that can have no equal are ruled out by cheap keys before any content is hashed:

1. one scan writes a narrow key row per document: length in bytes and a hash of the first ``prefix`` characters;
2. lengths that occur once settle their rows; the others are grouped by length and prefix hash;
3. only rows of groups that are left have their whole text hashed (SHA-256), in the scan, row by row: texts
   themselves are never shuffled.  Rows are grouped by length and this hash.

Which keys are left is told to the scans by a bitmap of ``2**BITMAP_BITS`` slots, so what is broadcast has a fixed bound
(a row for 64 slots, 2**18 rows) whatever the corpus; a slot that two keys share lets more rows through to the next
step and never fewer.  Groups are aggregates with partial sums, so a group of a third of all rows is combined in every
task; the join that tells each row its group is between two written tables, whose skewed parts AQE splits.

A null text counts as empty.  Of equal texts the row with the largest ``doc_id`` stays, a null id counting as smaller
than all others; of rows that repeat that id too, one stays (the one that the scan numbered first).  Other columns play no part and may have
any name.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import free_names, written

PREFIX_CHARS = 256
BITMAP_BITS = 24


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << BITMAP_BITS))


def _cell(slot: Column) -> Column:
    return F.shiftright(slot, 6)


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))


def _bitmap(keys: DataFrame, *key: str) -> DataFrame:
    """cell, bits: the slots of ``keys``; at most 2**(BITMAP_BITS - 6) rows."""
    slot = _slot(*map(F.col, key))
    return keys.select(_cell(slot).alias("cell"), _bit(slot).alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))


def _marked(df: DataFrame, bitmap: DataFrame, slot: Column, flag: str) -> DataFrame:
    """``df`` with a boolean column: whether the row's slot is in the bitmap."""
    cell, bits = free_names(df, "cell", "bits")
    bitmap = F.broadcast(bitmap.select(F.col("cell").alias(cell), F.col("bits").alias(bits)))
    hit = F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(_bit(slot)) != 0
    return df.withColumn(cell, _cell(slot)).join(bitmap, cell, "left").withColumn(flag, hit).drop(cell, bits)


def _candidates(docs: DataFrame, prefix: int) -> DataFrame:
    """The bitmap of (length, prefix hash) keys that several rows have."""
    n, p = F.octet_length(_text()).cast("long"), F.xxhash64(F.substring(_text(), 1, prefix))
    keys = written(docs.select(n.alias("n"), p.alias("p")))
    lengths = keys.groupBy("n").count().filter("count > 1")
    rest = _marked(keys, _bitmap(lengths, "n"), _slot(F.col("n")), "open").filter("open")
    return written(_bitmap(rest.groupBy("n", "p").count().filter("count > 1"), "n", "p"))


def _hashed(docs: DataFrame, prefix: int, n: str, h: str) -> DataFrame:
    """``docs`` with the length and, for rows that may have an equal, the SHA-256 of the whole text (else null)."""
    p, flag = free_names(docs, "p", "flag")
    bitmap = _candidates(docs, prefix)
    docs = docs.withColumn(n, F.octet_length(_text()).cast("long")).withColumn(p, F.xxhash64(F.substring(_text(), 1, prefix)))
    docs = _marked(docs, bitmap, _slot(F.col(n), F.col(p)), flag)
    return docs.withColumn(h, F.when(F.col(flag), F.unhex(F.sha2(_text().cast("binary"), 256)))).drop(p, flag)


def _groups(rows: DataFrame) -> DataFrame:
    """n, h, group_size, keep_id, keep_row of every group of two or more rows (columns n, h, doc_id, rid)."""
    best = F.max(F.struct("doc_id", (-F.col("rid")).alias("first")))
    groups = rows.groupBy("n", "h").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).filter("group_size > 1")
    return groups.select("n", "h", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.first")).alias("keep_row"))


def exact_duplicates(docs: DataFrame, prefix: int = PREFIX_CHARS, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id (of the row of its group that stays), group_size, kept, and the columns of
    ``carry`` (expressions over ``docs``, computed in the scan that hashes)."""
    n, h = free_names(docs, "n", "h")
    extra = dict(carry or {})
    rows = _hashed(docs, prefix, n, h).select("doc_id", F.col(n).alias("n"), F.col(h).alias("h"), F.monotonically_increasing_id().alias("rid"),
                                              *[c.alias(f"c_{k}") for k, c in extra.items()])
    rows = written(rows)
    shown = [F.col(f"c_{k}").alias(k) for k in extra]
    alone = rows.filter("h is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *shown)
    open_ = rows.filter("h is not null")
    told = open_.join(written(_groups(open_)), ["n", "h"], "left")
    one = F.col("group_size").isNull()
    told = told.select("doc_id", F.when(one, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                       (one | (F.col("rid") == F.col("keep_row"))).alias("kept"), *shown)
    return alone.unionByName(told)


def drop_duplicates(docs: DataFrame, prefix: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Of rows equal in text and id one stays, whichever."""
    n, h = free_names(docs, "n", "h")
    rows = _hashed(docs, prefix, n, h)
    keep, size = free_names(rows, "keep_id", "group_size")
    open_ = rows.filter(F.col(h).isNotNull())
    groups = written(open_.groupBy(n, h).agg(F.count(F.lit(1)).alias(size), F.max("doc_id").alias(keep)).filter(F.col(size) > 1))
    stay = open_.join(groups, [n, h], "left").filter(F.col(size).isNull() | F.col("doc_id").eqNullSafe(F.col(keep)))
    stay = stay.filter(F.col(size).isNull()).unionByName(stay.filter(F.col(size).isNotNull()).dropDuplicates([n, h]))
    return rows.filter(F.col(h).isNull()).select(*docs.columns).unionByName(stay.select(*docs.columns))
