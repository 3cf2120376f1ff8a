"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run: one entry ``(digest, best row, rows)`` per distinct text. Runs
exchange their entries in binomial rounds, ``MERGE_BITS`` rounds at a time: in each, the runs whose
numbers differ in these bits only are merged, every one of them taking the digests that end in its
own bits. A merge sorts what came (Spark's sort, which spills) and reduces equal neighbours as they
stream by, so a task holds one Arrow batch, whatever the number of copies. After the last round a
digest is in one run only, as one entry.

Then the result goes down the same tree. An entry was in at most ``2 ** MERGE_BITS`` runs of the
level below, and in a run of the lowest level are the rows of one input partition; so neither merging
nor telling the rows meets a key with more rows than that, even if all texts are equal.

Equal texts: identical after lower-casing A-Z, null counts as empty. Entries carry SHA-256, the
length in bytes and a second, independent hash; only entries that agree in all three are merged.
Of equal texts the row with the largest (or smallest) ``doc_id`` stays; null ids come last; of rows
with equal id and text exactly one stays. An empty table gives no rows. Other columns of the input
play no part, whatever their names. Texts of any length are hashed whole in the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, ascii_lower, fresh_name, id_and_text
from tastemill.staging import stage_table

#: Binomial rounds that one shuffle does at once: 16 runs are merged into each.
MERGE_BITS = 4
KEY = ("sha", "size", "check")
_ARROW = pa.schema([("run", pa.int32()), ("sha", pa.binary()), ("size", pa.int32()), ("check", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])
ENTRY = "run int, sha binary, size int, check bigint, id bigint, row bigint, n bigint"
#: Bits of monotonically_increasing_id() below the number of the partition.
ROW_BITS = 33


def _folded(text: Column) -> Column:
    """A-Z in lower case; ``lower`` is faster and does the same where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))


def _rows(docs: DataFrame) -> DataFrame:
    """``run, sha, size, check, id, row``: digests of every row, written once so that row numbers stand."""
    folded = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("id"), _folded(F.col("text")).alias("text"))
    hashed = folded.select(
        F.unhex(F.sha2("text", 256)).alias("sha"),
        F.octet_length("text").alias("size"),
        F.xxhash64("text").alias("check"),
        "id",
        F.monotonically_increasing_id().alias("row"),
    )
    return stage_table("digests", hashed.select(F.shiftright("row", ROW_BITS).cast("int").alias("run"), "*"))


def _merge(batches: Batches) -> Batches:
    """Reduce neighbours of equal run and key to the last one, with the sum of their rows."""
    held = None
    for batch in batches:
        # One schema for both: Spark marks columns that have no nulls.
        batch = pa.RecordBatch.from_arrays(batch.columns, schema=_ARROW)
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table.num_rows:
            continue
        fixed = table["sha"].chunk(0).cast(pa.binary(32))
        sha = np.frombuffer(fixed.buffers()[1], dtype=np.uint64).reshape(-1, 4)[fixed.offset : fixed.offset + len(fixed)]
        plain = [table[c].to_numpy() for c in ("run", "size", "check")]
        new = (sha[1:] != sha[:-1]).any(axis=1)
        for column in plain:
            new |= column[1:] != column[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        lasts = np.concatenate([starts[1:], [table.num_rows]]) - 1
        total = np.add.reduceat(table["n"].to_numpy(), starts)
        columns = [c.chunk(0).take(pa.array(lasts)) for c in table.columns]
        merged = pa.RecordBatch.from_arrays([*columns[:-1], pa.array(total)], schema=_ARROW)
        yield merged.slice(0, merged.num_rows - 1)
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield held


def _merged(entries: DataFrame, largest: bool) -> DataFrame:
    """``entries`` of each run in order of their keys, one per key; the row that stays comes last."""
    best = [F.asc_nulls_first("id"), F.desc("row")] if largest else [F.desc_nulls_first("id"), F.desc("row")]
    return entries.select("run", *KEY, "id", "row", "n").sortWithinPartitions("run", *KEY, *best).mapInArrow(_merge, ENTRY)


def _next_run(level: int) -> Column:
    """The run that takes an entry in the round of ``level``: its own number with these bits from the digest."""
    shift = level * MERGE_BITS
    mask = ((1 << MERGE_BITS) - 1) << shift
    return F.col("run").bitwiseAND(F.lit(~mask)).bitwiseOR((F.col("check") % F.lit(1 << 30)).cast("int").bitwiseAND(F.lit(mask)))


def exact_duplicates(docs: DataFrame, largest: bool = True) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs (doc_id, text)``.

    ``keep_id`` is the id of the row that stays of those with an equal text, ``group_size`` their
    number, and ``kept`` holds for exactly one of them. See the module for nulls, ties and empty tables.
    """
    rows = _rows(docs)
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    levels = [stage_table("runs", _merged(rows.withColumn("n", F.lit(1).cast("bigint")).repartition("run"), largest))]
    while 1 << (MERGE_BITS * (len(levels) - 1)) < runs:
        moved = levels[-1].withColumn("run", _next_run(len(levels) - 1))
        levels.append(stage_table("runs", _merged(moved.repartition("run"), largest)))

    top = levels.pop()
    told = top.select("run", *KEY, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    while levels:
        below = levels.pop().select("run", *KEY).withColumn("up", _next_run(len(levels)))
        above = told.withColumnRenamed("run", "up")
        told = below.join(above, ["up", *KEY]).select("run", *KEY, "keep_id", "keep_row", "group_size")
        told = stage_table("told", told) if levels else told
    found = rows.join(told, ["run", *KEY])
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame, largest: bool = True) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``; which of two rows with equal id and text is open."""
    own, theirs = fresh_name(docs, "own"), fresh_name(docs, "kept")
    digest = F.sha2(_folded(F.coalesce(F.col("text"), F.lit(""))), 256)
    named = docs.withColumn(own, F.struct(F.col("doc_id").cast("bigint").alias("id"), digest.alias("sha")))
    kept = exact_duplicates(docs, largest).filter("kept")
    kept = kept.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).alias(theirs))
    return named.join(kept, named[own] == kept[theirs], "left_semi").dropDuplicates([own]).select(docs.columns)
