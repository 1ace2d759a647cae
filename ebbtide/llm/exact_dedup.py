"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Texts are equal when identical after each run of white space is one space. Each
has a fingerprint of ``FP_BITS`` bits; ranges of fingerprints have owners.

1. A partition sorts the fingerprints of up to ``SOURCE_ROWS`` rows at a time and
   sends each owner the distinct ones of its range as a Golomb code.
2. An owner merges the lists that it gets and answers each with a bitmap: which
   of its fingerprints other lists hold too. A partition adds those that it holds
   twice itself. These fingerprints are the suspects.
3. Only rows with a suspect's fingerprint are shuffled with their text, and
   compared byte by byte; a partition sends equal texts once. Texts that merely
   share a fingerprint part here.

Number and size of the owners follow the number of rows (``OWNER_ROWS`` each). A
copy held by a third of all rows comes to its owner once a list, to the
comparison once a partition and there through ``SALTS`` groups, and its class is
broadcast to its rows. Rows are filtered before the shuffle by a bitmap of the
suspects of at most ``FILTER_BITS`` bits; where that is too small for all suspects
(from some 10^8 on) more rows than the suspects are shuffled and compared, with the
same result. Two texts with one fingerprint and one SHA-256 stop the job.

Of equal texts the row with the smallest id stays, one without id last; of rows
with equal ids and texts one stays. A null text counts as empty, and all empty
texts are equal. Texts of any length are handled whole. An empty table gives an
empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import semijoin
from . import golomb
from .classes import attach
from .scratch import drop_stored, stored

FP_BITS = 48
SOURCE_ROWS = 1 << 20
OWNER_ROWS = 1 << 18
SALTS = 64
FILTER_BITS = 1 << 27

#: Runs of white space that are not a single space already.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def _fingerprint(text: Column, bits: int) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << bits) - 1))


def send(marks: DataFrame, bits: int, owner_bits: int, source_rows: int = SOURCE_ROWS) -> DataFrame:
    """(list, owner, n, code, own): a partition's fingerprints for each owner, and a
    bitmap of those that it holds more than once itself."""
    width = 1 << (bits - owner_bits)

    def lists(found: list[np.ndarray], name: int) -> Iterator[pa.RecordBatch]:
        values, times = np.unique(np.concatenate(found), return_counts=True)
        owners, at = np.unique(values >> (bits - owner_bits), return_index=True)
        at = np.append(at, len(values))
        for some in range(0, len(owners), 4096):
            part = range(some, min(some + 4096, len(owners)))
            yield pa.RecordBatch.from_pydict({
                "list": pa.array(np.full(len(part), name), pa.int64()),
                "owner": pa.array(owners[part.start : part.stop], pa.int64()),
                "n": pa.array([int(at[i + 1] - at[i]) for i in part], pa.int32()),
                "code": pa.array([golomb.encode(values[at[i] : at[i + 1]] - owners[i] * width, width) for i in part], pa.binary()),
                "own": pa.array([np.packbits(times[at[i] : at[i + 1]] > 1).tobytes() for i in part], pa.binary()),
            })

    def run(batches):
        found, held, name = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            found.append(batch.column(0).to_numpy(zero_copy_only=False))
            held += batch.num_rows
            if held >= source_rows:
                yield from lists(found, name)
                found, held, name = [], 0, name + 1
        if held:
            yield from lists(found, name)

    return marks.select("fp").mapInArrow(run, "list bigint, owner bigint, n int, code binary, own binary")


def answer(lists: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """(list, owner, held): for each list a bitmap of its fingerprints that its owner got in other lists too."""
    width = 1 << (bits - owner_bits)

    def merge(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_numpy()
        values = np.concatenate([golomb.decode(c, n, width) for c, n in zip(table.column("code").to_pylist(), sizes.tolist(), strict=True)])
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        twice = np.zeros(len(values), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        cuts = np.split(twice, np.cumsum(sizes)[:-1])
        return pa.table({"list": table.column("list"), "owner": table.column("owner"), "held": pa.array([np.packbits(x).tobytes() for x in cuts], pa.binary())})

    return lists.select("list", "owner", "n", "code").groupBy("owner").applyInArrow(merge, "list bigint, owner bigint, held binary")


def receive(lists: DataFrame, answers: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """(fp): the suspects of every list, by its answers."""
    width = 1 << (bits - owner_bits)

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for owner, n, code, own, held in zip(*(rows[c] for c in ("owner", "n", "code", "own", "held")), strict=True):
                set_bits = np.frombuffer(own, np.uint8) | np.frombuffer(held, np.uint8)
                if set_bits.any():
                    flags = np.unpackbits(set_bits, count=n).astype(bool)
                    yield pa.RecordBatch.from_pydict({"fp": pa.array(golomb.decode(code, n, width)[flags] + owner * width, pa.int64())})

    return lists.join(answers, ["list", "owner"]).select("owner", "n", "code", "own", "held").mapInArrow(run, "fp bigint")


def suspects(marks: DataFrame, n_rows: int, bits: int = FP_BITS, owner_rows: int = OWNER_ROWS, source_rows: int = SOURCE_ROWS) -> DataFrame:
    """(fp): every fingerprint that two rows of ``marks`` have, once for each list that holds it."""
    owners = max(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // owner_rows))
    owner_bits = min((owners - 1).bit_length(), bits)
    lists = stored(send(marks, bits, owner_bits, source_rows), "lists")
    out = stored(receive(lists, answer(lists, bits, owner_bits), bits, owner_bits), "suspects")
    drop_stored(lists)
    return out


def _compared(docs: DataFrame, keep, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(fp, sha, group_size) of the texts that more than one row has, compared whole."""
    rows = docs.select(F.col(id_col).alias("doc"), normalised(F.col(text_col)).alias("body")).withColumn("fp", _fingerprint(F.col("body"), bits))
    part = keep(rows).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    once = part.groupBy("salt", "fp", "body").agg(F.count(F.lit(1)).alias("n")).drop("salt")
    texts = once.repartition("fp").groupBy("fp", "body").agg(F.sum("n").alias("n"))
    named = texts.select("fp", F.sha2("body", 256).alias("sha"), "n").groupBy("fp", "sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    size = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a fingerprint and a SHA-256")).cast("bigint")).otherwise(F.col("n"))
    return named.select("fp", "sha", size.alias("group_size")).filter("group_size > 1")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FP_BITS, owner_rows: int = OWNER_ROWS, source_rows: int = SOURCE_ROWS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    body = docs.select(F.col(id_col).alias("doc"), normalised(F.col(text_col)).alias("body"))
    marks = stored(body.select("doc", F.sha2("body", 256).alias("sha"), _fingerprint(F.col("body"), bits).alias("fp"), F.monotonically_increasing_id().alias("row")), "marks")
    n_rows = marks.count()
    found = suspects(marks, n_rows, bits, owner_rows, source_rows)
    # 16 bits a suspect leave 6 in 100 other rows in; 64 bits are a row of the bitmap
    wanted = min(filter_bits, max(1 << 16, 64 * -(-found.count() // 4)))
    held = semijoin.bitmap(found, "fp", wanted)

    def keep(rows: DataFrame) -> DataFrame:
        return semijoin.keep_members(rows, held, "fp", wanted)

    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("first")
    keepers = keep(marks).groupBy("fp", "sha").agg(first)
    classes = stored(_compared(docs, keep, id_col, text_col, bits).join(keepers, ["fp", "sha"]).select(
        "fp", "sha", "group_size", F.col("first.doc").alias("keep_id"), F.col("first.row").alias("keep_row")), "classes")
    drop_stored(found)
    joined = attach(marks, classes, ["fp", "sha"], "group_size", n_rows)
    alone = F.col("keep_row").isNull()
    return joined.select(
        F.col("doc").alias(id_col),
        F.when(alone, F.col("doc")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )

