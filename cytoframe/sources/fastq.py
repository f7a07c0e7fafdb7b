"""FASTQ reads as rows, without moving whole files: blocks are read as lines, and only records cut by a block's edge are joined."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.sources.scratch import written

_WHERE = "_file string, _block long"
BLOCKS_SENT = 100_000  # blocks whose line numbers are sent to all tasks; more go through a join by block


def _by_block(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with their block's first line number, in file order inside a block, where the blocks are too many to broadcast."""
    return lines.withColumn("_i", F.monotonically_increasing_id()).hint("merge").join(starts, ["_file", "_block"]).repartition("_file", "_block").sortWithinPartitions("_file", "_block", "_i")


def _lines_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each block, as partial counts."""
    for batch in batches:
        yield from batch.select([0, 1]).to_pandas().groupby(["_file", "_block"], as_index=False).size().pipe(lambda d: pa.Table.from_pandas(d, preserve_index=False).to_batches())


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (_file, _record, _lines): whole records with four lines, and the ones at a block's edges with the lines that are there.

    _lines holds the line's place in its record (0 to 3) and its text.
    """
    key, number, held = None, 0, []

    def row(part: list) -> tuple:
        return key[0], part[0][0] // 4, [{"place": n % 4, "text": text} for n, text in part]

    for batch in batches:
        out = []
        for file, block, before, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (file, block) != key:
                if held:
                    out.append(row(held))
                key, number, held = (file, block), before, []
            held.append((number, text))
            number += 1
            if number % 4 == 0:
                out.append(row(held))
                held = []
        if out:
            yield _batch(out)
    if held:
        yield _batch([row(held)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())])))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["_file", "_record", "_lines"])


def read_fastq(spark: SparkSession, path: str | list[str], *, min_quality: float | None = None) -> DataFrame:
    """Rows (file, read_id, seq, qual, comment) of four-line FASTQ files, plain or compressed; extensions decide the codec.

    Large plain files are split by Spark. A first pass counts the lines of each block (one row a block is shuffled), so the second
    knows which of the four lines a block begins with; records inside a block never leave their task. A trailing blank line is
    left out; a file whose last record is short loses that record. min_quality keeps reads whose mean error probability is at most that of the Phred value.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("_text"))
    number = lines.mapInArrow(_lines_of_blocks, f"{_WHERE}, size long").groupBy("_file", "_block").agg(F.sum("size").alias("_n"))
    number = written(number, "blocks")
    # one small row a block
    starts = number.select("_file", "_block", (F.sum("_n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_n")).alias("_before"))
    placed = lines.join(F.broadcast(starts), ["_file", "_block"]) if number.count() <= BLOCKS_SENT else _by_block(lines, starts)
    placed = placed.select("_file", "_block", "_before", "_text")
    found = placed.mapInArrow(_records, "_file string, _record long, _lines array<struct<place:int,text:string>>")
    whole = found.where(F.size("_lines") == 4).select("_file", "_lines")
    cut = found.where(F.size("_lines") < 4).groupBy("_file", "_record").agg(F.array_sort(F.flatten(F.collect_list("_lines"))).alias("_lines")).where(F.size("_lines") == 4).select("_file", "_lines")
    text = lambda i: F.get("_lines", F.lit(i))["text"]
    head = F.substring_index(F.translate(text(0), "\t", " "), " ", 1)
    reads = whole.union(cut).select(F.col("_file").alias("file"), F.substring(head, 2, 1 << 30).alias("read_id"), text(1).alias("seq"), text(3).alias("qual"), F.nullif(F.substring(text(0), F.length(head) + 2, F.lit(1 << 30)), F.lit("")).alias("comment"))
    return reads if min_quality is None else reads.where(seq.mean_quality(F.col("qual")) >= min_quality)


def write_fastq(reads: DataFrame, path: str, *, compression: str = "gzip") -> None:
    """FASTQ part files of (read_id, seq, qual); reads without bases are left out."""
    record = F.concat(F.lit("@"), F.col("read_id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    reads.where(F.length("seq") > 0).select(record.alias("value")).write.option("compression", compression).text(path)
