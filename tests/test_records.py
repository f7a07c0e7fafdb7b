"""FASTQ and SAM data sources: splits, compression, layouts, streams and restarts."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cytoframe.sources import fastq, records


def texts(n, seed=1):
    """Records with quality lines that begin with '@' or '+', empty reads, comments by blank and tab."""
    g = random.Random(seed)
    out = []
    for i in range(n):
        size = g.choice([0, 1, 3, 40, 300])
        seq = "".join(g.choice("ACGT") for _ in range(size))
        qual = "".join(g.choice("@+!IF") for _ in range(size))
        out.append((f"r{seed}.{i}", seq, qual, g.choice([None, "runid=x a=1", "k\tv"])))
    return out


def as_text(rows):
    return "".join(f"@{i}{'' if c is None else ' ' + c}\n{s}\n+{i if len(s) == 3 else ''}\n{q}\n" for i, s, q, c in rows)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open if path.endswith(".gz") else open)(path, "wt", newline="") as f:
        f.write(text)


def rows_of(df):
    return sorted((r.read_id, r.seq, r.qual, r.comment) for r in df.collect())


@pytest.mark.parametrize("split_bytes", [1, 7, 64, 1000, 10**9])
def test_ranges_of_every_size(spark, tmp_path, split_bytes):
    n = 12 if split_bytes < 10 else 300
    rows = texts(n)
    put(f"{tmp_path}/a.fastq", as_text(rows))
    got = records.fastq(spark, str(tmp_path), split_bytes=split_bytes)
    assert rows_of(got) == sorted(rows)


def test_every_cut_of_a_file(tmp_path):
    """Any two ranges give all records once, wherever they meet, with blocks of a few bytes."""
    rows = texts(9, 5)
    put(f"{tmp_path}/a.fastq", as_text(rows))
    system, path = records.file_system(f"{tmp_path}/a.fastq")
    size = os.path.getsize(path)
    before, records.BLOCK_BYTES = records.BLOCK_BYTES, 5
    try:
        for cut in range(1, size):
            got = [r["read_id"] for a, b in ((0, cut), (cut, size)) for batch in records.fastq_batches(system, path, None, a, b, "error") for r in batch.to_pylist()]
            assert got == [r[0] for r in rows], cut
    finally:
        records.BLOCK_BYTES = before


def test_as_the_reader_of_text(spark, tmp_path):
    rows = texts(200, 2)
    put(f"{tmp_path}/a.fastq", as_text(rows))
    put(f"{tmp_path}/b.fq.gz", as_text(texts(50, 3)))
    put(f"{tmp_path}/c.fastq", as_text(texts(20, 4)).replace("\n", "\r\n").rstrip("\r\n"))  # ends without a line's end
    put(f"{tmp_path}/note.txt", "not read")
    got = records.fastq(spark, f"file://{tmp_path}", split_bytes=500)
    assert rows_of(got) == sorted(rows + texts(50, 3) + texts(20, 4))
    assert rows_of(got.where("file like '%a.fastq'")) == rows_of(fastq.read_fastq(spark, f"{tmp_path}/a.fastq"))
    empty = tmp_path / "none"
    empty.mkdir()
    put(f"{empty}/e.fastq", "")
    assert records.fastq(spark, str(empty)).count() == 0


def test_broken_files(spark, tmp_path):
    put(f"{tmp_path}/a/x.fastq", "@r\nAC\n+\nII\n@s\nAC\n")
    with pytest.raises(Exception, match="ends inside a record"):
        records.fastq(spark, f"{tmp_path}/a").count()
    assert [r.read_id for r in records.fastq(spark, f"{tmp_path}/a", truncated="drop").collect()] == ["r"]
    put(f"{tmp_path}/b/x.fastq", "@r\nACG\n+\nII\n")
    with pytest.raises(Exception, match="no record of four lines at byte 0"):
        records.fastq(spark, f"{tmp_path}/b").count()
    with pytest.raises(Exception, match="split_bytes"):
        records.fastq(spark, f"{tmp_path}/a", split_bytes=0).count()


def test_layouts(spark, tmp_path):
    one = as_text(texts(3))
    for p in ("s1/a.fastq", "s2/b.fastq", "unclassified/c.fastq", "s1_fail/d.fastq", "s3/e.txt"):
        put(f"{tmp_path}/in/{p}", one)
    folders = lambda **o: {r.folder for r in records.fastq(spark, f"{tmp_path}/in", **o).collect()}
    assert folders() == {"s1", "s2"}
    assert folders(unclassified="true") == {"s1", "s2", "unclassified"}
    assert folders(sheet=json.dumps({"s2": 1, "s9": 1})) == {"s2"}
    put(f"{tmp_path}/in/f.fastq", one)
    with pytest.raises(Exception, match="in the folder and in sub-folders"):
        folders()
    put(f"{tmp_path}/deep/a/b/c.fastq", one)
    with pytest.raises(Exception, match="deeper"):
        records.fastq(spark, f"{tmp_path}/deep").count()
    put(f"{tmp_path}/top/c.fastq", one)
    with pytest.raises(Exception, match="sample sheet"):
        records.fastq(spark, f"{tmp_path}/top", sheet='{"s1": 1}').count()


def test_stream_takes_every_file_once(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(f"{folder}/s1/a.fastq", as_text(texts(30, 1)))

    def run():
        reads = records.fastq_stream(spark, folder, f"{tmp_path}/log", split_bytes=200)
        q = reads.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/check").start()
        q.processAllAvailable()
        return q

    q = run()
    put(f"{folder}/s2/b.fastq.gz", as_text(texts(30, 2)))
    q.processAllAvailable()
    q.stop()
    put(f"{folder}/s2/c.fastq", as_text(texts(30, 3)))
    run().stop()  # a restart goes on where the last one ended
    got = spark.read.parquet(out)
    assert rows_of(got) == sorted(texts(30, 1) + texts(30, 2) + texts(30, 3))
    assert rows_of(got) == rows_of(records.fastq(spark, folder))


def test_stream_layout_rules(spark, tmp_path):
    put(f"{tmp_path}/in/s9/a.fastq", as_text(texts(3)))
    reads = records.fastq_stream(spark, f"{tmp_path}/in", f"{tmp_path}/log", sheet='{"s1": 1}')
    q = reads.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/check").start()
    with pytest.raises(Exception, match="sample sheet lacks: s9"):
        q.processAllAvailable()
    q.stop()


def test_sam_lines(spark, tmp_path):
    lines = ["@HD\tVN:1.6\tSO:coordinate", *(f"r{i}\t0\tchr1\t{i}" for i in range(100))]
    put(f"{tmp_path}/a.sam", "\n".join(lines) + "\n")
    put(f"{tmp_path}/b.sam.gz", "\n".join(lines))
    records.register(spark)
    got = spark.read.format("sam_lines").option("split_bytes", 33).load(str(tmp_path))
    assert sorted(r.line for r in got.where(F.col("file").endswith("a.sam")).collect()) == sorted(lines)
    assert sorted(r.line for r in got.where(F.col("file").endswith(".gz")).collect()) == sorted(lines)
