"""Readers and writers on small files."""

import gzip

from pyspark.sql import functions as F

from cytoframe.operators.matrix import Matrix
from cytoframe.sources import alignments, annotation, exchange, fastq


def test_fastq_records_cut_by_blocks(spark, tmp_path):
    reads = [(f"r{i}", "ACGT" * (1 + i % 5), "@+I5" * (1 + i % 5)) for i in range(200)]
    text = "".join(f"@{n} run=1\n{s}\n+\n{q}\n" for n, s, q in reads)
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = fastq.read_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.read_id, r.seq, r.qual) for r in got) == sorted(reads * 2)
    assert {r.comment for r in got} == {"run=1"}


def test_fastq_quality_and_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "AC", "II"), ("b", "AC", "!!"), ("c", "", "")], "read_id string, seq string, qual string")
    fastq.write_fastq(rows, str(tmp_path / "out"))
    assert [r.read_id for r in fastq.read_fastq(spark, str(tmp_path / "out")).orderBy("read_id").collect()] == ["a", "b"]
    assert [r.read_id for r in fastq.read_fastq(spark, str(tmp_path / "out"), min_quality=10).collect()] == ["a"]


SAM = "@HD\tVN:1.6\n@SQ\tSN:tr1\tLN:100\nr1\t0\ttr1\t11\t60\t5S20M\t*\t0\t0\tACGT\tIIII\tAS:i:20\tCB:Z:AAA\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\nr3\t2048\ttr1\t1\t7\t10M\t*\t0\t0\t*\t*\n"


def test_sam(spark, tmp_path):
    p = str(tmp_path / "x.sam")
    (tmp_path / "x.sam").write_text(SAM)
    a = alignments.read_sam(spark, p)
    t = {r.read_id: r for r in alignments.transcript_alignments(a, alignments.read_references(spark, p)).collect()}
    assert (t["r1"].aln_score, t["r1"].tr_cov, t["r1"].q_cov, t["r1"].tr_mapq) == (20, 0.2, 0.8, 60)
    assert set(t) == {"r1", "r3"} and t["r3"].aln_score == 0
    assert [(r.read_id, r.CB, r.CR, r.CY, r.start, r.end) for r in alignments.extract_tags(a).collect()] == [("r1", "AAA", "-", "????????", 10, 30)]
    assert alignments.flag_counts(a).first().asDict() == {"primary": 1, "secondary": 0, "supplementary": 1, "unmapped": 1, "total": 3}
    assert [r.read_id for r in alignments.without_flags(a, 2052).collect()] == ["r1"]
    tags = spark.createDataFrame([("r1", "CCC", "G1"), ("r9", "x", "y")], "read_id string, CB string, GN string")
    alignments.write_sam(alignments.tag_alignments(a, tags), str(tmp_path / "out"))
    back = alignments.read_sam(spark, str(tmp_path / "out")).collect()
    assert [(r.read_id, r.start, r.tags) for r in back] == [("r1", 10, {"AS": "20", "CB": "CCC", "GN": "G1"})]


def test_annotation(spark, tmp_path):
    row = lambda kind, a, b, more: f"chr1\tx\t{kind}\t{a}\t{b}\t.\t+\t.\t{more}\n"
    (tmp_path / "a.gtf").write_text("#h\n" + row("transcript", 1, 90, 'transcript_id "t1"; gene_name "g1";') + row("mRNA", 1, 90, 'transcript_id "t2";') + row("exon", 1, 10, 'transcript_id "t1";') + row("exon", 31, 50, 'transcript_id "t1";') + row("exon", 71, 90, 'transcript_id "t1";'))
    got = annotation.read_transcript_genes(spark, str(tmp_path / "a.gtf")).collect()
    assert sorted((r.ref_id, r.gene_name or "") for r in got) == [("t1", "g1"), ("t2", "")]
    assert sorted((r.start, r.end) for r in annotation.junctions(spark, str(tmp_path / "a.gtf")).collect()) == [(10, 30), (50, 70)]


def test_genotypes(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tc1\tc2\nchr1\t5\t.\tA\tC,G\t.\t.\t.\tDP:GT\t3:0/1\t4:./.\n")
    got = annotation.read_genotypes(spark, str(tmp_path / "a.vcf")).collect()
    assert sorted((r.variant, r["sample"], r.gt) for r in got) == [("chr1_5_A_C", "c1", "0/1"), ("chr1_5_A_C", "c2", "./.")]


def test_sheets(spark):
    sheet = lambda rows: spark.createDataFrame(rows, "barcode string, alias string, type string")
    sound = sheet([("barcode01", "a", "test_sample"), ("barcode02", "b", "positive_control")])
    assert annotation.sheet_faults(sound).count() == 0
    assert {r.fault for r in annotation.sheet_faults(sheet([("barcode01", "a", "odd"), ("barcode01", "barcodex", "test_sample"), ("x", "a", "test_sample")])).collect()} == {
        "a barcode is not 'barcode' and two digits or more",
        "an alias begins with 'barcode'",
        "barcodes differ in length",
        "a barcode repeats",
        "an alias repeats",
        "a sample type is unknown",
    }
    assert annotation.sheet_faults(sound, required_types=("negative_control",)).count() == 1
    found = spark.createDataFrame([("barcode01",), ("barcode77",)], "folder string")
    assert sorted((r.alias, r.folder or "", r.matched or "") for r in annotation.join_sheet(found, sound).collect()) == [("a", "barcode01", "barcode"), ("b", "", "")]


def test_exchange_round_trip(spark, tmp_path):
    values = spark.createDataFrame([(f"g{i % 7}", f"c{i % 11}", i + 1) for i in range(40)], "feature string, cell string, value long")
    m = Matrix.from_values(values)
    exchange.write_exchange(m, str(tmp_path / "mex"))
    back = exchange.read_exchange(spark, str(tmp_path / "mex"))
    assert sorted(map(tuple, back.values.withColumn("value", F.col("value").cast("long")).collect())) == sorted(map(tuple, values.collect()))
    ids = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "mex/features.tsv")).collect()]
    assert sorted(ids) == [[f"unknown_{i:05d}", f"g{i}", "Gene Expression"] for i in range(7)]
    head = "\n".join(r.value for r in spark.read.text(str(tmp_path / "mex/matrix.mtx/header")).collect()).split("\n")
    assert head[0].startswith("%%MatrixMarket") and head[-1] == "7 11 40"


def test_downsample_and_saturation(spark):
    values = spark.createDataFrame([(f"g{i % 5}", f"c{i % 9}", 50) for i in range(45)], "feature string, cell string, value long")
    m = Matrix.from_values(values)
    half = m.downsample(0.5).values.agg(F.sum("value")).first()[0]
    assert 0.4 < half / (45 * 50) < 0.6
    assert m.downsample(1.0).values.agg(F.sum("value")).first()[0] == 45 * 50
    s = {r.frac: r for r in m.saturation_statistics((1.0, 0.5, 0.01)).collect()}
    assert s[1.0].n_umis == 2250 and s[0.5].n_umis == half and s[0.01].n_umis < 100
    assert s[1.0].median_feats == 5 and s[1.0].median_umis == 250
