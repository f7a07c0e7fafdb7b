"""Errors, parameters and edges of the core pipeline and of ingress."""

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import fusions, kits, saturation, summaries, tagging
from cytoframe.operators.matrix import Matrix
from cytoframe.plans import pipeline
from cytoframe.sources import alignments, annotation, ingress
from cytoframe.sources.scratch import scratch_path

VALUES = "feature string, cell string, value long"


def test_matrix_errors(spark):
    m = Matrix.from_values(spark.createDataFrame([("a", "x", 1), ("MT-b", "x", 9), ("a", "y", 2)], VALUES))
    none = Matrix.from_values(m.values.limit(0))
    for call in (lambda k: k.remove_cells(9, strict=True), lambda k: k.remove_features(9, strict=True), lambda k: k.remove_cells_and_features(9, 1, strict=True), lambda k: k.remove_skewed_cells(-1.0, ["MT-"], strict=True), lambda k: k.bin_cells(4, strict=True)):
        for own in (m, none):
            with pytest.raises(ValueError):
                call(own)
    with pytest.raises(ValueError):
        none.remove_unknown(strict=True)
    with pytest.raises(ValueError):
        Matrix.from_values(m.values.withColumn("feature", F.lit("-"))).remove_unknown(strict=True)
    with pytest.raises(ValueError):
        Matrix(m.values, m.features.where("feature = 'a'"), m.cells).checked()
    with pytest.raises(ValueError):
        Matrix(m.values, m.features.union(m.features), m.cells).checked()
    assert m.checked().remove_skewed_cells(0.5, ["MT-"], strict=True).cells.collect()[0].cell == "y"


def test_parameters():
    with pytest.raises(ValueError, match="unknown"):
        pipeline.Parameters.of({"expected_cells": 5, "cells": 3})
    for bad in ({"kit": "none", "expected_cells": 1}, {}, {"expected_cells": 1, "matrix_max_mito": 101}, {"expected_cells": 1, "umi_length": 0}):
        with pytest.raises(ValueError):
            pipeline.Parameters(**bad)
    p = pipeline.Parameters(kit="visium", mito_prefix="MT-,mt-")
    assert p.mito == ["MT-", "mt-"] and p.kit_spec().reversed


def test_pipeline_of_no_cells(spark):
    with pytest.raises(ValueError, match="no cells"):
        pipeline.processed(Matrix.from_values(spark.createDataFrame([], VALUES)), pipeline.Parameters(expected_cells=1))


def test_reads_to_matrix(spark):
    """Reads of two cells of two genes: from bases to counts."""
    kit = kits.Kit("3prime")
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    a2 = kit.adapters()["adapter2_f"]
    cells = ["ACGTTGCAACGTTGCA", "GGATCCTTAGGCATCA"]
    umis = ["ACACACGTGTGT", "TTGACCATGCAA", "CCGGAATTCAGT"]
    body = "GCTAGCATCGACTAGCATCAGCATCAGCGACGACTACGACATCAGC"
    reads, features = [], []
    for c, cell in enumerate(cells):
        for u, m in enumerate(umis):
            for copy in range(3):
                name = f"r{c}{u}{copy}"
                reads.append((name, kits.ADAPTER1 + cell + m + "T" * 14 + body + flip(a2)))
                features.append((f"{name}_0", f"gene{u % 2}", "-"))
    # as sequenced: the second adapter's end first
    rows = [(n, s, "I" * len(s)) for n, s in reads] + [("junk", "A" * 60, "I" * 60)]
    p = pipeline.Parameters(expected_cells=2, matrix_min_genes=1, matrix_min_cells=1, matrix_max_mito=100, estimate_cell_count=False)
    frame = spark.createDataFrame([(n, s.replace(flip(a2), a2) if n == "junk" else s[: -len(a2)] + a2, q) for n, s, q in rows], "read_id string, seq string, qual string")
    first = pipeline.barcoded(frame, p)
    labels = {r.lab: r["count"] for r in first["subreads"].groupBy("lab").count().collect()}
    assert labels == {"full_len": 18, "no_adapters": 1}
    tags = first["barcodes"].withColumn("chr", F.lit("chr1")).withColumn("start", F.lit(10).cast("long")).withColumn("end", F.lit(400).cast("long"))
    found = pipeline.shortlist(tags, p)
    assert {r.barcode for r in found.collect()} == set(cells)
    out = pipeline.run(pipeline.corrected(tags, found, p), spark.createDataFrame(features, "read_id string, gene string, transcript string"), p)
    got = {(r.feature, r.cell): r.value for r in out["raw"].values.collect()}
    assert got == {(g, c): n for c in cells for g, n in (("gene0", 2), ("gene1", 1))}
    assert {r.cell for r in out["mean_expression"].collect()} == set(cells)
    path = scratch_path(spark, "out")
    pipeline.write({k: out[k] for k in ("raw", "processed", "stats")}, path)
    assert spark.read.text(f"{path}/raw/barcodes.tsv").count() == 2


def test_spatial_matrix_is_binned(spark):
    name = lambda x, y: f"s_002um_{x:05d}_{y:05d}-1"
    m = Matrix.from_values(spark.createDataFrame([("a", name(0, 0), 2), ("a", name(3, 3), 1), ("b", name(4, 0), 5)], VALUES))
    p = pipeline.Parameters(kit="visium", matrix_min_genes=1, matrix_min_cells=1, matrix_max_mito=100)
    out = pipeline.processed(m, p)
    assert {(r.feature, r.cell): r.value for r in out["raw"].values.collect()} == {("a", "bin_0_0"): 3, ("b", "bin_1_0"): 5}
    assert out["fine"].cells.count() == 3


def test_fusions_without_matches(spark):
    rows = spark.createDataFrame([("F", "L", "1", "R", "2", "S", "r1,r1,r2")], ", ".join(f"{k} string" for k in [*fusions.KEYS, "LR_accessions"]))
    none = spark.createDataFrame([], "read_id string, CB string, UB string")
    found = fusions.of_cells(fusions.read_rows(rows), none)
    assert fusions.per_fusion(found, "x").count() == 0
    assert tuple(fusions.per_sample(found, "x").first()) == ("x", 0, 0, 0, 0.0, 0.0)
    assert {r.read_id for r in fusions.without_tags(fusions.read_rows(rows), none).collect()} == {"r1", "r2"}
    some = spark.createDataFrame([("r1", "c", "u")], "read_id string, CB string, UB string")
    assert fusions.of_cells(fusions.read_rows(rows), some).count() == 2


def test_depth_clip(spark):
    a = spark.range(20_000).select(F.col("id").cast("string").alias("read_id"))
    deep = a.where("int(read_id) < 10000").withColumn("depth", F.lit(400.0))
    kept = alignments.clip_depth(a, deep, 100.0)
    n = kept.where("int(read_id) < 10000").count()
    assert kept.where("int(read_id) >= 10000").count() == 10_000 and 2_300 < n < 2_700
    assert kept.count() == alignments.clip_depth(a.repartition(7), deep, 100.0).count()


def test_junction_split_keeps_bases(spark):
    rows = [("a", 10, "3S5M2I4N6M1D2M100N7M1S", "ACGTACGTACGTACGTACGTACGTAC"), ("b", 7, "9M", "ACGTACGTA"), ("c", 0, "2M5N", "AC")]
    df = spark.createDataFrame(rows, "read_id string, start long, cigar string, seq string").withColumn("qual", F.lit("*"))
    got = sorted((r.read_id, r.part, r.start, r.end, r.cigar, r.seq) for r in alignments.split_at_junctions(df).collect())
    s = rows[0][3]
    assert got == [("a", 0, 10, 15, "3S5M2I", s[:10]), ("a", 1, 19, 28, "6M1D2M", s[10:18]), ("a", 2, 128, 135, "7M1S", s[18:26]), ("b", 0, 7, 16, "9M", "ACGTACGTA"), ("c", 0, 0, 2, "2M", "AC")]


def test_headers(spark):
    path = scratch_path(spark, "headers")
    for k, lines in enumerate((["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:a\tLN:5", "@SQ\tSN:b\tLN:6"], ["@SQ\tSN:a\tLN:5", "@SQ\tSN:b\tLN:6"], ["@RG\tID:x"])):
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{path}/{k}")
    kinds = alignments.header_kinds(spark, [f"{path}/{k}" for k in range(3)])
    assert sorted((r.aligned, r.sorted, len(r.references)) for r in kinds.collect()) == [(False, False, 0), (True, False, 2), (True, True, 2)]
    assert not alignments.same_references(kinds) and alignments.same_references(kinds.where("aligned"))


def test_genotypes_of_two_files(spark):
    """Each file's calls carry the samples of its own header."""
    path = scratch_path(spark, "vcfs")
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    for k, (names, row) in enumerate((("s1\ts2", "c\t5\t.\tA\tG,T\t.\t.\t.\tDP:GT\t3:0/1\t4:1|1"), ("s3", "c\t6\t.\tC\tT\t.\t.\t.\tDP\t7"))):
        spark.createDataFrame([("##x\n" + head + names + "\n" + row,)], "value string").coalesce(1).write.text(f"{path}/{k}")
    got = {(r.variant, r.sample): r.gt for r in annotation.read_genotypes(spark, [f"{path}/0", f"{path}/1"]).collect()}
    assert got == {("c_5_A_G", "s1"): "0/1", ("c_5_A_G", "s2"): "1|1", ("c_6_C_T", "s3"): "./."}


def test_discovery_errors(spark):
    def touch(path, names):
        fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for n in names:
            out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}"))
            out.write(bytearray(b"@"))
            out.close()
        return path

    flat = touch(scratch_path(spark, "in"), ["a.fastq", "b.fq.gz", "c.txt"])
    assert sorted((r.sample, r.path.rsplit("/", 1)[1]) for r in ingress.discover(spark, flat).collect()) == [(None, "a.fastq"), (None, "b.fq.gz")]
    for names in (["a.fastq", "s/b.fastq"], ["s/t/b.fastq"]):
        with pytest.raises(ValueError):
            ingress.discover(spark, touch(scratch_path(spark, "in"), names))


def test_sheet_with_two_folders_for_a_row(spark):
    sheet = spark.createDataFrame([("barcode01", "one")], "barcode string, alias string")
    with pytest.raises(Exception, match="two folders"):
        annotation.join_sheet(spark.createDataFrame([("barcode01",), ("one",)], "folder string"), sheet).collect()


def test_repeated_ids_meet_in_order(spark):
    a = spark.createDataFrame([(1,), (1,)], "read_id long")
    assert tagging.in_order(a, a.distinct()).count() == 1 and tagging.in_order(a, a).count() == 2


def test_saturation_tables_add_up(spark):
    reads = spark.range(400).select((F.col("id") % 50).cast("string").alias("UB"), (F.col("id") % 4).cast("string").alias("CB"), F.lit("g").alias("gene"), "id")
    one = saturation.curve(reads, F.xxhash64("id"))
    full = one.where("frac = 1.0").first()
    assert (full.n_reads, full.n_umis, full.saturation) == (400, 100, 0.75)
    parts = [saturation.curve(reads.where(F.col("CB").isin(*k)), F.xxhash64("id")) for k in (["0", "1"], ["2", "3"])]
    assert sorted(map(tuple, saturation.added(*parts, saturation.zero(spark)).collect())) == sorted(map(tuple, one.collect()))
    assert saturation.zero(spark).agg(F.max("saturation")).first()[0] == 0


def test_one_basecaller(spark):
    info = summaries.run_info(spark.createDataFrame([("a", "runid=r basecall_model_version_id=m"), ("b", "basecall_model_version_id=m"), ("b", "basecall_model_version_id=n"), ("c", None)], "sample string, comment string"))
    assert {r.sample for r in summaries.one_basecaller(info).collect()} == {"a", "c"}
    assert summaries.one_basecaller(info, allow_many=True).count() == 3
