"""Headers of many files as one, and alignment files of every kind as one sorted table."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cytoframe.sources import headers, merging, records


def brute_header(files):
    """One sample's header by walking through the lines; None for a fault."""
    hd, sq, groups, programs, comments, seen, renamed, tail, n = "@HD\tVN:1.6\tSO:unknown", [], {}, [], [], set(), {}, None, 0
    for lines in files:
        if own := [x for x in lines if x.startswith("@SQ")]:
            sq = own
        for x in lines:
            kind, *fields = x.split("\t")
            if kind == "@HD":
                hd = x
            elif kind == "@CO":
                comments.append(x)
            elif kind == "@RG":
                key = next(f for f in fields if f.startswith("ID:"))
                if key in groups and sorted(groups[key].split("\t")) != sorted(x.split("\t")):
                    return None
                groups.setdefault(key, x)
            elif kind == "@PG":
                tags = dict(f.split(":", 1) for f in fields)
                own = tags.pop("ID")
                new = own
                if own in seen:
                    new, n = f"{own}-{n}", n + 1
                    renamed[own] = new
                seen.add(own)
                up = tags.pop("PP", None)
                if up is not None:
                    if up not in seen:
                        return None
                    up = renamed.get(up, up)
                    if up == new:
                        return None
                else:
                    up = tail
                tail = new
                programs.append("\t".join(["@PG", f"ID:{new}", *(f"{k}:{v}" for k, v in tags.items()), *([f"PP:{up}"] if up else [])]))
    return [hd, *sq, *groups.values(), *programs, *comments]


def as_rows(spark, samples):
    rows = [(s, f"f{i:03}", j, line) for s, files in samples.items() for i, lines in enumerate(files) for j, line in enumerate(lines)]
    return spark.createDataFrame(rows, "sample string, file string, at long, line string").repartition(5)


def test_headers_as_brute_force(spark):
    g = random.Random(11)
    samples = {}
    for s in range(60):
        files = []
        for _ in range(g.randint(1, 5)):
            lines = ["@HD\tVN:1.5\tSO:unsorted"] if g.random() < 0.5 else []
            lines += [f"@SQ\tSN:c{i}\tLN:{100 + i}" for i in range(3)] if g.random() < 0.7 else []
            lines += [f"@RG\tID:g{(k := g.randint(0, 5))}\tSM:s{k}" + ("\tDS:other" if g.random() < 0.02 else "") for _ in range(g.randint(0, 2))]
            last = None
            for _ in range(g.randint(0, 3)):
                own = g.choice("abc")
                up = g.choice([None, last, g.choice("abc") if g.random() < 0.1 else None])
                lines.append(f"@PG\tID:{own}\tPN:x" + (f"\tPP:{up}" if up and up != own else ""))
                last = own
            lines += ["@CO\tsome text"] if g.random() < 0.3 else []
            files.append(lines or ["@CO\tnothing"])
        samples[f"s{s}"] = files
    want = {s: brute_header(files) for s, files in samples.items()}
    good = {s: f for s, f in samples.items() if want[s] is not None}
    assert 20 < len(good) < 60
    got = {}
    for r in headers.merged_headers(as_rows(spark, good)).orderBy("sample", "rank").collect():
        got.setdefault(r["sample"], []).append(r["line"])
    assert got == {s: want[s] for s in good}
    records_ = headers.header_records(as_rows(spark, samples))
    faulty = {r["sample"] for r in headers.merge_faults(records_, headers.linked_programs(records_)).collect()}
    assert faulty == {s for s, w in want.items() if w is None}


def test_a_chain_of_three_and_clashing_ids(spark):
    one = ["@PG\tID:a", "@PG\tID:b\tPP:a", "@PG\tID:c\tPP:b"]
    got = [r.line for r in headers.merged_headers(as_rows(spark, {"x": [one, one]})).orderBy("rank").collect()]
    assert got[1:] == ["@PG\tID:a", "@PG\tID:b\tPP:a", "@PG\tID:c\tPP:b", "@PG\tID:a-0\tPP:c", "@PG\tID:b-1\tPP:a-0", "@PG\tID:c-2\tPP:b-1"]


def test_chains(spark):
    rows = [("good", f"p{i}", f"p{i - 1}" if i else None) for i in range(40)]
    rows += [("cycle", "a", "c"), ("cycle", "b", "a"), ("cycle", "c", "b"), ("cycle", "h", None), ("self", "a", "a"), ("two", "a", None), ("two", "b", None), ("one", "a", None)]
    faults = {}
    for r in headers.chain_faults(spark.createDataFrame(rows, "sample string, id string, parent string")).collect():
        faults.setdefault(r["sample"], []).append(r.fault)
    assert {s: sorted(x) for s, x in faults.items()} == {"cycle": ["programs go round in a cycle: a, b, c"], "self": ["no program is without a parent", "programs go round in a cycle: a"], "two": ["several programs are without a parent"]}


@pytest.mark.parametrize("line, fault", [("@PG\tPN:x", "without an id"), ("@RG\tID:a\tlong:x", "invalid field"), ("@XX\tA:b", "unknown header record"), ("@PG\tID:a\tPP:z", "does not stand before it")])
def test_faults_are_errors(spark, line, fault):
    with pytest.raises(Exception, match=fault):
        headers.merged_headers(as_rows(spark, {"x": [["@HD\tVN:1", line]]})).collect()


def put(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("".join(f"{x}\n" for x in lines))


SQ = ["@SQ\tSN:chr2\tLN:500", "@SQ\tSN:chr10\tLN:900"]


def line(i, chrom, start, flag=0, seq="ACGT", qual="ABCD"):
    return f"{i}\t{flag}\t{chrom}\t{start}\t60\t4M\t*\t0\t0\t{seq}\t{qual}\tNM:i:0"


def test_files_of_every_kind(spark, tmp_path):
    put(f"{tmp_path}/in/a/1.sam", ["@HD\tVN:1.6\tSO:coordinate", *SQ, "@RG\tID:g", line("r1", "chr2", 5), line("r2", "chr10", 1)])
    put(f"{tmp_path}/in/a/2.sam", ["@HD\tVN:1.6\tSO:unsorted", *SQ, "@RG\tID:g", line("r4", "*", 0, 4), line("r3", "chr2", 2, 16), line("r0", "chr10", 1)])
    put(f"{tmp_path}/in/b/1.sam", ["@HD\tVN:1.6\tSO:coordinate", *SQ, line("x", "chr10", 7)])
    put(f"{tmp_path}/in/c/1.sam", [line("u", "*", 0, 4), line("v", "*", 0, 4 | 16), line("v", "*", 0, 4 | 256)])
    m = merging.merge_alignments(spark, f"{tmp_path}/in", split_bytes=40)
    assert {(r["sample"], r.n_files, r.kind) for r in m.samples.collect()} == {("a", 2, "unsorted"), ("b", 1, "sorted"), ("c", 1, "unaligned")}
    assert [(r["sample"], r.read_id) for r in m.rows.collect()] == [("a", "r3"), ("a", "r1"), ("a", "r0"), ("a", "r2"), ("a", "r4"), ("b", "x"), ("c", "u"), ("c", "v"), ("c", "v")]
    head = [r.line for r in m.headers.where("sample = 'a'").orderBy("rank").collect()]
    assert head == ["@HD\tVN:1.6\tSO:coordinate", *SQ, "@RG\tID:g"]
    assert m.headers.where("sample = 'c'").first().line == "@HD\tVN:1.6\tSO:coordinate"
    reads = {(r["sample"], r.read_id): (r.seq, r.qual) for r in merging.reads_of(m.rows).collect()}
    assert len(reads) == 8 and reads["a", "r3"] == ("ACGT", "DCBA") and reads["a", "r1"] == ("ACGT", "ABCD")
    named = merging.merge_alignments(spark, f"{tmp_path}/in", by="name", keep_unaligned=False)
    assert [r.read_id for r in named.rows.collect()] == ["r0", "r1", "r2", "r3", "r4", "x"]
    assert {(r["sample"], r.chr, r.mapped) for r in merging.contigs_with_reads(m.rows).collect()} == {("a", "chr2", 2), ("a", "chr10", 2), ("b", "chr10", 1)}
    plan = m.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.split('== Initial Plan ==')[0].count("rangepartitioning") == 1
    put(f"{tmp_path}/in/b/2.sam", ["@SQ\tSN:chr2\tLN:501", line("y", "chr2", 7)])
    with pytest.raises(ValueError, match="different references in one sample: b"):
        merging.merge_alignments(spark, f"{tmp_path}/in")


def test_written_files_come_back(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.lit("l"), "id").alias("line"), F.concat(F.lit("f"), F.col("id") % 3).alias("name"), F.concat(F.lit("s"), F.col("id") % 2).alias("folder"), "id").repartition(4, "folder", "name").sortWithinPartitions("id")
    records.register(spark)
    for compression in ("none", "gzip"):
        path = f"{tmp_path}/{compression}"
        rows.write.format("sam_lines").option("compression", compression).mode("append").save(path)
        got = spark.read.format("sam_lines").load(path)
        assert got.count() == 40 and got.select("file").distinct().count() == 6
        for f in got.select("file").distinct().collect():
            own = [int(r.line[1:]) for r in got.where(F.col("file") == f.file).orderBy("at").collect()]
            assert own == sorted(own)
    rows.limit(1).write.format("sam_lines").mode("overwrite").save(f"{tmp_path}/gzip")
    assert spark.read.format("sam_lines").load(f"{tmp_path}/gzip").count() == 1
