"""Genotypes through merge, split and atomise, and representative reads, against plain versions."""

import random
import re
from collections import defaultdict

import pytest

from cytoframe.operators import jointcalls, representatives


def brute_atoms(pos, ref, alt):
    n = min(len(ref), len(alt))
    out = [(pos + i, ref[i], alt[i]) for i in range(n) if ref[i] != alt[i]]
    return out + ([(pos + n - 1, ref[n - 1 :], ref[n - 1] + alt[n:])] if len(ref) != len(alt) else [])


def brute_genotypes(calls):
    sites = defaultdict(list)
    for c in calls:
        sites[c[0], c[1]].append(c)
    atoms = defaultdict(set)
    for (chrom, pos), own in sites.items():
        ref = max((c[2] for c in own), key=len)
        for _, _, r, alts, *_ in own:
            for a in alts.split(",") if alts != "." else ():
                for p, x, y in brute_atoms(pos, ref, a + ref[len(r) :]):
                    atoms[chrom, pos].add((p, x, y))
    held = defaultdict(dict)
    for chrom, pos, r, alts, sample, gt in calls:
        ref = max((c[2] for c in sites[chrom, pos]), key=len)
        for atom in atoms[chrom, pos]:
            for k, a in enumerate(re.split("[/|]", gt)):
                v = None if a == "." else int(a != "0" and atom in brute_atoms(pos, ref, alts.split(",")[int(a) - 1] + ref[len(r) :]))
                key = (chrom, *atom, sample)
                before = held[key].get(k)
                held[key][k] = v if before is None else before if v is None else max(v, before)
    out = {}
    for key, alleles in held.items():
        values = [alleles[k] for k in sorted(alleles)]
        out[key] = ["." if v is None else str(v) for v in values]
    return out


def made_calls(seed):
    g = random.Random(seed)
    genome = "".join(g.choice("ACGT") for _ in range(60))
    files = []
    for f in range(3):
        rows = []
        for pos in range(1, 50):
            if g.random() < 0.5:
                continue
            ref = genome[pos - 1 : pos - 1 + g.choice([1, 1, 2, 3])]
            alts = list({"".join(g.choice("ACGT") for _ in range(g.choice([1, len(ref), 3]))) for _ in range(g.choice([1, 2, 3]))} - {ref}) or ["."]
            n = 0 if alts == ["."] else len(alts)
            for s in range(2):
                if g.random() < 0.8:
                    rows.append(("c1", pos, ref, ",".join(alts), f"s{f}{s}", g.choice("/|").join(g.choice([".", *map(str, range(n + 1))]) for _ in range(g.choice([1, 2, 2])))))
        files.append(rows)
    return files


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_genotypes(spark, seed):
    files = made_calls(seed)
    schema = "chrom string, pos long, ref string, alt string, sample string, gt string"
    split = jointcalls.merged_genotypes(*[spark.createDataFrame(f, schema) for f in files])
    got = {(r.chrom, r.pos, r.ref, r.alt, r["sample"]): (re.split("[/|]", r.gt), r.code) for r in split.collect()}
    want = brute_genotypes([c for f in files for c in f])
    assert {k: v[0] for k, v in got.items()} == want and len(want) > 100
    assert all(code == (None if "." in gt else gt.count("1")) for gt, code in got.values())
    counts = {(r.chrom, r.pos, r.ref, r.alt): (r.ac, r.an, r.ns, r.af) for r in jointcalls.allele_counts(split).collect()}
    by_site = defaultdict(list)
    for k, gt in want.items():
        by_site[k[:4]].append(gt)
    for k, gts in by_site.items():
        ac, an = sum(x.count("1") for x in gts), sum(len(x) - x.count(".") for x in gts)
        assert counts[k] == (ac, an, sum(any(a != "." for a in x) for x in gts), ac / an if an else None)


def test_a_call_of_two_alternatives(spark):
    schema = "chrom string, pos long, ref string, alt string, sample string, gt string"
    one = spark.createDataFrame([("c", 5, "A", "G", "x", "0|1"), ("c", 9, "AC", "GT", "x", "0/1")], schema)
    two = spark.createDataFrame([("c", 5, "A", "T,G", "y", "1/2"), ("c", 5, "A", "T,G", "z", "./.")], schema)
    got = {(r.pos, r.ref, r.alt, r["sample"]): (r.gt, r.code) for r in jointcalls.merged_genotypes(one, two).collect()}
    assert got[5, "A", "G", "x"] == ("0|1", 1) and got[5, "A", "T", "x"] == ("0|0", 0)
    assert got[5, "A", "G", "y"] == ("0/1", 1) and got[5, "A", "T", "y"] == ("1/0", 1)  # once a code of 3 without a name
    assert got[5, "A", "T", "z"] == ("./.", None)
    assert got[9, "A", "G", "x"] == got[10, "C", "T", "x"] == ("0/1", 1)
    bad = spark.createDataFrame([("c", 5, "C", "G", "x", "0/1")], schema)
    with pytest.raises(Exception, match="references of one site differ"):
        jointcalls.merged_genotypes(one, bad).collect()
    with pytest.raises(Exception, match="allele that its record lacks"):
        jointcalls.merged_genotypes(spark.createDataFrame([("c", 5, "A", "G", "x", "0/2")], schema)).collect()


def brute_representatives(rows, tell):
    groups = defaultdict(list)
    for r in rows:
        if r["flag"] & 4 or r["chr"] == "*" or r["tags"].get("CB", "-") in ("-", "") or r["tags"].get("UB", "-") in ("-", ""):
            continue
        ops = re.findall(r"(\d+)([MIDNSHP=X])", r["cigar"])
        inner = [o for o in ops if o[1] != "H"]
        lead, trail = (int(o[0]) if o[1] == "S" else 0 for o in (inner[0], inner[-1]))
        back = bool(r["flag"] & 16)
        at = r["end"] + trail if back else r["start"] - lead
        groups[r["chr"], r["tags"]["CB"], r["tags"]["UB"], back, at, "N" in r["cigar"] if tell else None].append(r)
    return {min(g, key=lambda r: (int(r["tags"].get("NH", 1)), -r["mapq"], r["read_id"]))["read_id"]: len(g) for g in groups.values()}


@pytest.mark.parametrize("tell", [False, True])
def test_representatives(spark, tell):
    g = random.Random(7)
    rows = []
    for i in range(600):
        cigar = g.choice(["10M", "2S8M", "8M2S", "3H2S8M", "8M2S1H", "4M5N6M", "2S4M5N4M2S", "2H10M"])
        start = g.randint(1, 8)
        length = sum(int(n) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if o in "MDN=X")
        tags = {"CB": g.choice(["a", "b", "-"]), "UB": g.choice(["u", "v"])} | ({"NH": str(g.randint(1, 3))} if g.random() < 0.6 else {})
        if g.random() < 0.05:
            del tags["UB"]
        rows.append({"read_id": f"r{i:04}", "flag": g.choice([0, 16, 256, 4, 16]), "chr": g.choice(["c1", "c2", "*"]), "start": start, "end": start + length, "mapq": g.randint(0, 3), "cigar": cigar, "tags": tags})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "read_id string, flag int, chr string, start long, end long, mapq int, cigar string, tags map<string,string>").repartition(5)
    got = representatives.representatives(df, tell_spliced=tell)
    assert {r.read_id: r.n_reads for r in got.collect()} == brute_representatives(rows, tell)
    assert got.columns[:8] == df.columns
    assert representatives.representatives(df.limit(0)).count() == 0
