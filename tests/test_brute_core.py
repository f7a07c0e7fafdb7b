"""Operators of the engine against brute force on small random input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.operators import adapters, barcodes, intervals, probes, reduction, umi
from cytoframe.operators.kits import Kit
from cytoframe.operators.matrix import Matrix
from cytoframe.operators.ranks import numbered


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def reached(counts, limit=2):
    """Each UMI with the best-ranked one that reaches it."""
    out = {}
    for u in sorted(counts, key=lambda u: (-counts[u], u)):
        seen, queue = {u}, [u]
        while queue:
            a = queue.pop()
            for b in counts:
                if b not in seen and counts[a] >= 2 * counts[b] - 1 and edits(a, b) <= limit:
                    seen.add(b)
                    queue.append(b)
        for v in seen:
            out.setdefault(v, u)
    return out


def test_umis_of_mixed_lengths(spark):
    """Small groups, which are compared whole, and large ones, which meet by pieces."""
    g = random.Random(4)
    groups = {}
    for k, size in enumerate((5, 20, 120)):
        groups[f"g{k}"] = {"".join(g.choice("AC") for _ in range(g.randrange(6, 14))): g.choice((1, 1, 1, 2, 5, 9, 30)) for _ in range(size)}
    groups["g3"] = {"TTATGCAGAAAA": 50, "ACTGTATACGTCC": 20, "ACTGTATAGTCC": 1}
    rows = [(gene, "c", u, n) for gene, counts in groups.items() for u, n in counts.items()]
    got = {(r.gene, r.ur): r.ub for r in umi.representatives(spark.createDataFrame(rows, "gene string, cb string, ur string, n long")).collect()}
    assert got == {(gene, u): b for gene, counts in groups.items() for u, b in reached(counts).items()}
    assert got["g3", "ACTGTATAGTCC"] == "ACTGTATACGTCC"


def test_umis_without_gene_or_cell(spark):
    reads = spark.createDataFrame([(None, "c", "ACGT"), ("g", None, "ACGT"), ("g", "c", None)], "gene string, cb string, ur string")
    assert sorted(map(str, umi.cluster(reads).collect())) == sorted(["Row(gene=None, cb='c', ur='ACGT', ub='ACGT')", "Row(gene='g', cb=None, ur='ACGT', ub='ACGT')", "Row(gene='g', cb='c', ur=None, ub=None)"])
    assert umi.cluster(reads.limit(0)).count() == 0


def test_knee_at_the_farthest_point(spark):
    g = random.Random(5)
    for trial in range(25):
        n = g.randrange(2, 40)
        counts = {f"b{i:02d}": g.choice((1, 1, 2, 3, 8, 30, g.randrange(1, 200))) for i in range(n)}
        order = sorted(counts, key=lambda b: (counts[b], [-ord(c) for c in b]))
        y = [counts[b] for b in order]
        gap = [abs((y[-1] - y[0]) * i - (c - y[0]) * (n - 1)) for i, c in enumerate(y)]
        want = set(order[gap.index(max(gap)) :])
        got = {r.barcode for r in barcodes.distance_knee(spark.createDataFrame(list(counts.items()), "barcode string, count long").coalesce(1)).collect()}
        assert got == want, trial


def test_merged_intervals_across_stretches(spark):
    g = random.Random(6)
    rows = [(g.choice("xy"), a, a + g.choice((0, 1, 5, 40, 300))) for a in (g.randrange(2000) for _ in range(120))]
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    for slop, stretch in ((0, 50), (3, 7), (0, 10_000)):
        want = []
        for c in "xy":
            for a, b in sorted((max(a - slop, 0), b + slop) for k, a, b in rows if k == c):
                if want and want[-1][0] == c and a <= want[-1][2]:
                    want[-1][2] = max(want[-1][2], b)
                else:
                    want.append([c, a, b])
        assert sorted([r.chrom, r.start, r.end] for r in intervals.merged(df, slop, stretch).collect()) == sorted(want)


def score_of(read, probe, s):
    """Best local score, cell by cell."""
    t, low, best = s.table(), -(10**9), 0
    h = [[0] * (len(probe) + 1) for _ in range(len(read) + 1)]
    e, f = ([[low] * (len(probe) + 1) for _ in range(len(read) + 1)] for _ in range(2))
    for i in range(1, len(read) + 1):
        for j in range(1, len(probe) + 1):
            e[i][j] = max(h[i][j - 1] - s.gap_open, e[i][j - 1] - s.gap_extend)
            f[i][j] = max(h[i - 1][j] - s.gap_open, f[i - 1][j] - s.gap_extend)
            h[i][j] = max(0, h[i - 1][j - 1] + t[read[i - 1], probe[j - 1]], e[i][j], f[i][j])
            best = max(best, h[i][j])
    return best


def mutated(g, x, most):
    y = list(x)
    for _ in range(g.randrange(most)):
        p = g.randrange(len(y))
        y[p : p + 1] = g.choice(("", "A", y[p] + "C"))
    return "".join(y)


@pytest.mark.parametrize("scores", [probes.Scores(), probes.Scores(gap_open=5, gap_extend=1)])
def test_local_alignment(scores):
    g, probe = random.Random(7), Kit("3prime").probe.encode()
    bases = lambda n: "".join(g.choice("ACGT") for _ in range(n))
    reads = [mutated(g, bases(g.randrange(30)) + "CTTCCGATCT" + bases(28) + "T" * 12 + bases(20), 8)[:100].encode() for _ in range(60)] + [b"", b"A", b"NN"]
    aligned, own, end, score = probes.local_alignments(reads, probe, scores)
    table = scores.table()
    for r, a, b, e, v in zip(reads, aligned, own, end, score, strict=True):
        assert v == score_of(r, probe, scores)
        bare = b.replace(b"-", b"")
        assert r[e + 1 - len(bare) : e + 1] == bare and a.replace(b"-", b"") in probe
        total, gap = 0, None
        for x, y in zip(a, b, strict=True):
            side = "probe" if x == 45 else "read" if y == 45 else None
            total += table[x, y] if side is None else -(min(scores.gap_extend, scores.gap_open) if side == gap else scores.gap_open)
            gap = side
        assert total == v


def test_extracted_barcodes(spark):
    """Exact adapters, three and four changed bases (one too many), and reads of nothing."""
    cell, u, body = "AAACCCAAGAAACACT", "GACTGACTGACT", "GCATCAGTCAGGCATCAGTCAG"
    molecules = {"good": "CTTCCGATCT", "three": "CTTCCGAGGG", "four": "CTTCCGGGGA"}
    rows = [(k, a + cell + u + "T" * 10 + body, "5" * 10 + "9" * 16 + ":" * 12 + "5" * 32) for k, a in molecules.items()] + [("empty", "", "")]
    five = Kit("5prime")
    assert five.probe.endswith("TTTCTTATATGGG")
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(k, flip(s), q[::-1]) for k, s, q in rows], "read_id string, seq string, qual string")
    got = {r.read_id: r for r in probes.extract_barcodes(reads, Kit("3prime")).collect()}
    assert set(got) == {"good", "three"}
    r = got["good"]
    assert (r.CR, r.CY, r.UR, r.UY, r.adapter1_ed) == (cell, "9" * 16, u, ":" * 12, 0)
    assert got["three"].adapter1_ed == 3
    assert len(r.seq) == len(r.qual) and r.seq.startswith(flip(body))
    counts = probes.high_quality_counts(probes.extract_barcodes(reads, Kit("3prime")), spark.createDataFrame([(cell,)], "barcode string"))
    assert [tuple(x) for x in counts.collect()] == [(cell, 2)]


def test_adapter_search(spark):
    g, names = random.Random(8), Kit("5prime").adapters()
    bases = lambda n: "".join(g.choice("ACGT") for _ in range(n))
    reads = []
    for _ in range(60):
        reads.append(bases(g.randrange(40)) + mutated(g, g.choice(list(names.values())), 5) + bases(g.randrange(60)))
    reads += ["A" * 40, "AC", names["adapter1_f"]]
    got = {}
    for r in adapters.search(spark.createDataFrame(list(enumerate(reads)), "read_id long, seq string"), names).collect():
        got.setdefault(r["query"], {})[r.target] = (r.identity, r.qilo, r.qihi, r.ql)
    for i, s in enumerate(reads):
        if len(s) < adapters.SHORTEST:
            assert i not in got
            continue
        want = {}
        for name, a in names.items():
            row = [0] * (len(s) + 1)
            for x in a:  # Sellers: the stretch may begin anywhere
                new = [row[0] + 1]
                for j, y in enumerate(s, 1):
                    new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
                row = new
            d = min(row[1:])
            end = row.index(d, 1)
            begin = max(b for b in range(end + 1) if edits(a, s[b:end]) == d)
            identity = 1 - d / max(len(a), end - begin)
            if identity >= 0.7:
                want[name] = (pytest.approx(identity), begin + 1, end, len(s))
        assert got[i] == (want or {"*": (None, None, None, len(s))}), (i, s)


def test_components_span_the_same_space(spark):
    g = np.random.default_rng(3)
    dense = g.poisson(1.0, (30, 12)) @ np.diag(np.linspace(3, 0.5, 12)) + g.poisson(2.0, (30, 1)) * np.arange(12)
    rows = [(f"f{i}", f"c{j:02d}", float(dense[i, j])) for i in range(30) for j in range(12) if dense[i, j]]
    m = Matrix.from_values(spark.createDataFrame(rows, "feature string, cell string, value double"))
    m.cells = m.cells.union(spark.createDataFrame([("empty",)], "cell string"))
    got = {r.cell: np.array(r[1:]) for r in reduction.components(m, 2).collect()}
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    want = (vt[:2].T * s[:2]) * np.sign(u[np.abs(u).argmax(0), range(12)])[:2]
    assert np.allclose(np.stack([got[f"c{j:02d}"] for j in range(12)]), want, atol=1e-3 * s[0])
    assert (got["empty"] == 0).all()


def test_numbered_is_dense_and_ordered(spark):
    g = random.Random(9)
    rows = [(i, g.randrange(5)) for i in range(300)]
    got = numbered(spark.createDataFrame(rows, "i long, k long").repartition(7), "n", F.desc("k"), F.col("i")).collect()
    assert [r.n for r in sorted(got, key=lambda r: (-r.k, r.i))] == list(range(1, 301))
