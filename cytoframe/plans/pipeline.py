"""From tags of reads to processed matrices, with one set of parameters."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators import adapters, barcodes, kits, probes, reduction, saturation, summaries, tagging, umi
from cytoframe.operators.matrix import Matrix
from cytoframe.sources import exchange
from cytoframe.sources.scratch import dealt_by_rows, written


@dataclass(frozen=True)
class Parameters:
    """What changes results. Shares are per cent, as a user writes them."""

    kit: str = "3prime"
    expected_cells: int | None = None
    estimate_cell_count: bool = True
    full_length_only: bool = True
    min_read_qual: float | None = None
    barcode_length: int = 16
    umi_length: int = 12
    barcode_adapter1_suff_length: int = 10
    barcode_min_quality: int = 15
    barcode_max_ed: int = 2
    barcode_min_ed_diff: int = 2
    gene_assigns_minqv: int = 30
    matrix_min_genes: int = 200
    matrix_min_cells: int = 3
    matrix_max_mito: float = 20
    matrix_norm_count: float = 10_000
    mito_prefix: str = "MT-"
    principal_components: int = 0

    def __post_init__(self):
        if self.kit not in kits.ADAPTER2:
            raise ValueError(f"no kit {self.kit!r}")
        if self.expected_cells is None and self.kit != "visium":
            raise ValueError("expected_cells is needed for this kit")
        for name, low in (("barcode_length", 1), ("umi_length", 1), ("barcode_max_ed", 0), ("barcode_min_ed_diff", 0), ("matrix_min_genes", 0), ("matrix_min_cells", 0), ("matrix_norm_count", 1)):
            if getattr(self, name) < low:
                raise ValueError(f"{name} is below {low}")
        if not 0 <= self.matrix_max_mito <= 100:
            raise ValueError("matrix_max_mito is a share in per cent")

    @classmethod
    def of(cls, values: dict) -> Parameters:
        """From names and values; unknown names are errors."""
        if unknown := sorted(set(values) - {f.name for f in fields(cls)}):
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        return cls(**values)

    @property
    def mito(self) -> list[str]:
        return [p for p in self.mito_prefix.split(",") if p]

    def kit_spec(self) -> kits.Kit:
        return kits.Kit(self.kit, self.barcode_length, self.umi_length, self.barcode_adapter1_suff_length)


def barcoded(reads: DataFrame, p: Parameters) -> dict[str, DataFrame]:
    """Reads (read_id, seq, qual) to subreads, and their barcodes and UMIs: adapters are sought, reads cut and turned, the probe aligned."""
    if p.min_read_qual is not None:
        reads = reads.where(seq.mean_quality(F.col("qual")) >= p.min_read_qual)
    hits = written(adapters.search(reads, p.kit_spec().adapters()), "hits")
    parts = written(adapters.subreads(hits), "subreads")
    own = kits.stranded(reads, parts, p.kit_spec(), full_length_only=p.full_length_only)
    tags = written(probes.extract_barcodes(own.select("read_id", "seq", "qual"), p.kit_spec()), "barcodes")
    return {"subreads": parts, "adapter_summary": adapters.summary(parts), "barcodes": tags}


def shortlist(tags: DataFrame, p: Parameters, long_list: DataFrame | None = None) -> DataFrame:
    """Barcodes of cells: those of good quality (and on the long list), above the knee, or the expected number of most frequent ones."""
    counts = probes.high_quality_counts(tags, long_list, min_quality=p.barcode_min_quality)
    if p.kit == "visium":
        return counts
    return barcodes.quantile_knee(counts, p.expected_cells) if p.estimate_cell_count else barcodes.fixed_knee(counts, p.expected_cells)


def corrected(tags: DataFrame, cells: DataFrame, p: Parameters) -> DataFrame:
    """Tags (with CR) with their corrected barcode CB, '-' where there is none, and the reason."""
    found = barcodes.correct(tags.select(F.col("CR").alias("cr")), cells, max_edits=p.barcode_max_ed, margin=p.barcode_min_ed_diff, barcode_length=p.barcode_length)
    return tags.join(found.select(F.col("cr").alias("CR"), F.coalesce("cb", F.lit("-")).alias("CB"), "reason"), "CR", "left").na.fill("-", subset=["CB"])


def known_tags(tags: DataFrame, features: DataFrame) -> DataFrame:
    """Usable tags (read_id, chr, start, end, CB, UR, ...) with gene and transcript of their read."""
    return tagging.usable(tagging.with_features(tags, features))


def with_umis(known: DataFrame, p: Parameters) -> DataFrame:
    """known_tags() with the corrected UMI UB; reads are clustered by chromosome and gene, or region where the gene is unknown.

    Reads whose corrected UMI has another length than the kit's go.
    """
    group = F.concat_ws(":", "chr", F.when(F.col("gene") == "-", seq.region_label(F.col("chr"), F.col("start"), F.col("end"))).otherwise(F.col("gene")))
    keyed = known.withColumn("_g", group)
    clusters = umi.cluster(keyed.select(F.col("_g").alias("gene"), F.col("CB").alias("cb"), F.col("UR").alias("ur")), length=p.umi_length)
    return keyed.join(clusters.select(F.col("gene").alias("_g"), F.col("cb").alias("CB"), F.col("ur").alias("UR"), F.col("ub").alias("UB")), ["_g", "CB", "UR"]).drop("_g")


def matrix_of(tags: DataFrame, feature: str = "gene") -> Matrix:
    """Distinct UMIs of each chromosome, feature and cell."""
    return Matrix.from_tags(tags, feature, "CB", F.struct("chr", "UB"))


def processed(matrix: Matrix, p: Parameters, *, filtering: bool = True) -> dict[str, object]:
    """The matrix through its whole treatment.

    stats (medians before any filter), raw (without the unknown feature, binned where cells are spatial), processed (masked, without
    skewed cells, normalised, log-transformed), mito_pct and mean_expression per cell, and pca where components are asked for. A matrix
    without cells, or one that the masks empty, is an error.
    """
    own = matrix.kept()
    if own.cells.isEmpty():
        raise ValueError("the expression matrix has no cells: check the kit, the reference and the data's quality")
    stats = own.medians()
    raw = own.remove_unknown(strict=True)
    fine = raw if raw.is_spatial() else None
    if fine is not None:
        raw = fine.bin_cells(4).kept()
    mito = None
    if filtering:
        masked = raw.remove_cells_and_features(p.matrix_min_genes, p.matrix_min_cells, strict=True).kept()
        mito = masked.share(p.mito).select("cell", (100 * F.col("share")).alias("mito_pct"))
        masked = masked.remove_skewed_cells(p.matrix_max_mito / 100, p.mito, strict=True)
    else:
        masked = raw
    done = masked.normalize(p.matrix_norm_count).log_transform().kept()
    out = {"stats": stats, "raw": raw, "fine": fine, "processed": done, "mito_pct": mito, "mean_expression": done.mean_expression()}
    if p.principal_components:
        out["pca"] = reduction.components(done, p.principal_components)
    return out


def run(tags: DataFrame, features: DataFrame, p: Parameters) -> dict[str, object]:
    """Corrected tags and features of reads to matrices, summaries and saturation.

    The tags are counted first, so they should be a written table: the more there are, the more parts the steps deal them to.
    """
    with dealt_by_rows(tags.sparkSession, tags.count()):
        known = written(known_tags(tags, features), "known")
        rows = written(with_umis(known, p), "expression")
        out = processed(matrix_of(rows), p)
    out["expression_summary"] = summaries.expression(known)
    out["sequencing_saturation"] = saturation.curve(rows, F.xxhash64("read_id"))
    out["tags"] = rows
    return out


def write(results: dict[str, object], path: str) -> None:
    """Matrices as market-exchange folders, tables as tab-separated text."""
    for name, value in results.items():
        if isinstance(value, Matrix):
            exchange.write_exchange(value, f"{path}/{name}", integer=name in ("raw", "fine"))
        elif isinstance(value, DataFrame):
            value.write.option("sep", "\t").option("header", True).csv(f"{path}/{name}")
