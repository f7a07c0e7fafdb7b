"""Sequencing kits: adapters and the probe that spans adapter, barcode and UMI."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import seq

#: Adapter sequences of the kits, the template-switch oligo, and the kits whose reads run against the barcode.
ADAPTER1 = "CTACACGACGCTCTTCCGATCT"
ADAPTER2 = {"3prime": "ATGTACTCTGCGTTGATACCACTGCTT", "multiome": "ATGTACTCTGCGTTGATACCACTGCTT", "visium": "ATGTACTCTGCGTTGATACCACTGCTT", "5prime": "GTACTCTGCGTTGATACCACTGCTT"}
SWITCH_OLIGO = "TTTCTTATATGGG"
REVERSED = ("3prime", "multiome", "visium")


@dataclass(frozen=True)
class Kit:
    """A kit's name and the lengths of what its probe holds."""

    name: str
    barcode_length: int = 16
    umi_length: int = 12
    suffix_length: int = 10
    polyt_length: int = 10

    def __post_init__(self):
        if self.name not in ADAPTER2:
            raise ValueError(f"no kit {self.name!r}: one of {', '.join(ADAPTER2)}")

    @property
    def reversed(self) -> bool:
        return self.name in REVERSED

    @property
    def suffix(self) -> str:
        """The end of the first adapter that the probe begins with."""
        return ADAPTER1[-self.suffix_length :]

    @property
    def probe(self) -> str:
        tail = "T" * self.polyt_length if self.reversed else SWITCH_OLIGO
        return self.suffix + "N" * (self.barcode_length + self.umi_length) + tail

    def adapters(self) -> dict[str, str]:
        """Both adapters in both orientations."""
        flip = lambda s: s[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))
        two = ADAPTER2[self.name]
        return {"adapter1_f": ADAPTER1, "adapter1_r": flip(ADAPTER1), "adapter2_f": two, "adapter2_r": flip(two)}


def probe_column(barcode_length: Column, umi_length: int, reversed_kit: Column, *, suffix_length: int = 10, polyt_length: int = 10) -> Column:
    """The probe as an expression, for tables that hold kits."""
    return F.concat(F.lit(ADAPTER1[-suffix_length:]), F.repeat(F.lit("N"), barcode_length.cast("int")), F.lit("N" * umi_length), F.when(reversed_kit, "T" * polyt_length).otherwise(SWITCH_OLIGO))


def adapter_fasta(spark: SparkSession, kit: Kit) -> DataFrame:
    """Lines of a FASTA file of the kit's adapters."""
    return spark.createDataFrame([(line,) for name, s in kit.adapters().items() for line in (f">{name}", s)], "value string")


def with_kit(samples: DataFrame, kits: DataFrame) -> DataFrame:
    """Samples (kit as name:version) with kit_name, kit_version and the configuration of their kit, where there is one."""
    config = kits.select(*[F.col(c).alias(c if c == "kit" or c not in samples.columns else f"{c}_config") for c in kits.columns])
    parts = F.split("kit", ":")
    return samples.join(config, "kit", "left").withColumn("kit_name", parts[0]).withColumn("kit_version", F.get(parts, F.lit(1)))


def set_differences(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows (side, key): keys wanted but not found ('missing') and found but not wanted ('extra'); none if both hold the same."""
    a, b = wanted.select(key).distinct(), found.select(key).distinct()
    return a.join(b, key, "left_anti").select(F.lit("missing").alias("side"), key).union(b.join(a, key, "left_anti").select(F.lit("extra").alias("side"), key))


def stranded(reads: DataFrame, subreads: DataFrame, kit: Kit, *, full_length_only: bool = True) -> DataFrame:
    """Subreads of reads (read_id, seq, qual) cut out and turned to the kit's strand; empty ones are left out.

    subreads: query, read_id, start, end, fl, strand, adapter_config, lab. The configuration of a turned subread is turned with it.
    """
    own = subreads.where("fl") if full_length_only else subreads
    j = reads.select(F.col("read_id").alias("query"), "seq", "qual").join(own, "query")
    cut = lambda c: seq.subsequence(F.col(c), F.col("start").cast("int"), F.col("end").cast("int"))
    turn = F.col("strand") == ("+" if kit.reversed else "-")
    s, q = cut("seq"), cut("qual")
    config = F.when(turn, seq.reverse_config(F.col("adapter_config"))).otherwise(F.col("adapter_config"))
    return j.select("read_id", F.when(turn, seq.reverse_complement(s)).otherwise(s).alias("seq"), F.when(turn, F.reverse(q)).otherwise(q).alias("qual"), config.alias("adapter_config"), "lab", "fl", "strand").where(F.length("seq") > 0)
