"""Expression matrices as long tables (feature, cell, value) with axis tables; zeros are implicit."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions import draws
from cytoframe.operators.ranks import numbered
from cytoframe.sources.scratch import ROWS_A_TASK, parts_for, written

#: The shares of reads or counts that saturation curves are drawn at.
FRACTIONS = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05, 0.04, 0.03, 0.02, 0.01)
SPATIAL_NAME = r"^s_002um_\d{5}_\d{5}-1$"
SALTS = 64  # parts that the UMIs of one feature and cell are dealt to


@dataclass
class Matrix:
    """values: feature, cell, value without zeros; features and cells: the axes, which may hold empty rows and columns."""

    values: DataFrame
    features: DataFrame
    cells: DataFrame
    full: bool = False  # every feature and cell of the axes has a value
    parts: int | None = None  # tasks to deal the values to where a task sorts them; None: as Spark does

    @classmethod
    def from_values(cls, values: DataFrame) -> Matrix:
        return cls(values, values.select("feature").distinct(), values.select("cell").distinct(), True)

    @classmethod
    def from_tags(cls, tags: DataFrame, feature: str = "gene", cell: str = "cb", umi: Column | str = "ub", *, unknown: bool = False) -> Matrix:
        """Distinct UMIs of every feature and cell; unknown features ('-') are left out unless wanted.

        Nearly every row is a UMI of its own, so what a task tells apart follows from the rows dealt to it alone. They are counted before,
        and the more there are, the more parts they are dealt to: by feature, cell and a part of the UMIs, then the parts' counts by
        feature and cell. Tags that are costly to compute should be a written table.
        """
        u = F.col(umi) if isinstance(umi, str) else umi
        kept = tags if unknown else tags.where(F.col(feature) != "-")
        rows = kept.select(F.col(feature).alias("feature"), F.col(cell).alias("cell"), F.pmod(F.xxhash64(u), F.lit(SALTS)).alias("_part"), u.alias("_umi"))
        dealt = parts_for(tags.sparkSession, kept.count(), ROWS_A_TASK)
        parts = rows.repartition(dealt, "feature", "cell", "_part").distinct().groupBy("feature", "cell", "_part").agg(F.count("_umi").alias("_n"))
        counted = cls.from_values(parts.select("feature", "cell", "_n").repartition(dealt, "feature", "cell").groupBy("feature", "cell").agg(F.sum("_n").alias("value")))
        return replace(counted, parts=dealt if dealt > parts_for(tags.sparkSession, 0) else None)

    def kept(self) -> Matrix:
        """The matrix with its values and axes as written tables, so that nothing before it is computed again by what follows."""
        v = written(self.values, "matrix")
        same = lambda axis, c: v.select(c).distinct() if axis is None else written(axis, f"axis-{c}")
        return Matrix(v, same(self._own_axis("features"), "feature"), same(self._own_axis("cells"), "cell"), self.full, self.parts)

    def _own_axis(self, name: str) -> DataFrame | None:
        """The axis, or None where it is by construction that of the values."""
        return None if self.full else getattr(self, name)

    def checked(self) -> Matrix:
        """Itself; an error if a value's feature or cell is not on its axis, or an axis repeats a name."""
        for c, axis in (("feature", self.features), ("cell", self.cells)):
            if not self.values.join(axis, c, "left_anti").isEmpty():
                raise ValueError(f"values name a {c} that the axis lacks")
            if not axis.groupBy(c).count().where("count > 1").isEmpty():
                raise ValueError(f"the axis repeats a {c}")
        return self

    def _sized(self, where: str) -> None:
        if self.cells.isEmpty() or self.features.isEmpty():
            raise ValueError(f"the matrix is empty on entry to {where}")

    def _some(self, axis: DataFrame, what: str) -> DataFrame:
        if axis.isEmpty():
            raise ValueError(f"all {what} would be removed; lower the thresholds")
        return axis

    @classmethod
    def merged(cls, *parts: Matrix) -> Matrix:
        """Sum of matrices over the union of their axes."""
        from functools import reduce

        both = lambda f: reduce(DataFrame.unionByName, map(f, parts))
        return cls(both(lambda m: m.values).groupBy("feature", "cell").agg(F.sum("value").alias("value")), both(lambda m: m.features).distinct(), both(lambda m: m.cells).distinct())

    def _kept(self, cells: DataFrame | None, features: DataFrame | None) -> Matrix:
        """The matrix with these axes, each distinct names of its own values. A task hashes its names and sorts no values."""
        v, f, c = self.values, self.features, self.cells
        if cells is not None:
            v, c = v.join(cells.hint("shuffle_hash"), "cell", "left_semi"), cells
        if features is not None:
            v, f = v.join(features.hint("shuffle_hash"), "feature", "left_semi"), features
        return Matrix(v, f, c, parts=self.parts)

    def _rich_cells(self, n: int) -> DataFrame:
        return self.values.where("value != 0").groupBy("cell").count().where(F.col("count") >= n).select("cell")

    def _common_features(self, n: int) -> DataFrame:
        return self.values.where("value != 0").groupBy("feature").count().where(F.col("count") >= n).select("feature")

    def remove_cells(self, min_features: int, *, strict: bool = False) -> Matrix:
        """Cells with at least so many features. strict (here and below): an empty matrix, or one that would become empty, is an error."""
        rich = self._rich_cells(min_features)
        if strict:
            self._sized("remove_cells")
            self._some(rich, "cells")
        return self._kept(rich, None)

    def remove_features(self, min_cells: int, *, strict: bool = False) -> Matrix:
        common = self._common_features(min_cells)
        if strict:
            self._sized("remove_features")
            self._some(common, "features")
        return self._kept(None, common)

    def remove_cells_and_features(self, min_features: int, min_cells: int, *, strict: bool = False) -> Matrix:
        """Both masks come from the matrix as it stands."""
        rich, common = self._rich_cells(min_features), self._common_features(min_cells)
        if strict:
            self._sized("remove_cells_and_features")
            self._some(rich, "cells")
            self._some(common, "features")
        return self._kept(rich, common)

    def share(self, parts: list[str]) -> DataFrame:
        """Per cell, the share of its counts in features whose name contains one of the parts."""
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.col("feature").contains(p)
        return self.values.groupBy("cell").agg((F.sum(F.when(hit, F.col("value")).otherwise(0)) / F.sum("value")).alias("share"))

    def remove_skewed_cells(self, limit: float, parts: list[str], *, strict: bool = False) -> Matrix:
        even = self.share(parts).where(F.col("share") <= limit).select("cell")
        if strict:
            self._sized("remove_skewed_cells")
            self._some(even, "cells")
        return self._kept(even, None)

    def remove_unknown(self, key: str = "-", *, strict: bool = False) -> Matrix:
        """Without the feature of unknown ones; cells stay on their axis."""
        features = self.features.where(F.col("feature") != key)
        if strict:
            self._sized("remove_unknown")
            self._some(features, "features")
        return Matrix(self.values.where(F.col("feature") != key), features, self.cells, parts=self.parts)

    def find_features(self, parts: list[str], *, inverse: bool = False) -> DataFrame:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.col("feature").contains(p)
        return self.features.where(~hit if inverse else hit)

    def normalize(self, to: float) -> Matrix:
        """Scales every cell to the same total. A cell has no more values than the feature axis is long, so its rows may meet in one task."""
        total = F.sum("value").over(Window.partitionBy("cell"))
        values = self.values.repartition(self.parts, "cell") if self.parts else self.values
        return Matrix(values.select("feature", "cell", (F.col("value") * to / total).alias("value")), self.features, self.cells, self.full, self.parts)

    def log_transform(self) -> Matrix:
        return Matrix(self.values.withColumn("value", F.log1p("value") / F.log(F.lit(10.0))), self.features, self.cells, self.full, self.parts)

    def mean_expression(self) -> DataFrame:
        """Sum per cell over the length of the feature axis; cells of zeros count as 0."""
        height = self.features.agg(F.count("*").alias("_n"))
        sums = self.cells.join(self.values.groupBy("cell").agg(F.sum("value").alias("_s")), "cell", "left")
        return sums.join(F.broadcast(height)).select("cell", (F.coalesce("_s", F.lit(0.0)) / F.col("_n")).alias("mean_expression"))

    def medians(self) -> DataFrame:
        """Median counts and median non-zero features of the cells, empty cells included."""
        per = self.values.groupBy("cell").agg(F.sum("value").alias("_s"), F.count_if(F.col("value") != 0).alias("_f"))
        every = self.cells.join(per, "cell", "left").na.fill(0)
        return every.agg(F.median("_s").alias("median_counts"), F.median("_f").alias("median_features"), F.count("*").alias("n_cells"))

    def _drawn(self, shares: tuple[float, ...]) -> DataFrame:
        """Entries with counts and _d, nested binomial draws of them for the shares: fixed by the entry's names, at a cost per entry."""
        key = F.xxhash64("feature", "cell")
        return self.values.where("value >= 1").withColumn("_d", draws.thinned(F.floor("value"), key, shares))

    def downsample(self, p: float) -> Matrix:
        """Thins integer counts: each is kept with probability p; entries that fall to zero go, the axes stay."""
        kept = self._drawn((p,)).withColumn("value", F.col("_d")[0].cast(self.values.schema["value"].dataType)).drop("_d")
        return Matrix(kept.where("value > 0"), self.features, self.cells, parts=self.parts)

    def saturation_statistics(self, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
        """Per fraction: all counts, and median features and counts of the cells (empty ones included), from nested thinning in one pass."""
        n = range(len(fractions))
        drawn = self._drawn(tuple(fractions)).select("cell", *[F.col("_d")[i].alias(f"_{i}") for i in n])
        per = drawn.groupBy("cell").agg(*[F.sum(f"_{i}").alias(f"_u{i}") for i in n], *[F.count_if(F.col(f"_{i}") > 0).alias(f"_f{i}") for i in n])
        every = self.cells.join(per, "cell", "left").na.fill(0)
        stats = every.agg(*[F.struct(F.lit(f).alias("frac"), F.sum(f"_u{i}").alias("n_umis"), F.median(f"_f{i}").cast("long").alias("median_feats"), F.median(f"_u{i}").cast("long").alias("median_umis")).alias(f"_{i}") for i, f in enumerate(fractions)])
        return stats.select(F.explode(F.array(*stats.columns)).alias("x")).select("x.*")

    def is_spatial(self) -> bool:
        """Whether the first cell in byte order has a name with coordinates."""
        first = self.cells.agg(F.min("cell").alias("c")).where(F.col("c").rlike(SPATIAL_NAME))
        return not first.isEmpty()

    def coordinates(self) -> DataFrame:
        """Rows (cell, x, y) of the cells whose names hold coordinates."""
        at = lambda g: F.regexp_extract("cell", r"_(\d{5})_(\d{5})", g).cast("int")
        return self.cells.where(F.col("cell").rlike(SPATIAL_NAME)).select("cell", at(1).alias("x"), at(2).alias("y"))

    def bin_cells(self, size: int, *, strict: bool = False) -> Matrix:
        """Sums squares of size x size positions of cells named s_002um_XXXXX_YYYYY-1."""
        if strict and not self.is_spatial():
            raise ValueError("cells can only be binned if their names hold coordinates")
        x, y = (F.floor(F.substring("cell", p, 5).cast("int") / size).cast("int") for p in (9, 15))
        return Matrix.from_values(self.values.groupBy("feature", F.concat_ws("_", F.lit("bin"), x, y).alias("cell")).agg(F.sum("value").alias("value")))

    def triples(self) -> DataFrame:
        """1-based (row, column, value) in byte order of the axis names, as a market-exchange file lists them."""
        f, c = numbered(self.features, "row", "feature"), numbered(self.cells, "col", "cell")
        return self.values.join(f, "feature").join(c, "cell").select("row", "col", "value")

    def dense(self, cells: list[str]) -> DataFrame:
        """A column per listed cell, zeros filled in; for export."""
        return self.values.groupBy("feature").pivot("cell", cells).agg(F.sum("value")).na.fill(0)

    def dense_genes(self, genes: list[str]) -> DataFrame:
        """A row per cell that has any of the genes and a column per gene, zeros filled in; unknown genes are zero throughout."""
        return self.values.where(F.col("feature").isin(genes)).groupBy("cell").pivot("feature", genes).agg(F.sum("value")).na.fill(0)
