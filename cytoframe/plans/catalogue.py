"""Registered queries of the engine and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators import adapters, barcodes, features, fusions, intervals, kits, probes, saturation, summaries, tagging, umi, variants
from cytoframe.operators.matrix import Matrix
from cytoframe.operators.ranks import numbered
from cytoframe.plans import views
from cytoframe.plans.views import t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = views.with_views(oracle)
        return f

    return register


def _matrix(s: SparkSession, d: str) -> Matrix:
    return Matrix.from_tags(views.tags(s, d))


KEEP = "cells as (select cell from matrix group by 1 having count(*) >= 20), feats as (select feature from matrix group by 1 having count(*) >= 3)"


# ---- expression matrix -------------------------------------------------------------------------------------------------------
@query("select feature, cell, value from matrix")
def expression_matrix_genes(s, d):
    return _matrix(s, d).values


@query("select concat(gene, '.', chr) as feature, cb as cell, count(distinct ub) as value from tags group by 1, 2")
def expression_matrix_transcripts(s, d):
    return Matrix.from_tags(views.tags(s, d).withColumn("tr", F.concat_ws(".", "gene", "chr")), "tr").values


@query("select gene as feature, cb as cell, cast(sum(n) as bigint) as value from (select gene, cb, chr, count(distinct ub) as n from tags group by 1, 2, 3) group by 1, 2")
def matrix_merge_shards(s, d):
    tags = views.tags(s, d)
    return Matrix.merged(*[Matrix.from_tags(tags.where(F.col("chr") == c)) for c in ("A", "N", "R")]).values


@query(f"with {KEEP} select feature, cell, value from matrix where cell in (select * from cells) and feature in (select * from feats)")
def matrix_filter_simultaneous(s, d):
    return _matrix(s, d).kept().remove_cells_and_features(20, 3).values


@query("with c as (select * from matrix where cell in (select cell from matrix group by 1 having count(*) >= 20)) select feature, cell, value from c where feature in (select feature from c group by 1 having count(*) >= 60)")
def matrix_filter_cells_then_features(s, d):
    return _matrix(s, d).kept().remove_cells(20).remove_features(60).values


@query("with f as (select * from matrix where feature in (select feature from matrix group by 1 having count(*) >= 60)) select feature, cell, value from f where cell in (select cell from f group by 1 having count(*) >= 20)")
def matrix_filter_features_then_cells(s, d):
    return _matrix(s, d).kept().remove_features(60).remove_cells(20).values


@query("select cell, round(sum(case when contains(feature, 'MT-') then value else 0 end) / sum(value), 6) as share from matrix group by 1")
def matrix_mito_pct(s, d):
    return _matrix(s, d).share(["MT-"]).select("cell", F.round("share", 6).alias("share"))


@query("select feature, cell, value from matrix where cell in (select cell from matrix group by 1 having sum(case when contains(feature, 'MT-') then value else 0 end) / sum(value) <= 0.05)")
def matrix_mito_filter(s, d):
    return _matrix(s, d).kept().remove_skewed_cells(0.05, ["MT-"]).values


@query("select feature, cell, round(log10(1 + value * 10000.0 / total), 6) as value from matrix join (select cell, sum(value) as total from matrix group by 1) using (cell)")
def matrix_normalize_log(s, d):
    return _matrix(s, d).normalize(10000.0).log_transform().values.withColumn("value", F.round("value", 6))


@query("select distinct feature from matrix where not (contains(feature, 'MT-') or contains(feature, '39'))")
def matrix_find_features_inverse(s, d):
    return _matrix(s, d).find_features(["MT-", "39"], inverse=True)


@query(
    f"with {KEEP}, kept as (select * from matrix where cell in (select * from cells) and feature in (select * from feats)), ok as (select cell from kept group by 1 having sum(case when contains(feature, 'MT-') then value else 0 end) / sum(value) <= 0.2), "
    "m as (select * from kept where cell in (select * from ok)), tot as (select cell, sum(value) as total, count(*) as n from m group by 1) "
    "select m.cell, round(sum(log10(1 + value * 10000.0 / total)) / (select count(*) from feats), 6) as mean_expression, cast(any_value(total) as bigint) as umis, any_value(n) as n_features from m join tot using (cell) group by 1"
)
def matrix_processed_flagship(s, d):
    """Counts, simultaneous masks, mitochondrial filter, normalisation, log and cell means in one plan."""
    kept = _matrix(s, d).kept().remove_cells_and_features(20, 3).remove_skewed_cells(0.2, ["MT-"]).kept()
    stats = kept.values.groupBy("cell").agg(F.sum("value").alias("umis"), F.count("*").alias("n_features"))
    mean = kept.normalize(10000.0).log_transform().mean_expression()
    return mean.join(stats, "cell").select("cell", F.round("mean_expression", 6).alias("mean_expression"), "umis", "n_features")


@query("select cell, round(sum(value) / (select count(distinct feature) from matrix), 6) as mean_expression from matrix group by 1")
def cell_mean_expression(s, d):
    return _matrix(s, d).kept().mean_expression().withColumn("mean_expression", F.round("mean_expression", 6))


@query("select median(s) as median_counts, cast(median(f) as double) as median_features, count(*) as n_cells from (select cell, sum(value) as s, count(*) as f from matrix group by 1)")
def matrix_median_stats(s, d):
    return _matrix(s, d).kept().medians()


@query("select feature, cast(coalesce(sum(value) filter (cell = 'c1'), 0) as bigint) as c1, cast(coalesce(sum(value) filter (cell = 'c2'), 0) as bigint) as c2, cast(coalesce(sum(value) filter (cell = 'c3'), 0) as bigint) as c3 from matrix group by 1")
def matrix_pivot_dense(s, d):
    return _matrix(s, d).dense(["c1", "c2", "c3"])


@query("select r as row, c as col, value from matrix join (select feature, row_number() over (order by feature) as r from (select distinct feature from matrix)) using (feature) join (select cell, row_number() over (order by cell) as c from (select distinct cell from matrix)) using (cell)")
def mex_triples(s, d):
    return _matrix(s, d).kept().triples()


SPATIAL = "select concat('F', l_partkey % 50) as feature, concat('s_002um_', lpad(cast(l_suppkey % 40 as string), 5, '0'), '_', lpad(cast(l_orderkey % 40 as string), 5, '0'), '-1') as cell, count(*) as value from lineitem group by 1, 2"


def _spatial(s, d) -> Matrix:
    t(s, d, "lineitem").createOrReplaceTempView("lineitem")
    return Matrix.from_values(s.sql(SPATIAL))


@query(f"select feature, concat('bin_', cast(substr(cell, 9, 5) as int) // 4, '_', cast(substr(cell, 15, 5) as int) // 4) as cell, cast(sum(value) as bigint) as value from ({SPATIAL}) group by 1, 2")
def spatial_bin_8um(s, d):
    return _spatial(s, d).bin_cells(4).values


@query(f"select cell, cast(substr(cell, 9, 5) as int) as x, cast(substr(cell, 15, 5) as int) as y, cast(sum(value) as bigint) as total from ({SPATIAL}) where regexp_matches(cell, '^s_002um_[0-9]{{5}}_[0-9]{{5}}-1$') group by 1, 2, 3")
def spatial_coordinate_join(s, d):
    m = _spatial(s, d)
    return m.coordinates().join(m.values.groupBy("cell").agg(F.sum("value").alias("total")), "cell", "left")


@query("select feature, cell, value from matrix where feature in ('G100', 'G200', 'MT-3')")
def goi_expression(s, d):
    genes = s.createDataFrame([("G100",), ("G200",), ("MT-3",), ("absent",)], "feature string")
    return _matrix(s, d).values.join(genes, "feature", "left_semi")


@query("select 1.0::double as frac, count(*) as n_reads, count(distinct concat_ws('|', ub, cb, gene)) as n_umis, round(1 - count(distinct concat_ws('|', ub, cb, gene)) / count(*), 6) as saturation from tags")
def seq_saturation_full(s, d):
    reads = views.tags(s, d).withColumnRenamed("ub", "UB").withColumnRenamed("cb", "CB")
    return saturation.curve(reads, F.xxhash64("UB", "CB", "gene"), (1.0,)).withColumn("saturation", F.round("saturation", 6))


@query()
def seq_saturation_curve(s, d):
    """Nested samples by a hash of the read."""
    return saturation.curve(views.tags(s, d).withColumnRenamed("ub", "UB").withColumnRenamed("cb", "CB"), F.xxhash64("UB", "CB", "gene", "l_linenumber", "l_quantity", "l_partkey"))


# ---- barcodes ----------------------------------------------------------------------------------------------------------------
@query("select cr as barcode, count(*) as count from reads where cr in (select barcode from whitelist) and list_min(list_transform(string_split(cy, ''), lambda c: ascii(c) - 33)) >= 15 group by 1")
def barcode_hq_counts(s, d):
    return probes.high_quality_counts(views.reads(s, d).select(F.col("cr").alias("CR"), F.col("cy").alias("CY")), views.whitelist(s, d), min_quality=15)


COUNTS = "counts as (select cr as barcode, count(*) as count from reads group by 1)"


def _counts(s, d) -> DataFrame:
    return views.reads(s, d).groupBy(F.col("cr").alias("barcode")).count()


@query(f"with {COUNTS} select barcode, count from counts where count >= (select quantile_cont(count, 0.95) / 20 from (select count from counts order by count desc, barcode limit 100))")
def knee_quantile(s, d):
    return barcodes.quantile_knee(_counts(s, d), 100)


@query(f"with {COUNTS} select barcode, count from counts order by count desc, barcode limit 75")
def knee_fixed(s, d):
    return barcodes.fixed_knee(_counts(s, d), 75)


@query(f"with {COUNTS} select barcode, count from counts where count >= 10")
def knee_abundance(s, d):
    return barcodes.abundance_knee(_counts(s, d), 10)


@query(
    f"with {COUNTS}, h as (select *, row_number() over (order by count, barcode desc) - 1 as i from counts), e as (select min(count) as y0, max(count) as y1, max(i) as x1 from h), "
    "g as (select i, abs((y1 - y0) * i - (count - y0) * x1) as gap from h, e) select barcode, count from h where i >= (select i from g order by gap desc, i limit 1)"
)
def knee_distance(s, d):
    return barcodes.distance_knee(_counts(s, d))


@query(f"with {COUNTS} select barcode, count from counts")
def shortlist_unfiltered(s, d):
    return _counts(s, d)


@query(f"with {COUNTS} select stat, val from (select count(*) as cells, cast(sum(count) as bigint) as reads, cast(max(count) as bigint) as most from counts) unpivot (val for stat in (cells, reads, most))")
def shortlist_summary(s, d):
    one = _counts(s, d).agg(F.count("*").alias("cells"), F.sum("count").alias("reads"), F.max("count").alias("most"))
    return one.unpivot([], ["cells", "reads", "most"], "stat", "val")


def _correction_sql(blocked: bool) -> str:
    km = "select {c}, unnest(list_distinct(list_transform(generate_series(0, length({c}) - 6), lambda i: substr({c}, i + 1, 5)))) as k from {t}"
    pairs = f"select distinct cr, wl from ({km.format(c='cr', t='d')}) a join ({km.format(c='wl', t='w')}) b using (k)" if blocked else "select cr, wl from d, w"
    return (
        "with w as (select barcode as wl from whitelist), d as (select distinct cr from reads where cr not in (select barcode from whitelist)), "
        f"p as (select cr, wl, levenshtein(cr, wl) as ed from ({pairs}) where levenshtein(cr, wl) <= 5), q as (select *, row_number() over (partition by cr order by ed, wl) as r from p), "
        "b as (select d.cr, a.wl, a.ed, coalesce(z.ed, length(d.cr)) - a.ed as gap from d left join (select * from q where r = 1) a using (cr) left join (select * from q where r = 2) z using (cr)), "
        "res as (select distinct cr, cr as cb, 'bc_shortlist_exact_match' as reason from reads where cr in (select barcode from whitelist) union all "
        "select cr, case when length(cr) >= 14 and ed <= 2 and gap >= 2 then wl end, case when length(cr) < 14 then null when ed is null or ed > 2 then 'bc_no_shortlist_match' when gap >= 2 then 'bc_corrected' else 'bc_shortlist_multiple_hits' end from b) "
    )


def _corrected(s, d, blocked=True) -> DataFrame:
    return barcodes.correct(views.reads(s, d), views.whitelist(s, d), blocked=blocked, barcode_length=16)


@query(_correction_sql(True) + "select cr, cb, reason from res")
def barcode_correct_kmer(s, d):
    return _corrected(s, d)


@query(_correction_sql(False) + "select cr, cb, reason from res")
def barcode_correct_full(s, d):
    """Every barcode against the whole list, as small lists allow."""
    return _corrected(s, d, blocked=False)


@query(_correction_sql(True) + "select reason, count(*) as count from reads join res using (cr) where reason is not null group by 1")
def barcode_reason_counts(s, d):
    return barcodes.reason_counts(views.reads(s, d), _corrected(s, d))


@query(_correction_sql(True) + "select cb, count(*) as count from reads join res using (cr) where cb is not null and length(cr) >= 14 group by 1")
def barcode_assigned_counts(s, d):
    return barcodes.assigned_counts(views.reads(s, d), _corrected(s, d))


# ---- UMIs --------------------------------------------------------------------------------------------------------------------
CLUSTER = (
    "with recursive n as (select gene, cb, ur, count(*) as n from rr group by 1, 2, 3), e as (select a.gene, a.cb, a.ur as u, b.ur as v from n a join n b on a.gene = b.gene and a.cb = b.cb and a.ur <> b.ur and levenshtein(a.ur, b.ur) <= 2 and a.n >= 2 * b.n - 1), "
    "reach as (select gene, cb, ur as u, ur as v from n union select r.gene, r.cb, r.u, e.v from reach r join e on r.gene = e.gene and r.cb = e.cb and r.v = e.u), "
    "ranked as (select r.gene, r.cb, r.v as ur, r.u as ub, row_number() over (partition by r.gene, r.cb, r.v order by n.n desc, r.u) as k from reach r join n on n.gene = r.gene and n.cb = r.cb and n.ur = r.u) "
)


def _clustered(s, d, gene) -> DataFrame:
    return umi.cluster(views.reads(s, d).select(gene.alias("gene"), F.col("user_id").cast("string").alias("cb"), "ur"))


@query(CLUSTER.replace("with recursive n", "with recursive rr as (select gene, cast(user_id as string) as cb, ur from reads), n") + "select gene, cb, ur, ub from ranked where k = 1")
def umi_cluster(s, d):
    return _clustered(s, d, F.col("gene"))


REGION = "concat_ws('_', chr, cast(floor(floor((start + start + 700) / 2) / 1000) * 1000 as bigint), cast(ceil(floor((start + start + 700) / 2) / 1000) * 1000 as bigint))"


@query(CLUSTER.replace("with recursive n", f"with recursive rr as (select case when gene = 'click' then {REGION} else gene end as gene, cast(user_id as string) as cb, ur from reads), n") + "select gene, cb, ur, ub from ranked where k = 1")
def umi_region_fallback(s, d):
    """Reads without a gene (here: one event type) are clustered by region."""
    r = views.reads(s, d)
    rows = r.select(F.when(F.col("gene") == "click", "-").otherwise(F.col("gene")).alias("gene"), F.col("user_id").cast("string").alias("cb"), "ur", "chr", "start")
    out = umi.cluster_by_region(rows, seq.region_label(F.col("chr"), F.col("start"), F.col("start") + 700))
    return out.select(F.col("_group").alias("gene"), "cb", "ur", "ub")


@query("select read_id, substr(ur, 1, cast(length(ur) - read_id % 2 as int)) as ub from reads where length(ur) - read_id % 2 = 12")
def umi_length_filter(s, d):
    return views.reads(s, d).select("read_id", F.expr("substr(ur, 1, int(length(ur) - read_id % 2))").alias("ub")).where("length(ub) = 12")


# ---- adapters and sequences --------------------------------------------------------------------------------------------------
ADAPT = (
    "with w as (select *, lead(target) over q as t2, lead(qilo) over q as lo2, lead(qihi) over q as hi2 from hits window q as (partition by query order by qilo, target)), "
    "p as (select *, concat_ws('-', target, t2) as c from w where concat_ws('-', target, t2) in ('adapter1_f-adapter2_f', 'adapter2_r-adapter1_r') and t2 is not null), "
    "f as (select query, concat(query, '_', row_number() over (partition by query order by case when target = 'adapter1_f' then 0 else 1 end, qilo) - 1) as read_id, case when target = 'adapter1_f' then qilo - 1 else qihi end as start, case when target = 'adapter1_f' then lo2 - 1 else hi2 end as \"end\", true as fl, case when target = 'adapter1_f' then '+' else '-' end as strand, c as adapter_config, 'full_len' as lab from p), "
    "r as (select query, string_agg(target, '-' order by qilo, target) as c, min(qilo) as lo, max(qihi) as hi, max(ql) as ql from hits group by 1 having query not in (select query from f)), "
    "s as (select * from f union all select query, concat(query, '_0'), case when c in ('adapter1_f', 'adapter2_r') then lo - 1 else 0 end, case when c in ('adapter2_f', 'adapter1_r') then hi else ql end, false, case when c in ('adapter1_f', 'adapter2_f') then '+' when c in ('adapter1_r', 'adapter2_r') then '-' else '*' end, c, case when c in ('adapter1_f', 'adapter1_r') then 'single_adapter1' when c in ('adapter2_f', 'adapter2_r') then 'single_adapter2' when c in ('adapter1_f-adapter1_r', 'adapter1_r-adapter1_f') then 'double_adapter1' when c in ('adapter2_f-adapter2_r', 'adapter2_r-adapter2_f') then 'double_adapter2' else 'other' end from r) "
)


@query(ADAPT + "select query, read_id, start, \"end\", fl, strand, adapter_config, lab from s")
def adapter_labels(s, d):
    return adapters.subreads(views.hits(s, d))


@query(ADAPT + "select query, read_id, start, \"end\" from s where fl")
def adapter_pairs(s, d):
    return adapters.subreads(views.hits(s, d)).where("fl").select("query", "read_id", "start", "end")


@query("select query, string_agg(target, '-' order by qilo, target) as config from hits group by 1")
def adapter_config_string(s, d):
    return adapters.configurations(views.hits(s, d))


FLAGS = "count(*) as subreads, count(*) filter (fl) as full_length, count(*) filter (strand <> '*') as stranded, count(*) filter (strand = '+') as plus, count(*) filter (strand = '-') as minus, " + ", ".join(f"count(*) filter (lab = '{k}') as {k}" for k in ("no_adapters", "single_adapter1", "single_adapter2", "double_adapter1", "double_adapter2", "full_len", "other"))


@query(ADAPT + f"select statistic, count from (select {FLAGS} from s) unpivot (count for statistic in (subreads, full_length, stranded, plus, minus, no_adapters, single_adapter1, single_adapter2, double_adapter1, double_adapter2, full_len, other))")
def adapter_summary(s, d):
    return adapters.summary(adapters.subreads(views.hits(s, d)))


@query("select read_id, translate(reverse(cr), 'ACGTacgt', 'TGCAtgca') as rc from reads")
def revcomp(s, d):
    return views.reads(s, d).select("read_id", seq.reverse_complement(F.col("cr")).alias("rc"))


@query("select read_id, list_min(list_transform(string_split(cy, ''), lambda c: ascii(c) - 33)) as q from reads")
def phred_min(s, d):
    return views.reads(s, d).select("read_id", seq.phred_min(F.col("cy")).alias("q"))


@query("select read_id, substr(cr, 4, 9) as part from reads")
def subseq_trim(s, d):
    return views.reads(s, d).select("read_id", seq.subsequence(F.col("cr"), F.lit(3), F.lit(12)).alias("part"))


@query("select n_nationkey, concat(right('CTACACGACGCTCTTCCGATCT', 10), repeat('N', cast(14 + n_nationkey % 3 as int)), repeat('N', 12), case when n_nationkey % 2 = 0 then repeat('T', 10) else 'TTTCTTATATGGG' end) as probe from nation")
def probe_sequence(s, d):
    n = F.col("n_nationkey")
    return t(s, d, "nation").select("n_nationkey", kits.probe_column(14 + n % 3, 12, n % 2 == 0).alias("probe"))


@query("select k as kmer, count(*) as count from (select unnest(list_transform(generate_series(0, length(cr) - 6), lambda i: substr(cr, i + 1, 5))) as k from reads) group by 1")
def kmers(s, d):
    return views.reads(s, d).select(F.explode(seq.kmers(F.col("cr"), 5)).alias("kmer")).groupBy("kmer").count()


@query("select read_id, levenshtein(cr, c) as ed from (select read_id, cr, substr(cr, 2) as c from reads)")
def edit_distance(s, d):
    return views.reads(s, d).select("read_id", F.levenshtein("cr", F.expr("substr(cr, 2)")).alias("ed"))


@query("select query, string_agg(case when target like '%\\_f' escape '\\' then replace(target, '_f', '_r') else replace(target, '_r', '_f') end, '-' order by qilo desc, target desc) as config from hits group by 1")
def config_reverse(s, d):
    return adapter_config_string(s, d).select("query", seq.reverse_config(F.col("config")).alias("config"))


CUT = "case when length(cr) < 16 then 0 else 10 end"


@query(f"select read_id, case when read_id % 2 = 0 then translate(reverse(substr(cr, 3, {CUT})), 'ACGT', 'TGCA') else substr(cr, 3, {CUT}) end as seq, case when read_id % 2 = 0 then reverse(substr(cy, 3, {CUT})) else substr(cy, 3, {CUT}) end as qual from reads where {CUT} > 0")
def stranded_subreads(s, d):
    """Subreads cut out and turned; those of short barcodes are empty and go."""
    r = views.reads(s, d)
    reads = r.select(F.col("read_id").cast("string").alias("read_id"), F.col("cr").alias("seq"), F.col("cy").alias("qual"))
    parts = r.select(F.col("read_id").cast("string").alias("query"), F.col("read_id").cast("string").alias("read_id"), F.lit(2).alias("start"), F.when(F.length("cr") < 16, 2).otherwise(12).alias("end"), F.lit(True).alias("fl"), F.when(F.col("read_id") % 2 == 0, "+").otherwise("-").alias("strand"), F.lit("adapter1_f-adapter2_f").alias("adapter_config"), F.lit("full_len").alias("lab"))
    return kits.stranded(reads, parts, kits.Kit("3prime")).select(F.col("read_id").cast("long").alias("read_id"), "seq", "qual")


# ---- features ----------------------------------------------------------------------------------------------------------------
ALN = "select distinct l_orderkey as read_id, concat('tr', cast(l_partkey as string)) as query_transcript, cast(l_quantity as int) as aln_score, l_discount * 10 as tr_cov, l_tax * 10 as q_cov, cast(l_linenumber % 3 as int) as tr_mapq from lineitem"
TMAP = "select concat('tr', cast(p_partkey as string)) as qry_id, concat('ref', cast(p_partkey % 300 as string)) as ref_id, case p_size % 8 when 0 then 'i' when 1 then 's' else '=' end as class_code from part"
ANNO = "select distinct concat('ref', cast(p_partkey % 300 as string)) as ref_id, concat('gene', cast(p_partkey % 300 % 60 as string)) as gene_name from part where p_size > 3"
GENO = "select o_orderkey as read_id, cast(o_custkey % 61 as int) as mapq from orders"
ASSIGN = (
    f"with j as (select a.read_id, query_transcript, aln_score, tr_cov, q_cov, tr_mapq, mapq, gene_name as gene, case when class_code in ('i', 'y', 'p', 's') then '-' else ref_id end as transcript from ({ALN}) a join ({TMAP}) on query_transcript = qry_id join ({ANNO}) using (ref_id) join ({GENO}) using (read_id)), "
    "c as (select *, count(*) over (partition by read_id) as n from j), "
    "m as (select *, row_number() over b as r, lead(aln_score) over b as a2, lead(q_cov) over b as q2, lead(tr_cov) over b as t2, first_value(case when mapq < 30 then '-' else gene end) over (partition by read_id order by mapq desc, aln_score desc, q_cov desc, tr_cov desc, query_transcript) as g from c where n > 1 window b as (partition by read_id order by aln_score desc, q_cov desc, tr_cov desc, query_transcript)), "
    "res as (select read_id, case when mapq < 30 then '-' else gene end as gene, transcript, 1 as kind from c where n = 1 and tr_mapq > 0 union all select read_id, g, case when ((aln_score <> a2 or q_cov <> q2) and tr_cov >= 0.4 and q_cov >= 0.4) or (not (aln_score <> a2 or q_cov <> q2) and tr_cov <> t2 and tr_cov > 0.8) then transcript else '-' end, 2 from m where r = 1) "
)


def _assigned(s, d) -> DataFrame:
    for name in ("lineitem", "part", "orders"):
        t(s, d, name).createOrReplaceTempView(name)
    return features.assign_features(s.sql(ALN), s.sql(TMAP), s.sql(ANNO), s.sql(GENO))


@query(ASSIGN + "select read_id, gene, transcript from res where gene <> '-' or transcript <> '-'")
def feature_assign(s, d):
    return _assigned(s, d)


@query(ASSIGN + "select gene, count(*) as reads, count(*) filter (transcript <> '-') as with_transcript from res where gene <> '-' or transcript <> '-' group by 1")
def feature_gene_summary(s, d):
    return _assigned(s, d).groupBy("gene").agg(F.count("*").alias("reads"), F.count_if(F.col("transcript") != "-").alias("with_transcript"))


@query("select class_code, count(*) as n, count(*) filter (class_code in ('i', 's')) as masked from (" + TMAP + ") group by 1")
def feature_classcode_mask(s, d):
    t(s, d, "part").createOrReplaceTempView("part")
    return s.sql(TMAP).groupBy("class_code").agg(F.count("*").alias("n"), F.count_if(F.col("class_code").isin("i", "y", "p", "s")).alias("masked"))


# ---- tags and sheets ---------------------------------------------------------------------------------------------------------
@query("select read_id, cr, coalesce(f.gene, '-') as gene from reads r left join (select l_orderkey as k, min(concat('g', l_partkey)) as gene from lineitem group by 1) f on r.read_id = f.k")
def tags_left_join_features(s, d):
    f = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("read_id")).agg(F.min(F.concat(F.lit("g"), F.col("l_partkey"))).alias("gene"))
    return tagging.with_features(views.reads(s, d).select("read_id", "cr"), f)


@query("select o_orderkey as read_id, cr, o_custkey from orders join reads on o_orderkey = read_id")
def sorted_id_join(s, d):
    return tagging.in_order(t(s, d, "orders").select(F.col("o_orderkey").alias("read_id"), "o_custkey"), views.reads(s, d).select("read_id", "cr"))


@query("select a.read_id, a.chr as aln_chr, t.cr from (select event_id as read_id, concat('chr', (user_id + event_id % 2) % 3) as chr from events) a join reads t on a.read_id = t.read_id where a.chr = t.chr or t.read_id % 4 = 0")
def tag_lookup_with_sa(s, d):
    """Tags apply on their own chromosome, those of split alignments (every fourth read) on any."""
    tags = views.reads(s, d).select("read_id", "cr", "chr", F.when(F.col("read_id") % 4 == 0, "yes").otherwise("-").alias("SA"))
    a = t(s, d, "events").select(F.col("event_id").alias("read_id"), F.concat(F.lit("chr"), ((F.col("user_id") + F.col("event_id") % 2) % 3).cast("string")).alias("chr"))
    return tagging.tags_of_alignments(a, tags).select("read_id", F.col("chr").alias("aln_chr"), "cr")


@query("select read_id from reads where read_id not in (select l_orderkey from lineitem)")
def untagged_anti(s, d):
    return views.reads(s, d).join(t(s, d, "lineitem").select(F.col("l_orderkey").alias("read_id")), "read_id", "left_anti").select("read_id")


@query("select n_name, split_part(concat(n_name, ':v', n_nationkey % 3), ':', 1) as kit_name, split_part(concat(n_name, ':v', n_nationkey % 3), ':', 2) as kit_version, r_name from nation left join region on n_regionkey = r_regionkey")
def kit_config_join(s, d):
    kit = F.concat(F.col("n_name"), F.lit(":v"), (F.col("n_nationkey") % 3).cast("string")).alias("kit")
    n = t(s, d, "nation")
    config = n.join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(kit, "r_name")
    return kits.with_kit(n.select("n_name", kit), config).select("n_name", "kit_name", "kit_version", "r_name")


@query("select n_regionkey as analysis_group, count(*) as samples, count(*) = count(distinct n_name) as aliases_unique, bool_and(regexp_matches(concat('barcode', lpad(cast(n_nationkey as string), 2, '0')), '^barcode[0-9]{2,}$')) as barcodes_valid from nation group by 1")
def sample_sheet_checks(s, d):
    b = F.concat(F.lit("barcode"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return t(s, d, "nation").groupBy(F.col("n_regionkey").alias("analysis_group")).agg(F.count("*").alias("samples"), (F.count("*") == F.countDistinct("n_name")).alias("aliases_unique"), F.bool_and(b.rlike(r"^barcode\d\d+$")).alias("barcodes_valid"))


@query("select n_nationkey, n_name, cnt from nation full join (select s_suppkey % 30 + 3 as k, count(*) as cnt from supplier group by 1) on n_nationkey = k")
def sample_sheet_outer_join(s, d):
    dirs = t(s, d, "supplier").groupBy((F.col("s_suppkey") % 30 + 3).alias("k")).agg(F.count("*").alias("cnt"))
    return t(s, d, "nation").join(dirs, F.col("n_nationkey") == F.col("k"), "full").select("n_nationkey", "n_name", "cnt")


@query("with a as (select n_nationkey as id from nation), b as (select distinct s_suppkey % 30 + 3 as id from supplier) select 'missing' as side, id from a where id not in (select id from b) union all select 'extra', id from b where id not in (select id from a)")
def id_set_equality(s, d):
    return kits.set_differences(t(s, d, "nation").select(F.col("n_nationkey").alias("id")), t(s, d, "supplier").select((F.col("s_suppkey") % 30 + 3).alias("id")), "id")


# ---- statistics --------------------------------------------------------------------------------------------------------------
@query("select statistic, count from (select count(*) filter (length(cr) = 16) as valid_barcodes, count(*) filter (gene <> 'click') as gene_tagged, count(*) filter (length(ur) = 12) as transcript_tagged, count(distinct concat(chr, gene)) filter (gene <> 'click') as genes, count(distinct concat(chr, ur)) filter (length(ur) = 12) as transcripts from reads) unpivot (count for statistic in (valid_barcodes, gene_tagged, transcript_tagged, genes, transcripts))")
def expression_summary(s, d):
    r = views.reads(s, d)
    known = lambda ok, c: F.when(ok, F.col(c)).otherwise("-")
    return summaries.expression(r.select("chr", known(F.length("cr") == 16, "cr").alias("CB"), known(F.col("gene") != "click", "gene").alias("gene"), known(F.length("ur") == 12, "ur").alias("transcript")))


@query("select l_returnflag as key, cast(sum(l_linenumber) as bigint) as total from lineitem group by 1")
def tsv_key_sum(s, d):
    rows = t(s, d, "lineitem").select(F.col("l_returnflag").alias("key"), F.col("l_linenumber").alias("total"))
    return summaries.key_sums([rows.where("total < 3"), rows.where("total >= 3")], "key", "total")


@query("select 's' as sample, count(*) as reads_aligned, count(*) filter (l_linenumber in (1, 5, 6, 7)) as primary, count(*) filter (l_linenumber = 2) as secondary, count(*) filter (l_linenumber = 3) as supplementary, count(*) filter (l_linenumber = 4) as unmapped from lineitem")
def bam_stats_sum(s, d):
    """Line numbers stand for flags: 2 secondary, 3 supplementary, 4 unmapped."""
    n = F.col("l_linenumber")
    flags = t(s, d, "lineitem").select(F.when(n == 2, 256).when(n == 3, 2048).when(n == 4, 4).otherwise(0).alias("flag"))
    return summaries.alignment_stats(flags, "s")


SURVIVAL = ADAPT + f", st as (select statistic, cast(count as double) as count from (select {FLAGS} from s) unpivot (count for statistic in (subreads, full_length, stranded, plus, minus, no_adapters, single_adapter1, single_adapter2, double_adapter1, double_adapter2, full_len, other))), n as (select count(*) as reads from events), c as (select count(*) as cells from whitelist), a as (select statistic, count from st union all select 'reads', cast(reads as double) from n union all select 'cells', cast(cells as double) from c union all select 'mean_reads_per_cell', reads / cells from n, c)"


@query(SURVIVAL + "select statistic, round(count, 6) as count, round(100.0 * count / reads, 6) as pct_of_input_reads, round(100.0 * count / (select max(count) from st where statistic = 'full_length'), 6) as pct_of_fl_reads, 'x' as sample_id from a, n")
def survival_table(s, d):
    table = summaries.survival(adapters.summary(adapters.subreads(views.hits(s, d))), t(s, d, "events").count(), views.whitelist(s, d), sample="x")
    return table.select("statistic", *[F.round(c, 6).alias(c) for c in ("count", "pct_of_input_reads", "pct_of_fl_reads")], "sample_id")


@query(f"with {COUNTS} select barcode, row_number() over (order by count desc, barcode) - 1 as rank from counts")
def barcode_rank(s, d):
    return numbered(_counts(s, d), "n", F.desc("count"), F.col("barcode")).select("barcode", (F.col("n") - 1).alias("rank"))


@query(f"with {COUNTS}, r as (select barcode, count, row_number() over (order by count desc, barcode) as n, count(*) over () as all_rows from counts) select barcode, count from r where all_rows <= 500 or n % greatest(all_rows // 500, 1) = 0")
def rank_thinning(s, d):
    """A rank curve of some 500 points for a plot: every n-th barcode where there are more."""
    return barcodes.thinned(_counts(s, d), 500)


@query("select cast(length(text) // 500 as bigint) as bin, count(*) as n from documents group by 1")
def read_length_hist(s, d):
    return t(s, d, "documents").groupBy(F.floor(F.length("text") / 500).alias("bin")).agg(F.count("*").alias("n"))


@query("with h as (select length(text) as l, count(*) as n from documents group by 1), c as (select l, sum(l * n) over (order by l desc) as s from h) select cast(max(l) as bigint) as n50 from c where s * 2 >= (select sum(l * n) from h)")
def read_length_n50(s, d):
    h = t(s, d, "documents").groupBy(F.length("text").cast("long").alias("l")).agg(F.count("*").alias("n"))
    c = h.select("l", F.sum(F.col("l") * F.col("n")).over(Window.orderBy(F.desc("l"))).alias("_s"))
    return c.join(F.broadcast(h.agg(F.sum(F.col("l") * F.col("n")).alias("_t")))).where("_s * 2 >= _t").agg(F.max("l").alias("n50"))


# ---- fusions and genotypes ---------------------------------------------------------------------------------------------------
FUSION = "select concat('F', cast(o_custkey % 200 as string)) as fusion, concat_ws(',', cast(o_orderkey as string), cast(o_orderkey + 1 as string), cast(o_custkey as string)) as reads from orders"
FUSED = f"with x as (select fusion, cast(unnest(string_split(reads, ',')) as bigint) as read_id from ({FUSION})) "


def _fusions(s, d) -> DataFrame:
    t(s, d, "orders").createOrReplaceTempView("orders")
    return s.sql(FUSION).select("fusion", F.explode(F.split("reads", ",")).alias("read_id")).withColumn("read_id", F.col("read_id").cast("long"))


@query(FUSED + "select fusion, read_id from x")
def fusion_explode(s, d):
    return _fusions(s, d)


FCELL = "j as (select fusion, user_id as cb, value as ub from x join events on read_id = event_id) "


def _fusion_reads(s, d) -> DataFrame:
    """Reads of the fusions as the fusion operators take them; the other key columns follow from the name."""
    return _fusions(s, d).withColumnRenamed("fusion", "FusionName").withColumns({k: F.lit("x") for k in fusions.KEYS[1:]})


def _fused(s, d) -> DataFrame:
    tags = t(s, d, "events").select(F.col("event_id").alias("read_id"), F.col("user_id").alias("CB"), F.col("value").alias("UB"))
    return fusions.of_cells(_fusion_reads(s, d), tags)


@query(FUSED + ", " + FCELL + "select fusion, count(distinct cb) as cells, count(distinct ub) as umis from j group by 1")
def fusion_per_fusion(s, d):
    return fusions.per_fusion(_fused(s, d), "s").select(F.col("Fusion").alias("fusion"), "cells", F.col("UMIs").alias("umis"))


@query(FUSED + ", " + FCELL + ", c as (select cb, count(*) as n, count(distinct fusion) as f from j group by 1) select count(*) as cells, (select count(distinct fusion) from j) as fusions, cast(sum(n) as bigint) as rows, round(avg(n), 6) as mean_reads, round(avg(f), 6) as mean_fusions from c")
def fusion_per_sample(s, d):
    one = fusions.per_sample(_fused(s, d), "s")
    return one.select(F.col("cells_with_fusions").alias("cells"), F.col("unique_fusions").alias("fusions"), F.col("reads").alias("rows"), F.round("mean_fusion_reads_per_cell", 6).alias("mean_reads"), F.round("mean_unique_fusions_per_cell", 6).alias("mean_fusions"))


@query(FUSED + "select fusion, read_id, count(*) over (partition by fusion) as n from x where read_id not in (select event_id from events)")
def fusion_unmatched(s, d):
    lost = fusions.without_tags(_fusion_reads(s, d), t(s, d, "events").select(F.col("event_id").alias("read_id")))
    rows = fusions.per_read(_fusion_reads(s, d).join(lost, "read_id"))
    return rows.select(F.col("FusionName").alias("fusion"), "read_id", "n")


GT = "select concat('v', cast(l_partkey % 300 as string)) as variant, concat('c', cast(l_suppkey as string)) as cell, max(case l_linenumber % 4 when 0 then '0/0' when 1 then '0/1' when 2 then '1|1' else './.' end) as gt from lineitem group by 1, 2"
CODE = "case when contains(gt, '.') then -1 else cast(substr(gt, 1, 1) as int) + cast(substr(gt, 3, 1) as int) end"


def _genotypes(s, d) -> DataFrame:
    t(s, d, "lineitem").createOrReplaceTempView("lineitem")
    return s.sql(GT).select("variant", "cell", seq.genotype(F.col("gt")).alias("code"))


@query(f"select variant, cell, {CODE} as code from ({GT})")
def genotype_code(s, d):
    return _genotypes(s, d)


@query(f"select variant, cell, code from (select variant, cell, {CODE} as code from ({GT})) where code <> -1")
def genotype_matrix(s, d):
    """Reference homozygotes are stored as zeros, missing ones are not."""
    return _genotypes(s, d).where("code != -1")


@query(f"with g as (select variant, cell, {CODE} as code from ({GT})) select variant, coalesce(max(code) filter (cell = 'c1'), -1) as c1, coalesce(max(code) filter (cell = 'c2'), -1) as c2 from g where variant in (select distinct variant from g order by 1 limit 50) group by 1")
def genotype_top_pivot(s, d):
    calls = _genotypes(s, d).select("variant", F.col("cell").alias("sample"), "code", F.lit("c").alias("chrom"), F.lit(1).alias("pos"))
    return variants.report_table(calls, ["c"], ["c1", "c2"])


@query(f"with g as (select variant, {CODE} as code from ({GT})) select variant, cast(sum(case when code >= 0 then code else 0 end) as bigint) as ac, cast(2 * count(*) filter (code >= 0) as bigint) as an, round(sum(case when code >= 0 then code else 0 end) / nullif(2 * count(*) filter (code >= 0), 0), 6) as af from g group by 1")
def allele_fill_tags(s, d):
    return variants.fill_tags(_genotypes(s, d)).withColumn("af", F.round("af", 6))


# ---- intervals ---------------------------------------------------------------------------------------------------------------
@query("select id from intervals a where exists (select 1 from event_intervals b where a.chrom = b.chrom and a.start < b.\"end\" and b.start < a.\"end\")")
def interval_overlap_semi(s, d):
    """Orders that overlap an event."""
    return intervals.overlapping(views.intervals(s, d), views.event_intervals(s, d)).select("id")


@query("select a.id, min(b.start) as start2 from intervals a join event_intervals b on a.chrom = b.chrom and a.start < b.\"end\" and b.start < a.\"end\" group by 1")
def interval_overlap_first(s, d):
    return intervals.first_overlap(views.intervals(s, d), views.event_intervals(s, d), "id")


@query(
    "with w as (select distinct chrom, greatest(start - 100, 0) as s, \"end\" + 100 as e from intervals), g as (select *, max(e) over (partition by chrom order by s, e rows between unbounded preceding and 1 preceding) as b from w), "
    "k as (select *, sum(case when b is null or s > b then 1 else 0 end) over (partition by chrom order by s, e rows between unbounded preceding and current row) as i from g) select chrom, min(s) as start, max(e) as \"end\" from k group by chrom, i"
)
def interval_slop_merge(s, d):
    return intervals.merged(views.intervals(s, d), 100, stretch=5_000)


DEPTH = "with b as (select chrom, start, \"end\", unnest(generate_series(start // 500, (\"end\" - 1) // 500)) * 500 as lo from intervals), dd as (select chrom, lo as start, round(sum(least(\"end\", lo + 500) - greatest(start, lo)) / 500, 6) as depth, lo + 500 as \"end\" from b group by chrom, lo) "


def _depth(s, d) -> DataFrame:
    return intervals.window_depth(views.intervals(s, d), 500).withColumn("depth", F.round("depth", 6))


@query(DEPTH + "select chrom, start, depth, \"end\" from dd")
def window_mean_depth(s, d):
    return _depth(s, d)


@query(DEPTH + "select chrom, start, \"end\" from dd where depth > 2")
def high_depth_filter(s, d):
    return intervals.deep(_depth(s, d), 2).select("chrom", "start", "end")


@query(DEPTH + "select concat(chrom, ':', greatest(start - 50, 0), '-', least(\"end\" + 50, 200000)) as locus from dd order by depth desc, chrom, start limit 1")
def max_depth_locus(s, d):
    depths = _depth(s, d)
    return intervals.deepest_locus(depths, 50, depths.select("chrom", F.lit(200000).cast("long").alias("length")).distinct())


@query("select chr, start, cr, ur, read_id from (select *, row_number() over (partition by chr, start, cr, ur order by length(cy), read_id) as r from reads) where r = 1")
def umi_dedup_representative(s, d):
    best = views.reads(s, d).groupBy("chr", "start", "cr", "ur").agg(F.min(F.struct(F.length("cy"), "read_id")).alias("x"))
    return best.select("chr", "start", "cr", "ur", "x.read_id")


@query("select chr, count(*) as mapped from reads where start % 10 > 0 group by 1 having count(*) > 0")
def contigs_with_reads(s, d):
    return views.reads(s, d).where("start % 10 > 0").groupBy("chr").agg(F.count("*").alias("mapped")).where("mapped > 0")


@query("select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) + 20 as ref_len, cast(l_quantity as bigint) + 15 as query_len from lineitem")
def cigar_lengths(s, d):
    c = F.concat(F.lit("5S"), F.col("l_quantity").cast("int").cast("string"), F.lit("M10N5I"), F.lit("5D5="))
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", seq.cigar_length(c, "MDN=X").alias("ref_len"), seq.cigar_length(c, "MIS=X").alias("query_len"))


@query("select event_type as gene, count(*) as count from events group by 1")
def stream_gene_counts(s, d):
    """Gene counts of the events read as a file stream until all of it is seen; equals the batch count."""
    from cytoframe.streaming.ingest import stream_counts

    return stream_counts(s, d, "events.parquet")
