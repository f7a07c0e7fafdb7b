"""Headers of alignment files put together: one header for the files of each sample.

Header records are rows; files are in the order of their names and records in that of their lines. Read groups are a union, programs get
new ids where they collide, and each program follows its parent or else the program before it, so a sample has one chain. All of it is
joins and windows by sample and id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.sources.scratch import written

#: The header line of files without one, and the order of record kinds.
NO_HEADER = "@HD\tVN:1.6\tSO:unknown"
KINDS = ("@HD", "@SQ", "@RG", "@PG", "@CO")
NAMED = ("@RG", "@PG")


def header_records(lines: DataFrame) -> DataFrame:
    """Header lines of rows (sample, file, at, line) as rows (sample, file, at, line, kind, fields, id, parent).

    fields are the key:value texts of read groups and programs in their order. A record of another kind, a field that is not two letters
    and digits with a colon, and a read group or program without id are errors, raised when the row is read.
    """
    f = F.split("line", "\t")
    kind, rest = f[0], F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0)))
    own = lines.where("line rlike '^@[A-Z][A-Z](\\t|$)'").select("sample", "file", "at", "line", kind.alias("kind"), F.when(kind.isin(*NAMED), rest).alias("fields"))
    value = lambda k: F.substring(F.get(F.filter("fields", lambda x: x.startswith(f"{k}:")), F.lit(0)), 4, 1 << 30)
    named = own.withColumns({"id": value("ID"), "parent": value("PP")})
    odd = F.exists("fields", lambda x: ~x.rlike("^[A-Za-z][A-Za-z0-9]:"))
    fault = F.when(~F.col("kind").isin(*KINDS), "unknown header record: ").when(odd, "header record with an invalid field: ").when(F.col("kind").isin(*NAMED) & F.col("id").isNull(), "header record without an id: ")
    return named.withColumn("kind", F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.col("line")))).otherwise(F.col("kind")))


def chain_faults(programs: DataFrame) -> DataFrame:
    """Rows (sample, fault) of programs (sample, id, parent) that are no single chain back to one head.

    Every program jumps to the parent of its parent until none moves: those that reach no head after as many doublings as their number
    has bits go round in a cycle. Each round is a written table of one row a program.
    """
    heads = programs.groupBy("sample").agg(F.count_if(F.col("parent").isNull()).alias("_n"))
    count = F.when(F.col("_n") == 0, "no program is without a parent").when(F.col("_n") > 1, "several programs are without a parent")
    most = programs.groupBy("sample").count().agg(F.max("count")).first()[0] or 0
    now = written(programs.select("sample", "id", F.col("parent").alias("_up")), "chain")
    for _ in range(most.bit_length()):
        over = now.select("sample", F.col("id").alias("_up"), F.col("_up").alias("_next"))
        now = written(now.where("_up is not null").join(over, ["sample", "_up"], "left").select("sample", "id", F.col("_next").alias("_up")), "chain")
    cycle = now.where("_up is not null").groupBy("sample").agg(F.concat(F.lit("programs go round in a cycle: "), F.array_join(F.slice(F.array_sort(F.collect_set("id")), 1, 5), ", ")).alias("fault"))
    return heads.select("sample", count.alias("fault")).where("fault is not null").union(cycle)


def linked_programs(records: DataFrame) -> DataFrame:
    """Programs (sample, file, at, line, fields, old_id, id, parent) with ids told apart and every one linked.

    A second program of an id gets a suffix: the number of collisions in its sample before it. A parent's id means the last program of that
    id so far. A program without a parent follows the one before it. A parent that has not come yet stays null with `unseen` true.
    """
    place = Window.partitionBy("sample").orderBy("file", "at")
    p = records.where("kind = '@PG'").select("sample", "file", "at", "line", "fields", F.col("id").alias("old_id"), F.col("parent").alias("_pp"))
    nth = F.row_number().over(Window.partitionBy("sample", "old_id").orderBy("file", "at"))
    # a sample's programs are some lines a file
    p = p.withColumn("_again", nth > 1).withColumn("_c", F.sum(F.col("_again").cast("long")).over(place) - 1)
    p = p.withColumn("id", F.when(F.col("_again"), F.concat_ws("-", "old_id", F.col("_c").cast("string"))).otherwise(F.col("old_id"))).drop("_again", "_c")
    p = written(p.withColumn("_before", F.lag("id").over(place)), "programs")
    known = p.select("sample", F.col("old_id").alias("_key"), "file", "at", F.lit(0).alias("_asks"), "id")
    asked = p.where("_pp is not null").select("sample", F.col("_pp").alias("_key"), "file", "at", F.lit(1).alias("_asks"), F.lit(None).cast("string").alias("id"))
    last = F.last("id", ignorenulls=True).over(Window.partitionBy("sample", "_key").orderBy("file", "at", "_asks"))
    seen = known.union(asked).withColumn("_found", last).where("_asks = 1").select("sample", "file", "at", "_found")
    out = p.join(seen, ["sample", "file", "at"], "left")
    return out.select("sample", "file", "at", "line", "fields", "old_id", "id", F.when(F.col("_pp").isNotNull(), F.col("_found")).otherwise(F.col("_before")).alias("parent"), (F.col("_pp").isNotNull() & F.col("_found").isNull()).alias("unseen"))


def merge_faults(records: DataFrame, programs: DataFrame) -> DataFrame:
    """Rows (sample, fault): read groups of one id that differ, parents that have not come yet, and broken chains."""
    content = F.array_sort("fields")
    groups = records.where("kind = '@RG'").groupBy("sample", "id").agg(F.min(content).alias("_a"), F.max(content).alias("_b")).where("_a != _b")
    unseen = programs.where("unseen").select("sample", F.concat(F.lit("a program's parent does not stand before it: "), "line").alias("fault"))
    return groups.select("sample", F.concat(F.lit("read groups of one id differ: "), "id").alias("fault")).union(unseen).union(chain_faults(programs.where("not unseen").select("sample", "id", "parent")))


def merged_headers(lines: DataFrame, *, sort_order: str | None = None) -> DataFrame:
    """Rows (sample, rank, line): the one header of each sample, from rows (sample, file, at, line) of its files.

    The last header line (or a default), with the sort order if one is given; the references of the last file that has some; read groups
    by first appearance; programs; comments. Faults are errors.
    """
    records = written(header_records(lines), "header")
    programs = written(linked_programs(records), "linked")
    if faults := merge_faults(records, programs).limit(20).collect():
        raise ValueError("; ".join(f"{r.sample}: {r.fault}" for r in faults))
    each = records.select("sample", "kind", "file", "at", "line", "fields", "id")
    head = each.where("kind = '@HD'").groupBy("sample").agg(F.max_by("line", F.struct("file", "at")).alias("line"))
    head = lines.select("sample").distinct().join(head, "sample", "left").select("sample", F.lit("").alias("file"), F.lit(0).cast("long").alias("at"), F.coalesce("line", F.lit(NO_HEADER)).alias("line"))
    if sort_order:
        head = head.withColumn("line", F.concat(F.regexp_replace("line", "\tSO:[^\t]*", ""), F.lit(f"\tSO:{sort_order}")))
    last = each.where("kind = '@SQ'").groupBy("sample").agg(F.max("file").alias("file"))
    references = each.where("kind = '@SQ'").join(last, ["sample", "file"], "left_semi").select("sample", "file", "at", "line")
    groups = each.where("kind = '@RG'").groupBy("sample", "id").agg(F.min_by(F.struct("file", "at", "line"), F.struct("file", "at")).alias("x")).select("sample", "x.*")
    others = F.filter("fields", lambda x: ~x.startswith("ID:") & ~x.startswith("PP:"))
    text = F.concat_ws("\t", F.lit("@PG"), F.concat(F.lit("ID:"), F.col("id")), others, F.concat(F.lit("PP:"), F.col("parent")))
    comments = each.where("kind = '@CO'").select("sample", "file", "at", "line")
    parts = (head, references, groups, programs.select("sample", "file", "at", text.alias("line")), comments)
    every = None
    for i, p in enumerate(parts):
        own = p.select("sample", F.lit(i).alias("_k"), "file", "at", "line")
        every = own if every is None else every.union(own)
    return every.select("sample", F.row_number().over(Window.partitionBy("sample").orderBy("_k", "file", "at")).alias("rank"), "line")
