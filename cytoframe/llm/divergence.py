"""Audit of how the term use of sources differs within a language.

Terms are counted by DuckDB over Arrow batches where texts are read, and again in shards by language and term, which hold every source of
a term. A shard gives, by SQL over term-aligned chunks: the terms' top differences, partial sums over the pairs of sources that share
terms, and how many terms of a source have which count. A pair's sum over all kept terms follows from these, without a row for each term
and each source that lacks it:

    sum f(p, q) = V f(p0, q0) + sum over the first's terms (f(p, q0) - f(p0, q0)) + the same of the second
                  + sum over shared terms (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)),

where p0 and q0 are the shares of a term that does not occur. All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.hashing import LOWER
from cytoframe.llm.shared import packed, partitions, slices, trim, written

LEAST_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
TEXT_BYTES = 8 << 20  # of texts that one count query takes, more only for one longer text
ROWS = 400_000  # of counts that a task holds
BLOCK = 256  # sources of a language whose pairs one query sums
_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
COUNTS = "lang string, source string, term string, n long, d long"
FOUND = "kind string, lang string, source string, item string, value long, n long"


def connection():
    """DuckDB in memory, of one thread: a task has one core. Nothing is spilled to a local folder; inputs are bounded."""
    import duckdb

    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "autoinstall_known_extensions": False})


def _rows(con, query: str) -> list[pa.RecordBatch]:
    return con.sql(query).to_arrow_table().to_batches(max_chunksize=1 << 16)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of packed texts (runs of ASCII letters and characters beyond ASCII, A-Z lower-cased) and how many each text has."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1 : len(data)]
    at = np.flatnonzero(begins)
    kept = np.concatenate([[0], np.cumsum(inside)])
    to = np.append(kept[at], kept[-1])
    raw = np.ascontiguousarray(LOWER[data][inside])
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(raw)), np.diff(np.searchsorted(at, offsets))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, over some texts at a time, then over as many as fit."""
    con = connection()
    con.execute("create table c (lang varchar, source varchar, term varchar, n bigint, d bigint)")
    held, size = [], 0

    def count() -> None:
        texts = pa.Table.from_batches([pa.RecordBatch.from_arrays([x[1], x[2], pa.array(x[3])], names=["lang", "source", "k"]) for x in held])
        number = texts.column("k").to_numpy()
        rows = pa.table([pa.chunked_array([x[0] for x in held]), pa.array(np.repeat(np.arange(len(number), dtype=np.int32), number))], names=["term", "row"])
        texts = texts.drop_columns(["k"]).append_column("row", pa.array(np.arange(len(number), dtype=np.int32)))
        con.register("rows", rows)
        con.register("texts", texts)
        con.execute("insert into c select lang, source, term, sum(k), count(*) from (select row, term, count(*) k from rows group by row, term) join texts using (row) group by lang, source, term")
        con.unregister("rows")
        con.unregister("texts")
        held.clear()

    def handed_on(least: int) -> Iterator[pa.RecordBatch]:
        if con.execute("select count(*) from c").fetchall()[0][0] <= least:
            return
        con.execute("create or replace table c as select lang, source, term, sum(n)::bigint n, sum(d)::bigint d from c group by lang, source, term")
        if con.execute("select count(*) from c").fetchall()[0][0] > least // 2:
            yield from _rows(con, "from c")
            con.execute("truncate c")
            trim()

    for batch in batches:
        for part in slices(batch, "text", TEXT_BYTES):
            data, offsets = packed(part.column(2))
            found, number = terms(data, offsets)
            held.append((found, part.column(0), part.column(1), number))
            size += len(data)
            if size >= TEXT_BYTES:
                count()
                size = 0
                yield from handed_on(ROWS)
    if held:
        count()
    yield from handed_on(0)
    con.close()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows sorted by lang and term, cut only between terms, with the number of each row's term as `t`."""
    held, size = [], 0

    def cut(last: bool) -> tuple[pa.Table | None, pa.Table | None]:
        rows = pa.Table.from_batches(held).combine_chunks()
        new = np.ones(rows.num_rows, bool)
        for c in ("lang", "term"):
            x = rows.column(c)
            differ = pc.not_equal(x[1:], x[:-1]).to_numpy()
            new[1:] = differ if c == "lang" else new[1:] | differ
        at = rows.num_rows if last else int(np.flatnonzero(new)[-1])
        rows = rows.append_column("t", pa.array(np.cumsum(new)))
        return rows.slice(0, at), rows.slice(at).drop_columns(["t"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            full, rest = cut(False)
            held, size = rest.to_batches(), rest.num_rows
            if full.num_rows:
                yield full
    if size:
        yield cut(True)[0]


def _kept(least: int):
    """Counts of the terms that enough documents of their language have; one row of each term is marked as its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connection()
        for chunk in _chunks(batches):
            con.register("chunk", chunk)
            query = f"with s as (select t, lang, source, term, sum(n)::bigint n, sum(d) d from chunk group by all) select lang, source, term, n, row_number() over (partition by t order by source) = 1 as first from s qualify sum(d) over (partition by t) >= {least}"
            yield from _rows(con, query)
            con.unregister("chunk")
        con.close()
        trim()

    return run


def _audited(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connection()
        con.execute("create macro f(p, q) as ((p - q) * (p - q)) // (p + q)")
        for chunk in _chunks(batches):
            con.register("chunk", chunk)
            con.execute(f"create or replace table c as select *, (1 + ({UNIT}::hugeint * (sum(n) over (partition by t) + 2)) // (lang_n + 2 * v))::bigint q, k // {BLOCK} as b from chunk")
            con.unregister("chunk")
            yield from _rows(con, f"select 'term' as kind, lang, source, term as item, f(p, q)::bigint as value, 1::bigint as n from c where p > q qualify row_number() over (partition by lang, source order by value desc, item) <= {top}")
            yield from _rows(con, "select 'count' as kind, lang, source, '' as item, n as value, count(*)::bigint as n from c group by all")
            blocks = [x[0] for x in con.execute("select distinct b from c order by b").fetchall()]
            for i, one in enumerate(blocks):
                for other in blocks[i:]:
                    yield from _rows(con, f"select 'pair' as kind, x.lang, any_value(x.source) as source, any_value(y.source) as item, sum(f(x.p, y.p) - f(x.p, y.p0) - f(x.p0, y.p) + f(x.p0, y.p0))::bigint as value, count(*)::bigint as n from c x join c y on x.t = y.t and x.k < y.k where x.b = {one} and y.b = {other} group by x.lang, x.k, y.k")
        con.close()
        trim()

    return run


def _share(count: str, total: str):
    """1 + floor(UNIT (count + 2) / (total + 2 v)), in whole numbers of any size."""
    return F.expr(f"case when {total} + 2 * v > 0 then 1 + cast({UNIT} as decimal(10, 0)) * ({count} + 2) div ({total} + 2 * v) end")


def _f(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) div ({p} + {q})"


def divergences(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far each source's term shares are from other sources' and from its language's.

    Null text, lang and source count as ''. A language keeps the terms that least_docs of its rows hold. A group's share of a kept term
    is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N its occurrences of kept terms, V the number of kept terms; a difference is
    f = floor((p - q)^2 / (p + q)). Part pair: for every other source of the language the sum of f over all kept terms (0 without any).
    Part term: the group's `top` terms with a share above the language's, by f. Ranks by value descending, then by item's bytes. Every
    occurring (lang, source) is a group, with or without terms; repeated rows are documents of their own; other columns are not looked at,
    whatever their names; an empty table gives no rows.

    Where texts are read, counts are combined, so a frequent term gives a task one row a source; chunks of shards end between terms, so
    no task holds more than its share. Sources of a language are paired in blocks; their pairs are rows of the result anyway.
    """
    n = partitions(docs)
    source = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    shard = lambda df: df.repartition(n, "lang", "term").sortWithinPartitions("lang", "term")
    kept = written(shard(source.mapInArrow(_counted, COUNTS)).mapInArrow(_kept(least_docs), "lang string, source string, term string, n long, first boolean"), "terms")
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("g_n"), F.count_if("first").alias("_v"))
    every = source.groupBy("lang", "source").agg(F.lit(1)).select("lang", "source").join(by_source, ["lang", "source"], "left").fillna(0)
    by_lang = every.groupBy("lang").agg(F.sum("g_n").alias("lang_n"), F.sum("_v").alias("v"))
    groups = every.join(by_lang, "lang").withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")).withColumn("p0", _share("0", "g_n"))
    groups = written(groups.select("lang", "source", "k", "g_n", "lang_n", "v", "p0"), "groups")
    rows = kept.select("lang", "source", "term", "n").join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "k", "lang_n", "v", "p0", _share("n", "g_n").alias("p"))
    found = written(shard(rows).mapInArrow(_audited(top), FOUND), "found")
    shared = found.where("kind = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("_both"))
    counts = found.where("kind = 'count'").groupBy("lang", "source", "value").agg(F.sum("n").alias("_terms"))
    counts = counts.join(groups, ["lang", "source"]).select("lang", "source", "_terms", "p0", _share("value", "g_n").alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    own = counts.join(other, "lang").where("source != item").groupBy("lang", "source", "item").agg(F.sum(F.expr(f"_terms * ({_f('p', 'q0')} - {_f('p0', 'q0')})")).alias("_own"))
    swap = lambda df, c: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), c)
    parts = own.withColumnRenamed("_own", "_part")
    parts = parts.union(swap(parts, "_part")).union(shared.withColumnRenamed("_both", "_part")).union(swap(shared, "_both"))
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("_part").alias("_part"))
    pairs = groups.join(other, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.expr(f"case when v > 0 then v * ({_f('p0', 'q0')}) + coalesce(_part, 0) else 0 end").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = found.where("kind = 'term'").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(order)).union(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


SQL = r"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as found from documents),
o as (select row, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
kept as (select lang, term from o group by lang, term having count(distinct row) >= 10),
c as (select lang, source, term, count(*) as n from o semi join kept using (lang, term) group by lang, source, term),
g as (select distinct lang, source from d),
lang_v as (select lang, count(*) as v from kept group by lang),
total as (select lang, source, sum(n) as n from c group by lang, source),
lang_c as (select lang, term, sum(n) as n from c group by lang, term),
lang_n as (select lang, sum(n) as n from lang_c group by lang),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * v.v) as p
      from g join kept k using (lang) join lang_v v using (lang) left join total t using (lang, source) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
q as (select l.lang, l.term, 1 + (1000000000::hugeint * (l.n + 2)) // (t.n + 2 * v.v) as q from lang_c l join lang_n t using (lang) join lang_v v using (lang)),
s as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source != b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
best as (select p.lang, p.source, 'term' as part, p.term as item, (((p.p - q.q) * (p.p - q.q)) // (p.p + q.q))::bigint as value from p join q using (lang, term) where p.n > 0 and p.p > q.q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (from pairs union all from best))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
