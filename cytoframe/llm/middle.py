"""Fill-in-middle transformation: texts cut at two drawn word boundaries and put in another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.shared import free_name, packed, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def codepoints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-32 code points of packed texts, and where each text begins among them (with an end mark)."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, before[offsets]


def unit_starts(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where units begin, and the first unit of each text (with an end mark).

    A unit is a run of other characters than blanks with the blanks before it, or the blanks at a text's end. So one begins with each text
    that is not empty, and wherever a blank follows another character.
    """
    blank = (points < 256) & BLANK[np.minimum(points, 255)]
    begins = np.zeros(len(points), bool)
    begins[1:] = blank[1:] & ~blank[:-1]
    begins[starts[:-1][starts[:-1] < starts[1:]]] = True
    at = np.flatnonzero(begins)
    return at, np.searchsorted(at, starts)


def draws(seed: int, key: str) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that seed and key fix."""
    d = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(d[i : i + 4], "big") for i in (0, 4, 8, 12))


def fill_in_middle(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] | None = None, seed: int = 42, percent: int = 50, suffix_first_percent: int = 80) -> DataFrame:
    """One row per row of docs: columns `keep` (the id alone by default), n (units), form, prefix_chars, middle_chars and output.

    The text's two cuts fall on boundaries of units; their ranks, and whether it is transformed, follow from seed and id alone, so a
    repeated id is cut by the same draws. Form plain: the text as it is (100 - percent of 100, empty and null texts, texts that hold a
    mark already), prefix_chars and middle_chars null. Form psm: prefix, suffix, middle behind their marks. Form spm: suffix first. A null
    id counts as an empty one. Other columns are not looked at, whatever their names; an empty table gives an empty one. No shuffle.
    """
    keep = (id_column,) if keep is None else keep
    fields = [docs.schema[c] for c in keep] + [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                points, starts = codepoints(*packed(part.column(0)))
                at, first = unit_starts(points, starts)
                at = np.append(at, len(points))
                number = np.diff(first)
                rows = []
                for i, key in enumerate(part.column(1).to_pylist()):
                    a, b, n = int(starts[i]), int(starts[i + 1]), int(number[i])
                    h1, h2, h3, h4 = draws(seed, "" if key is None else key)
                    cut = lambda k: b if k == n else int(at[first[i] + k])  # noqa: B023, E731
                    low, high = sorted((cut(h1 % (n + 1)), cut(h2 % (n + 1))))
                    piece = lambda x, y: points[x:y].tobytes().decode("utf-32-le")  # noqa: B023, E731
                    whole = piece(a, b)
                    if a == b or h3 % 100 >= percent or any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append(("plain", None, None, whole))
                        continue
                    prefix, middle, suffix = piece(a, low), piece(low, high), piece(high, b)
                    if h4 % 100 < suffix_first_percent:
                        rows.append(("spm", low - a, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"))
                    else:
                        rows.append(("psm", low - a, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"))
                form, before, inside, out = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(number, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(out, pa.string())], names=names)

    text, key = free_name(docs, "_text"), free_name(docs, "_key")
    return docs.select(F.col(text_column).alias(text), F.col(id_column).cast("string").alias(key), *keep).mapInArrow(run, T.StructType(fields))


def restored(output: str = "output", form: str = "form"):
    """The text as a column, rebuilt from output and form. Each mark stands there once, since texts that hold one stay plain."""
    part = lambda x, mark, i: F.split_part(x, F.lit(mark), F.lit(i))
    o = F.col(output)
    middle, ahead = part(o, MIDDLE, 2), part(o, MIDDLE, 1)
    psm = F.concat(part(part(ahead, SUFFIX, 1), PREFIX, 2), middle, part(ahead, SUFFIX, 2))
    spm = F.concat(part(ahead, PREFIX, 2), middle, part(part(ahead, PREFIX, 1), SUFFIX, 2))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(o)


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units from documents),
r as (select *, len(units) as n, ('0x' || h[1:8])::ubigint % (len(units) + 1) as a, ('0x' || h[9:16])::ubigint % (len(units) + 1) as b, ('0x' || h[17:24])::ubigint as h3, ('0x' || h[25:32])::ubigint as h4 from d),
f as (select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form,
      array_to_string(units[1:least(a, b)], '') as prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') as middle, array_to_string(units[greatest(a, b) + 1:], '') as suffix from r),
o as (select *, case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output from f),
p as (select *, strpos(output, '<P>') as at_p, strpos(output, '<S>') as at_s, strpos(output, '<M>') as at_m from o)
select doc_id, n, form, case when form != 'plain' then length(prefix) end as prefix_chars, case when form != 'plain' then length(middle) end as middle_chars, sha256(output) as output_sha256,
       sha256(case form when 'plain' then output when 'psm' then substr(output, 4, at_s - 4) || substr(output, at_m + 3) || substr(output, at_s + 3, at_m - at_s - 3) else substr(output, at_p + 3, at_m - at_p - 3) || substr(output, at_m + 3) || substr(output, 4, at_p - 4) end) as restored_sha256
from p
"""
