"""Fill-in-the-middle samples: each text is cut at two ranks of its units and put in another order.

A unit is a word with the white space before it; white space at the end of a text is a unit of its
own. The units of a text go into an indexable skip list. Lane 0 has a node for each unit; every
higher lane keeps about one node of four, and a node carries how many units and how many code points
lie between it and the next one of its lane. Descending by the summed unit-widths reaches a rank
after a number of steps that grows with the logarithm of the text, and the code-point-widths passed
on the way add up to the place of the cut.

The two ranks, whether a text is cut at all and the order of the parts are drawn from a digest of the
seed and the id, so that reruns agree whatever the partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, raw_texts, slices

SEED = 42
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"

_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_LEADS = np.array([b & 0xC0 != 0x80 for b in range(256)], np.int64)


def unit_widths(raw: bytes, chunk: int = 1 << 20) -> np.ndarray:
    """Code points of every unit of a UTF-8 text; ``chunk`` bytes are looked at at a time."""
    data = np.frombuffer(raw, np.uint8)
    before, ends = 0, []
    for start in range(0, len(data), chunk):
        part, after = data[start : start + chunk], data[start + 1 : start + 1 + chunk]
        last = ~_BLANK[part]
        last[: len(after)] &= _BLANK[after]
        points = np.cumsum(_LEADS[part]) + before
        ends.append(points[last])
        before = int(points[-1])
    if len(data) and _BLANK[data[-1]]:
        ends.append(np.array([before], np.int64))
    return np.diff(np.concatenate(ends), prepend=0) if ends else np.zeros(0, np.int64)


def heights(n: int) -> np.ndarray:
    """In how many express lanes each of ``n`` units stands: pairs of zero bits at the end of a hash of its number."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    lowest = np.log2((x & (~x + np.uint64(1))).astype(np.float64) + (x == 0))
    return lowest.astype(np.int64) >> 1


class SkipList:
    """The units of a text by rank; ``lanes`` from the lowest up, each with units, points and the node below."""

    def __init__(self, widths: np.ndarray):
        self.lanes = [(np.ones(len(widths), np.int64), widths, np.arange(len(widths)))]
        tall = heights(len(widths)) if len(widths) > 4 else widths
        while len(self.lanes[-1][0]) > 4:
            units, points, _ = self.lanes[-1]
            keep = tall >= len(self.lanes)
            keep[0] = True  # every lane begins at the first unit
            at = np.flatnonzero(keep)
            if len(at) == len(units):
                break
            self.lanes.append((np.add.reduceat(units, at), np.add.reduceat(points, at), at))
            tall = tall[at]

    def reach(self, rank: int) -> int:
        """Code points before unit number ``rank``; the number of units gives the whole length."""
        passed = points = node = 0
        for units, widths, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(widths[node])
                node += 1
            if passed == rank or node == len(units):
                return points
            node = int(below[node])
        return points


def draws(name: str, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the seed and an id."""
    text = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return int(text[:8], 16), int(text[8:16], 16), int(text[16:24], 16), int(text[24:32], 16)


def rearranged(raw: bytes, name: str, seed: int, cut_percent: int, suffix_first_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    widths, text = unit_widths(raw), raw.decode("utf-8", "replace")
    n = len(widths)
    one, two, cut, order = draws(name, seed)
    if not text or cut % 100 >= cut_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(widths)
    a, b = sorted((units.reach(one % (n + 1)), units.reach(two % (n + 1))))
    before, middle, after = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{after}{PREFIX}{before}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{before}{SUFFIX}{after}{MIDDLE}{middle}"


def _columns(batch: pa.RecordBatch, name: str, text: str, *options: int) -> list[pa.Array]:
    names = ["null" if x is None else x for x in batch.column(name).to_pylist()]
    rows = [rearranged(raw, own, *options) for raw, own in zip(raw_texts(batch, text), names, strict=True)]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, cut_percent: int = CUT_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """``(id_col, n, form, prefix_chars, middle_chars, output)`` for every row of ``docs``.

    Null counts as an empty text. Texts that are empty or hold one of the marks stay ``plain``, as do
    those not drawn; their two lengths are null. Rows without an id draw as if it were ``null``;
    repeated rows get the same result. An empty table gives an empty one; other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("i"), F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = _columns(batch, "name", "t", seed, cut_percent, suffix_first_percent)
            yield pa.RecordBatch.from_arrays([batch.column("i"), *made], names=["i", "n", "form", "prefix_chars", "middle_chars", "output"])

    return arrow_map(picked, run, f"i {picked.schema['i'].dataType.simpleString()}, {RESULT}").withColumnRenamed("i", id_col)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, cut_percent: int = CUT_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """``docs`` with the texts rearranged, all columns kept; a null text becomes an empty one."""
    names, place = docs.columns, docs.columns.index(text_col)
    widened = docs.select("*", F.col(id_col).cast("string"), F.col(text_col).cast("string")).toDF(*[f"c{k}" for k in range(len(names) + 2)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = _columns(batch, f"c{len(names)}", f"c{len(names) + 1}", seed, cut_percent, suffix_first_percent)[-1]
            own = [made if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(own, names=[f"c{k}" for k in range(len(names))])

    kinds = ["string" if k == place else f.dataType.simpleString() for k, f in enumerate(docs.schema.fields)]
    return arrow_map(widened, run, ", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds))).toDF(*names)


def restored(output: Column, form: Column) -> Column:
    """The text before it was rearranged, put together from the parts between the marks."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda k: F.get(parts, k)
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def digest_columns(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Outputs and restored texts as digests."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    back = restored(F.col("output"), F.col("form"))
    return made.select(id_col, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256"))


_DRAW = "('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), {}, 8))::BIGINT"
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
         {_DRAW.format(1)} AS h1, {_DRAW.format(9)} AS h2, {_DRAW.format(17)} AS h3, {_DRAW.format(25)} AS h4
  FROM documents),
c AS (
  SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1:b], '') AS y, array_to_string(u[b + 1:n], '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
