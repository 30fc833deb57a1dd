"""Fill-in-middle: a text is cut at two ranks of its units and put in order anew.

The units of a text are runs of ASCII letters and single other code points.
They hang in an indexable skip list: lane 0 links each unit to the next, and
every express lane above links about a quarter of the nodes of the lane below.
A link carries its width twice, in units and in code points, so a descent that
adds up widths from the topmost lane reaches the code point of any rank exactly,
in a logarithmic number of steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillgate.llm import common as c

#: marks before prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: of 100 texts, so many stay plain; of 100 of the others, so many have the suffix first
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
#: a node is on the next lane with a chance of one in 2**LANE_BITS
LANE_BITS = 2
#: code points of results that are handed on at once
RESULT_POINTS = 1 << 22


class SkipList:
    """Units in lanes, from the offsets at which they begin.

    ``starts``: code-point offset of every unit, rising from 0; ``end``: offset
    behind the last one.  Heights come from a hash of the unit's number, so the
    same text always gives the same lanes.
    """

    def __init__(self, starts: np.ndarray, end: int):
        self.n = len(starts)
        offset = np.append(starts, end).astype(np.int32)  # a text holds less than 2**31
        height = c.mix(np.arange(self.n + 1, dtype=np.uint64) + np.uint64(1))
        at = np.arange(self.n + 1, dtype=np.int32)
        #: of each lane: units and code points that its links pass, and the place of each node in the lane below
        self.units, self.points, self.down = [], [], []
        below = at
        while True:
            self.units.append(np.diff(at))
            self.points.append(np.diff(offset[at]))
            self.down.append(np.searchsorted(below, at).astype(np.int32))
            if len(at) <= 2:
                break
            bits = np.uint64((1 << LANE_BITS * len(self.units)) - 1)
            tall = (height[at] & bits) == 0
            tall[0] = tall[-1] = True  # head and end are on every lane
            below, at = at, at[tall]

    def offset(self, rank: int) -> int:
        """Code points of the first ``rank`` units (0 to n)."""
        node = units = points = 0
        for lane in range(len(self.units) - 1, -1, -1):
            wide, long = self.units[lane], self.points[lane]
            while node < len(wide) and units + wide[node] <= rank:
                units += int(wide[node])
                points += int(long[node])
                node += 1
            node = int(self.down[lane][node])
        return points


def unit_starts(text: str) -> np.ndarray:
    """Code-point offsets at which the units of a text begin."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((points | np.uint32(32)) - np.uint32(97)) < 26
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] = False
    return np.flatnonzero(~inside)


def rearrange_text(text: str, draws: tuple[int, int, int, int], plain_share: int = PLAIN_SHARE,
                   suffix_first_share: int = SUFFIX_FIRST_SHARE) -> tuple:
    """(units, form, code points of the prefix, of the middle, output)."""
    starts = unit_starts(text)
    n = len(starts)
    if not text or draws[2] % 100 >= 100 - plain_share or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    lanes = SkipList(starts, len(text))
    first, last = (lanes.offset(rank) for rank in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if draws[3] % 100 < suffix_first_share:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def rearrange(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[Column] | None = None, seed: str = "1",
              plain_share: int = PLAIN_SHARE, suffix_first_share: int = SUFFIX_FIRST_SHARE) -> DataFrame:
    """For every row of ``docs`` the columns of ``keep``, then ``n`` (units),
    ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (code points;
    null if plain) and ``output``.

    Cuts and form depend on ``seed`` and the id alone: the first four groups of
    eight digits of the hex sha256 of ``seed:id``.  A null text is empty; empty
    texts and those that hold a mark stay plain.  A null id draws as an empty
    one.  Repeated rows give repeated results, an empty table none.  Texts are
    cut whole, whatever their length; each is handled by itself in its task.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.struct(F.lit(0).alias("_0"), *(keep or [])).alias("_keep"), F.col(text).alias("text"), *draws)

    def run(batches):
        for batch in batches:
            lo = done = 0
            results: list[tuple] = []
            columns = [batch.column(i) for i in range(2, 6)]
            for i, text in enumerate(batch.column("text")):
                given = tuple(h[i].as_py() for h in columns)
                results.append(rearrange_text(text.as_py() or "", given, plain_share, suffix_first_share))
                done += len(results[-1][-1])
                if done >= RESULT_POINTS or i + 1 == batch.num_rows:
                    n, form, prefix, middle, output = zip(*results)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_keep").slice(lo, len(results)), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                         pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                        names=["_keep", "n", "form", "prefix_chars", "middle_chars", "output"])
                    lo, done, results = i + 1, 0, []

    found = T._parse_datatype_string("n long, form string, prefix_chars long, middle_chars long, output string")
    got = rows.mapInArrow(run, T.StructType([rows.schema["_keep"], *found]))
    names = [f"_keep.`{f.name}`" for f in rows.schema["_keep"].dataType.fields if f.name != "_0"]
    return got.select(*names, "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text again, from an output and its form.

    Only plain texts hold a mark, and no mark can begin inside another, so the
    first find of each in turn is the one that was set.
    """
    out, kind = F.col(output), F.col(form)
    outer, inner = F.when(kind == "psm", SUFFIX).otherwise(PREFIX), F.lit(MIDDLE)
    second = F.call_function("locate", outer, out, F.lit(4))
    third = F.call_function("locate", inner, out, second)
    head = F.substring(out, F.lit(4), second - 4)
    tail = F.substring(out, second + 3, third - second - 3)
    middle = F.substring(out, third + 3, F.length(out))
    return F.when(kind == "plain", out).when(kind == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
