"""Fill-in-the-middle transformation with cuts found in an indexable skip list.

The units of a text are runs of ASCII letters and single other code points. Every unit is a node
of lane 0; each higher lane keeps about a quarter of the nodes below, by a fixed hash of the rank.
A node carries how many units and how many code points lie between it and the next node of its
lane. A descent adds up these widths from the top lane down and ends exactly at a rank: its
position in code points is the sum of the widths passed. Both cuts of a text are found this way,
in time logarithmic in the number of units once the lanes stand.

Python tasks return three numbers a text; pieces are cut and put together by Spark. There is no
shuffle. A task holds the lanes of one text at a time: about eight bytes a unit and the text in
four bytes a code point by blocks.

Defined cases: a null text counts as empty; an empty text, or one that contains a marker, stays
plain; a null id draws from the text of no digits; repeated rows are transformed alike; an empty
table gives no rows; very long texts are read whole; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import table

# Markers of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = len(PREFIX)

SEED = 1
#: Percent of texts that stay plain, and percent of the others with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20

#: Code points that are looked at together.
_BLOCK = 1 << 20


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit `[A-Za-z]+|[^A-Za-z]`, from left to right."""
    starts, in_letters = [], False
    for at in range(0, len(text), _BLOCK):
        points = np.frombuffer(text[at : at + _BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = ((points | 32) - np.uint32(97)) < 26
        follows = np.empty(len(letter), bool)
        follows[0], follows[1:] = in_letters, letter[:-1]
        starts.append(np.flatnonzero(~(letter & follows)) + at)
        in_letters = bool(letter[-1])
    if not starts:
        return np.zeros(0, np.int64)
    return np.diff(np.concatenate(starts), append=len(text))


def _heights(n: int) -> np.ndarray:
    """Lane of each rank: a fixed hash of the rank, each lane a quarter as likely as the one below."""
    x = np.arange(n, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(31)) ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    zeros = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1))
    return (zeros >> 1).astype(np.uint8)


class SkipList:
    """Lanes over the units of a text; rank 0 is in every lane."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        #: For each lane from 0 up: units to the next node, code points to it, and the node's place in the lane below.
        self.lanes: list[tuple[np.ndarray | None, np.ndarray, np.ndarray | None]] = [(None, widths, None)]
        heights, ranks, points = _heights(self.n), np.arange(self.n), widths
        lane = 0
        while len(ranks) > 4:
            lane += 1
            kept = heights[ranks] >= lane
            kept[0] = True
            down = np.flatnonzero(kept)
            if len(down) == len(ranks):
                continue
            ranks, points = ranks[down], np.add.reduceat(points, down)
            self.lanes.append((np.diff(ranks, append=self.n), points, down))

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank; all of them for the rank after the last."""
        node = units = points = 0
        for steps, widths, down in reversed(self.lanes):
            while units < rank:
                step = 1 if steps is None else int(steps[node])
                if units + step > rank:
                    break
                units += step
                points += int(widths[node])
                node += 1
            if units == rank:
                return points
            node = node if down is None else int(down[node])
        raise IndexError(rank)


def cut_points(text: str, one: int, two: int) -> tuple[int, int, int]:
    """Units of a text, and the code points before the lesser and the greater of the two drawn ranks."""
    units = SkipList(unit_widths(text))
    ranks = sorted((one % (units.n + 1), two % (units.n + 1)))
    return units.n, units.offset(ranks[0]), units.offset(ranks[1])


def _cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    got = [cut_points(t.as_py(), a.as_py(), b.as_py()) for t, a, b in zip(text, one, two)]
    columns = [pa.array(column, pa.int64()) for column in (zip(*got) if got else ([], [], []))]
    return pa.StructArray.from_arrays(columns, ["n", "first", "second"])


def _draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    seed: int = SEED,
    plain_percent: int = PLAIN_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of every row.

    The form is `plain`, `psm` (prefix, suffix, middle) or `spm` (suffix, prefix, middle).
    """
    one, two, three, four = _draws(F.col("doc_id"), seed)
    text, cut = F.col("text"), F.col("cut")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (three % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(four % 100 < suffix_first_percent, "spm").otherwise("psm")
    first, second = cut["first"].cast("int"), cut["second"].cast("int")
    prefix = F.substring(text, F.lit(1), first)
    middle = F.substring(text, first + 1, second - first)
    suffix = F.substring(text, second + 1, F.length(text) - second)
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .withColumn("cut", F.arrow_udf(_cuts, "struct<n:bigint,first:bigint,second:bigint>")("text", one, two))
        .withColumn("form", form)
        .select(
            "doc_id",
            "text",
            cut["n"].alias("n"),
            "form",
            F.when(F.col("form") != "plain", cut["first"]).alias("prefix_chars"),
            F.when(F.col("form") != "plain", cut["second"] - cut["first"]).alias("middle_chars"),
            output.alias("output"),
        )
    )


def restored(output: Column, form: Column) -> Column:
    """The text from which an output of this form was made.

    The pieces hold no marker and every marker starts with `<`, so the first match of each is the marker itself.
    """

    def rest(from_: Column) -> Column:
        return F.substring(output, from_, F.length(output))

    def text(first_mark: str, psm: bool) -> Column:
        second = F.locate(first_mark, output, MARK + 1)
        third = F.call_function("locate", F.lit(MIDDLE), output, second + MARK)
        one = F.substring(output, F.lit(MARK + 1), second - (MARK + 1))
        two = F.substring(output, second + MARK, third - second - MARK)
        middle = rest(third + MARK)
        return F.concat(one, middle, two) if psm else F.concat(two, middle, one)

    return F.when(form == "plain", output).when(form == "psm", text(SUFFIX, True)).otherwise(text(PREFIX, False))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same result in DuckDB's SQL.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), r AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS prefix,
         CASE WHEN b > a THEN array_to_string(list_slice(units, a + 1, b), '') ELSE '' END AS middle,
         CASE WHEN n > b THEN array_to_string(list_slice(units, b + 1, n), '') ELSE '' END AS suffix
  FROM r
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(CASE WHEN a > 0 THEN prefix ELSE '' END) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || CASE WHEN a > 0 THEN prefix ELSE '' END || '<M>' || middle
                        ELSE '<P>' || CASE WHEN a > 0 THEN prefix ELSE '' END || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
