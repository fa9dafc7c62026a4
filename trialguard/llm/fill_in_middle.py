"""Fill-in-middle transformation with Roaring-style boundary sets.

A text falls into units: runs of ASCII letters, and every other code point. The offsets where units start, with the
end of the text, are kept in a ``BoundarySet``, so "the offset after so many units" is a select: a search in the
cumulative cardinalities finds the container of 2**16 offsets, and a select inside the container the offset. Two hashes
of the document's id choose the numbers of units of prefix and of prefix with middle; both offsets come from the set.

Tasks hand only the text and the two hashes to Python, in Arrow batches, and get both offsets back; hashes, forms and
the output are Spark expressions. Each row stands for itself, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import fresh

#: The marks of the output, the share of texts that stay plain and of suffix-first forms, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Offsets of a container, and the most that an array container holds.
SPAN, ARRAY_MOST = 1 << 16, 4096


class _Array:
    """Sorted offsets as they are: for few of them."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class _Runs:
    """First offset and cumulative length of each run: for offsets in long rows."""

    def __init__(self, low: np.ndarray, breaks: np.ndarray):
        self.first = low[np.concatenate(([0], breaks))].astype(np.uint16)
        self.until = np.append(breaks, len(low))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.until, k, side="right"))
        return int(self.first[run]) + k - (int(self.until[run - 1]) if run else 0)


class _Bitmap:
    """A bit for each offset, and the number of bits up to each word: for many offsets in no order."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.until = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.until, k, side="right"))
        inside = k - (int(self.until[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[inside])


def _container(low: np.ndarray) -> _Array | _Runs | _Bitmap:
    """The smallest form of a container: two bytes an offset, four a run, or 8,192 for all bits."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    runs = 2 + 4 * (len(breaks) + 1)
    if runs < min(2 * len(low), SPAN // 8):
        return _Runs(low, breaks)
    return _Array(low) if len(low) <= ARRAY_MOST else _Bitmap(low)


class BoundarySet:
    """A set of rising offsets that answers which one is the ``k``-th."""

    def __init__(self, offsets: np.ndarray):
        high = offsets // SPAN
        cuts = np.flatnonzero(np.diff(high)) + 1
        self.bases = high[np.concatenate(([0], cuts))] * SPAN if len(offsets) else high
        self.containers = [_container(part % SPAN) for part in np.split(offsets, cuts)] if len(offsets) else []
        self.until = np.append(cuts, len(offsets))

    def __len__(self) -> int:
        return int(self.until[-1])

    def select(self, k: int) -> int:
        """The offset with ``k`` smaller ones."""
        at = int(np.searchsorted(self.until, k, side="right"))
        return int(self.bases[at]) + self.containers[at].select(k - (int(self.until[at - 1]) if at else 0))


def boundaries(text: str) -> BoundarySet:
    """Where the units of ``text`` start, and its end, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = (codes | 32) - np.uint32(97) < 26  # unsigned: what comes before "a" wraps around
    starts = ~letter
    starts[:1] = True
    starts[1:] |= ~letter[:-1]
    return BoundarySet(np.append(np.flatnonzero(starts), len(codes)))


_CUTS = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Units of each text, and its two cut offsets by two hashes."""
    for texts, ones, others in batches:
        out = []
        for text, one, other in zip(texts, ones.to_pylist(), others.to_pylist(), strict=True):
            marks = boundaries(text.as_py())
            low, high = sorted((one % len(marks), other % len(marks)))
            out.append((len(marks) - 1, marks.select(low), marks.select(high)))
        n, first, second = zip(*out, strict=True) if out else ((), (), ())
        yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, first, second)], fields=list(_CUTS))


def _hashes(id_: Column, seed: str) -> list[Column]:
    """Four unsigned numbers of 32 bits from the document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1") -> DataFrame:
    """All columns of ``docs`` and ``n, form, prefix_chars, middle_chars, output`` (with ``_`` added to names taken).

    ``n`` counts the units of the text; ``form`` is plain (the output is the text), psm or spm, with the lengths of
    prefix and middle in code points, null if plain. A null text is empty and so plain; a null id counts as an empty
    id; rows with one id are cut by the same hashes, each in its own text. A text that holds a mark stays plain, so
    every output can be taken apart again (``restore``). An empty table gives no rows.
    """
    cuts = F.arrow_udf(_cuts, "n bigint, first bigint, second bigint")
    added = ("text", "h3", "h4", "cuts", "n", "form", "prefix_chars", "middle_chars", "output")
    names = {name: fresh(docs, name) for name in added}
    column = {k: F.col(f"`{v}`") for k, v in names.items()}
    h1, h2, h3, h4 = _hashes(F.col(id_col), seed)
    full = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        "*", full.alias(names["text"]), (h3 % 100).alias(names["h3"]), (h4 % 100).alias(names["h4"]),
        cuts(full, h1, h2).alias(names["cuts"]),
    )
    text, first, second = column["text"], column["cuts"]["first"], column["cuts"]["second"]
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | (column["h3"] >= PLAIN_FROM), "plain").when(column["h4"] < SPM_BELOW, "spm")
    shaped = cut.withColumn(names["form"], form.otherwise("psm"))
    plain = column["form"] == "plain"
    prefix = F.substring(text, F.lit(1), first.cast("int"))
    middle = F.substring(text, (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring(text, (second + 1).cast("int"), F.length(text))
    output = (
        F.when(plain, text)
        .when(column["form"] == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return shaped.select(
        *(F.col(f"`{c}`") for c in docs.columns), column["cuts"]["n"].alias(names["n"]), column["form"],
        F.when(~plain, first).alias(names["prefix_chars"]), F.when(~plain, second - first).alias(names["middle_chars"]),
        output.alias(names["output"]),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )


SQL = """
WITH cut AS (
  SELECT *, h1 % (n + 1) AS one, h2 % (n + 1) AS other FROM (
    SELECT doc_id, text, units, len(units) AS n,
      ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
      ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
    FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
      sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents))),
parts AS (
  SELECT doc_id, n, text,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(one, other)], '') AS prefix,
    array_to_string(units[least(one, other) + 1:greatest(one, other)], '') AS middle,
    array_to_string(units[greatest(one, other) + 1:], '') AS suffix
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
