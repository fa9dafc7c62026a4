from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialguard.llm import fill_in_middle as fim


def _want(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def _texts():
    rng = random.Random(9)
    alphabet = "abcXYZ 019 \n\t.,éß🎉中́<>PSM\x00"
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)]
    long = ["1234567890" * 20_000, "ab " * 70_000, "word" * 60_000, "a1" * 50_000 + "é" * 70_000 + "x y" * 30_000]
    return [None, "", "a", "é", "<P>", "x <S> y", "<", "<P", "a<P >", *made, *long, "".join(rng.choices(alphabet, k=300_000))]


def test_outputs_match_brute_force_and_can_be_taken_apart(spark):
    rows = [(i, t, "n", 1) for i, t in enumerate(_texts())]
    rows += [(None, "an id that is null, 12 times", "x", 2), rows[20], rows[20], (20, "one id, another text", "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, N int").repartition(5)
    made = fim.fill_in_middle(df)
    assert made.columns == ["doc_id", "text", "output", "N", "n_", "form", "prefix_chars", "middle_chars", "output_"]
    forms = set()
    got = made.withColumn("again", fim.restore(F.col("output_"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_, r.form, r.prefix_chars, r.middle_chars, r.output_) == _want(r.doc_id, r.text), r.doc_id
        assert r.again == (r.text or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


SETS = {
    "few": lambda rng: np.unique(rng.integers(0, 400_000, 500)),
    "bits": lambda rng: np.unique(rng.integers(0, 300_000, 150_000)),
    "runs": lambda rng: np.flatnonzero(np.repeat(rng.integers(0, 2, 300), 1000)),
    "all": lambda rng: np.arange(200_001),
    "one": lambda rng: np.array([0]),
    "far": lambda rng: np.array([0, 65_535, 65_536, 131_071, 1 << 33]),
    "mixed": lambda rng: np.concatenate([np.arange(70_000), np.unique(rng.integers(70_000, 140_000, 30_000)), [900_000, 900_002]]),
}


@pytest.mark.parametrize("kind", SETS)
def test_select_gives_every_offset(kind):
    offsets = SETS[kind](np.random.default_rng(2))
    marks = fim.BoundarySet(offsets)
    assert len(marks) == len(offsets)
    ranks = range(len(offsets)) if len(offsets) < 5000 else [*range(0, len(offsets), 37), len(offsets) - 1]
    assert [marks.select(k) for k in ranks] == [int(offsets[k]) for k in ranks]


def test_each_container_is_used_where_it_is_smallest():
    kinds = {k: {type(c).__name__ for c in fim.BoundarySet(f(np.random.default_rng(2))).containers} for k, f in SETS.items()}
    assert kinds["few"] == {"_Array"} and kinds["bits"] == {"_Bitmap"} and kinds["runs"] == {"_Runs"}
    assert kinds["mixed"] == {"_Runs", "_Bitmap", "_Array"}


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
