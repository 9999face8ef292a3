"""Rank and select against counting, fill-in-the-middle against slices of strings, and its inverse."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_operators import TEXTS

from strandmark.llm import infill
from strandmark.llm.succinct import Bits, starts_of_points


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400), st.integers(0, 2))
def test_rank_and_select(data, kind):
    flags = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
    flags = [flags, np.zeros_like(flags), np.ones_like(flags)][kind]
    bits = Bits(flags)
    at = np.arange(len(flags) + 1)
    assert bits.rank(at).tolist() == np.concatenate(([0], np.cumsum(flags))).tolist()
    assert bits.total == flags.sum()
    assert bits.select(np.arange(bits.total + 1)).tolist() == [*np.flatnonzero(flags).tolist(), len(flags)]


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=300))
def test_points(text):
    data = np.frombuffer(text.encode("utf-8", "ignore"), np.uint8)
    assert Bits(starts_of_points(data)).total == len(data.tobytes().decode())


def brute(doc_id, text, seed=1):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if not t or any(x in t for x in infill.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ODD = ["", None, "é", "<P>", "a<S>b", "<M", "M>x<", "<<PP>>", "<P<S<M", "S>\n\r\0P>", "\U0001f600́ " * 50, "x" * 70_000, "ß€\U00010348a" * 4000, "\n", "<" * 90]


def test_against_slices(spark):
    rows = [(k, t, "kept", "old") for k, t in enumerate(ODD * 12 + TEXTS)] + [(None, "no id é", None, None), (3, "another text of an id", None, None), (3, "another text of an id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, Form string").repartition(3)
    out = infill.transformed(df)
    assert out.columns == ["doc_id", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r["a.b"], r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in got], key=key) == sorted([(r[0], r[2], *brute(*r[:2]), r[1] or "") for r in rows], key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_parameters(spark):
    df = spark.createDataFrame([(k, "abc déf") for k in range(40)], "k long, body string")
    marks = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
    out = infill.transformed(df, seed=7, plain=0, spm=100, id_col="k", text_col="body", marks=marks)
    got = out.withColumn("again", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    assert {r.form for r in got} == {"spm"} and {r.again for r in got} == {"abc déf"}
    assert {r.form for r in infill.transformed(df, plain=100, id_col="k", text_col="body").collect()} == {"plain"}
    assert infill.transformed(df.limit(0), id_col="k", text_col="body").collect() == []
    for wrong in ({"marks": ("<P>", "<P>", "<M>")}, {"marks": ("P", "<S>", "<M>")}, {"plain": 101}):
        with pytest.raises(ValueError):
            infill.transformed(df, id_col="k", text_col="body", **wrong)


def test_text_of_many_megabytes(spark):
    """One row beside short ones."""
    df = spark.range(1).select("id", F.repeat(F.lit("né€ "), 2_000_000).alias("text")).union(spark.createDataFrame([(1, "kurz")], "id long, text string"))
    out = infill.transformed(df, id_col="id")
    got = {r.id: r for r in out.select("id", "n", (F.sha2("output", 256)).alias("o"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("again")).collect()}
    long = "né€ " * 2_000_000
    assert got[0].n == 8_000_000 and got[0].again == hashlib.sha256(long.encode()).hexdigest() and got[0].o == hashlib.sha256(brute(0, long)[4].encode()).hexdigest()
