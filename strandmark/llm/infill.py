"""Operator 11: fill-in-the-middle. A text is cut at two places into prefix, middle and suffix, and put in another order.

Cuts are in code points, texts are UTF-8. The first bytes of the code points of a run of texts are a packed bitvector with a
directory of block popcounts (``succinct``). Popcounts give a text's number n of code points, and select on two ranks gives
the bytes at which it's cut, so no text is decoded and none is copied but into its output. The two ranks, the form and the share of texts left
plain follow from a hash of seed and id alone: rows may be dealt anyhow, and a lost task gives the same again.

    plain   the text
    psm     <P> prefix <S> suffix <M> middle
    spm     <S> suffix <P> prefix <M> middle

Texts that hold a mark stay plain, and a mark can't arise where pieces meet, so ``restored`` gets the exact text from output
and form.

Edge cases: null and empty texts are plain and empty, with n = 0; a cut may lie at either end of the text and both may be at
one place, pieces are empty then; a null id hashes as the empty string; rows that repeat get the same output each; rows of
an id with several texts are cut each by its own length; columns of the input with the names of new ones are replaced (the
case of names doesn't count), others stay; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import base, tokens
from .succinct import Bits, starts_of_points

MARKS = ("<P>", "<S>", "<M>")
#: Texts of a hundred left plain, and of a hundred others given suffix first.
PLAIN, SPM = 10, 20
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def form_of(text: Column, third: Column, fourth: Column, plain: int, spm: int, marks: tuple[str, str, str]) -> Column:
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains(text, F.lit(mark))
    return F.when((text == "") | marked | (third % 100 >= 100 - plain), "plain").when(fourth % 100 < spm, "spm").otherwise("psm")


def view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """(bytes of all texts in a row, where each begins and the last one's end, their buffer); no text may be null."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2] or pa.py_buffer(b"")
    return np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0], buffer.slice(offsets[0], offsets[-1] - offsets[0])


def cut(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """(n, code points of prefix, of middle, [prefix, middle, suffix]) of texts, by two draws a text."""
    data, at, buffer = view(texts)
    points = Bits(starts_of_points(data))
    ranks = points.rank(at)
    n = np.diff(ranks)
    a, b = first % (n + 1), second % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    ends = at[1:]
    # the rank after a text's last code point is the next text's first; where that isn't in this text, the cut is its end
    one, two = (np.where(k == n, ends, points.select(ranks[:-1] + k)) for k in (low, high))
    bounds = np.empty(3 * len(texts) + 1, np.int32)
    bounds[0:-1:3], bounds[1::3], bounds[2::3], bounds[-1] = at[:-1], one, two, at[-1]
    pieces = pa.StringArray.from_buffers(3 * len(texts), pa.py_buffer(bounds), buffer)
    return n, low, high - low, [pieces.take(pa.array(np.arange(k, 3 * len(texts), 3))) for k in range(3)]


def written_out(texts: pa.Array, form: pa.Array, pieces: list[pa.Array], marks: tuple[str, str, str]) -> pa.Array:
    p, s, m = marks
    prefix, middle, suffix = pieces
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    return pc.case_when(pc.make_struct(pc.equal(form, "psm"), pc.equal(form, "spm")), psm, spm, texts)


def transformed(docs: DataFrame, seed: int = 1, plain: int = PLAIN, spm: int = SPM, id_col: str = "doc_id", text_col: str = "text", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """docs with n, form, prefix_chars, middle_chars (null where plain) and output, which takes the place of the text."""
    if len(set(marks)) < 3 or not all(re.fullmatch(r"<[^<>]+>", m) for m in marks):
        raise ValueError(f"marks {marks}: three different ones, each in angle brackets and without such inside")
    if not (0 <= plain <= 100 and 0 <= spm <= 100):
        raise ValueError(f"shares of a hundred: {plain}, {spm}")
    rest = [c for c in docs.columns if c != text_col and c.lower() not in NEW]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h = draws(F.col(f"`{id_col}`"), seed)
    packed = docs.select(*[F.col(f"`{c}`") for c in rest], F.struct(text.alias("text"), h[0].alias("h1"), h[1].alias("h2"), form_of(text, h[2], h[3], plain, spm, marks).alias("form")).alias("_fim"))
    # plain names inside: a column's own may hold dots
    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(packed.schema.fields[:-1])])
    for name, kind in zip(NEW, (LongType(), StringType(), LongType(), LongType(), StringType())):
        schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.forget()
        for batch in batches:
            texts = batch.column(len(rest)).field("text")
            for a, b in tokens.slices(texts):
                part = batch.slice(a, b - a)
                own = part.column(len(rest))
                some, h1, h2, form = (own.field(k) for k in ("text", "h1", "h2", "form"))
                n, low, middle, pieces = cut(some, h1.to_numpy(), h2.to_numpy())
                none = pc.equal(form, "plain").to_numpy(zero_copy_only=False)
                counts = [pa.array(n), form, pa.array(low, mask=none), pa.array(middle, mask=none)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *counts, written_out(some, form, pieces, marks)], schema.names)

    return packed.toDF(*schema.names[: len(rest)], "_fim").mapInArrow(run, schema).toDF(*rest, *NEW)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again, from output and form only: no piece holds a mark, so the marks are where it's cut."""
    part = F.split(output, "|".join(map(re.escape, marks)), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = transformed(docs)
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
