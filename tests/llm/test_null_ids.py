"""Rows without an id stay in op9's result, uncut."""

from strandmark.llm import suffixes


def test_suffix_dedup_returns_rows_without_an_id(spark):
    text = "a passage that is long enough to be cut as a repeat of another document "
    docs = spark.createDataFrame([(1, text), (2, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.repeats(docs).collect())
    n = len(text)
    assert got == [(0, 0, 0, 0, b""), (0, n, 0, 0, text.encode()), (1, n, 0, 0, text.encode()), (2, n, n, 1, b"")]
    assert suffixes.without_repeats(docs).where("doc_id IS NULL AND text IS NULL").count() == 1
