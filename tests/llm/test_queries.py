"""The registered queries themselves on a small folder: columns, types and values against brute force, with null and repeated
ids, empty texts, and empty tables."""

import functools
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import test_secrets
import xxhash
from pyspark.sql import functions as F
from test_operators import TEXTS, brute_cut, closure, sentence

import corpus_pipeline
from strandmark.llm import lines, media, registry, sentences, suffixes, tokens, webp

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TYPES = {
    "op1_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op2_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op3_media_columns": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op4_sentencepiece": "doc_id bigint, n_ids bigint, ids_crc32 bigint, decoded_sha256 string",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_nearest_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op10_token_records": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op12_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_fill_in_middle": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
}


@functools.cache
def rows():
    out = [(3 * k, t, ["en", "de", None][k % 3], "s", len(t or "")) for k, t in enumerate(TEXTS)]
    out += [(500 + k, f"{sentence(6)}\nThe same line\n{sentence(4)}", "en", "s", 1) for k in range(14)]
    out += [(600, sentence(9000), "de", "s", 1), (601, "você " * 40, "pt", None, None)]
    return out


def odd_rows():
    """Rows without an id, and ids of several rows."""
    return [(None, TEXTS[7], "en", "s", 1), (None, None, None, None, None), (None, TEXTS[7], "en", "s", 1), (21, TEXTS[8], "en", "s", 1), (21, TEXTS[7], "en", "s", 1), (500, "another text of an id", "de", "s", 2)]


def put(spark, folder, documents, vectors=None):
    spark.createDataFrame(documents, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 16)) if vectors is None else vectors
    spark.createDataFrame([(k, v.tolist(), "l") for k, v in enumerate(x)], "vec_id long, embedding array<double>, label string").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(r[0], 1, int((r[0] or 0) % 5 == 0)) for r in documents], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    return put(spark, tmp_path_factory.mktemp("plain"), rows())


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return put(spark, tmp_path_factory.mktemp("odd"), rows() + odd_rows())


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return put(spark, tmp_path_factory.mktemp("empty"), [], np.zeros((0, 16)))


def got(spark, name, folder):
    df = registry.QUERIES[name](spark, folder)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields) == TYPES[name]
    return df.collect()


def ids_of(name, drops):
    tool = tokens.Encoder(public_tokenizers.path(name), drops).library
    return lambda t: tool.encode(t, add_special_tokens=False).ids if t else []


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def check_packing(found, texts):
    ids, want = ids_of("word_bpe_49k.json", True), []
    for i, t in texts:
        own = ids(t) + [1]
        want += [(i, k, s, len(own[s : s + 4096]), crc(own[s : s + 4096])) for k, s in enumerate(range(0, len(own), 4096))]
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:5] for r in found], key=key) == sorted(want, key=key)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    # first fit on falling lengths, which best-two-fit isn't to be worse than
    room = []
    for n in sorted((w[3] for w in want), reverse=True):
        k = next((k for k, x in enumerate(room) if x >= n), None)
        if k is None:
            room.append(4096 - n)
        else:
            room[k] -= n
    assert len(bins) <= len(room)


def check_lines(found, texts):
    fold = str.maketrans(lines.UPPER, lines.UPPER.lower())
    cut = [(i, [(x, x.strip(lines.BLANKS).translate(fold)) for x in (t or "").split("\n")]) for i, t in texts]
    holders = {}
    for i, own in cut:
        for _, k in own:
            holders.setdefault(k, set()).update([i] if i is not None else [])
    common = {k for k, who in holders.items() if k and len(who) >= 10}
    want = []
    for i, own in cut:
        gone = common if i is not None else set()
        want.append((i, len(own), sum(k in gone for _, k in own), sha("\n".join(x for x, k in own if k not in gone))))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def check_media(found, texts):
    want = []
    for i, t in texts:
        raw = (t or "").encode()
        payload = media.padded(raw)
        stored = media.to_media([payload])[0]
        pixels = np.concatenate([webp.decode(x)[..., 1:] for x in webp.files(stored)])
        assert pixels.shape[1:] == (64, 3) and (pixels[..., 0] == pixels[..., 2]).all() and pixels[..., 1].tobytes() == payload
        grey = pixels[..., 0].astype(int)
        feature = f"64x{len(grey)};mean256={grey.sum() * 256 // grey.size};max={grey.max()};step256={abs(np.diff(grey, axis=1)).sum() * 256 // (len(grey) * 63)}"
        want.append((i, len(raw), len(payload), sha(payload), zlib.crc32(payload[-16:]), len(stored), sha(stored), feature))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def check_sentences(found, texts):
    tool = sentences.Encoder(public_tokenizers.path("piece_bpe_32k.model"), 0.1, 13)
    want = []
    for i, t in texts:
        ids, _ = tool.encode(sentences.pa.array([t or ""]), np.array([tool.salt(i)], np.uint64))
        want.append((i, len(ids), crc(ids), sha(t or "")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def check_scores(found, texts, remainder, modulus):
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in texts)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) and 0 <= r.score <= 1 for r in found)


def check_toxic(found, texts):
    check_scores(found, texts, 2, 4)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)


def check_languages(found, texts):
    check_scores(found, texts, 1, 3)
    letters = {i: bool(re.search(r"[^\W\d_]", t or "")) for i, t in texts}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) for r in found if [i for i, _ in texts].count(r.doc_id) == 1)
    assert {r.lang_pred for r in found} <= {"und", "en", "de", "pt"}


def check_simhash(found, texts):
    fold = str.maketrans(lines.UPPER, lines.UPPER.lower())
    marks = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        marks.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    roots = closure(len(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2)
    least = {}
    for (i, _), r in zip(texts, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, f"{m:016x}", least.get(r)) for (i, _), m, r in zip(texts, marks, roots)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def check_suffixes(found, texts):
    if len({i for i, _ in texts}) == len(texts):
        cut = brute_cut({i: t or "" for i, t in texts}, suffixes.LENGTH)
        assert sorted(map(tuple, found)) == sorted((i, n, m, s, sha(kept)) for i, (n, m, s, kept) in cut.items())
    else:
        assert sorted(str((r.doc_id, r.n_bytes)) for r in found) == sorted(str((i, len((t or "").encode()))) for i, t in texts)
        assert all(r.n_removed == 0 for r in found if r.doc_id is None)


def check_records(found, texts):
    ids, at = ids_of("byte_bpe_50k.json", False), 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in found) == sorted(str((i, len(ids(t)) + 1, crc(ids(t) + [0]))) for i, t in texts)


CHECKS = {
    "op1_best_fit_packing": check_packing, "op2_line_dedup": check_lines, "op3_media_columns": check_media, "op4_sentencepiece": check_sentences, "op5_toxicity": check_toxic, "op6_language_id": check_languages,
    "op8_simhash": check_simhash, "op9_suffix_dedup": check_suffixes, "op10_token_records": check_records, "op12_secret_scan": test_secrets.check,
}


@pytest.mark.parametrize("name", CHECKS)
def test_query(spark, plain, name):
    CHECKS[name](got(spark, name, plain), [r[:2] for r in rows()])


@pytest.mark.parametrize("name", CHECKS)
def test_query_on_null_and_repeated_ids(spark, odd, name):
    CHECKS[name](got(spark, name, odd), [r[:2] for r in rows() + odd_rows()])


@pytest.mark.parametrize("name", TYPES)
def test_query_on_empty_tables(spark, empty, name):
    assert got(spark, name, empty) == []


def test_neighbours_query(spark, plain):
    x = np.random.default_rng(1).standard_normal((900, 16))
    found = got(spark, "op7_nearest_neighbours", plain)
    hits = 0
    for q in range(0, 900, 100):
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert [r.rank for r in own] == list(range(1, 11)) and np.allclose([r.score for r in own], [d[r.vec_id] for r in own], rtol=1e-12, atol=0)
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {r.vec_id for r in own})
    assert hits >= 85


def test_sql_is_registered_for_what_it_can_express():
    assert set(registry.QUERIES) == set(TYPES) and set(registry.ORACLE_SQL) <= set(TYPES)


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_query_equals_its_sql(spark, plain, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{plain}/{table}.parquet/*.parquet'")
    columns = [f.split()[0] for f in TYPES[name].split(", ")]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got(spark, name, plain))) == sorted(want)


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    now = spark.read.parquet(f"{odd}/documents.parquet")
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, odd)
        assert now.columns == columns, name
        now = spark.createDataFrame(now.collect(), now.schema)
    kept = {r.doc_id for r in now.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, now, odd).collect()
    assert {r.doc_id for r in packed} == kept and None in kept
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert corpus_pipeline.run(spark, odd).where(F.col("piece") == 0).count() >= 30
