"""The stored images go through the format's features, and the batch reader equals the single one."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest

from strandmark.llm import media, webp

SF = "/root/testdata/sf0.01"


def grey_images(made):
    return [webp.decode(x) for x in made]


def features(file):
    """What a file uses, read from its bits by the single-image decoder's own steps."""
    found = set()
    r = webp.Reader(webp.chunk(file))
    r.read(40)
    width, height = (int.from_bytes(webp.chunk(file)[1:5], "little") >> s & 0x3FFF for s in (0, 14))
    now = width + 1
    while r.read(1):
        kind = r.read(2)
        found.add(("predictor", "cross-colour", "subtract-green", "palette")[kind])
        if kind in (webp.PREDICTOR, webp.CROSS_COLOUR):
            bits = r.read(3) + 2
            webp.read_image(r, webp.cells(now, bits), webp.cells(height + 1, bits), False)
        elif kind == webp.PALETTE:
            n = r.read(8) + 1
            webp.read_image(r, n, 1, False)
            now = webp.cells(now, webp.pack_bits(n))
    if r.read(1):
        found.add("cache")
        cache = r.read(4)
    else:
        cache = 0
    assert not r.read(1)
    codes = [webp.read_prefix(r, n) for n in (280 + (1 << cache if cache else 0), 256, 256, 256, 40)]
    if any(codes[0].lengths[256:280]):
        found.add("references")
    return found


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables")
def test_registered_documents_use_the_formats_features():
    rows = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    payloads = [media.padded((t or "").encode()) for (t,) in rows]
    kept = media.to_media(payloads)
    counts = Counter(f for m in kept for x in webp.files(m) for f in features(x))
    assert counts["references"] > 900 and counts["cross-colour"] > 900 and counts["palette"] > 0
    assert [b"".join(x.tobytes() for x in i) for i in media.from_media(kept)] == payloads
    assert sum(map(len, kept)) < 0.55 * sum(map(len, payloads))
    some = [x for m in kept[::50] for x in webp.files(m)]
    assert all(np.array_equal(webp.decode(x)[..., 1:], y) for x, y in zip(some, webp.decode_many(some)))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="the driver's tables")
def test_every_transform_is_chosen_for_some_document():
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' ORDER BY doc_id").fetchall()
    payloads = [p[a : a + media.IMAGE_BYTES] for (t,) in rows for p in [media.padded((t or "").encode())] for a in range(0, len(p), media.IMAGE_BYTES)]
    counts = Counter()
    for k in range(0, len(payloads), 2000):
        sizes = np.array([len(p) for p in payloads[k : k + 2000]])
        counts.update(webp.chosen(np.frombuffer(b"".join(payloads[k : k + 2000]), np.uint8), np.cumsum(sizes) - sizes, sizes).tolist())
    # the colour cache is weighed as well, but no document is smaller by it
    assert all(counts[c] > 0 for c in (webp.DIRECT, webp.GREEN_ONLY, webp.ABOVE, webp.INDEXED))


def sample_payloads():
    rng = np.random.default_rng(5)
    walk = (np.cumsum(rng.integers(-1, 2, 64 * 60)) % 256).astype(np.uint8)
    stripes = np.tile(rng.integers(0, 256, 64), 1).astype(np.uint8)[None] + rng.integers(0, 3, (90, 64)).astype(np.uint8)
    return {
        "one sample": b"z" * 192, "two": b"ab" * 96, "sixteen": bytes(rng.integers(0, 16, 640).astype(np.uint8)), "seventeen": bytes(rng.integers(0, 17, 640).astype(np.uint8)), "left": walk.tobytes(), "above": stripes.tobytes(),
        "noise": rng.integers(0, 256, 8192).astype(np.uint8).tobytes(), "long run": b"q" * 8128 + b"r" * 64, "text": ("the quick brown fox " * 400).encode()[:7680],
    }


@pytest.mark.parametrize("choice", range(6))
def test_every_choice_is_read_alike_by_both_readers(monkeypatch, choice):
    payloads = [p for p in sample_payloads().values() if choice not in (webp.INDEXED, webp.CACHED) or len(set(p)) <= 16]
    monkeypatch.setattr(webp, "chosen", lambda flat, starts, sizes: np.full(len(sizes), choice))
    made = webp.encode_many(payloads)
    for p, one, many in zip(payloads, grey_images(made), webp.decode_many(made)):
        assert (one[..., 0] == 255).all() and np.array_equal(one[..., 1:], many) and media.samples(many).tobytes() == p


def test_choices_follow_the_samples():
    own = sample_payloads()
    flat = np.frombuffer(b"".join(own.values()), np.uint8)
    sizes = np.array([len(p) for p in own.values()])
    got = dict(zip(own, webp.chosen(flat, np.cumsum(sizes) - sizes, sizes).tolist()))
    assert got["one sample"] == webp.DIRECT and got["left"] == webp.LEFT and got["above"] == webp.ABOVE and got["noise"] == webp.GREEN_ONLY and got["sixteen"] in (webp.INDEXED, webp.GREEN_ONLY)


def test_uniform_predictors_equal_the_general_rule():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (7, 12, 4)).astype(np.uint8)
    for mode in (1, 2):
        mixed = np.full((2, 3), mode)
        rest = webp.predictor(image, mixed, 2, True)
        assert np.array_equal(webp.predictor(rest, mixed, 2, False), image)


def test_damage_is_an_error():
    made = webp.encode_many([sample_payloads()["text"], sample_payloads()["noise"]])
    for cut in (30, 60, len(made[0]) - 20):
        with pytest.raises(ValueError):
            webp.decode_many([made[1], webp.riff(webp.chunk(made[0])[: cut - 20])])
    with pytest.raises(ValueError):
        media.samples(np.arange(12, dtype=np.uint8).reshape(2, 2, 3))


def test_digests_of_a_known_text(spark):
    text = "the same words, the same words, the same words again"
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in media.read_back(media.stored(docs.selectExpr("doc_id", "encode(text, 'UTF-8') payload"), "payload")).collect()}
    payload = text.encode() + b" " * (192 - len(text))
    stored = media.to_media([payload])[0]
    assert (got[1].media_bytes, got[1].media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()) and got[2].media_sha256 == got[1].media_sha256
    rows = [payload[k : k + 64] for k in range(0, 192, 64)]
    steps = sum(abs(a - b) for x in rows for a, b in zip(x, x[1:]))
    assert got[1].feature == f"64x3;mean256={sum(payload) * 256 // 192};max={max(payload)};step256={steps * 256 // (3 * 63)}"
    assert got[3].feature == "64x3;mean256=8192;max=32;step256=0"
