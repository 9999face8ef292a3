"""Every operator against brute force or an exact round trip, with nulls, empty and long texts, ties, repeats, empty
tables and columns of clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strandmark.llm import base, langid, lines, media, neighbours, packing, records, sentences, simhash, suffixes, tokens, toxicity, webp

SCHEMA = "doc_id long, text string, id string, key string, n_bytes int"
RNG = random.Random(11)
WORDS = ["the", "of", "thanea", "ernt", "idiot", "Straße", "élan", "ñandú", "x,", "end.", "don't", "日本", "A"]


def sentence(n):
    return " ".join(RNG.choice(WORDS) + str(RNG.randrange(40)) for _ in range(n))


PASSAGE = sentence(30)
TEXTS = [
    None, "", " ", "\n", "one", "One ", "\tONE\n\none", sentence(120), sentence(400), "a  b \n c\t\r\n", "%%% " * 30, "aaaa" * 60, "x <|endoftext|> y\x00\x01 , .", "▁ real ▁x",
    PASSAGE, PASSAGE + " tail " + sentence(20), sentence(20) + PASSAGE, sentence(9) + " " + PASSAGE[10:120], "日本語テキスト " * 20,
]
TEXTS += [TEXTS[7], TEXTS[7] + " more", TEXTS[8].replace("the1", "the2", 1), "common line\n" + sentence(5), " Common LINE \n" + sentence(6), sentence(3) + "\ncommon line", sentence(4000)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(3 * k + 1, t, f"i{k}", "k", k) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def texts_by_id():
    return {3 * k + 1: t or "" for k, t in enumerate(TEXTS)}


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_encoder_equals_the_library(name, drops):
    tool = tokens.Encoder(public_tokenizers.path(name), drops)
    odd = ["foo!, bar", "a, b. c, ", "x., y", "foo , bar", ", a", "\x01 a", "a \n b", "\n\nx y ", "é é x", "İ ΣΑΣ Σ", "ﬁ ＡＢ", "word.\n Next", "don't they're"]
    for part in (TEXTS, odd, odd + TEXTS):
        ids, at = tool.encode(part)
        for k, t in enumerate(part):
            assert ids[at[k] : at[k + 1]].tolist() == (tool.library.encode(t, add_special_tokens=False).ids if t else []), t
    tokens.CACHE_PIECES, kept = 40, tokens.CACHE_PIECES
    try:
        for part in (TEXTS, odd, TEXTS):
            ids, at = tool.encode(part)
        assert ids[at[7] : at[8]].tolist() == tool.library.encode(TEXTS[7], add_special_tokens=False).ids
    finally:
        tokens.CACHE_PIECES = kept


def brute_plan_is_whole(counts, capacity):
    left = dict(counts)
    for times, lengths in packing.plan(counts, capacity):
        assert times > 0 and sum(lengths) <= capacity
        for x in lengths:
            left[x] -= times
    assert not any(left.values())


def fewest_bins(lengths, capacity):
    best = len(lengths)

    def place(k, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if k == len(lengths):
            best = len(gaps)
            return
        for g in {g for g in gaps if g >= lengths[k]}:
            rest = list(gaps)
            rest.remove(g)
            place(k + 1, [*rest, g - lengths[k]])
        place(k + 1, [*gaps, capacity - lengths[k]])

    place(0, [])
    return best


def test_packing_plan():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randrange(4, 40)
        brute_plan_is_whole({rng.randrange(1, capacity + 1): rng.randrange(1, 50) for _ in range(rng.randrange(0, 12))}, capacity)
    # 6 + 3 leaves 1; the best two for the gap of 4 left by 3 are 2 + 2
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])
    for _ in range(40):  # against the best packing there is
        counts = {rng.randrange(1, 11): rng.randrange(1, 3) for _ in range(4)}
        lengths = sorted((n for n, k in counts.items() for _ in range(k)), reverse=True)
        assert sum(t for t, _ in packing.plan(counts, 10)) <= fewest_bins(lengths, 10) + 1
    bins = packing.plan({n: 1000 for n in range(1, 101)}, 100)
    assert sum(t for t, _ in bins) <= 1.002 * sum(n * 1000 for n in range(1, 101)) / 100


def test_packing(spark, docs, none):
    got = packing.pack(docs, 64, "word_bpe_49k.json", True, 1, with_ids=True).collect()
    tool = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), True).library
    whole = {}
    for r in sorted(got, key=lambda r: (r.id, r.piece)):
        assert r.start == 64 * r.piece and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        whole.setdefault(r.id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert whole == {i: (tool.encode(t, add_special_tokens=False).ids if t else []) + [1] for i, t in texts_by_id().items()}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 64
    assert packing.pack(none, 64, "word_bpe_49k.json", True, 1).count() == 0


def brute_lines(min_docs, policy):
    keyed, n, first = {}, {}, {}
    fold = str.maketrans(lines.UPPER, lines.UPPER.lower())
    for i, t in sorted(texts_by_id().items()):
        keyed[i] = [(x, x.strip(lines.BLANKS).translate(fold)) for x in t.split("\n")]
        for p, (_, k) in enumerate(keyed[i]):
            n.setdefault(k, set()).add(i)
            first.setdefault(k, (i, p))
    out = {}
    for i, rows in keyed.items():
        gone = [bool(k) and len(n[k]) >= min_docs and (policy == "every" or first[k] != (i, p)) for p, (_, k) in enumerate(rows)]
        out[i] = (len(rows), sum(gone), "\n".join(x for (x, _), g in zip(rows, gone) if not g))
    return out


@pytest.mark.parametrize("policy", ["every", "repeats"])
def test_line_dedup(docs, none, policy):
    got = lines.dedup_lines(docs, 2, policy=policy)
    assert got.columns == [*SCHEMA.replace(",", "").split()[::2], "n_lines", "n_dropped"]
    assert {i: (r.n_lines, r.n_dropped, r.text) for i, r in by_id(got).items()} == brute_lines(2, policy)
    assert lines.dedup_lines(none, 2).count() == 0
    with pytest.raises(ValueError):
        lines.dedup_lines(docs, 2, policy="other")


def random_image(rng, h, w, colours=None):
    image = rng.integers(0, 6, (h, w, 4)).astype(np.uint8) * 40
    return image if colours is None else rng.integers(0, 256, (colours, 4)).astype(np.uint8)[rng.integers(0, colours, (h, w))]


@pytest.mark.parametrize("options", ["plain", "references", "cache", "green", "predictor", "cross", "all"])
def test_webp_transforms(options):
    rng = np.random.default_rng(4)
    image = random_image(rng, 21, 35)
    modes, factors = rng.integers(0, 14, (6, 9)), rng.integers(0, 256, (6, 9, 4)).astype(np.uint8)
    kw = {
        "plain": {"references": False}, "references": {}, "cache": {"cache_bits": 6}, "green": {"subtract_green": True}, "predictor": {"predictor_modes": modes}, "cross": {"factors": factors},
        "all": {"subtract_green": True, "predictor_modes": modes, "factors": factors, "cache_bits": 3},
    }[options]
    assert np.array_equal(webp.decode(webp.encode(image, **kw)), image)


@pytest.mark.parametrize("colours", [1, 2, 3, 16, 17, 256])
def test_webp_palettes(colours):
    image = random_image(np.random.default_rng(colours), 9, 13, colours)
    assert np.array_equal(webp.decode(webp.encode(image, palette=True)), image)


def test_webp_fast_lane_and_faults():
    rng = np.random.default_rng(9)
    payloads = [b" " * 192, bytes(range(192)), rng.integers(0, 256, 19200).astype(np.uint8).tobytes(), b"ab " * 640]
    grey = [np.repeat(np.frombuffer(p, np.uint8), 3).tobytes() for p in payloads]
    made = webp.encode_many(payloads)
    assert [x.tobytes() for x in webp.decode_many(made)] == grey
    assert [webp.decode(x)[..., 1:].tobytes() for x in made] == grey
    other = random_image(rng, 5, 6)
    assert np.array_equal(webp.decode_many([made[0], webp.encode(other)])[1], other[..., 1:])
    for bad in (b"RIFF", made[1][:-12], b"x" * 64):
        with pytest.raises(ValueError):
            webp.decode(bad)


def test_media_columns(docs, none, monkeypatch):
    rows = docs.withColumn("payload", F.encode("text", "UTF-8"))
    kept = media.stored(rows, "payload")
    got = by_id(media.read_back(kept))
    for i, t in texts_by_id().items():
        raw = t.encode()
        want = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-16:]))
    assert got[1 + 3 * 7].media_sha256 == got[1 + 3 * TEXTS.index(TEXTS[7], 8)].media_sha256
    assert {r.width for r in media.pixels(kept).collect()} == {64}
    assert media.read_back(media.stored(none.withColumn("payload", F.encode("text", "UTF-8")), "payload")).count() == 0
    monkeypatch.setattr(media, "IMAGE_BYTES", 192 * 3)
    long = [b"x" * 192 * 8, b"y" * 192]
    assert [b"".join(x.tobytes() for x in i) for i in media.from_media(media.to_media(long))] == long


def test_sentencepiece_without_dropout_equals_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, tool = sentencepiece.SentencePieceProcessor(model_file=path), sentences.Encoder(path, 0.0, 1)
    plain = [t for t in TEXTS if sentences.BLANK not in (t or "")]
    ids, at = tool.encode(pa.array(plain, pa.string()), 0)
    for t, a, b in zip(plain, at, at[1:]):
        assert ids[a:b].tolist() == (model.encode(t) if t else []), t


def test_sentencepiece_dropout(docs, none):
    one = by_id(sentences.encoded(docs, "piece_bpe_32k.model", 0.3, 5))
    same, other = by_id(sentences.encoded(docs, "piece_bpe_32k.model", 0.3, 5)), by_id(sentences.encoded(docs, "piece_bpe_32k.model", 0.3, 6))
    assert all(one[i].ids == same[i].ids for i in one) and any(one[i].ids != other[i].ids for i in one)
    back = sentences.decoded(sentences.encoded(docs, "piece_bpe_32k.model", 0.3, 5), "piece_bpe_32k.model")
    assert {i: r.text for i, r in by_id(back).items()} == texts_by_id()
    assert sentences.encoded(none, "piece_bpe_32k.model", 0.3, 5).count() == 0


def test_records(spark, docs, none, tmp_path):
    folder = str(tmp_path / "data")
    records.write_records(docs, folder, "byte_bpe_50k.json", False, 0, files=3)
    records.write_index(records.read_records(spark, folder), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    library, start = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), False).library, 0
    for r in index.orderBy("key").collect():
        ids = library.encode(texts_by_id()[r.key], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_ids, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert index.count() == len(TEXTS)
    some = records.read_at(spark, folder, index.where("key % 2 = 0")).collect()
    assert {r.key for r in some} == {i for i in texts_by_id() if i % 2 == 0}
    records.write_records(none, str(tmp_path / "none"), "byte_bpe_50k.json", False, 0)
    # a file that isn't named isn't opened: what's in the others may be anything
    first = index.where("file = 0").orderBy("key").limit(2)
    for place in (tmp_path / "data").glob("part-*"):
        if not place.name.startswith("part-00000"):
            place.write_bytes(b"damaged")
            (tmp_path / "data" / f".{place.name}.crc").unlink(missing_ok=True)
    assert {r.key for r in records.read_at(spark, folder, first).collect()} == {r.key for r in first.collect()}
    with pytest.raises(Exception, match="length of the frame"):
        records.read_at(spark, folder, index).collect()
    assert records.read_at(spark, folder, index.where("key < 0")).count() == 0
    records.write_records(docs, str(tmp_path / "rolled"), "byte_bpe_50k.json", False, 0)
    assert spark.read.format("binaryFile").load(str(tmp_path / "rolled")).count() >= 2


def test_records_without_a_key_and_of_one_key(spark, tmp_path):
    rows = [(None, "b"), (5, "x y"), (None, None), (5, "x y"), (5, "z"), (-7, "first"), (1 << 62, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = str(tmp_path / "data")
    records.write_records(docs, folder, "byte_bpe_50k.json", False, 0, files=4)
    got = records.with_starts(records.read_records(spark, folder)).orderBy("start").collect()
    assert [r.key for r in got] == [None, None, -7, 5, 5, 5, 1 << 62]
    ends = [0, *np.cumsum([r.n_ids for r in got]).tolist()]
    assert [r.start for r in got] == ends[:-1]
    library = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), False).library
    texts = sorted(str(library.encode(t or "", add_special_tokens=False).ids + [0]) for _, t in rows)
    assert sorted(str(np.frombuffer(r.ids, "<u4").tolist()) for r in got) == texts
    assert {r.key for r in records.read_at(spark, folder, records.read_records(spark, folder).where("key IS NULL")).collect()} == {None}


def test_frames_tell_damage():
    content = b"".join(records.frame(p) + b"\n" for p in (b"", b"abc\n", bytes(300)))
    assert [p for _, p in records.parse(content)] == [b"", b"abc\n", bytes(300)] and records.frame_at(content, 17) == b"abc\n"
    for k in (0, 9, 20, len(content) - 3):
        with pytest.raises(ValueError):
            list(records.parse(content[:k] + bytes([content[k] ^ 1]) + content[k + 1 :]))
    with pytest.raises(ValueError):
        list(records.parse(content[:-4]))


def brute_fingerprint(text, width):
    fold = str.maketrans(lines.UPPER, lines.UPPER.lower())
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    shingles = [" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [find(k) for k in range(n)]


def test_simhash(spark, docs, none):
    got = by_id(simhash.components(docs), "id")
    marks = {i: brute_fingerprint(t, 3) for i, t in texts_by_id().items()}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == marks
    ids = sorted(marks)
    roots = closure(len(ids), lambda a, b: (marks[ids[a]] ^ marks[ids[b]]).bit_count() <= 2)
    assert [got[i].component_id for i in ids] == [ids[r] for r in roots]
    assert simhash.components(none).count() == 0


def test_simhash_links(spark):
    rng = random.Random(8)
    marks = [rng.getrandbits(64) for _ in range(30)]
    for m in list(marks):
        for _ in range(4):
            m ^= 1 << rng.randrange(64)
            marks.append(m)
    marks = sorted(set(marks))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    got = base.connected_components(simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long")))
    roots = {r.node: r.root for r in got.collect()}
    want = closure(len(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2)
    groups = {}
    for m, w in zip(signed, want):
        groups.setdefault(w, set()).add(roots.get(m, m))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in base.connected_components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}
    assert base.connected_components(edges.where("a < 0")).count() == 0


def test_near_copies(spark, none):
    rng = random.Random(6)
    own = [" ".join(str(rng.randrange(10**6)) for _ in range(300)) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(own)] + [(100 + k, t.replace(t.split()[150], "changed")) for k, t in enumerate(own[:10])] + [(200, own[3]), (201, None), (None, "stays")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect() if r.doc_id is not None)
    assert kept == [*range(30), 201]
    assert simhash.keep_one(docs).where("doc_id IS NULL").count() == 1 and simhash.keep_one(none).count() == 0


def brute_cut(texts, length):
    seen, out = {}, {}
    for i in sorted(texts):
        b = texts[i].encode()
        gone, own = [False] * len(b), set()
        for j in range(len(b) - length + 1):
            w = b[j : j + length]
            own.add(w)
            if w in seen:
                gone[j : j + length] = [True] * length
        for w in own:
            seen.setdefault(w, i)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g))
    return out


def check_cuts(spark, texts, monkeypatch=None):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in texts.items()], "doc_id long, text string, id string, n_bytes int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.repeats(docs).collect()}
    assert got == brute_cut(texts, suffixes.LENGTH)


def test_suffix_dedup(spark, docs, none):
    check_cuts(spark, texts_by_id())
    rng = random.Random(4)
    passages = [sentence(25) for _ in range(6)]
    # a passage in most documents makes hot anchors; periodic text makes anchors with many runs
    texts = {k: sentence(rng.randrange(30)) + rng.choice(passages[:1] * 5 + passages) + sentence(rng.randrange(30)) + rng.choice(["", "ab" * rng.randrange(60), "é" * rng.randrange(40)]) for k in range(400)}
    check_cuts(spark, texts)
    assert suffixes.repeats(none).count() == 0


def test_suffix_dedup_keeps_columns_and_null_ids(spark, docs):
    cut = suffixes.without_repeats(docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))))
    assert cut.columns == docs.columns and cut.count() == len(TEXTS) + 1
    want = brute_cut(texts_by_id(), suffixes.LENGTH)
    assert all(r.text.encode() == want[r.doc_id][3].decode(errors="ignore").encode() for r in cut.where("doc_id IS NOT NULL").collect())


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 32))
    x[100:110] = x[50]
    rows = [(k, v.tolist(), "l") for k, v in enumerate(x)] + [(2000, None, "l"), (2100, [0.0] * 32, "l"), (2200, [1.0, None] + [0.0] * 30, "l"), (2300, [float("nan")] * 32, "l"), (2400, [1.0], "l"), (None, [1.0] * 32, "l")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(1500), d))[:10]
        hits += len(set(best.tolist()) & {v for v, _ in got[q]})
        assert all(np.isclose(s, d[v], rtol=1e-12) for v, s in got[q]) and len(got[q]) == 10
    assert hits >= 0.97 * 300 and set(got) == set(range(0, 1500, 50))
    assert [v for v, _ in got[50]] == list(range(100, 110))
    few = neighbours.nearest(vectors.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert len(few) == 3 and neighbours.nearest(vectors.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def toxic_rows(spark, n):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(["river", "stone", "cloud", "paper", "music"]) + str(rng.randrange(50)) for _ in range(rng.randrange(5, 60))]
        bad = k % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["grubnak", "grubnakken", "sluvvo"])
        rows.append((k, " ".join(words), "en", 1.0))
        labels.append((k, int(bad)))
    rows += [(n, None, "en", 1.0), (n + 1, "", "en", 1.0), (n + 2, "word " * 30000, "en", 1.0)]
    labels += [(n, None), (n + 9, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_rows(spark, 600)
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    got = by_id(toxicity.scored(docs, model))
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [r[0] for r in docs.where(toxicity.held_out() & F.col("doc_id").between(0, 599)).select("doc_id").collect()]
    assert sum(got[i].predicted == (i % 5 == 0) for i in held) >= 0.95 * len(held)
    assert toxicity.scored(docs.limit(0), model).count() == 0
    blank = toxicity.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.score for r in toxicity.scored(docs.limit(3), blank).collect()} == {0.0}


def test_isotonic_and_trees():
    rng = np.random.default_rng(2)
    raw = rng.standard_normal(400)
    y = (rng.random(400) < 1 / (1 + np.exp(-3 * raw))).astype(float)
    x, p = toxicity.isotonic(raw, y)
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all() and 0 <= p.min() <= p.max() <= 1
    z = rng.random((500, len(toxicity.NAMES)))
    t = ((z[:, 0] > 0.5) ^ (z[:, 3] > 0.5)).astype(float)
    assert ((toxicity.Trees().fit(z, t).raw(z) > 0) == t).mean() > 0.95
    assert toxicity.plain("st00pid") == "stoopid" and toxicity.plain("m0r0n") == "moron" and toxicity.plain("sooooo") == "so"


def test_language_id(spark):
    rng = random.Random(7)
    parts = {"aa": ["kol", "mar", "tin"], "bb": ["sche", "ung", "keit"], "cc": ["eau", "oux", "ille"]}
    rows = [(k, " ".join(rng.choice(parts[lang]) + rng.choice(parts[lang]) for _ in range(rng.randrange(1, 40))), lang, 0.5) for k in range(450) for lang in [sorted(parts)[k % 3]]]
    rows += [(1000, None, "aa", 0.5), (1001, "123 !!", "bb", 0.5), (1002, "kolmar", None, 0.5), (1003, "", "cc", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = by_id(langid.identified(docs, langid.train(docs, ~langid.held_out())))
    held = [r for r in rows[:450] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1003)) and got[1002].lang_pred == "aa"
    assert {r.lang_pred for r in langid.identified(docs, langid.train(docs, F.lit(False))).collect()} == {"und"}
    weights = langid.train(docs, F.lit(True)).weights
    assert (weights == 0).mean() > 0.5


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, labels = toxic_rows(spark, 400)
    shared = "a shared line of words"
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 1, F.concat("text", F.lit("\n" + shared))).otherwise(F.col("text")))
    docs = docs.drop("score").withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    copies = docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 5000)
    docs.unionByName(copies).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = now.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / f"out{k}"))
        now = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen[name] = now
        assert k == len(corpus_pipeline.STAGES) - 1 or now.columns == columns
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    assert len([i for i in ids("toxicity") if i < 400 and i % 5 == 0]) <= 4 and len([i for i in ids("toxicity") if i < 400 and i % 5]) >= 316
    assert seen["line dedup"].where(F.col("text").contains(shared)).count() == 0 and ids("line dedup") == ids("toxicity")
    assert not {i for i in ids("simhash near-dedup") if 5000 <= i < 5020} and ids("best-fit packing") == ids("simhash near-dedup") == ids("suffix-array dedup")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["best-fit packing"].count()
