"""Merge-dropout: every occurrence draws for itself, and the trees of agendas give what a plain agenda gives."""

import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from strandmark.llm import sentences

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def plain_agenda(word, skipped):
    """Pieces of a word by the definition: the best candidate merge in turn, none of those in skipped (a set of spans and splits)."""
    parts = [(k, k + 1) for k in range(len(word))]
    while True:
        heap = []
        for n, ((a, b), (_, e)) in enumerate(zip(parts, parts[1:])):
            ids = [MODEL.piece_to_id(word[x:y]) for x, y in ((a, b), (b, e), (a, e))]
            if all(not MODEL.is_unknown(i) for i in ids) and (a, b, e) not in skipped:
                heapq.heappush(heap, (-MODEL.get_score(ids[2]), n))
        if not heap:
            return [MODEL.piece_to_id(word[a:b]) for a, b in parts]
        n = heap[0][1]
        parts[n : n + 2] = [(parts[n][0], parts[n + 1][1])]


@pytest.mark.parametrize("rate", [0.1, 0.5, 0.9])
def test_occurrences_equal_the_plain_agenda(rate):
    tool = sentences.Encoder(PATH, rate, 3)
    words = ["thanea", "attioning", "the", "erinthdoring", "cioncillado", "straightforward", "a"]
    texts = [" ".join(words[k % 7] for k in range(n)) for n in (50, 1, 80)]
    salts = np.array([tool.salt(k) for k in range(3)], np.uint64)
    ids, at = tool.encode(pa.array(texts), salts)
    for n, t in enumerate(texts):
        want = []
        for place, w in enumerate(t.split(" ")):
            w = sentences.BLANK + w
            spans = [(a, b, e) for a in range(len(w)) for b in range(a + 1, len(w)) for e in range(b + 1, len(w) + 1)]
            key = sentences._mix(salts[n : n + 1] + np.array([place], np.uint64) * np.uint64(0x9FB21C651E98DF25))
            hit = tool.skipped(np.repeat(key, len(spans)), np.array([sentences._coded(*s) for s in spans]))
            want += plain_agenda(w, {s for s, h in zip(spans, hit) if h})
        assert ids[at[n] : at[n + 1]].tolist() == want


def test_a_word_has_many_segmentations_over_documents_and_places():
    tool = sentences.Encoder(PATH, 0.3, 5)
    ids, at = tool.encode(pa.array(["attioning " * 20] * 200), np.array([tool.salt(k) for k in range(200)], np.uint64))
    own = [tuple(ids[a:b]) for a, b in zip(at, at[1:])]
    assert len(set(own)) > 190
    alone, at = tool.encode(pa.array(["attioning"] * 200), np.array([tool.salt(k) for k in range(200)], np.uint64))
    assert len({tuple(alone[a:b]) for a, b in zip(at, at[1:])}) > 8
    words, at = tool.encode(pa.array([" ".join(["attioning"] * 300)]), tool.salt(1))
    text = [MODEL.id_to_piece(int(i)) for i in words]
    starts = [k for k, p in enumerate(text) if p.startswith(sentences.BLANK)] + [len(text)]
    assert len({tuple(text[a:b]) for a, b in zip(starts, starts[1:])}) > 8


def test_odd_words_and_full_caches_stay_lossless(monkeypatch):
    monkeypatch.setattr(sentences, "CACHE_NODES", 10)
    texts = ["x" * 300 + " " + sentences.BLANK + "a  b", "日本語 zz" + sentences.BLANK * 2, "  lead", "trail  ", "\n\t", "word " * 50]
    for rate in (0.0, 0.4):
        tool = sentences.Encoder(PATH, rate, 9)
        for _ in range(3):
            ids, at = tool.encode(pa.array(texts), np.array([tool.salt(k) for k in texts], np.uint64))
            assert [tool.decode(ids[a:b]) for a, b in zip(at, at[1:])] == texts
    first, _ = sentences.Encoder(PATH, 0.4, 9).encode(pa.array(texts), np.array([tool.salt(k) for k in texts], np.uint64))
    assert first.tolist() == ids.tolist()


def test_numbers():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 62, 20_000))
    rng.shuffle(keys)
    table = sentences.Numbers(4)
    for part in np.array_split(keys, 7):
        table.put(part, part % 1000)
    assert (table.get(keys) == keys % 1000).all() and (table.get(np.array([5, 6, 7])) == -1).all()
