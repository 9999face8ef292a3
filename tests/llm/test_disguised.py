"""Words that the lexicon holds are found whatever their disguise and whatever stands beside them."""

import pytest

from strandmark.llm import toxicity


@pytest.mark.parametrize("word", ["stuuupid", "ugggly", "xyz,", "(xyz)", "xyz", "m0r0n", "st*pid2x", "grubnaks?", "g$$$rubnakken", "1*2*3"])
def test_every_word_that_look_up_knows_counts(word):
    lexicon = toxicity.Lexicon({"xyz": 2.0, "grubna*": 1.5, "stpid*": 1.0, "1*2**": 1.0})
    want = lexicon.look_up(word.strip(toxicity._EDGES))[0]
    got = dict(zip(toxicity.NAMES, toxicity.features(f"a plain text with {word} in it", lexicon)))
    assert got["weight_max"] == want and (got["distinct_hits"] == 1) == (want > 0)
    assert want > 0 or word == "g$$$rubnakken"
