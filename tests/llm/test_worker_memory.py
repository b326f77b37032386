"""What a Python worker keeps, and the window search of many texts at once."""

import numpy as np
import pyarrow as pa

from spendline.llm import decontam, tokens, toxicity, words


def test_an_operator_drops_what_others_kept_in_the_worker():
    assert any(s is toxicity._LEXICON for s in words.KEPT) and any(s is tokens._ENCODERS for s in words.KEPT)
    own, other = words.kept({}), words.kept({})
    try:
        own["a"], other["b"] = 1, 2
        words.drop_others(own)
        assert own == {"a": 1} and other == {}
    finally:
        del words.KEPT[-2:]


def test_windows_of_a_portion_are_those_of_its_texts_one_by_one():
    texts = pa.array([None, "", "a", "a b", "... !", "3 km", "Hello World of Foo. Bar", "-- x -- y z", "1 2 3 4 5 6 7 8 9 10", "The 5 cats. Run",
                      "one fine day near London 7 dogs ran home with us", "Ends here.", "Starts Anew with a Name"])
    every = np.full(1 << (decontam.FILTER_BITS - 3), 255, np.uint8)
    found = sorted(decontam._hits(texts, [3, 4, 8], 0.5, every))
    alone = sorted((k, *row[1:]) for k in range(len(texts)) for row in decontam._hits(texts.slice(k, 1), [3, 4, 8], 0.5, every))
    assert found == alone
    lengths = [len(h) for h, *_ in decontam.templates(texts)]
    expected = sum(max(0, n - w + 1) for n in lengths for w in (3, 4, 8)) + sum(0 < n < decontam.LEAST_TOKENS for n in lengths)
    assert len(found) == expected
    by_hand = decontam.mix(decontam.rolling(decontam.templates(texts.slice(10, 1))[0][0], 8) + np.uint64(8)).view(np.int64)
    some = {(at, h): slots for k, h, at, n, slots in found if k == 10 and n == len(by_hand)}
    assert [some[0, int(by_hand[0])], some[2, int(by_hand[2])]] == [["one", "day", "london", "7"], ["day", "london", "7"]]
