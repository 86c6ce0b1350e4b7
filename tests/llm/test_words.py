"""Looking up which words are new takes time by the slice, not by what a worker remembers."""

import public_tokenizers

from chatloom.llm.packing import WordIds


class Counted(WordIds):
    walked = 0

    def __iter__(self):
        Counted.walked += 1
        return super().__iter__()

    def keys(self):
        Counted.walked += 1
        return super().keys()


def test_a_slice_does_not_walk_the_remembered_words():
    ids = Counted(public_tokenizers.path("word_bpe_49k.json"))
    first = ids.of(["one two three", "three four"])
    assert ids.of(["one two three", "three four"]) == first and dict.__len__(ids) == 4
    assert not Counted.walked
