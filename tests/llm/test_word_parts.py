"""New words get their ids from lower-cased letters and signs, each of which the tokeniser sees once."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chatloom.llm.packing import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


class Seen(WordIds):
    def __init__(self, path):
        super().__init__(path)
        self.seen = []

    def encode(self, words):
        self.seen += words
        return super().encode(words)

    def encode_letters(self, words):
        self.seen += words
        return super().encode_letters(words)


def _whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for t in texts]


def test_case_and_signs_do_not_make_a_word_new():
    ids, texts = Seen(PATH), ["Zorvind zorvind, ZORVIND!! zorvind.", "Zorvind: Überzor überzor&&&"]
    assert ids.of(texts) == _whole(texts)
    assert len(ids.seen) == len(set(ids.seen)) and [w for w in ids.seen if "zor" in w.lower()] == sorted(["zorvind", "überzor"], key=ids.seen.index)


def test_equal_to_whole_texts():
    rng = random.Random(3)
    letters = "ab Z|'s.,\n\t é́ßẞΣςİ<>|0 1²中​̸Å \r\x0bª&&!!"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", "abc<|endoftext|>.", "<|endoftext|>", "<|startoftext|>!! x", "it's its'. 's.", "x" * 500 + " " + "y" * 65 + ".", "É́. é. e.́"]
    ids = WordIds(PATH)
    assert ids.of(texts) == _whole(texts) and ids.of([]) == []
    ids.most = 10
    assert [x for i in range(0, len(texts), 7) for x in ids.of(texts[i : i + 7])] == _whole(texts)
