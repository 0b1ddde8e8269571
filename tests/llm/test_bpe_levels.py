"""The encoder works on new words level by level, remembers words across texts, and splits most texts with a faster rule."""

import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def words():
    rng = random.Random(8)
    made = {"".join(rng.choice("thineraoudsé漢 '0\x00\n") for _ in range(rng.randint(1, 14))) for _ in range(4000)}
    return sorted(made | {"a", "ab", "abc", "\x00", "\x00\x00", "z" * 48})


def test_levels_give_what_the_walk_gives(words):
    own = bpe.TrieEncoder(PATH)
    own._stepped, own._followed = bpe.Recall(3), bpe.Recall(4)  # most places change hands
    texts = [w.encode() for w in words]
    expected = list(own.encode_sorted(texts))
    for _ in range(2):
        flat, ends = own.encode_levels(texts)
        assert [tuple(flat[a:b].tolist()) for a, b in zip([0, *ends], ends)] == expected


def test_words_of_one_text_after_another_are_learned_once(monkeypatch):
    learned = []
    monkeypatch.setattr(bpe.TrieEncoder, "learn", lambda self, words, f=bpe.TrieEncoder.learn: (learned.extend(words), f(self, words))[1])
    own, reference = bpe.TrieEncoder(PATH, remembered=60), Tokenizer.from_file(PATH)
    common = " ".join(f"w{chr(97 + k)}x" for k in range(20))
    for k in range(20):  # fresh words fill the memory again and again
        text = common + " " + " ".join(f"q{chr(97 + k)}{chr(97 + n)}y" for n in range(15))
        assert own.encode_batch([text])[0].tolist() == reference.encode(text).ids
    assert sorted(learned) == sorted(set(learned))


def test_the_rule_for_16_bit_characters():
    slow, fast = regex.compile(bpe.PRE_TOKEN), bpe.plane_rule()
    plane = [chr(k) for k in range(1 << 16)]
    rng = random.Random(4)
    texts = [" ".join(plane), "".join(plane)] + ["".join(rng.choice("aZ'sdtmrevl  \n\x1c\x85　½é漢.—‍" + rng.choice(plane)) for _ in range(40)) for _ in range(3000)]
    assert all(slow.findall(t) == fast.findall(t) for t in texts)
