import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tapwise.llm import tokens

ALPHABET = [
    "a", "b", "The", "é", "É", "é", "́", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", ",", "'s", "'", "n't",
    "1", "23", "²", "½", "中文", "中", "🙂", " ", "\x85", "\x1c", "​", "_", "<|endoftext|>", "<", "|", "***", "İ", "ß",
    "ſ", "Σ", "ς", "ᾳ", "ﬁ", "\x00", "-", "x" * 70, "ü", "µ", "ª", "×", "ǅ", "ʰ", " ", "word", "Wordy,", "!?", "\x01", "\u3000",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_whole_text(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 20)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 500)
    monkeypatch.setattr(tokens, "GATHER_WORDS", 30)
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["", None, " ", "\n", *ALPHABET]
    texts += ["".join(rng.choices(ALPHABET, k=rng.randint(1, 12))) for _ in range(4000)]
    texts += [" ".join(rng.choices(ALPHABET, k=rng.randint(1, 30))) for _ in range(1500)]
    encoder = tokens.Encoder(path)
    for text, found in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        wanted = plain.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == wanted, repr(text)
    assert len(encoder.known) <= 20


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("stop", [None, [], [5, 6], "the word's own"])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_words_are_encoded_many_at_once(name, stop):
    """Where the stop has no id of its own, each is encoded by itself."""
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéÉßıXYZ", k=rng.randint(1, 12))) for _ in range(4000)]
    words += ["the", "12", "x.y", ".", "..", "(or", "end.", "a.\nNext", "中文"]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(400)]
    encoder = tokens.Encoder(path)
    if stop is not None:
        encoder.stop = plain.encode(" the", add_special_tokens=False).ids if isinstance(stop, str) else stop
    encoder.tokenizer = Counted(encoder.tokenizer)
    for text, found in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(encoder.known) > 3000
    assert (encoder.tokenizer.texts < 200) == (stop is None)
