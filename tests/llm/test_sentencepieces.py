"""The agenda gives the library's ids for parts of any length and any characters."""

import random

import public_tokenizers

from regstar.llm.sentencepieces import MODEL, SPACE, Vocabulary


def test_agenda_equals_the_library():
    v = Vocabulary(public_tokenizers.path(MODEL))
    rng = random.Random(8)
    letters = "aaeeiinnstrhdlouc" + "ñçßüé" + "Ελ漢字" + "😀\u0301" + "0123.,-_/"
    parts = ["".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 13, 47, 48, 49, 90]))) for _ in range(3000)]
    parts += ["a" * 5000, "the" * 2000, "ab" * 3001, "é" * 777]
    assert [v.encode(SPACE + p) for p in parts] == v.library.encode(parts)
    assert [v.decode(v.encode(SPACE + p)) for p in parts] == [" " + p for p in parts]
