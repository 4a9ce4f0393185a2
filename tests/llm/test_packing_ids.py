import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest

from joinscope.llm.packing import WordIds


@pytest.fixture(scope="module")
def words():
    return WordIds(public_tokenizers.path("word_bpe_49k.json"))


def same(words, text):
    return np.frombuffer(words.of(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_letters_that_change_before_and_after_marks(words):
    """All letters, marks and digits whose normal or lower-case form differs, and all of the first blocks."""
    everything = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    odd = [c for c in everything if unicodedata.category(c)[0] in "MLN" and (ord(c) < 0x700 or unicodedata.normalize("NFC", c) != c or len(c.lower()) > 1 or c.lower() != c)]
    assert len(odd) > 3000
    wrong = [c for c in odd if not all(same(words, t) for t in (f"a{c}, b", f"{c}!? {c}", f",{c} .{c}.", f"x{c}'s {c}'"))]
    assert not wrong


def test_texts_of_many_scripts(words):
    for text in ("BELEDİYESİ, ANKARA", "এটা হয়, ভালো", "बड़ड़, था", "בשׁ, x", "STRASSE, ẞ! ΣΑΣ, ς.", "한국어, 각.", "ﬁ, ①! Å.", "J\u030c é, J\u030cX", "I\u0307 E\u0301, ÀB", "Der Fluß WAR Größer, ÜBER"):
        assert same(words, text), text


def test_random_mixes(words):
    draw = random.Random(4)
    letters = [chr(c) for c in range(0xC0, 0x600) if chr(c).isalpha()] + list("ßİẞΣ߀য়ड़שׁé") + list("abcdeXYZ019") * 20 + list(",.!?'\"-^|<>") * 20 + [" ", "\n", "́"] * 40
    for _ in range(5000):
        text = "".join(draw.choices(letters, k=draw.randint(1, 40)))
        assert same(words, text), text
