import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from joinscope.llm import sentence_pieces
from joinscope.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    return sentence_pieces.PieceTable(PATH)


def digest(library, text):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


ODD = [
    "", " ", "  a", "a  b ", "a\nb\x00c", "▁a", "▁", "日本語テキスト�", "<s> </s> <0x41> <unk>", "ﬁ①Ａ é é", " x", "a b\t",
    "\r\n", "x\U0001f600", "x" * 5000, "ab" * 3000, " " * 3000, "▁▁ ▁▁", "İSTANBUL ßẞ", "‍​", "();\r\n}\r\n{\r", "\u0085 ",
]


def test_odd_texts(library, table):
    for text in ODD:
        ids = library.encode(text)
        assert table.encode(text) == ids
        assert table.decode(ids) == library.decode(ids)
        assert table.digest(text) == digest(library, text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(library, table, text):
    assert table.encode(text) == library.encode(text)
    assert table.digest(text) == digest(library, text)


def test_pieces_side_by_side(library, table):
    names, draw = sorted(table.id), random.Random(5)
    for _ in range(5000):
        text = "".join(draw.choices(names, k=draw.randint(1, 6))).replace("▁", " ")
        assert table.encode(text) == library.encode(text), text


def test_decoding_of_any_ids(library, table):
    draw = random.Random(7)
    for _ in range(5000):
        ids = draw.choices(range(32000), k=draw.randint(0, 6)) + draw.choices(range(3, 259), k=draw.randint(0, 5))
        draw.shuffle(ids)
        assert table.decode(ids) == library.decode(ids), ids
    with pytest.raises(ValueError, match="vocabulary"):
        table.decode([32000])


def test_last_tokens_are_those_of_each_prefix(table):
    """What the table rests on: every prefix ends in the token that merging it gives."""
    for text in ("▁unbelievable", "▁representations", "aaaaaaaaaaaaa", "▁▁▁▁▁▁▁x", "ancellationTokens"):
        for end in range(1, len(text) + 1):
            assert table.tokens(text[:end]) == table.merged(text[:end])


def test_long_text_without_cuts(library, table):
    text = "".join(random.Random(1).choices("abcdefgh", k=100_000))
    assert table.encode(text) == library.encode(text)


def test_memory_is_bounded_and_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 50)
    small = sentence_pieces.PieceTable(PATH)
    draw = random.Random(2)
    for _ in range(200):
        text = " ".join("".join(draw.choices("abcdefghij.,", k=draw.randint(1, 90))) for _ in range(draw.randint(1, 120)))
        assert small.digest(text) == digest(library, text)
        assert len(small.words) <= 170 and len(small.parts) <= 50 and all(len(w) <= sentence_pieces.LONGEST for w in small.words)


def test_whole_table(spark, sf_dir, real, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_sentence_pieces"](spark, sf_dir).collect()}
    assert got == {i: digest(library, text) for i, text in real}


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, library):
    text = F.col("text")
    ids = sentence_pieces.encode(text, PATH)
    both = odd_docs.select("*", ids.alias("ids"), sentence_pieces.decode(ids, PATH).alias("again"), sentence_pieces.digests(text, PATH).alias("d")).collect()
    assert len(both) == len(odd_rows)
    for r in both:
        assert list(r.ids) == library.encode(r.text or "") and r.again == library.decode(list(r.ids))
        assert tuple(r.d) == digest(library, r.text)
    assert no_docs.select(sentence_pieces.digests(text, PATH)).count() == 0


def test_automaton_lists_the_tokens_that_end_at_a_place_longest_first(table, monkeypatch):
    text = "▁unbelievable▁representations();▁日本▁aaaa"
    automaton = sentence_pieces.Automaton(table.alphabet.union(table.id))
    for _ in range(2):
        state = automaton.start
        for end, character in enumerate(text, 1):
            state = state[character]
            ends = [text[k:end] for k in range(end)]
            assert state.found == [(len(t), t) for t in ends if t in automaton.tokens]
        assert len(automaton.states) <= automaton.steps <= len(text) + 1
        automaton.forget()


def test_words_go_without_their_first_mark(table):
    texts = ["a", "a b", "a b ", " a", "a  b", "▁a b", "a ▁", " ", "  ", "a\n b", "a b  "]
    for text in texts:
        words = table._words(text)
        marked = sentence_pieces.MARK + text.replace(" ", sentence_pieces.MARK)
        assert "".join(sentence_pieces.MARK + w for w in words) == marked
        assert all(w.lstrip(sentence_pieces.MARK) or w is words[-1] for w in words), text


def test_a_word_known_already_is_not_cut_again(table, monkeypatch):
    draw = random.Random(11)
    known = ["".join(draw.choices("abcdefgh", k=9)) for _ in range(300_000)]
    small = sentence_pieces.PieceTable(PATH)
    monkeypatch.setattr(small, "_ids", lambda word: [300])
    for k in range(0, len(known), 1000):
        small.digest(" ".join(known[k : k + 1000]))
    assert set(known) <= set(small.words)
