"""SentencePiece encoding and decoding of a merge-type model through a table over prefixes.

Encoding a text by merges gives each of its prefixes one last token. The table holds that token
for every prefix: an automaton over the vocabulary lists the pieces that end at a place, and of
these only one goes with the last token of the prefix before it. Two tokens go together if merging
their joined text gives just the two back. That is all that has to be tested: merges go by score
and then from the left, so that what happens within two neighbours doesn't depend on the rest. The
ids are then read off backwards, from the last token of the whole text. The work is linear in the
text's length, whatever it looks like.

A place where no piece holds the two characters side by side is never merged over, so texts are
cut there and each different part is encoded once. Every task does its own rows; nothing is
shuffled, and what a worker remembers is bounded.

Decoding joins the pieces' bytes, turns their space marks to blanks, and leaves out the mark that
encoding puts before the text; bytes that are no UTF-8 become U+FFFD.

Defined results: a null text is an empty one, which has no ids; a text's own space marks (U+2581) come
back as blanks, as the model has it; characters that are no piece are spelt in bytes; ids
that are no pieces are refused; other columns stay as they are, and clashing names aren't touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
#: Words and parts of them, of each that many, and twice as many pairs and steps of the automaton,
#: that a worker remembers before it starts anew; words that come again are taken over.
REMEMBERED = 400_000
#: Characters of a word or part that is worth remembering.
LONGEST = 64
_WORD = re.compile(f"{MARK}({MARK}*[^{MARK}]+|{MARK}*)")
#: Where a word is looked at for a cut: between letters or digits and other characters.
_PART = re.compile(rf"{MARK}*\w+|{MARK}*[^\w{MARK}]+|{MARK}+")


class _State(dict):
    """A state of the automaton: the next state by character, made when it is first met.

    ``read`` is the longest end of what was read that a token starts with, and ``found`` the tokens
    that end here, the longest first, with their lengths.
    """

    __slots__ = ("found", "make", "read")

    def __init__(self, read: str, found: list[tuple[int, str]], make: Callable[[str], _State]):
        self.read, self.found, self.make = read, found, make

    def __missing__(self, character: str) -> _State:
        self[character] = state = self.make(self.read + character)
        return state


class Automaton:
    """Lists, character by character, the tokens that end at a place. Only what texts need is built."""

    def __init__(self, tokens: set[str]):
        self.tokens = tokens
        self.starts = {t[:n] for t in tokens for n in range(len(t) + 1)}
        self.forget()

    def forget(self) -> None:
        self.steps = 0
        self.states: dict[str, _State] = {}
        self.start = self._state("")
        self.steps = 0

    def _state(self, read: str) -> _State:
        self.steps += 1
        while read not in self.starts:
            read = read[1:]
        state = self.states.get(read)
        if state is None:
            ends = (read[k:] for k in range(len(read)))
            self.states[read] = state = _State(read, [(len(t), t) for t in ends if t in self.tokens], self._state)
        return state


class _After(dict):
    """For each token tested beside ``token``: its own :class:`_After` if the two stay as they are, else None."""

    __slots__ = ("length", "test", "token")

    def __init__(self, token: str, test: Callable[[str, str], _After | None]):
        self.token, self.length, self.test = token, len(token), test

    def __missing__(self, right: str) -> _After | None:
        self[right] = after = self.test(self.token, right)
        return after


class PieceTable:
    """Ids of texts for one model file, and texts of ids."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        self.names = [sp.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.names[i]: i for i in plain}
        self.score = {self.names[i]: sp.get_score(i) for i in plain}
        self.byte_id = {int(self.names[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        shown = [byte_of.get(i) or (b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else n.replace(MARK, " ").encode()) for i, n in enumerate(self.names)]
        self.shown, self.opening = shown, {i for i, n in enumerate(self.names) if i not in byte_of and n.startswith(MARK)}
        self.unknown = sp.unk_id()
        self.joined = {n[k : k + 2] for n in self.id for k in range(len(n) - 1)}
        self.cut_at_marks = not any(p[1] == MARK != p[0] for p in self.joined)
        # A character that is only found within pieces may still be merged: it is a token on the way.
        self.alphabet = {c for n in self.id for c in n}
        self.automaton = Automaton(self.alphabet.union(self.id))
        self.together: dict[str, _After] = {}
        self.tested = 0
        # Ids in decimal and decoded bytes of each word, without its first mark.
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.decimal = [b"%d" % i for i in ids]

    # --- one text through the table -----------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text, by merging its pairs one after another."""
        tokens, score = list(text), self.score.get
        scores = [score(a + b, _NEVER) for a, b in zip(tokens, tokens[1:])]
        while scores and (best := max(scores)) is not _NEVER:
            k = scores.index(best)
            tokens[k : k + 2] = [tokens[k] + tokens[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = score(tokens[k - 1] + tokens[k], _NEVER)
            if k < len(scores):
                scores[k] = score(tokens[k] + tokens[k + 1], _NEVER)
        return tokens

    def _together(self, left: str, right: str) -> _After | None:
        """Do the two tokens stay as they are beside each other? ``left`` is empty at the start."""
        self.tested += 1
        return self._after(right) if self.merged(left + right) == ([left, right] if left else [right]) else None

    def _after(self, token: str) -> _After:
        return self.together.get(token) or self.together.setdefault(token, _After(token, self._together))

    def tokens(self, text: str) -> list[str]:
        """Fill the table of last tokens prefix by prefix, then go back from the end.

        ``text`` has characters of the alphabet only, so that each prefix has a last token.
        """
        if self.tested >= 2 * REMEMBERED:
            self.together, self.tested = {}, 0
        if self.automaton.steps >= 2 * REMEMBERED:
            self.automaton.forget()
        state, last = self.automaton.start, [self._after("")]
        add = last.append
        for character in text:
            state = state[character]
            for n, token in state.found:
                after = last[-n][token]
                if after is not None:
                    add(after)
                    break
            else:
                raise ValueError("a character of no piece")
        out, at = [], len(text)
        while at:
            end = last[at]
            out.append(end.token)
            at -= end.length
        out.reverse()
        return out

    def _spelt(self, token: str) -> list[int]:
        known = self.id.get(token)
        if known is not None:
            return [known]
        ids = self.byte_id
        return [ids[b] for b in token.encode()] if ids else [self.unknown]

    def _part(self, text: str) -> tuple[int, ...]:
        """Ids between two places that nothing is merged over."""
        known = self.parts.get(text)
        if known is None:
            tokens = self.tokens(text) if len(text) > 1 else [text]
            known = tuple(map(self.id.get, tokens))
            if None in known:
                known = tuple(i for t in tokens for i in self._spelt(t))
            if len(text) <= LONGEST:
                if len(self.parts) >= REMEMBERED:
                    self.parts.clear()
                self.parts[text] = known
        return known

    def _cut(self, spans: list[str]) -> list[int]:
        """Ids of a word that is given in spans, cut where no piece of the vocabulary goes over."""
        if len(spans) == 1:
            return list(self._part(spans[0]))
        joined, part, out = self.joined, spans[0], []
        for span in spans[1:]:
            if part[-1] + span[0] in joined:
                part += span
            else:
                out += self._part(part)
                part = span
        out += self._part(part)
        return out

    def _ids(self, word: str) -> list[int]:
        # A character of no piece is cut out by itself.
        return self._cut(_PART.findall(word) if self.alphabet.issuperset(word) else list(word))

    # --- whole texts --------------------------------------------------------------------

    def _words(self, text: str) -> list[str]:
        """Cut before each run of marks, unless pieces go on over them; words go without their first mark."""
        if not self.cut_at_marks:
            return [text.replace(" ", MARK)]
        if "  " not in text and MARK not in text and text[0] != " ":
            return text.split(" ")
        return _WORD.findall(MARK + text.replace(" ", MARK))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return [i for w in self._words(text) for i in self._ids(MARK + w)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; it goes without the mark that was put before it."""
        ids = list(ids)
        if any(not 0 <= i < len(self.shown) for i in ids):
            raise ValueError("an id is not in the vocabulary")
        data = b"".join(map(self.shown.__getitem__, ids))
        first = next((i for i in ids if self.shown[i]), None)
        if first in self.opening:
            data = data[1:]
        return _readable(data)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and sha256 of the ids (decimal, joined by commas) and of the decoded text.

        What is hashed is the same as of ``encode`` and ``decode``, word by word: the ids in decimal
        and the bytes that they decode to are remembered for each word. A word ends with a whole
        character, so its bytes can be read by themselves.
        """
        if not text:
            return 0, _EMPTY, _EMPTY
        words, known = self._words(text), self.words
        if new := set(words).difference(known):
            if len(known) + len(new) > REMEMBERED:
                self.older, self.words = known, {}
                known, new = self.words, set(words)
            older, decimal, shown = self.older.get, self.decimal, self.shown
            for word in new:
                both = older(word)
                if both is None:
                    ids = self._ids(MARK + word)
                    both = b",".join([decimal[i] for i in ids]), _readable(b"".join([shown[i] for i in ids])).encode()
                known[word] = both
        both = list(map(known.__getitem__, words))
        ids = b",".join(map(_FIRST, both))
        # The first word opens with the mark that encoding put there.
        decoded = b"".join(map(_SECOND, both))[1:]
        for word in new:
            if len(word) > LONGEST:
                del known[word]
        return ids.count(b",") + 1, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


_NEVER = float("-inf")
_EMPTY = hashlib.sha256(b"").hexdigest()
_FIRST, _SECOND = itemgetter(0), itemgetter(1)


def _readable(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return _replaced(data)


def _replaced(data: bytes) -> str:
    """One U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
            except UnicodeDecodeError:
                continue
            break
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


_LOADED: dict[str, PieceTable] = {}


def loaded(path: str) -> PieceTable:
    return _LOADED.get(path) or _LOADED.setdefault(path, PieceTable(path))


def _applied(kind: str, use: Callable[[PieceTable, object], object], path: str) -> Callable[[Column], Column]:
    @F.pandas_udf(kind)
    def column(values: pd.Series) -> pd.Series:
        table = loaded(path)
        return pd.Series([use(table, v) for v in values], dtype=object)

    return column


def encode(text: Column, path: str) -> Column:
    """array<int> of a text column. ``path``: a model file that is there on every executor."""
    return _applied("array<int>", lambda t, v: t.encode(v), path)(text)


def decode(ids: Column, path: str) -> Column:
    """The text of array<int>; null for null."""
    return _applied("string", lambda t, v: None if v is None else t.decode(int(i) for i in v), path)(ids)


def digests(text: Column, path: str) -> Column:
    """(n_tokens, ids_sha256, decoded_sha256) of a text column; ids and texts stay in the worker."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def column(values: pd.Series) -> pd.DataFrame:
        table = loaded(path)
        return pd.DataFrame([table.digest(v) for v in values], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return column(text)
