"""Secret scan with a worklist of decoded layers.

A text is scanned for three kinds of secrets. Then the whole text with its URL escapes decoded, the
whole text with its Unicode escapes decoded, and every base64 run (and gzip or zlib data within it)
are layers of their own, which are scanned and decoded further in turn, until nothing new appears.
A layer with the content and the places of one seen before is not visited again, so texts that
decode to each other end, and an encoded part that comes again is reported at each of its places.
Each layer keeps, for every character, which characters of the original it came from, so that a
secret is reported at its place there; out of base64 that is the whole encoded text, which may be
wrapped over lines or stand behind a prefix of base64 characters.

Text columns are worked on in Arrow batches, one text at a time, and nothing is shuffled.

Defined results: a null or empty text has no span; repeated rows each get their result; other
columns are left alone. Compressed data is unpacked to its end, in overlapping
windows, so that a decompression bomb can't take an executor; base64 of compressed data within it
goes on from window to window. Between two windows only these may be missed: a secret that takes more
than ``OVERLAP`` characters as it is encoded there, and compressed data whose base64 is escaped.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import fresh

# Kinds of secrets in the order in which they are listed at one place.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARACTERS = 8

URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_CHAR = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8})|u\{([0-9A-Fa-f]{1,6})\})")
# Lines of a wrapped run are one run; a shorter word only starts one at the end of its line.
_B, _WRAP = "[A-Za-z0-9+/_-]", r"[ \t]*+\r?\n[ \t]*+"
BASE64_RUN = re.compile(rf"(?<!{_B})(?:{_B}{{19,}}+|{_B}++(?={_WRAP}{_B}))(?:{_WRAP}{_B}++)*+={{0,2}}")
#: Characters of the shortest secret's (14 bytes) base64 without padding.
BASE64_LEAST = 19
STANDARD = str.maketrans("-_", "+/")
READABLE = re.compile(rb"(?:[\t-\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){14,}+")
#: Plain text in UTF-16, of either byte order.
WIDE = re.compile(rb"(?:[\t-\r\x20-\x7e]\x00){14,}+|(?:\x00[\t-\r\x20-\x7e]){14,}+")
#: What gzip, or zlib without a dictionary, starts with.
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Base64 characters of a garbage prefix that may happen to be readable.
PREFIX = 8
#: Characters of runs whose findings are remembered for one text.
REMEMBERED = 32 << 20
BASE64_MORE = re.compile(r"[A-Za-z0-9+/_\s-]*+")
BLANKS = re.compile("\x20{2,}")
#: Bytes of a window of unpacked data, and the characters that it repeats of the one before.
WINDOW, OVERLAP = 4 << 20, 256 << 10
#: Windows halve from layer to layer down to this, so that deep nesting stays in bounded memory.
WINDOW_LEAST = 512 << 10
#: Bytes over which compressed data and data around it have to be equal to be taken for a cycle, where its end isn't seen.
HEAD = 64 << 10
#: Layers of compressed data directly in compressed data.
DEEPEST = 1000

Span = tuple[int, int]
#: A text and, for each of its characters, the start and the end of what it came from.
Layer = tuple[str, np.ndarray, np.ndarray]


def found(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of the secrets that stand in ``text`` itself."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= ASSIGN_CHARACTERS:
            yield m.start(), "assign", m.end()
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            yield m.start(), kind, m.end()


def _spliced(text: str, pattern: re.Pattern, decode) -> Layer | None:
    """``text`` with all matches of ``pattern`` decoded, and where its characters came from."""
    out, starts, ends, done = [], [], [], 0
    for m in pattern.finditer(text):
        piece, kept = decode(m), np.arange(done, m.start())
        out += [text[done : m.start()], piece]
        starts += [kept, np.full(len(piece), m.start())]
        ends += [kept + 1, np.full(len(piece), m.end())]
        done = m.end()
    if not done:
        return None
    kept = np.arange(done, len(text))
    return "".join([*out, text[done:]]), np.concatenate([*starts, kept]), np.concatenate([*ends, kept + 1])


def _url_bytes(m: re.Match) -> str:
    return bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")


def _unicode_char(m: re.Match) -> str:
    code = int(m[1] or m[2] or m[3] or m[4], 16)
    return chr(code) if code < 0x110000 else m[0]


class Runs:
    """Kinds of secrets within base64 runs; those of one text, so that a repeated run is read once.

    A run may have a prefix, such as a path, so it is decoded at each of the four alignments. At the
    wrong ones, and within the prefix, the bytes are no text. Secrets are looked for in every
    readable stretch and in all compressed data, and their place is that of the whole stretch.
    """

    def __init__(self):
        self.known: dict[tuple, set[tuple[int, str, int]]] = {}
        self.held, self.active, self.looped = 0, set(), False

    def spans(self, text: str, open_: list[Packed] | None = None, known: int = 0) -> Iterator[tuple[int, str, int]]:
        """(start, kind, end) in ``text``.

        If it is a window, ``open_`` gets the compressed data that starts after its first ``known``
        characters, those of the window before, and goes on behind it.
        """
        for m in BASE64_RUN.finditer(text):
            lines = m[0].rstrip("=").split()
            run = "".join(lines)
            if len(run) < BASE64_LEAST:
                continue
            second, last = (len(lines[0]), len(run) - len(lines[-1])) if len(lines) > 1 else (0, len(run))
            at = None
            if open_ is not None and not text[m.end() : m.end() + OVERLAP].strip():
                seen = sum(not c.isspace() for c in m[0][: max(0, known - m.start())])
                inside = set().union(*[self._decoded(run, k, second, last, open_, seen) for k in range(4)])
            else:
                inside = self.within(run, second, last)
            for a, kind, b in inside:
                if at is None:
                    at = range(m.start(), m.end()) if len(lines) == 1 else [m.start() + i for i, c in enumerate(m[0]) if not c.isspace()]
                yield at[a], kind, m.end() if b == len(run) else at[b - 1] + 1

    def kinds(self, text: str, open_: list[Packed] | None = None, known: int = 0) -> set[str]:
        """Kinds of secrets in ``text`` and all of its layers; ``open_`` and ``known`` as in ``spans``."""
        out, seen, work = set(), {text}, [text]
        while work and len(out) < len(KINDS):
            layer = work.pop()
            out.update(k for _, k, _ in found(layer))
            out.update(k for _, k, _ in (self.spans(layer, open_, known) if layer is text else self.spans(layer)))
            for inner in (URL_BYTES.sub(_url_bytes, layer), UNICODE_CHAR.sub(_unicode_char, layer)):
                if inner not in seen:
                    seen.add(inner)
                    work.append(inner)
        return out

    def within(self, run: str, second: int, last: int) -> set[tuple[int, str, int]]:
        """(start, kind, end) in ``run``, whose second line starts at ``second``, its last at ``last``."""
        key = (run, second, last)
        if key in self.known:
            return self.known[key]
        if key in self.active:  # it holds itself
            self.looped = True
            return set()
        self.active.add(key)
        out = set().union(*[self._decoded(run, k, second, last) for k in range(4)])
        self.active.remove(key)
        self.looped &= bool(self.active)
        if not self.looped:  # what lies in a loop is complete for the outermost run only
            self.held += len(run)
            if self.held > REMEMBERED:
                self.known, self.held = {}, len(run)
            self.known[key] = out
        return out

    def _decoded(self, run: str, shift: int, second: int, last: int, open_: list[Packed] | None = None, seen: int = 0) -> Iterator[tuple[int, str, int]]:
        body = run[shift : len(run) - ((len(run) - shift) % 4 == 1)]  # one character alone is no byte
        data = base64.b64decode(body.translate(STANDARD) + "=" * (-len(body) % 4))

        def start(byte: int) -> int:
            return shift + byte * 8 // 6

        def end(byte: int) -> int:
            return len(run) if byte >= len(data) else shift - (-byte * 8 // 6)

        for m in READABLE.finditer(data):
            if not (kinds := self.kinds(m[0].decode("utf-8", "replace"))):
                continue
            a, b = m.span()
            # a border just after the start, or the last line, may part garbage from the text
            if start(a):
                borders = [i + 1 for i in range(start(a), start(a) + PREFIX) if run[i : i + 1] in ("/", "_", "-") or i + 1 == second]
                for cut in reversed(borders):
                    byte = -(-(cut - shift) * 6 // 8)
                    if (cut - shift) % 4 == 0 and self.kinds(data[byte:b].decode("utf-8", "replace")) == kinds:
                        a = byte
                        break
            if start(a) < last < end(b) < len(run):
                byte = (last - shift) * 6 // 8
                if self.kinds(data[a:byte].decode("utf-8", "replace")) == kinds:
                    b = byte
            for kind in kinds:
                yield start(a), kind, end(b)
        for m in WIDE.finditer(data) if b"\0" in data else ():
            for kind in self.kinds(m[0].replace(b"\0", b"").decode()):
                yield start(m.start()), kind, end(m.end())
        done = 0
        if open_ is not None:
            data = data[: len(body) // 4 * 3]  # the characters behind the last whole four go on later
        for m in PACKED.finditer(data):
            if m.start() < done:
                continue
            inner = Packed(self)
            inner.feed(data[m.start() :])
            if inner.unpack.eof:
                done = len(data) - len(inner.unpack.unused_data)
            for kind in inner.kinds:
                yield start(m.start()), kind, end(done if inner.unpack.eof else len(data))
            if open_ is not None and inner.alive() and m.end() > (seen - shift) // 4 * 3:
                inner.rest = run[shift + len(body) // 4 * 4 :]
                open_.append(inner)


class Packed:
    """Kinds of secrets in compressed data that comes in parts and is unpacked window by window.

    Compressed data in what was unpacked is a layer of its own, whose kinds are those of the
    outermost one; the same data is visited once. A worklist goes through the layers, not recursion:
    what lies within a window is unpacked before the window after it.
    """

    def __init__(self, runs: Runs, outer: Packed | None = None):
        self.unpack = zlib.decompressobj(47)  # 47: gzip or zlib, whichever it is
        self.characters = codecs.getincrementaldecoder("utf-8")("ignore")
        self.outer, self.depth = outer, outer.depth + 1 if outer else 0
        self.runs, self.kinds, self.failed = runs, outer.kinds if outer else set(), False
        self.window = max(WINDOW >> self.depth, WINDOW_LEAST)
        self.head, self.taken = b"", 0  # the first bytes that came in, and how many were used
        self.inner: list[Packed] = []
        self.seen: set[bytes] = outer.seen if outer else set()  # compressed data that needs no second visit
        self.last = b""
        self.tail, self.open = "", []
        self.rest, self.lasts = "", True  # for compressed data that goes on behind a window

    def feed(self, data: bytes) -> None:
        self.head += data[: HEAD - len(self.head)]
        stack: list[Iterator[tuple[Packed, bytes | None, bytes | None]]] = [iter([(self, data, None)])]
        while stack:
            if (item := next(stack[-1], None)) is None:
                stack.pop()
                continue
            layer, left, piece = item
            if piece is None:
                piece, left = layer._step(left)
            if left is not None:
                stack.append(iter([(layer, left, None)]))
            if piece and len(self.kinds) < len(KINDS):
                stack.append(layer._layers(piece))

    def _step(self, data: bytes) -> tuple[bytes, bytes | None]:
        """One window of what ``data`` unpacks to, and what is left of it if there may be another."""
        if not self.alive():
            return b"", None
        try:
            piece = self.unpack.decompress(data, self.window)
        except zlib.error:
            self.failed = True
            return b"", None
        left = self.unpack.unconsumed_tail
        self.taken += len(data) - len(left) - len(self.unpack.unused_data)
        self._window(self.characters.decode(piece))
        return piece, left if not self.unpack.eof and (len(piece) == self.window or left) else None

    def _layers(self, piece: bytes) -> Iterator[tuple[Packed, bytes | None, bytes | None]]:
        """The compressed data in a window: what of it is still packed, and what was just unpacked."""
        self.inner = [x for x in self.inner if x.alive()]
        data, new, done = self.last + piece, len(self.last), 0
        self.last = data[-2:]
        for x in list(self.inner):
            x.head += piece[: HEAD - len(x.head)]
            yield x, piece, None
        for m in PACKED.finditer(data) if self.depth < DEEPEST else ():
            if m.end() <= new or m.start() < done:
                continue
            part = data[m.start() :]
            if self._around(part):
                continue
            x = Packed(self.runs, self)
            x.head = part[:HEAD]
            got, left = x._step(part)
            if x.failed:
                continue
            if x.unpack.eof:
                done = m.start() + x.taken
                if (seen := hashlib.sha256(part[: x.taken]).digest()) in self.seen:
                    continue
                self.seen.add(seen)
            else:
                self.inner.append(x)
                if left is None and x.taken >= HEAD:  # it is no chance, and goes on behind the window
                    done = len(data)
            yield x, left, got

    def _around(self, part: bytes) -> bool:
        """Whether ``part`` starts with the data that this or an outer layer was unpacked from."""
        layer = self
        while layer is not None:
            n = min(layer.taken, HEAD) if layer.unpack.eof else HEAD
            if len(layer.head) >= n <= len(part) and layer.head[:n] == part[:n]:
                return True
            layer = layer.outer
        return False

    def more(self, text: str) -> bool:
        """Go on with the base64 characters that ``text`` starts with; whether they may go on after it."""
        m = BASE64_MORE.match(text)
        body = self.rest + "".join(m[0].split())
        whole = len(body) // 4 * 4
        self.feed(base64.b64decode(body[:whole].translate(STANDARD)))
        self.rest = body[whole:]
        if m.end() < len(text) and len(self.rest) > 1:
            self.feed(base64.b64decode(self.rest.translate(STANDARD) + "=" * (4 - len(self.rest))))
        return m.end() == len(text) and self.alive()

    def alive(self) -> bool:
        return not (self.failed or self.unpack.eof)

    def _window(self, text: str) -> None:
        if len(self.kinds) == len(KINDS):
            return
        text = BLANKS.sub(" ", text.replace("\0", ""))  # their number means nothing to any pattern, nor do the zeros of UTF-16
        for inner in self.open:
            inner.lasts = inner.more(text)
            self.kinds |= inner.kinds
        self.open = [inner for inner in self.open if inner.lasts]
        known, text = len(self.tail), self.tail + text
        self.kinds |= self.runs.kinds(text, self.open, known)
        self.tail = text[-OVERLAP:]


def layers(text: str) -> Iterator[Layer]:
    """One step of decoding, with places in ``text``: all of it without its URL escapes, and all of
    it without its Unicode escapes."""
    if "%" in text and (layer := _spliced(text, URL_BYTES, _url_bytes)):
        yield layer
    if "\\" in text and (layer := _spliced(text, UNICODE_CHAR, _unicode_char)):
        yield layer


def secrets(text: str) -> tuple[set[tuple[int, str, int]], set[tuple[int, str, int]]]:
    """The spans in the text itself, and all spans with those from decoded layers."""
    base, runs = set(found(text)), Runs()
    all_, seen, work = base | set(runs.spans(text)), set(), [(text, None, None)]
    while work:
        outer, first, last = work.pop()
        for inner, starts, ends in layers(outer):
            if first is not None:
                starts, ends = first[starts], last[ends - 1]
            if not inner or (key := (inner, starts.tobytes(), ends.tobytes())) in seen:
                continue
            seen.add(key)
            for a, kind, b in (*found(inner), *runs.spans(inner)):
                all_.add((int(starts[a]), kind, int(ends[b - 1])))
            work.append((inner, starts, ends))
    return base, all_


def _listed(spans: set[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))


FOUND = "n_assign long, n_access long, n_hex long, base string, spans string"


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, all_ = secrets(text) if text else (set(), set())
        kinds = [k for _, k, _ in base]
        rows.append((*[kinds.count(k) for k in KINDS], _listed(base), _listed(all_)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])


def _redact(texts: pd.Series) -> pd.Series:
    return texts.map(redacted, na_action="ignore")


def redacted(text: str, by: str = "[SECRET]") -> str:
    """``text`` with each secret, also an encoded one, replaced; touching spans become one."""
    out, done = [], 0
    for a, b in _merged(sorted((a, b) for a, _, b in secrets(text)[1])):
        out += [text[done:a], by]
        done = b
    return "".join([*out, text[done:]])


def _merged(spans: list[Span]) -> Iterator[Span]:
    last = None
    for a, b in spans:
        if last and a <= last[1]:
            last = (last[0], max(last[1], b))
        else:
            if last:
                yield last
            last = (a, b)
    if last:
        yield last


def scan(docs: DataFrame, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` and a struct named ``into``: numbers of base spans by kind, ``base`` and ``spans``."""
    return docs.withColumn(fresh(docs, into), F.pandas_udf(_scan, FOUND)(F.col(f"`{text_col}`")))


def redact(text: Column) -> Column:
    """The text without its secrets; null stays null."""
    return F.pandas_udf(_redact, "string")(text)
