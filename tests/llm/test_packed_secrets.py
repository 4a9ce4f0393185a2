import base64
import gzip
import random
import zlib

import pytest

from joinscope.llm import secret_scan

SECRET = "password=hunter2hunter2"


def text_of(data: bytes) -> str:
    return "before " + base64.b64encode(data).decode() + " after"


def nested(text: str, *layers) -> bytes:
    data = text.encode()
    for layer in layers:
        data = layer(data)
    return data


def spans(text):
    return secret_scan.secrets(text)[1]


def b64(data):
    return base64.b64encode(data)


@pytest.mark.parametrize(
    "layers",
    [
        (gzip.compress, gzip.compress), (zlib.compress, gzip.compress), (gzip.compress, zlib.compress), (gzip.compress, zlib.compress, gzip.compress),
        (gzip.compress, b64, gzip.compress, zlib.compress), (gzip.compress, gzip.compress, b64, gzip.compress), (lambda d: b"some text " + gzip.compress(d) + b" more", gzip.compress),
    ],
)
def test_compressed_in_compressed(layers):
    text = text_of(nested("a line of text\n" + SECRET + "\nand another", *layers))
    (span,) = spans(text)
    assert span[1] == "assign" and span[0] >= 7 and span[2] <= len(text) - 6
    assert "[SECRET]" in secret_scan.redacted(text)
    assert not spans(text_of(nested("a line of text\nand another", *layers)))


def test_many_layers():
    data = SECRET.encode()
    for _ in range(300):
        data = gzip.compress(data)
    assert len(spans(text_of(data))) == 1


def test_several_streams_in_one_window():
    inside = b"".join(gzip.compress(x) + bytes(50) for x in (b"nothing here", SECRET.encode(), b"AKIA" + b"ABCDEFGHIJKLMNOP"))
    assert {k for _, k, _ in spans(text_of(gzip.compress(inside)))} == {"assign", "access"}


def test_stream_over_window_borders(monkeypatch):
    monkeypatch.setattr(secret_scan, "WINDOW", 2000)
    monkeypatch.setattr(secret_scan, "WINDOW_LEAST", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 500)
    draw = random.Random(3)
    noise = bytes(draw.choices(range(256), k=9000))
    for at in (0, 997, 1999, 2000, 5000):
        inner = gzip.compress(bytes(draw.choices(b"abc def", k=3000)) + b" " + SECRET.encode() + b" " + bytes(draw.choices(b"abc def", k=3000)))
        assert "assign" in {k for _, k, _ in spans(text_of(gzip.compress(noise[:at] + inner + noise)))}, at


def test_data_that_unpacks_to_itself_ends(monkeypatch):
    """A stand-in for a quine: unpacking gives the same data, time and again."""
    quine = b"\x1f\x8b\x08" + bytes(range(100))
    made = []

    class Same:
        def __init__(self, _):
            self.eof, self.unused_data, self.unconsumed_tail = False, b"", b""
            made.append(self)

        def decompress(self, data, most):
            self.eof = True
            return quine

    monkeypatch.setattr(secret_scan.zlib, "decompressobj", Same)
    packed = secret_scan.Packed(secret_scan.Runs())
    packed.feed(quine)
    assert len(made) == 1 and not packed.kinds


def test_false_starts_cost_nothing_else():
    text = "x^2 + " * 5000 + SECRET + " x^y" * 5000
    assert "assign" in {k for _, k, _ in spans(text_of(gzip.compress(gzip.compress(text.encode()))))}


@pytest.mark.parametrize("escaped", [r"password\U0000003dhunter2hunter2", r"password\u{3d}hunter2hunter2", r"password\u{00003D}hunter2hunter2"])
def test_further_escapes(escaped):
    assert spans(escaped) == {(0, "assign", len(escaped))}
    assert spans(r"password\U0011000012345678 \u{110000}") == set()


@pytest.mark.parametrize("kind", ["utf-16-le", "utf-16-be", "utf-16"])
def test_wide_text(kind):
    assert {k for _, k, _ in spans(text_of(SECRET.encode(kind)))} == {"assign"}
    assert {k for _, k, _ in spans(text_of(gzip.compress(SECRET.encode(kind))))} == {"assign"}
    assert not spans(text_of("nothing to be found in here".encode(kind)))
