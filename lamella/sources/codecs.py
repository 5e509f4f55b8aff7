"""Decoders of TIFF segments that give bytes as they are asked for, so that a task holds a block and not a segment."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np

# Numbers of compressions, and codes of the dictionary decoder.
PLAIN, LZW, DEFLATE, PACKBITS = (1,), (5,), (8, 32946), (32773,)
CLEAR, END, WIDEST = 256, 257, 12


class Plain:
    """The stored bytes themselves.  ``feed`` gives the next stored bytes, none at the end."""

    def __init__(self, feed: Callable[[], bytes]):
        self.feed, self.rest, self.ended = feed, b"", False

    def _more(self, want: int) -> bytes:
        """Some more bytes, of any number; none at the end."""
        return self.feed()

    def read(self, n: int) -> bytes:
        """The next n bytes; fewer at the end."""
        parts, got = [self.rest], len(self.rest)
        while got < n and (part := self._more(n - got)):
            parts.append(part)
            got += len(part)
        whole = b"".join(parts)
        self.rest = whole[n:]
        return whole[:n]


class Deflate(Plain):
    def __init__(self, feed: Callable[[], bytes]):
        super().__init__(feed)
        self.unpack, self.left = zlib.decompressobj(), b""

    def _more(self, want: int) -> bytes:
        while not self.unpack.eof:
            self.left = self.left or self.feed()
            if not self.left:
                return b""
            part = self.unpack.decompress(self.left, want)
            self.left = self.unpack.unconsumed_tail
            if part:
                return part
        return b""


class PackBits(Plain):
    """Runs of repeated bytes and of others, each behind a byte that counts it."""

    def __init__(self, feed: Callable[[], bytes]):
        super().__init__(feed)
        self.left, self.at = b"", 0

    def _more(self, want: int) -> bytes:
        out, size = [], 0
        while size < want:
            there = len(self.left) - self.at
            n = self.left[self.at] if there else 0
            need = 1 if not there or n == 128 else n + 2 if n < 128 else 2
            if there < need:
                more = self.feed()
                if not more:
                    break
                self.left, self.at = self.left[self.at :] + more, 0
                continue
            part = self.left[self.at + 1 : self.at + need] * (1 if n < 128 else 257 - n)
            self.at += need
            out.append(part)
            size += len(part)
        return b"".join(out)


class Lzw(Plain):
    """Strings of a growing dictionary by codes of 9 to 12 bits, the highest bit first.

    A code is a bit longer as soon as the dictionary lacks one entry of what the shorter ones can tell.
    """

    FIRST = [bytes([i]) for i in range(256)] + [b"", b""]

    def __init__(self, feed: Callable[[], bytes]):
        super().__init__(feed)
        self.data, self.at, self.held, self.bits = b"", 0, 0, 0
        self._clear()

    def _clear(self) -> None:
        self.table, self.width, self.before = self.FIRST.copy(), 9, b""

    def _more(self, want: int) -> bytes:
        out, size = [], 0
        data, at, held, bits, table, width, before = self.data, self.at, self.held, self.bits, self.table, self.width, self.before
        while size < want and not self.ended:
            while bits < width:
                if at == len(data):
                    data, at = self.feed(), 0
                    if not data:
                        self.ended = True
                        break
                held, bits, at = (held << 8) | data[at], bits + 8, at + 1
            if self.ended:
                break
            bits -= width
            code, held = held >> bits, held & ((1 << bits) - 1)
            if code == END:
                self.ended = True
            elif code == CLEAR:
                self._clear()
                table, width, before = self.table, self.width, self.before
            else:
                if code < len(table):
                    part = table[code]
                elif code == len(table) and before:
                    part = before + before[:1]
                else:
                    raise ValueError(f"a damaged segment: code {code} of {len(table)}")
                if before and len(table) < 1 << WIDEST:
                    table.append(before + part[:1])
                    if len(table) == (1 << width) - 1 and width < WIDEST:
                        width += 1
                before = part
                out.append(part)
                size += len(part)
        self.data, self.at, self.held, self.bits, self.width, self.before = data, at, held, bits, width, before
        return b"".join(out)


DECODERS = {**dict.fromkeys(PLAIN, Plain), **dict.fromkeys(LZW, Lzw), **dict.fromkeys(DEFLATE, Deflate), **dict.fromkeys(PACKBITS, PackBits)}


def samples(raw: bytes, order: str, bits: int, kind: int, predictor: int, line: int, each: int) -> np.ndarray:
    """Rows x line x samples of a pixel from decoded bytes; ``kind`` is 1 (unsigned), 2 (signed) or 3 (floating point).

    Predictor 2 stores differences to the pixel before, predictor 3 the bytes of a line's floating-point
    numbers, the highest ones first, as differences.
    """
    dtype = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[kind] }{bits // 8}")
    if predictor == 3:
        size = bits // 8
        steps = np.frombuffer(raw, np.uint8).reshape(-1, line * size, each)
        whole = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(-1, size, line * each)
        return np.ascontiguousarray(whole.transpose(0, 2, 1)).view(f">f{size}").reshape(-1, line, each)
    block = np.frombuffer(raw, dtype).reshape(-1, line, each)
    return np.cumsum(block, axis=1, dtype=dtype.newbyteorder("=")) if predictor == 2 else block
