"""Folding of texts to plain words, with the way back to the original characters."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import regex

MARKS = regex.compile(r"\p{M}+")
NOT_WORD = re.compile(r"[\W_]+")
WORD_RUN = re.compile(r"[^\W_]+")
BLANK_RUN = re.compile(r"\s+")
#: Kinds of characters: of a word, combining marks, blanks, line breaks, ends of sentences.
WORD, MARK, BLANK, LINE, STOP = 1, 2, 3, 4, 5
#: Characters that are folded at a time.
PIECE = 1 << 17
#: Odd, so that its powers can be undone modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def fold(text: str) -> str:
    """Case, diacritics and combining marks removed; d for the barred d."""
    t = text.casefold()
    if t.isascii():
        return t
    return MARKS.sub("", unicodedata.normalize("NFD", t)).replace("đ", "d")


def plain(text: str) -> str:
    """The folded words, each with one blank before and after it."""
    return f" {NOT_WORD.sub(' ', fold(text)).strip()} "


def words(text: str) -> list[str]:
    return NOT_WORD.sub(" ", fold(text)).split()


def plain_with_offsets(text: str) -> tuple[str, list[int]]:
    """plain(text) and for each of its characters the place in text that it comes from."""
    folded, at = [], []
    for i, ch in enumerate(text):
        for c in fold(ch):
            if not unicodedata.category(c).startswith("M"):
                folded.append(c)
                at.append(i)
    whole = "".join(folded)
    out, back = [" "], [0]
    for m in re.finditer(r"[^\W_]+", whole):
        out.append(m.group())
        back.extend(at[m.start() : m.end()])
        out.append(" ")
        back.append(at[m.end() - 1] + 1)
    return ("".join(out), back) if len(out) > 1 else ("  ", [0, 0])


def char_kinds() -> bytes:
    """For every code point WORD, MARK, BLANK, LINE, STOP or 0, packed; kinds() opens it."""
    kind = np.zeros(0x110000, np.uint8)
    for at in range(0, 0x110000, 0x10000):
        chars = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "\x00" for i in range(at, at + 0x10000))
        for pattern, k in ((WORD_RUN, WORD), (MARKS, MARK), (BLANK_RUN, BLANK)):
            for m in pattern.finditer(chars):
                kind[at + m.start() : at + m.end()] = k
    kind[ord("\n")] = LINE
    kind[[ord(c) for c in ".!?"]] = STOP
    return zlib.compress(kind.tobytes(), 9)


def kinds(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def pieces(text: str) -> Iterator[str]:
    """The text in stretches of about PIECE characters, cut after a blank."""
    at = 0
    while len(text) - at > PIECE:
        blank = BLANK_RUN.search(text, at + PIECE)
        if blank is None:
            break
        yield text[at : blank.end()]
        at = blank.end()
    yield text[at:]


def word_codes(texts: Sequence[str], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The folded words of all texts in turn as 32-bit hashes, the number of the text of each, and the number of its sentence.

    The words are those of words(); a sentence ends at a line break, or at a
    blank after a full stop, exclamation or question mark.
    """
    codes, owners, sentences, done = [], [], [], 0

    def read(first: int, held: list[str], same: bool) -> None:
        nonlocal done
        t = unicodedata.normalize("NFD", "\x00".join(held).casefold()).replace("đ", "d")
        cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        k = kind[cp]
        keep = k != MARK
        cp, k = cp[keep], k[keep]
        edges = np.flatnonzero(np.diff((k == WORD).view(np.int8), prepend=0, append=0))
        a, b = edges[::2], edges[1::2]
        # the hash of a word is a difference of prefix sums, shifted to the place of its first character
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(cp.astype(np.uint64) * powers(BASE, len(cp)), dtype=np.uint64)))
        h = (sums[b] - sums[a]) * powers(pow(BASE, -1, 1 << 64), len(cp) + 1)[a]
        for times in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h ^= h >> np.uint64(33)
            h *= np.uint64(times)
        ends = np.cumsum((k == LINE) | ((k == BLANK) & (np.concatenate(([0], k[:-1])) == STOP)))
        codes.append((h >> np.uint64(32)).astype(np.uint32))
        owners.append(np.full(len(a), first) if same else first + np.cumsum(cp == 0)[a])
        sentences.append(done + ends[a])
        done += int(ends[-1]) if len(ends) else 0

    held, first, size = [], 0, 0
    for i, text in enumerate(texts):
        text = text.replace("\x00", " ")
        if size + len(text) > PIECE and held:
            read(first, held, False)
            held, first, size = [], i, 0
        if len(text) > PIECE:
            for piece in pieces(text):
                read(i, [piece], True)
            first = i + 1
            continue
        held.append(text)
        size += len(text)
    if held:
        read(first, held, False)
    none = np.zeros(0, np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *codes]), np.concatenate([none, *owners]), np.concatenate([none, *sentences])
