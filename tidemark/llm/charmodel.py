"""A character language model counted over all documents, and words restored with it.

Letters are folded to a-z (accents off, case off); anything else ends a word. The model is the
number of times each letter, or word end, follows up to three letters of its word: at most
``SYMBOLS ** ORDER`` counts, summed by Spark over the whole corpus and interpolated down to single
letters.

The noisy channel: an obfuscated word is a lattice whose columns are the observed characters and
whose entries are what each may stand for: a look-alike stands for letters or for itself, a run of
one letter for one, two or all of them, a separator between single letters for nothing or a word
end. The Viterbi path is the reading with the least sum of channel and model costs.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import released, slices, texts

SYMBOLS = 27  # a word end, then a-z
ORDER = 4
_CODES = SYMBOLS**ORDER

# What a character may stand for besides itself.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou",
}

# Channel costs in nats.
_SUBSTITUTE, _MASKED, _ITSELF = 1.0, 2.5, 6.0
_ONE, _TWO = 0.5, 0.8
_DROPPED, _KEPT = 0.5, 1.0


# --- folding ---


def _fold_tables() -> tuple[bytes, np.ndarray]:
    """Byte to folded letter; second bytes of the Latin-1 letters fold to their base letter."""
    folded = bytearray(b" " * 256)
    for code in range(97, 123):
        folded[code] = folded[code - 32] = code
    for code in range(0x80, 0xC0):
        base = unicodedata.normalize("NFD", chr(code + 0x40))[0].lower()
        base = {"ß": "s", "æ": "a", "ø": "o", "ð": "d", "þ": "t"}.get(base, base)
        folded[code] = ord(base) if base.isascii() and base.isalpha() else 32
    for code in range(0xC4, 0x100):
        folded[code] = code
    table = bytes(folded)
    numbers = np.zeros(256, np.int32)
    numbers[97:123] = np.arange(1, 27)
    return table, numbers[np.frombuffer(table, np.uint8)]


_FOLD, _NUMBERS = _fold_tables()


def folded_words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD, b"\xc3").split()


# --- the model ---


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_CODES, np.int64)
    for batch in released(batches):
        data, offsets = texts(batch.column("text"))
        for first, last in slices(offsets):
            inner = offsets[first : last + 1]
            part = np.insert(data[inner[0] : inner[-1]], inner - inner[0], 32)
            s = _NUMBERS[part[part != 0xC3]]
            one = np.append(0, s[:-1])
            two = np.where(one > 0, np.append(0, one[:-1]), 0)
            three = np.where(two > 0, np.append(0, two[:-1]), 0)
            code = ((three * SYMBOLS + two) * SYMBOLS + one) * SYMBOLS + s
            counts += np.bincount(code[(s > 0) | (one > 0)], minlength=_CODES)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"code": seen.astype(np.int32), "n": counts[seen]})


def count_letters(documents: DataFrame) -> np.ndarray:
    rows = documents.select("text").mapInArrow(_count, "code int, n long")
    total = rows.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_CODES)
    counts[total.column("code").to_numpy()] = total.column("n").to_numpy()
    return counts


def costs(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Negative log probability of each symbol after each context, shorter contexts mixed in."""
    cube = counts.reshape((SYMBOLS,) * ORDER)
    level = cube.sum(axis=(0, 1, 2))
    chance = (level + 1) / (level.sum() + SYMBOLS)
    for axes in ((0, 1), (0,), ()):
        seen = cube.sum(axis=axes) if axes else cube
        chance = (seen + weight * chance) / (seen.sum(axis=-1, keepdims=True) + weight)
    return -np.log(chance).ravel().astype(np.float32)


# --- restoring ---

_LETTER = r"[^\W\d_]"
_SPACED = re.compile(
    rf"(?<![^\W_])(?:[^\W_]|[@$!])(?:[ .\-_*](?:[^\W_]|[@$!])){{3,}}(?![^\W_])"
)
_WORD = re.compile(r"[\w@$!|+*]{3,}")
_CORE = re.compile(rf"(?:[@$!|+*](?={_LETTER})|[^\W_]).*[^\W_]", re.S)
_ODD = re.compile(r"[0-9@$!|+*]|(?ai:([a-z])\1\1)")


def _letter(char: str) -> int:
    """The folded number of a letter, 0 for anything else."""
    found = folded_words(char.encode())
    return found[0][0] - 96 if found and 97 <= found[0][0] <= 122 else 0


class Restorer:
    """Restores obfuscated words of texts; remembers what it has restored."""

    REMEMBERED = 20_000

    def __init__(self, model: np.ndarray):
        self._model = model
        self._known: dict[str, str] = {}

    def _lattice(self, word: str, spaced: bool) -> list[list[tuple[tuple[int, ...], float]]]:
        columns, i = [], 0
        while i < len(word):
            char = word[i].lower()
            run = 1
            while not spaced and i + run < len(word) and word[i + run].lower() == char:
                run += 1
            letter = _letter(char)
            if spaced and i % 2:
                columns.append([((), _DROPPED), ((0,), _KEPT)])
                run = 1
            elif letter and run > 2:
                columns.append([((letter,), _ONE), ((letter,) * 2, _TWO), ((letter,) * run, 0.0)])
            elif letter:
                columns += [[((letter,), 0.0)]] * run
            else:
                cost = _MASKED if char == "*" else _SUBSTITUTE
                stands = [((ord(c) - 96,), cost) for c in LOOKS_LIKE.get(char, "")]
                columns += [[*stands, ((0,), _ITSELF)]] * run
            i += run
        return columns

    def _path(self, columns: list[list[tuple[tuple[int, ...], float]]]) -> list[int]:
        """Viterbi over the last three letters."""
        model, back = self._model, []
        states: dict[int, float] = {0: 0.0}
        for column in [*columns, [((0,), 0.0)]]:
            after: dict[int, tuple[float, int, tuple[int, ...]]] = {}
            for context, cost in states.items():
                for symbols, channel in column:
                    at, total = context, cost + channel
                    for symbol in symbols:
                        if symbol or at:  # a second word end in a row says nothing
                            total += float(model[at * SYMBOLS + symbol])
                        at = (at * SYMBOLS + symbol) % SYMBOLS ** (ORDER - 1) if symbol else 0
                    if at not in after or total < after[at][0]:
                        after[at] = (total, context, symbols)
            back.append(after)
            states = {context: entry[0] for context, entry in after.items()}
        at, path = min(states, key=states.get), []
        for after in reversed(back):
            _, at, symbols = after[at][0], after[at][1], after[at][2]
            path[:0] = symbols
        return path

    def word(self, word: str, spaced: bool) -> str:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= self.REMEMBERED:
                self._known.clear()
            path = self._path(self._lattice(word, spaced))
            known = "".join(chr(96 + s) if s else " " for s in path).strip()
            self._known[word] = known
        return known

    def text(self, text: str) -> tuple[str, int]:
        """The text with its obfuscated words restored, and how many there were."""
        n = 0

        def spaced(match: re.Match[str]) -> str:
            nonlocal n
            if sum(c.isalpha() for c in match[0]) < 3:
                return match[0]
            n += 1
            return self.word(match[0], True)

        def word(match: re.Match[str]) -> str:
            nonlocal n
            core = _CORE.search(match[0])
            if not core or not _ODD.search(core[0]) or sum(c.isalpha() for c in core[0]) < 2:
                return match[0]
            n += 1
            before, after = match[0][: core.start()], match[0][core.end() :]
            return before + self.word(core[0], False) + after

        return _WORD.sub(word, _SPACED.sub(spaced, text)), n


def _bytes(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


_ASCII = _bytes(bytes([*range(65, 91), *range(97, 123)]))
_LETTERS = _ASCII | (np.arange(256) >= 0x80)
_DIGITS = _bytes(b"0123456789")
_SIGNS = _bytes(b"@$!|+*")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BETWEEN = _bytes(b" .-_*")
_SINGLE = _LETTERS | _DIGITS | _bytes(b"@$!")

# Blanks between texts: no pattern looks further.
_APART = 8


def _odd_words(part: np.ndarray) -> np.ndarray:
    """Places of look-alikes next to letters and of plain letters three times in a row."""
    letter, digit, sign, low = _LETTERS[part], _DIGITS[part], _SIGNS[part], _LOWER[part]
    odd = digit | sign
    at = letter[:-2] & odd[1:-1] | odd[:-2] & letter[1:-1]
    # Signs behind a word are punctuation unless a letter or digit follows.
    ahead = at & letter[:-2] & sign[1:-1]
    if ahead.any():
        places = np.flatnonzero(ahead)
        rest = np.flatnonzero(~sign)
        after = rest[np.searchsorted(rest, places + 1)]
        at[places] = (letter | digit)[after]
    at |= letter[:-2] & (low[:-2] == low[1:-1]) & (low[:-2] == low[2:])
    return np.flatnonzero(at)


def _spaced_words(part: np.ndarray) -> np.ndarray:
    """Places from which four characters stand one by one; each byte is a character."""
    single, between, plain = _SINGLE[part], _BETWEEN[part], (_ASCII | _DIGITS)[part]
    n = len(part) - 8
    at = ~plain[:n] & ~plain[8:]
    for i in range(1, 8):
        at &= (single if i % 2 else between)[i : n + i]
    return np.flatnonzero(at)


def may_be_obfuscated(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the texts in which ``Restorer.text`` can change anything; some more are flagged.

    Look-alikes next to letters, with ``_`` between them or not; a plain letter three times; four
    single characters in a row, whatever number of bytes each has.
    """
    n = len(offsets) - 1
    part = np.insert(data, np.repeat(offsets, _APART), 32)
    starts = offsets[:-1] + _APART * np.arange(n)
    flags = np.zeros(n, bool)
    for kept, find in (
        (part != ord("_"), _odd_words), ((part & 0xC0) != 0x80, _spaced_words)
    ):
        before = np.zeros(len(part) + 1, np.int64)
        np.cumsum(kept, out=before[1:])
        places = find(part[kept])
        flags[np.searchsorted(before[starts], places, side="right") - 1] = True
    return flags
