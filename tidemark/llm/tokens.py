"""Token ids of whole texts with a public tokenizer, piece by piece.

The vocabulary's normaliser and splitter never carry anything across a blank: no piece holds white
space, composition stops at it, and added tokens hold none. So the ids of a text are those of its
blank-separated words one after the other. A word of plain letters is one piece, and what ASCII
punctuation stands behind them is another; the ids of new pieces come from the library's model in
one call. Any other word goes through its whole pipeline.

Pieces are cut, lowered and hashed a slice of text at a time. Only the distinct ones of a slice are
looked up among those known, and only new ones ever become Python strings. Pieces are known by two
independent 64-bit hashes; two that share the first one are told apart by the second.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidemark.llm.arrays import (
    BLANK,
    LOWER,
    mix,
    prefix_sums,
    ragged,
    slices,
    substring_hash,
    texts,
    words,
)

VOCABULARY = "word_bpe_49k.json"
END_ID = 1

# Pieces remembered by a Python worker, at about 60 bytes each; beyond it the memory starts anew.
REMEMBERED = 300_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
# Second bytes of the Latin-1 letters, whose first byte is C3, and of those that have a lower case.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_LATIN_UPPER = _LATIN & (np.arange(256) < 0x9F)
_SHUFFLED = np.random.default_rng(20240301).permutation(256).astype(np.uint8)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known:
    """Pieces by their two hashes, and the ids of each; number 0 is the end of a text."""

    def __init__(self, end_id: int):
        self.first = np.zeros(0, np.uint64)
        self.second = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self._ids = np.full(1, end_id, np.uint32)
        self._starts, self.lengths = np.zeros(1, np.int64), np.ones(1, np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 if it is new."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.searchsorted(self.first, first)
        at[at == len(self.first)] = 0
        same = (self.first[at] == first) & (self.second[at] == second)
        return np.where(same, self.numbers[at], -1)

    def add(
        self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, lengths: np.ndarray
    ) -> np.ndarray:
        """New numbers of pieces, which come in order of their first hash."""
        numbers = len(self.lengths) + np.arange(len(first))
        at = np.searchsorted(self.first, first)
        self.first = np.insert(self.first, at, first)
        self.second = np.insert(self.second, at, second)
        self.numbers = np.insert(self.numbers, at, numbers)
        starts = len(self._ids) + np.cumsum(lengths) - lengths
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        return numbers

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        return self._ids[ragged(self._starts[numbers], self.lengths[numbers])]


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with plain letters lowered, and which bytes belong to plain letters."""
    letters, low = _LETTER[data], LOWER[data]
    leads = np.flatnonzero(data[:-1] == 0xC3)
    if len(leads):
        leads = leads[_LATIN[data[leads + 1]]]
        letters[leads] = letters[leads + 1] = True
        upper = leads[_LATIN_UPPER[data[leads + 1]]] + 1
        low[upper] += 0x20
    return low, letters


def _cut(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in order: bytes (lowered where plain), start, end, whether plain, text number."""
    starts, ends, owner = words(data, offsets, BLANK)
    low, letters = _lowered(data)
    stops = np.flatnonzero(~letters)
    heads = np.append(stops, len(data))[np.searchsorted(stops, starts)]
    heads = np.minimum(heads, ends)
    punctuation = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_PUNCTUATION[data], out=punctuation[1:])
    plain = (heads > starts) & (punctuation[ends] - punctuation[heads] == ends - heads)
    heads = np.where(plain, heads, ends)
    tail = heads < ends
    place = np.arange(len(starts)) + np.cumsum(tail) - tail
    found = np.empty((4, len(starts) + int(tail.sum())), np.int64)
    found[:, place] = starts, heads, plain, owner
    found[:, place[tail] + 1] = heads[tail], ends[tail], np.ones(int(tail.sum()), int), owner[tail]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[~plain]] += 1
    edges[ends[~plain]] -= 1
    as_given = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    return np.where(as_given, data, low), found[0], found[1], found[2].astype(bool), found[3]


class Encoder:
    """Encodes batches of texts; remembers the ids of pieces."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # The same model on pieces that are normalised and split already.
        self._pieces_alone = Tokenizer(self._tokenizer.model)
        self._pieces_alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._shown = {
            code: as_bytes.pre_tokenize_str(chr(code))[0][0] for code in range(0xC0, 0x100)
        }
        vocabulary = self._tokenizer.get_vocab()
        self._ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self._ends_piece[number] = token.endswith("</w>")
        self._end = end_id
        self._known = _Known(end_id)

    def _plain_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """One call for all pieces; the last id of each is that of a word's end."""
        text = b" ".join(pieces).decode()
        if not text.isascii():
            text = text.translate(self._shown)
        (found,) = self._pieces_alone.encode_batch_fast([text], add_special_tokens=False)
        ids = np.asarray(found.ids, np.uint32)
        ends = np.flatnonzero(self._ends_piece[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("a piece has no end in this vocabulary")
        return ids, np.diff(ends, prepend=0)

    def _new_ids(
        self, raw: bytes, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pieces, in the order given, and how many each has."""
        pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        accented = np.fromiter((not piece.isascii() for piece in pieces), bool, len(pieces))
        firsts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        found, held = [], 0
        for at in (np.flatnonzero(plain & ~accented), np.flatnonzero(plain & accented)):
            if len(at):
                ids, lengths[at] = self._plain_ids([pieces[i] for i in at.tolist()])
                firsts[at] = held + np.cumsum(lengths[at]) - lengths[at]
                found.append(ids)
                held += len(ids)
        for i in np.flatnonzero(~plain).tolist():
            ids = self._tokenizer.encode(pieces[i].decode(), add_special_tokens=False).ids
            firsts[i], lengths[i] = held, len(ids)
            found.append(np.asarray(ids, np.uint32))
            held += len(ids)
        return np.concatenate(found)[ragged(firsts, lengths)], lengths

    def _numbers(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray
    ) -> np.ndarray:
        """The number of every piece of a slice; new ones are learnt."""
        first = substring_hash(prefix_sums(data), starts, ends) ^ plain
        second = substring_hash(prefix_sums(_SHUFFLED[data]), starts, ends) ^ plain
        while True:
            keys, at, where = np.unique(first, return_index=True, return_inverse=True)
            other = second != second[at][where]
            if not other.any():
                break
            first[other] = mix(first[other] + np.uint64(1))
        if len(self._known.first) > REMEMBERED:
            self._known = _Known(self._end)
        numbers = self._known.find(keys, second[at])
        new = numbers < 0
        if new.any():
            at = at[new]
            ids, lengths = self._new_ids(data.tobytes(), starts[at], ends[at], plain[at])
            numbers[new] = self._known.add(keys[new], second[at], ids, lengths)
        return numbers[where]

    def _encode_slice(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        data, starts, ends, plain, owner = _cut(data, offsets)
        # Number 0 behind the pieces of every text.
        numbers = np.zeros(len(starts) + n, np.int64)
        if len(starts):
            numbers[np.arange(len(starts)) + owner] = self._numbers(data, starts, ends, plain)
        last = np.searchsorted(owner, np.arange(n), side="right") + np.arange(n)
        return self._known.gather(numbers), np.cumsum(self._known.lengths[numbers])[last]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and the n + 1 offsets between texts."""
        data, offsets = texts(column)
        ids, bounds, before = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
        for first, last in slices(offsets):
            inner = offsets[first : last + 1]
            found, ends = self._encode_slice(data[inner[0] : inner[-1]], inner - inner[0])
            ids.append(found)
            bounds.append(before + ends)
            before += len(found)
        return np.concatenate(ids), np.concatenate(bounds)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    return Encoder(path, end_id)
