"""Token ids of whole texts by the public tokenizers, with a bounded memory of words.

The library cuts a text into pieces by a pattern and merges inside each. Texts of
Latin letters are cut here by the same pattern, and each piece is merged once per
worker by the library's model; pieces met before come out of a dictionary. Other
texts are cut only where neither vocabulary merges, at single spaces between
visible characters, and the library encodes what is new there.

Many texts at a time are cut at these spaces with numpy, and all their words are
looked up in one table at once; only words that are new there, or longer than its
keys, are handled one by one.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

REMEMBERED = 100_000  # pieces in each of two generations that a worker keeps, about 40 MB in all
LONGEST = 64  # longer ones are not kept
END_ID = 2

KEY_BYTES = 16  # words up to this length are keys of the table
LEARNED = 900_000  # words of the table, and as much as a block more
SLOTS = 1 << 21  # of the table: more than twice as many, 64 MB
BLOCK_WORDS = 1 << 16  # looked up at once
STORED_IDS = 1 << 23  # beyond this many the table forgets, 32 MB
CHUNK_SIGNS = 1 << 21  # texts are put together until they have so many characters

#: Cut where a letter meets a sign other than an apostrophe: no pattern spans this.
_INNER = re.compile(r"(?<=[A-Za-zß-öø-ÿ])(?=[!-&(-/:-@\[-`{-~\n])")
_WORDS = re.compile(r"\s*\S+(?:(?! \S)\s+\S*)*")
_TWO_SPACES = re.compile(r"\s\s")
_RARE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_RARE_ASCII_SPACE = "\t\r\v\f\x1c\x1d\x1e\x1f"
_ASCII_SPACE = re.compile("[ \t\n\v\f\r]+")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

# Letters, numbers and white space up to U+024F, and the patterns of both vocabularies over them.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\\t-\\r \x85\xa0"
_OTHER = f"[^{_SPACE}{_LETTER}{_NUMBER}]"
_ENDINGS = "'(?:[stmd]|re|ve|ll)"
_SPACED_PIECES = re.compile(f"{_ENDINGS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?{_OTHER}+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BARE_PIECES = re.compile(f"{_ENDINGS}|[{_LETTER}]+|[{_NUMBER}]|{_OTHER}+")
_BEYOND = re.compile("[^\0-\u024f\u2010-\u2027]")

#: The public byte alphabet of such vocabularies: visible bytes stand for themselves, the others for 256 and up.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def _any_of(literals: list[str]) -> re.Pattern | None:
    return re.compile("|".join(map(re.escape, literals))) if literals else None


class _Memory(dict):
    """Values by key, made when missing; the older half goes when it is full."""

    def __init__(self, make) -> None:
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class _Table:
    """Ids of words by their bytes, for many words at once.

    Up to 16 bytes a word is told exactly by its length, its first and its next 8
    bytes: these are the keys of an open-addressing table. Longer words are in a
    dictionary. When it is full, all is forgotten.
    """

    _MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], "<u8")
    _FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], "<u8")

    def __init__(self, make) -> None:
        self.make = make
        self.clear()

    def clear(self) -> None:
        self.rows = np.zeros((SLOTS, 4), "<u8")  # first bytes, next bytes, length (0: free), entry
        self.longer: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.store = np.zeros(1 << 14, "<u4")
        self.entries, self.stored = 0, 0

    def ids(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, how many each has); 16 bytes that belong to no word end ``data``."""
        if self.entries > LEARNED or self.stored > STORED_IDS:
            self.clear()
        sizes = ends - starts
        entry = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(sizes <= KEY_BYTES)
        at, n = starts[short], sizes[short]
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        keys = (eight[at] & self._MASKS[np.minimum(n, 8)], eight[at + 8] & self._MASKS[np.maximum(n, 8) - 8], n.astype("<u8"))
        slot = self._slots(keys)
        self._find(keys, slot, short, entry)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            place = np.full(len(starts), -1)
            place[short] = np.arange(len(short))
            self._learn(data, starts[missing], ends[missing], missing, place[missing], keys, slot, entry)
        counts = self.count[entry]
        before = np.cumsum(counts) - counts
        total = int(counts.sum())
        return self.store[np.repeat(self.first[entry] - before, counts) + np.arange(total)], counts

    def _slots(self, keys) -> np.ndarray:
        a, b, c = self._FACTORS
        mixed = keys[0] * a ^ (keys[1] ^ keys[2]) * b
        mixed = (mixed ^ (mixed >> np.uint64(32))) * c
        return ((mixed >> np.uint64(32)) & np.uint64(SLOTS - 1)).astype(np.int64)

    def _find(self, keys, slot: np.ndarray, where: np.ndarray, entry: np.ndarray) -> None:
        """Fills in the entries of known words; ``slot`` becomes the free one where a new word goes."""
        left = np.arange(len(slot))
        while len(left):
            rows = self.rows[slot[left]]
            same = (rows[:, 0] == keys[0][left]) & (rows[:, 1] == keys[1][left]) & (rows[:, 2] == keys[2][left])
            entry[where[left[same]]] = rows[same, 3].astype(np.int64)
            left = left[~same & (rows[:, 2] != 0)]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)

    def _learn(self, data, starts, ends, missing, place, keys, slot, entry) -> None:
        """Makes the ids of words that are not in the table, and puts the short ones there."""
        new: dict[bytes, int] = {}
        made, found, at = [], [], []
        for p, start, end in zip(place.tolist(), starts.tolist(), ends.tolist(), strict=True):
            word = data[start:end]
            known = new if p >= 0 else self.longer
            number = known.get(word)
            if number is None:
                number = self.entries + len(made)
                made.append(self.make(word.decode()))
                if end - start <= LONGEST:
                    known[word] = number
                if p >= 0:
                    at.append(p)
            found.append(number)
        entry[missing] = found
        if not made:
            return
        counts = np.array([len(m) // 4 for m in made])
        ids = np.frombuffer(b"".join(made), "<u4")
        firsts = self.stored + np.cumsum(counts) - counts
        self.first = _set(self.first, self.entries, firsts)
        self.count = _set(self.count, self.entries, counts)
        self.store = _set(self.store, self.stored, ids)
        self.entries, self.stored = self.entries + len(made), self.stored + len(ids)
        at = np.array(at, np.int64)
        self._put([k[at] for k in keys], slot[at], np.array(list(new.values()), "<u8"))

    def _put(self, keys, slot: np.ndarray, entry: np.ndarray) -> None:
        """Puts different new words in, each from the free slot that its search ended at."""
        left = np.arange(len(slot))
        while len(left):
            free = left[self.rows[slot[left], 2] == 0]
            _, one = np.unique(slot[free], return_index=True)
            free = free[one]
            self.rows[slot[free]] = np.stack([*(k[free] for k in keys), entry[free]], axis=1)
            waits = np.ones(len(slot), bool)
            waits[free] = False
            left = left[waits[left]]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)


def _set(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from ``at`` on, twice as long when it is full."""
    if at + len(values) > len(array):
        longer = np.zeros(2 * (at + len(values)), array.dtype)
        longer[:at] = array[:at]
        array = longer
    array[at : at + len(values)] = values
    return array


#: Bytes that part words: all ASCII white space.
_PARTS = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))

# Kinds of ASCII bytes, no pattern spans two of them. White space, apostrophes and other bytes have none.
_LETTERS, _DIGITS, _SIGNS, _FEEDS = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[33:127] = _SIGNS
_KINDS[48:58] = _DIGITS
_KINDS[65:91] = _KINDS[97:123] = _LETTERS
_KINDS[39] = 0
#: First of two bytes that are a letter: U+00C0 to U+024F, U+0400 to U+047F; but two signs, and a letter that ends in a mark in lower case.
_LEADS = np.isin(np.arange(256), [*range(0xC3, 0xCA), 0xD0, 0xD1])
_NO_LETTERS = np.frombuffer("×÷İ".encode(), ">u2")


def _kind_changes(signs: np.ndarray, spaced: bool) -> np.ndarray:
    """Places where a piece ends for the patterns, as its neighbours are of different kinds.

    Without ``spaced`` each digit is a piece; with it a single line feed between two kinds is one.
    """
    kind = _KINDS[signs]
    lead = np.flatnonzero(_LEADS[signs])
    lead = lead[~np.isin(signs[lead].astype(np.uint16) << 8 | signs[lead + 1], _NO_LETTERS)]
    kind[lead] = kind[lead + 1] = _LETTERS
    if spaced:
        feeds = np.flatnonzero(signs == 10)
        kind[feeds[(kind[feeds - 1] != 0) & (kind[feeds + 1] != 0)]] = _FEEDS
    here, before = kind[1:], kind[:-1]
    change = here != before
    if not spaced:
        change |= here == _DIGITS
    change &= here != 0
    change &= before != 0
    return np.flatnonzero(change) + 1


class WordEncoder:
    """Encodes texts with a vocabulary file; ``spaced`` tells if a word keeps the space before it.

    As the library does by default, the literal of a special token in a text
    becomes its id; with ``plain_specials`` it is ordinary text.
    """

    def __init__(self, path: str, spaced: bool, plain_specials: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = None if plain_specials else _any_of([t.content for t in self.tokenizer.get_added_tokens_decoder().values()])
        self.model = self.tokenizer.model
        self.spaced = spaced
        self.pattern = _SPACED_PIECES if spaced else _BARE_PIECES
        self.pieces = _Memory(self._piece)
        self.words = _Memory(self._word)
        self.table = _Table(self._segment)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """``encode`` of each text in turn, many at a time."""
        chunk: list[str | np.ndarray] = []
        held = 0
        for text in texts:
            whole = not text or self.specials and self.specials.search(text) or self.spaced and self._odd(text)
            chunk.append(self.encode(text) if whole else text)
            held += len(chunk[-1])
            if held > CHUNK_SIGNS:
                yield from self._encode_chunk(chunk)
                chunk, held = [], 0
        yield from self._encode_chunk(chunk)

    def _encode_chunk(self, chunk: list[str | np.ndarray]) -> Iterator[np.ndarray]:
        """Ids of texts that can be cut at white space (before a space, where words keep it), and others as they are."""
        parts = [x.encode() for x in chunk if isinstance(x, str)]
        if not parts:
            yield from chunk
            return
        # A tab ends each text: it is white space, of no kind, and part of no word.
        data = b"\t".join(parts) + b"\t" + bytes(KEY_BYTES)
        signs = np.frombuffer(data, np.uint8)[:-KEY_BYTES]
        sizes = np.array([len(p) + 1 for p in parts])
        heads = np.cumsum(sizes) - sizes
        if self.spaced:
            starts = np.sort(np.concatenate((heads, np.flatnonzero(signs == 32), _kind_changes(signs, True))))
            ends = np.append(starts[1:], len(signs))
            ends[np.searchsorted(starts, heads[1:]) - 1] -= 1  # without the tab
            ends[-1] -= 1
        else:
            inside = np.flatnonzero(np.diff(~_PARTS[signs], prepend=False))
            changes = _kind_changes(signs, False)
            starts, ends = (np.sort(np.concatenate((x, changes))) for x in (inside[::2], inside[1::2]))
        ids, counts = [], []
        for low in range(0, len(starts), BLOCK_WORDS):
            part = slice(low, low + BLOCK_WORDS)
            found, n = self.table.ids(data, starts[part], ends[part])
            ids.append(found)
            counts.append(n)
        flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
        total = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
        bounds = iter(total[np.searchsorted(starts, np.append(heads, len(signs)))].tolist())
        low = next(bounds)
        for x in chunk:
            if isinstance(x, str):
                high = next(bounds)
                x, low = flat[low:high], high
            yield x

    def _segment(self, word: str) -> bytes:
        """Ids of what stands between two cuts."""
        written = word if self.spaced else word.lower()
        if _BEYOND.search(written) is None:
            pieces = self.pattern.findall(written)
            if len(pieces) == 1:  # kept by the table
                return self._piece(pieces[0])
            return b"".join(map(self.pieces.__getitem__, pieces))
        return self._word(word)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers; none for a null or empty text."""
        if not text:
            return np.empty(0, "<u4")
        if self.specials and self.specials.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        written = text if self.spaced else text.lower()
        if _BEYOND.search(written) is None:
            return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.pattern.findall(written))), "<u4")
        return np.frombuffer(b"".join(map(self.words.__getitem__, self._cut(text))), "<u4")

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that the library would merge by itself."""
        if piece.isascii() and piece.isprintable():
            symbols = piece.replace(" ", "Ġ") if piece[0] == " " else piece
        else:
            symbols = piece.encode().decode("latin-1").translate(_SYMBOLS)
        return array.array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _cut(self, text: str) -> list[str]:
        if not self.spaced:
            return _ASCII_SPACE.split(text)
        if self._odd(text):
            return _WORDS.findall(text) or [text]
        return text.replace(" ", "\0 ").split("\0")

    @staticmethod
    def _odd(text: str) -> bool:
        """Whether a space may lie beside white space or at an end, or the text has the sign used for cutting."""
        if "  " in text or "\n " in text or " \n" in text or text[0] == " " or text[-1] == " " or "\0" in text:
            return True
        rare = any(c in text for c in _RARE_ASCII_SPACE) or (not text.isascii() and _RARE_SPACE.search(text))
        return bool(rare) and _TWO_SPACES.search(text) is not None

    def _word(self, word: str) -> bytes:
        if not (word[1:] if word[:1] == " " else word).isalpha():
            pieces = _INNER.split(word)
            if len(pieces) > 1:
                return b"".join([self.words[p] for p in pieces])
        return array.array("I", self._ids(word)).tobytes()

    def _ids(self, piece: str) -> list[int]:
        if not piece:
            return []
        space = self.spaced and piece[0] == " "
        plain = piece[1:] if space else piece
        if plain.isalpha() and (plain.isascii() or _LATIN.fullmatch(plain)):  # one word for the patterns: only merges are left
            if not self.spaced:
                plain = plain.lower()
            symbols = plain if plain.isascii() else plain.encode().decode("latin-1").translate(_SYMBOLS)
            return [t.id for t in self.model.tokenize("Ġ" + symbols if space else symbols)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids


_encoders: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, spaced: bool) -> WordEncoder:
    """One per worker process and vocabulary."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = WordEncoder(path, spaced)
    return _encoders[path, spaced]


def byte_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def largest_id(path: str) -> int:
    """The largest id of a vocabulary file, its added tokens included."""
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1
