"""Token ids of whole texts with a public tokenizer file, piece by piece through a bounded cache.

Both tokenizer kinds cut a text into pieces (words, digits, marks) and encode each piece alone. For
texts of plain Latin characters the cut is made here, for many texts at once, and each piece that is
not cached goes to the library's model; all other texts go to the library whole. Tests hold both
ways against the library's own encoding of the whole texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

CACHE_PIECES = 500_000  # kept by one worker, about 50 bytes each; a full cache is emptied
BLOCK_CHARS = 400_000  # texts are treated in blocks of this size, longer ones are cut between words

# Beyond these characters, letter and digit classes of the two languages need not agree.
_unusual = re.compile("[^\n\x20-\x7e¡-©«-±´¶-¸»¿-ÿ]")
_between_words = re.compile(r"(?<=\S)[ \n](?=\S)")
_SHORT_FORMS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")  # fixed value: the tokenizers' own list
_tokenizers: dict[tuple[str, bool], PieceTokenizer] = {}

LETTER, DIGIT, SPACE, MARK, EDGE = range(5)
_KINDS = np.full(256, MARK, dtype=np.uint8)
_KINDS[[ord(c) for c in map(chr, range(1, 256)) if c.isalpha()]] = LETTER
_KINDS[[ord(c) for c in "0123456789"]] = DIGIT
_KINDS[[ord(" "), ord("\n")]] = SPACE
_KINDS[0] = EDGE
_LOWER = np.array([ord(chr(b).lower()) for b in range(256)], dtype=np.uint8)


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


LONG_SLICE = 512


class SliceHash:
    """A 64-bit hash of many slices of one byte array at once, eight bytes of each at a time.

    Every eight bytes are mixed with what came before, so no algebra of the bytes makes slices
    collide, as it does for polynomials modulo 2**64. Long slices take a cryptographic hash.
    """

    def __init__(self, seed: int):
        self.seed = np.uint64(seed)

    def slices(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        left = ends - begins
        out = mixed(left.astype(np.uint64) + self.seed)
        rows, at = np.flatnonzero((left > 0) & (left <= LONG_SLICE)), begins.copy()
        while len(rows):
            size = np.minimum(left[rows], 8).astype(np.uint64)
            lane = lanes[at[rows]] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - size * np.uint64(8)))
            out[rows] = mixed(out[rows] * np.uint64(0x9E3779B97F4A7C15) + lane)
            at[rows] += 8
            left[rows] -= 8
            rows = rows[left[rows] > 0]
        for k in np.flatnonzero(ends - begins > LONG_SLICE):
            key = int(self.seed).to_bytes(8, "little")
            digest = hashlib.blake2b(data[begins[k] : ends[k]].tobytes(), digest_size=8, key=key).digest()
            out[k] = np.uint64(int.from_bytes(digest, "little"))
        return out


class PieceTokenizer:
    """Encodes lists of texts; ``spaces`` tells whether white space and letter case matter."""

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # such strings in a text are ordinary text
        self.spaces = spaces
        self.letters = _byte_letters()
        self.first, self.second = SliceHash(0x9E3779B97F4A7C15), SliceHash(0xD1B54A32D192ED03)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted; the next arrays follow their order
        self.checks = np.zeros(0, dtype=np.uint64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _begins(self, data: np.ndarray) -> np.ndarray:
        """Where pieces begin: the tokenizers' cutting rule for these characters."""
        kind = _KINDS[data]
        before = np.concatenate([[np.uint8(EDGE)], kind[:-1]])
        begin = (kind != before) | (kind == EDGE)
        blank_before = np.concatenate([[False], data[:-1] == 32])
        if self.spaces:
            after = np.concatenate([kind[1:], [np.uint8(EDGE)]])
            last_space = (kind == SPACE) & (after != SPACE) & (after != EDGE)
            begin |= last_space  # the last one of several; a blank joins the word that follows it
            begin &= ~((kind != SPACE) & (kind != EDGE) & blank_before)
        else:
            begin |= kind == DIGIT
        for at in np.flatnonzero((data == 39) & (before != MARK) & ~(blank_before & self.spaces)):
            form = next((f for f in _SHORT_FORMS if data[at : at + len(f)].tobytes() == f), None)
            if form:
                end = at + len(form)
                begin[at], begin[at + 1 : end] = True, False
                if end < len(data):
                    begin[end] = begin[end] or kind[end] in (LETTER, DIGIT)
        return np.flatnonzero(begin)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[bytes]) -> None:
        tokenize, letters = self.library.model.tokenize, self.letters
        ids = [[t.id for t in tokenize(p.decode("latin-1").encode().decode("latin-1").translate(letters))] for p in pieces]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, np.fromiter((x for y in ids for x in y), np.uint32, int(sizes.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts, all cut and looked up together."""
        if len(self.keys) > CACHE_PIECES:
            self._reset()
        data = np.frombuffer(("\0".join(texts) + "\0").encode("latin-1"), dtype=np.uint8)
        if not self.spaces:
            data = _LOWER[data]
        begins = self._begins(data)
        ends = np.append(begins[1:], len(data))
        first = data[begins]
        wanted = (first != 0) if self.spaces else (_KINDS[first] != EDGE) & (_KINDS[first] != SPACE)
        text_of = np.cumsum(first == 0)[wanted]  # every text ends with an edge
        begins, ends = begins[wanted], ends[wanted]
        keys, checks = (h.slices(data, begins, ends) for h in (self.first, self.second))
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        missing = np.ones(len(unique), dtype=bool)
        inside = at < len(self.keys)
        missing[inside] = self.keys[at[inside]] != unique[inside]
        if missing.any():
            new = where[missing]
            raw = data.tobytes()
            self._learn(unique[missing], checks[new], [raw[b:e] for b, e in zip(begins[new], ends[new], strict=True)])
            at = np.searchsorted(self.keys, unique)
        at = at[inverse]
        if not np.array_equal(self.checks[at], checks):  # two pieces with one key: practically never
            return [self._whole(t) for t in texts]
        sizes = self.sizes[at]
        offsets = np.cumsum(sizes) - sizes
        ids = self.flat[np.repeat(self.starts[at] - offsets, sizes) + np.arange(int(sizes.sum()))]
        counts = np.bincount(text_of, weights=sizes, minlength=len(texts)).astype(np.int64)
        return np.split(ids, np.cumsum(counts)[:-1])

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """All ids of each text as unsigned 32-bit integers; none for null and empty texts."""
        waiting: list[tuple[list[str], bool]] = []
        chars = 0
        for text in texts:
            parts = _parts(text or "")
            waiting.append((parts, bool(_unusual.search(text or ""))))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield from self._flush(waiting)
                waiting, chars = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[tuple[list[str], bool]]) -> Iterator[np.ndarray]:
        plain = [p for parts, unusual in waiting if not unusual for p in parts]
        done, block, size = [], [], 0
        for p in plain:
            block.append(p)
            size += len(p)
            if size >= BLOCK_CHARS:
                done += self._block(block)
                block, size = [], 0
        done += self._block(block) if block else []
        at = iter(done)
        for parts, unusual in waiting:
            yield self._whole("".join(parts)) if unusual else np.concatenate([next(at) for _ in parts])


def _parts(text: str) -> list[str]:
    """A long text cut between words, so that its parts can be encoded one after the other."""
    parts, begin = [], 0
    while len(text) - begin > BLOCK_CHARS and (m := _between_words.search(text, begin + BLOCK_CHARS)):
        parts.append(text[begin : m.start()])
        begin = m.start()
    return [*parts, text[begin:]]


def tokenizer(path: str, spaces: bool) -> PieceTokenizer:
    """One tokenizer for each worker process and file."""
    if (path, spaces) not in _tokenizers:
        _tokenizers[path, spaces] = PieceTokenizer(path, spaces)
    return _tokenizers[path, spaces]
