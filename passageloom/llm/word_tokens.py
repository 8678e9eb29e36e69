"""Token ids of a public word-level BPE file, many whole texts at a time.

The file's own library is exact but slow. The words of this vocabulary are merged independently of each other, so each
distinct piece between blanks is encoded once and looked up afterwards, with its bytes compared. New pieces go through a
faster BPE engine in which one blank after the word plays the end marker of the file; its ranks follow from the file by
rule, nothing is trained. Texts outside the simple alphabet below go through the library itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import numpy as np

from passageloom.llm.byte_words import CHUNK_BYTES, NOT_SPACE, hashes, in_chunks, ragged, word_bounds

# Characters below are split by the pattern here; other ones, and apostrophes (contractions), take the slow way.
SIMPLE_LIMIT = 0x180
WORD_END = "</w>"
SLOTS = 1 << 20
#: Ids remembered by a Python worker before it starts afresh, which bounds its memory and changes no result.
REMEMBERED_IDS = 6_000_000


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies (a public convention)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(SIMPLE_LIMIT) if test(chr(c)))


LETTERS, NUMBERS = _class(str.isalpha), _class(lambda c: c.isnumeric() and not c.isalpha())
WORDS = re.compile(f"\n|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
# By UTF-8 byte: apostrophe, the separators 1C to 1F (white space in some libraries only), the lead bytes from C6 on.
NOT_SIMPLE = np.array([b == 0x27 or 0x1C <= b <= 0x1F or b > 0xC5 for b in range(256)])


class WordTokenizer:
    """The ids equal ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        to_byte = _byte_characters()

        def raw(token: str) -> bytes:
            ended = token.endswith(WORD_END)
            body = token[: -len(WORD_END)] if ended else token
            return bytes(to_byte[c] for c in body) + b" " * ended

        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        start = {raw(t): i for t, i in vocabulary.items() if len(t.removesuffix(WORD_END)) == 1}
        # Marked bytes first, then the merges in their order: an engine that joins the lowest rank works as the file says.
        order = sorted(start, key=lambda b: (len(b), start[b]))
        ids = [start[b] for b in order]
        ranks = {b: i for i, b in enumerate(order)}
        for left, right in merges:
            piece = raw(left + right)
            if piece not in ranks:
                ranks[piece] = len(ids)
                ids.append(vocabulary[left + right])
        self.fast = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.to_id = np.array(ids, dtype=np.uint32)
        self.line_break = ranks[b"\n "]
        self._forget()

    def _forget(self) -> None:
        self.flat, self.bytes = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint8)
        # By slot: the hash, the place and number of the ids, the place and number of the bytes.
        self.hash = np.zeros(SLOTS, dtype=np.uint64)
        self.place = np.zeros((4, SLOTS), dtype=np.int32)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after the other, and the number of each."""
        text = b"\n".join(pieces).decode("utf-8") + "\n"
        ranks = self.fast.encode_to_numpy(" ".join(WORDS.findall(text)) + " ", disallowed_special=())
        ends = np.flatnonzero(ranks == self.line_break)
        return self.to_id[ranks[ranks != self.line_break]], np.diff(ends, prepend=-1) - 1

    def _simple_ids(self, joined: bytes, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lower-cased bytes, and how many of them lie before each of the byte positions ``until``."""
        if len(self.flat) > REMEMBERED_IDS:
            self._forget()
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = word_bounds(data, NOT_SPACE)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(until), dtype=np.int64)
        h, size = hashes(data, starts, ends), ends - starts
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        at, count, byte_at, byte_count = self.place[:, slot].astype(np.int64)
        known = np.flatnonzero((self.hash[slot] == h) & (byte_count == size))
        same = data[ragged(starts[known], size[known])] == self.bytes[ragged(byte_at[known], size[known])]
        exact = np.logical_and.reduceat(same, np.cumsum(size[known]) - size[known]) if len(known) else np.zeros(0, dtype=bool)
        new = np.ones(len(h), dtype=bool)
        new[known[exact]] = False
        if new.any():
            where = np.flatnonzero(new)
            spans = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(s, len(number)) for s in spans], dtype=np.int64)
            first = np.zeros(len(number), dtype=np.int64)
            first[which[::-1]] = where[::-1]
            ids, sizes = self._encode(list(number))
            new_at = len(self.flat) + np.cumsum(sizes) - sizes
            at[where], count[where] = new_at[which], sizes[which]
            new_bytes = size[first]
            taken = np.stack([new_at, sizes, len(self.bytes) + np.cumsum(new_bytes) - new_bytes, new_bytes])
            self.hash[slot[first]] = h[first]
            self.place[:, slot[first]] = taken
            self.flat = np.concatenate([self.flat, ids])
            self.bytes = np.concatenate([self.bytes, data[ragged(starts[first], new_bytes)]])
        before = np.concatenate([[0], np.cumsum(count)])
        return self.flat[ragged(at, count)], before[np.searchsorted(starts, until)]

    def _long_ids(self, text: bytes) -> np.ndarray:
        """As above for one text, in pieces that end at a blank."""
        parts, start = [], 0
        while start < len(text):
            end = start + CHUNK_BYTES
            if end < len(text):
                cut = max(text.rfind(b" ", start, end), text.rfind(b"\n", start, end))
                if cut < 0:
                    cuts = [c for c in (text.find(b" ", end), text.find(b"\n", end)) if c >= 0]
                    cut = min(cuts, default=len(text))
                end = max(cut, start + 1)
            parts.append(self._simple_ids(text[start:end], np.zeros(0, dtype=np.int64))[0])
            start = end
        return np.concatenate(parts)

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        lowered = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        out: list[np.ndarray] = []
        for part in in_chunks([len(b) for b in lowered]):
            chunk = lowered[part]
            simple = [not NOT_SIMPLE[np.frombuffer(b, dtype=np.uint8)].any() and b"<|" not in b for b in chunk]
            short = [b if ok and len(b) <= CHUNK_BYTES else b"" for b, ok in zip(chunk, simple)]
            until = np.cumsum([len(b) + 1 for b in short])
            flat, ends = self._simple_ids(b"\n".join(short), until)
            starts = np.concatenate([[0], ends[:-1]])
            for text, b, ok, x, y in zip(texts[part], chunk, simple, starts, ends):
                if not ok:
                    out.append(np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32))
                else:
                    out.append(flat[x:y] if len(b) <= CHUNK_BYTES else self._long_ids(b))
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]
