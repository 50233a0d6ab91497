"""BPE encoding and decoding with batched merge rounds in numpy."""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import SLICE_BYTES, map_texts

#: White space as the vocabulary file's pattern means it.
_WHITE = r"\t-\r \x85\xa0  -     　"
#: The vocabulary file's own pattern, white space spelled out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WHITE}\p{{L}}\p{{N}}]+"
#: Encoded words that a worker remembers, and their longest length in bytes.
REMEMBERED, LONGEST = 150_000, 64
NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Bpe:
    """A word-end BPE vocabulary: lower case, white space dropped, bytes as letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("not a vocabulary of the supported kind")
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t.encode() for t, i in {**self.vocab, **self.special}.items()}
        self.width = max(self.tokens) + 1
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([self.vocab[c + suffix] for c in letters], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([self.vocab[a] * self.width + self.vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], dtype=np.int64)
        # a round merges a word's lowest pair wherever it occurs; that equals one at a time only if
        # no merge can make a pair of lower rank
        born = dict(zip(made.tolist(), range(len(made)), strict=True))
        if len(born) != len(made) or any(max(born.get(self.vocab[a], -1), born.get(self.vocab[b], -1)) >= r for r, (a, b) in enumerate(pairs)):
            raise ValueError("merges are not in the order of their making")
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.pattern = regex.compile(rf"\n|{PATTERN}")
        self.marks = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        self.known: dict[bytes, bytes] = {}

    def _words(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all words of texts without ASCII white space, the words' lengths, and each word's text.

        All texts go through the normaliser and the pattern at once, a line each: no word, composition or
        pattern crosses a line.
        """
        text = b"\n".join(chunks).decode()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # letter by letter: a whole text's lower case would treat a last sigma otherwise
            text = "σ".join(part.lower() for part in text.split("Σ"))
        else:
            text = text.lower()
        items = np.frombuffer(" ".join(self.pattern.findall(text)).encode() + b" ", np.uint8)
        blanks = np.flatnonzero(items == 32)
        starts = np.r_[0, blanks[:-1] + 1]
        lines = items[starts] == 10
        lengths, owner = (blanks - starts)[~lines], np.cumsum(lines)[~lines]
        some = lengths > 0  # no item at all leaves one empty word
        return items[(items != 32) & (items != 10)], lengths[some], owner[some]

    def encode_words(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and how many each word has, from the words' bytes and lengths.

        The symbols of all words lie in one array. In every round the ranks of new neighbours are found by
        binary search over the sorted pair keys, each word's lowest pair is merged from left to right, and words
        without a pair leave. A word of n letters takes n rounds at most.
        """
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(lengths)), lengths)
        place, rank = self._ranks(symbols, word, np.arange(len(symbols)))
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
            ready = lowest == NONE
            if ready.any():
                done_symbols.append(symbols[ready])
                done_words.append(word[ready])
            at = np.flatnonzero((rank == lowest) & ~ready)
            left = ~ready
            if len(at):
                # of pairs that overlap, as in a row of equal symbols, every second one from the left
                runs = np.flatnonzero(np.r_[True, np.diff(at) > 1])
                at = at[(np.arange(len(at)) - np.repeat(runs, np.diff(np.r_[runs, len(at)]))) % 2 == 0]
                symbols[at] = self.made[place[at]]
                left[at + 1] = False
            fresh = np.cumsum(left)[at] - 1
            symbols, word, place, rank = symbols[left], word[left], place[left], rank[left]
            if len(at):
                changed = np.zeros(len(symbols) + 1, bool)
                changed[fresh] = changed[fresh - 1] = True  # place -1 is the spare one
                changed = np.flatnonzero(changed[:-1])
                place[changed], rank[changed] = self._ranks(symbols, word, changed)
        flat, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_symbols, done_words))
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(lengths))

    def _ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the pairs that begin ``at``, where they lie in the sorted keys, and their ranks."""
        after = np.minimum(at + 1, len(symbols) - 1)
        pairs = symbols[at] * self.width + symbols[after]
        place = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        found = (self.keys[place] == pairs) & (word[after] == word[at]) & (after > at)
        return place, np.where(found, self.ranks[place], NONE)

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each text without ASCII white space as little-endian 32-bit integers."""
        if not chunks:
            return []
        raw, lengths, owner = self._words(chunks)
        if not len(lengths):
            return [b""] * len(chunks)
        flat, counts = self.encode_words(raw, lengths)
        per_chunk = np.bincount(owner, weights=counts, minlength=len(chunks)).astype(np.int64)
        data, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(per_chunk)).tolist()
        return [data[begin:end] for begin, end in zip([0, *ends], ends, strict=False)]

    def _encode_marked(self, chunks: list[bytes]) -> list[bytes]:
        """The same for texts that hold special tokens, which stand for themselves."""
        parts, marks = [], []
        for chunk in chunks:
            text, at, own = chunk.decode(), 0, []
            for mark in self.marks.finditer(text):
                parts.append(text[at : mark.start()].encode())
                own.append(self.special[mark[0]].to_bytes(4, "little"))
                at = mark.end()
            parts.append(text[at:].encode())
            marks.append(own)
        plain = iter(self._encode_chunks(parts))
        return [b"".join([*(x for mark in own for x in (next(plain), mark)), next(plain)]) for own in marks]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for n, text in enumerate(texts):
            for part in _parts(text):
                held.append((n, part.split()))
                size += len(part)
                if size >= SLICE_BYTES:
                    self._encode_held(held, out)
                    held, size = [], 0
        self._encode_held(held, out)
        return [b"".join(parts) for parts in out]

    def _encode_held(self, held: list[tuple[int, list[bytes]]], out: list[list[bytes]]) -> None:
        known, new = self.known, set()
        for _, chunks in held:
            new.update(chunks)
        fresh = list(new.difference(known))
        marked = [c for c in fresh if b"<" in c and self.marks.search(c.decode())] if self.marks else []
        known.update(zip(marked, self._encode_marked(marked), strict=True))
        plain = list(set(fresh).difference(marked)) if marked else fresh
        known.update(zip(plain, self._encode_chunks(plain), strict=True))
        for n, chunks in held:
            out[n].append(b"".join(map(known.__getitem__, chunks)))
        for chunk in fresh:
            if len(chunk) > LONGEST:
                del known[chunk]
        if len(known) > REMEMBERED:
            known.clear()

    def decode(self, ids: bytes) -> bytes:
        """The tokens, special ones too, with a blank between."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _parts(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A long text cut at ASCII white space, where no word or letter composition goes on."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if not space:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


_SPACE = regex.compile(rb"[ \t\n\r\x0b\x0c]")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit integers) of every whole text.

    A null or empty text has no ids. Each row is encoded by itself, so repeated rows repeat; other columns are not
    read. The vocabulary is read from ``path`` on every worker.
    """

    def work(texts: list[bytes]) -> dict[str, list]:
        ids = load(path).encode(texts)
        return {"n_tokens": [len(i) // 4 for i in ids], "ids": ids}

    return map_texts(docs, "n_tokens long, ids binary", work, id_col, text_col, raw=True)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids, decoded from ids as :func:`encode` gives them; null ids count as none."""

    def work(ids: list[bytes]) -> dict[str, list]:
        bpe = load(path)
        return {"ids": ids, "decoded": [bpe.decode(i).decode() for i in ids]}

    return map_texts(encoded, "ids binary, decoded string", work, id_col, ids_col, raw=True)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, decoded: :func:`encode` and then :func:`decode` in one pass of one worker."""

    def work(texts: list[bytes]) -> dict[str, list]:
        bpe = load(path)
        ids = bpe.encode(texts)
        return {"n_tokens": [len(i) // 4 for i in ids], "ids": ids, "decoded": [bpe.decode(i).decode() for i in ids]}

    return map_texts(docs, "n_tokens long, ids binary, decoded string", work, id_col, text_col, raw=True)
