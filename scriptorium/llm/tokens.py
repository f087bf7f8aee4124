"""Token ids of many texts by a public tokenizer, a word at a time.

The vocabulary drops white space and never joins pieces across it, so the ids of
a text are those of its white-space-separated words, and each word is encoded
once a worker.  Letters with marks after them are looked up by their letters, as
case is dropped and the two are always apart.  Texts with separators on which
Python and the tokenizer differ are encoded whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .worker import kept

#: Separators of words that the tokenizer takes for signs, capitals whose small
#: letter hangs on the context, and the opening of special tokens.
ODD = "\x1c", "\x1d", "\x1e", "\x1f", "<|"
ODD_BEYOND_ASCII = "\u180e", "\u0130", "\u03a3"
MARKS = ".,;:!?*%$&#|"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def odd(text: str) -> bool:
    return any(c in text for c in ODD) or not text.isascii() and any(c in text for c in ODD_BEYOND_ASCII)


def strings(words: pa.Array) -> list[str]:
    """Words without line feeds as Python strings, which taking a long string apart makes fastest."""
    if not len(words):
        return []
    offsets = pa.array([0, len(words)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), "\n")[0].as_py().split("\n")


class Merges:
    """Byte-pair merges of many words at once, on flat arrays: each round merges in
    every word its leftmost pair of lowest rank, and words without one are done."""

    NONE = 1 << 30
    ODD_NUMBERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)

    def __init__(self, model: dict):
        vocab, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        end = model.get("end_of_word_suffix") or ""
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in shown]
        signs = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.inner = np.array([vocab[signs[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[signs[b] + end] for b in range(256)], np.int64)
        self.size = len(vocab)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.uint64)
        self.tables, rank = [], np.arange(len(keys))
        for odd, bits in zip(self.ODD_NUMBERS, (20, 18, 18), strict=True):
            slot = self._slot(keys, odd, bits)
            _, first = np.unique(slot, return_index=True)
            held, ranks = np.full(1 << bits, np.uint64(1 << 63)), np.full(1 << bits, self.NONE)
            held[slot[first]], ranks[slot[first]] = keys[first], rank[first]
            self.tables.append((odd, bits, held, ranks))
            keys, rank = np.delete(keys, first), np.delete(rank, first)
        if len(keys):
            raise ValueError("the merges don't fit the lookup tables")

    @staticmethod
    def _slot(keys: np.ndarray, odd: int, bits: int) -> np.ndarray:
        return ((keys * np.uint64(odd)) >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left * self.size + right).astype(np.uint64)
        found = np.full(len(keys), self.NONE)
        for odd, bits, held, ranks in self.tables:
            slot = self._slot(keys, odd, bits)
            found = np.where(held[slot] == keys, ranks[slot], found)
        return found

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has; words aren't empty and hold no line feed."""
        data = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        stops = np.flatnonzero(data == 10)
        sizes = np.diff(np.concatenate([[-1], stops])) - 1
        symbols = self.inner[data]
        symbols[stops - 1] = self.last[data[stops - 1]]
        symbols = np.delete(symbols, stops)
        number = np.arange(len(words))
        ranks = np.concatenate([self._ranks(symbols[:-1], symbols[1:]), [self.NONE]])
        ranks[np.cumsum(sizes) - 1] = self.NONE
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(number):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest < self.NONE
            if not live.all():
                of = np.repeat(live, sizes)
                done.append((number[~live], sizes[~live], symbols[~of]))
                symbols, ranks, number, sizes, lowest = symbols[of], ranks[of], number[live], sizes[live], lowest[live]
                continue
            word = np.repeat(np.arange(len(sizes)), sizes)
            hits = np.flatnonzero(ranks == lowest[word])
            at = hits[np.concatenate([[True], np.diff(word[hits]) > 0])] if len(hits) else hits
            symbols[at] = self.merged[lowest]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, sizes = symbols[keep], ranks[keep], sizes - 1
            at -= np.arange(len(at))
            ends = np.cumsum(sizes)
            before = at[at > ends - sizes] - 1
            ranks[before] = self._ranks(symbols[before], symbols[before + 1])
            ranks[ends - 1] = self.NONE
            after = at[at < ends - 1]
            ranks[after] = self._ranks(symbols[after], symbols[after + 1])
        number = np.concatenate([d[0] for d in done])
        sizes = np.concatenate([d[1] for d in done])
        symbols = np.concatenate([d[2] for d in done])
        order = np.argsort(number, kind="stable")
        starts = np.cumsum(sizes) - sizes
        sizes = sizes[order]
        ends = np.cumsum(sizes)
        return symbols[np.arange(len(symbols)) + np.repeat(starts[order] - (ends - sizes), sizes)], sizes


class WordTokenizer:
    """Ids by small-letter words; at most max_words are remembered, then it starts anew."""

    LONGEST = 80

    def __init__(self, path: str, max_words: int = 600_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f)["model"])
        self.max_words = max_words
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.cores: dict[str, bytes] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words of letters alone by merges, others as the tokenizer splits them."""
        plain = [w for w in words if w.isalpha() and len(w) <= self.LONGEST and unicodedata.is_normalized("NFC", w)]
        found = dict.fromkeys(words, b"")
        if plain:
            ids, sizes = self.merges.encode(plain)
            raw, ends = ids.astype(np.uint16).tobytes(), (2 * np.cumsum(sizes)).tolist()
            found.update(zip(plain, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        apart = set(plain)
        others = [w for w in words if w and w not in apart]
        for w, e in zip(others, self.whole.encode_batch_fast(others, add_special_tokens=False), strict=True):
            found[w] = np.array(e.ids, np.uint16).tobytes()
        return list(found.values())

    def _added(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Numbers words; ids: those of all of them in a row."""
        first = len(self.index)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids])

    def _learn_letters(self, words: pa.Array, cores: pa.Array) -> None:
        """Words of ASCII letters, the cores, with marks after them or none: all in arrays."""
        coded = cores.dictionary_encode()
        flat, sizes = self.merges.encode(strings(coded.dictionary))
        core = coded.indices.to_numpy()
        after = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        mark, marks = np.zeros(len(words), np.int64), [""]
        for n in np.unique(after[after > 0]).tolist():
            at = np.flatnonzero(after == n)
            ends = pc.utf8_slice_codeunits(words.take(pa.array(at)), -n).dictionary_encode()
            mark[at] = len(marks) + ends.indices.to_numpy()
            marks += ends.dictionary.to_pylist()
        new = [m for m in marks if m not in self.cores]
        if new:
            self.cores.update(zip(new, self._encode(new), strict=True))
        ids = [np.frombuffer(self.cores[m], np.uint16) for m in marks]
        flat = np.concatenate([flat.astype(np.uint16), *ids])
        sizes = np.concatenate([sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
        starts = np.cumsum(sizes) - sizes
        pieces = np.stack([core, len(coded.dictionary) + mark], axis=1).ravel()  # a core and its marks, word by word
        n = sizes[pieces]
        ends = np.cumsum(n)
        self._added(strings(words), flat[np.arange(ends[-1]) + np.repeat(starts[pieces] - (ends - n), n)], n.reshape(-1, 2).sum(axis=1))

    def _learn(self, words: list[str]) -> None:
        parts: list[tuple[str, str]] = []
        for w in words:
            core = w if w.isalpha() else w.rstrip(MARKS)
            apart = core.isalpha() and unicodedata.is_normalized("NFC", core)  # others may end in a mark that joins what follows
            parts.append((core, w[len(core) :]) if apart else (w, ""))
        cores = self.cores
        new = list(dict.fromkeys(x for p in parts for x in p if x not in cores))
        cores.update(zip(new, self._encode(new), strict=True))
        cores[""] = b""
        ids = [cores[a] + cores[b] for a, b in parts]
        self._added(words, np.frombuffer(b"".join(ids), np.uint16), np.fromiter(map(len, ids), np.int64, len(ids)) // 2)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts' words, and how many each text has.  Arrow splits and
        numbers the words, so that only different ones come to Python."""
        split = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
        coded = split.flatten().dictionary_encode()
        words = strings(coded.dictionary)
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(at < 0)
        if len(unseen):
            if self.index and len(self.index) + len(unseen) > self.max_words:
                self.forget()
                unseen = np.arange(len(words))
            new = coded.dictionary.take(pa.array(unseen))
            cores = pc.ascii_rtrim(new, MARKS)
            letters = pc.and_(pc.ascii_is_alpha(cores), pc.less_equal(pc.binary_length(cores), self.LONGEST)).to_numpy(zero_copy_only=False)
            quick, slow = np.flatnonzero(letters), np.flatnonzero(~letters)
            at[unseen[np.concatenate([quick, slow])]] = np.arange(len(self.index), len(self.index) + len(unseen))
            for k in range(0, len(quick), 200_000):
                some = pa.array(quick[k : k + 200_000])
                self._learn_letters(new.take(some), cores.take(some))
            others = strings(new.take(pa.array(slow)))
            for k in range(0, len(others), 50_000):
                self._learn(others[k : k + 50_000])
        return at[coded.indices.to_numpy()] if len(words) else at, np.diff(split.offsets.to_numpy()).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        apart = {i: np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint16) for i, t in enumerate(texts) if odd(t)}
        at, counts = self.words(["" if i in apart else t for i, t in enumerate(texts)] if apart else texts)
        starts, sizes = self.starts[at], np.diff(self.starts)[at] if len(at) else np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]
        words = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], ends])[words]
        lengths = np.diff(bounds)
        if apart:
            pieces = [apart.get(i, flat[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
            flat, lengths = np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        return flat, lengths

    def lengths(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has."""
        at, counts = self.words(texts)
        sizes = np.concatenate([[0], np.cumsum(np.diff(self.starts)[at])]) if len(at) else np.zeros(1, np.int64)
        found = np.diff(sizes[np.concatenate([[0], np.cumsum(counts)])])
        for i, t in enumerate(texts):
            if odd(t):
                found[i] = len(self.whole.encode(t, add_special_tokens=False).ids)
        return found


def tokenizer_key(path: str) -> str:
    return f"tokenizer {path}"


def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, which keeps it from task to task."""
    return kept(tokenizer_key(path), lambda: WordTokenizer(path))


def blocks(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices over rows whose sizes add up to about most."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts or bytes in a column make about most bytes, so
    that only a part at a time becomes Python objects."""
    for s in blocks(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist(), most):
        yield batch.slice(s.start, s.stop - s.start)
