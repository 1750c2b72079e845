"""Byte-pair encodings read from a tokenizers file, without the library.

``Bpe`` holds the file's vocabulary and merges as numpy arrays.  ``merge``
works on many words at once: the words are one ragged array of symbols, and in
each round every word merges its pair of lowest rank, all words together.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level files:
    bytes that print stand for themselves, the others follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return letters


# Fixed value: the split pattern that byte-level files imply.
GPT2_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Bytes of a word above which it is merged by itself.
LONG = 256


class Bpe:
    """``path``: a tokenizers .json with a BPE model over bytes."""

    def __init__(self, path: str):
        self.path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lower = bool(spec["normalizer"])
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64) if self.end else self.first
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.new = key[order], order.astype(np.int64), new
        # One probe finds nearly every pair: a hash of the key names its slot.
        self.bits = 20
        self.table_key = np.full(1 << self.bits, -1, np.int64)
        self.table_rank = np.zeros(1 << self.bits, np.int64)
        slot = self._slot(self.key)
        self.table_key[slot], self.table_rank[slot] = self.key, self.rank
        self.late = self.table_key[slot] != self.key           # lost their slot to another
        self.late_key, self.late_rank = self.key[self.late], self.rank[self.late]
        if spec["normalizer"]:
            split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        else:
            split = GPT2_SPLIT
        self.split = regex.compile(split).findall
        # The same without look-ahead, for texts whose blanks stand alone.
        self.marks = split.replace(r"\s+(?!\S)|\s+", r"\n") if not self.lower else split
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        back = {c: b for b, c in enumerate(letters)}
        self.token_of = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in (vocab | self.special).items():
            self.token_of[i] = token
        self.bytes_of = [t.encode() if t in self.special or not all(c in back for c in t) else bytes(back[c] for c in t)
                         for t in self.token_of]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of ids; a very large number if there is none."""
        key = left << 20 | right
        slot = self._slot(key)
        out = np.where(self.table_key[slot] == key, self.table_rank[slot], np.int64(1 << 40))
        miss = np.flatnonzero(out == 1 << 40)
        if len(miss) and len(self.late_key):
            at = np.minimum(np.searchsorted(self.late_key, key[miss]), len(self.late_key) - 1)
            hit = self.late_key[at] == key[miss]
            out[miss[hit]] = self.late_rank[at[hit]]
        return out

    def normal(self, text: str) -> str:
        """The file's normalizer: NFC and lower case, letter by letter (so that
        a capital sigma never becomes a final one)."""
        if not self.lower:
            return text
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words -> (all ids in a row, the count of each word).

        Words above ``LONG`` bytes, which need many rounds, are merged each by
        itself (``merge_long``); the others together (``merge_all``).
        """
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self.merge_all(words)
        apart = set(long)
        ids, n = self.merge_all([w for i, w in enumerate(words) if i not in apart])
        rest = iter(np.split(ids, np.cumsum(n)[:-1]) if len(n) else [])
        parts = [self.merge_long(w) if i in apart else next(rest) for i, w in enumerate(words)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word, rank by rank: the places of each rank's pairs wait in
        a list of their own, and only the neighbours of merged pairs get new ranks."""
        none = np.int64(1 << 40)
        flat = np.frombuffer(word, np.uint8)
        ids = self.first[flat]
        ids[-1] = self.last[flat[-1]]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)         # n: behind the last
        rank = np.append(self.ranks(ids[:-1], ids[1:]), none)              # of the pair that begins here
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[rank[at] < none]
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            cut = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cut) if len(at) else ():
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            parts = waiting.pop(r)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            at = at[rank[at] == r]                        # those that nothing has changed since
            if not len(at):
                continue
            touch = np.concatenate(([False], after[at[:-1]] == at[1:]))    # x x x: the third waits
            if touch.any():
                run = np.flatnonzero(~touch)
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            gone = after[at]
            ids[at] = self.new[r]
            rank[gone] = -1
            after[at] = after[gone]
            inside = after[at] < n
            before[after[at[inside]]] = at[inside]
            near = np.concatenate((at, before[at]))
            near = np.unique(near[near >= 0])
            near = near[rank[near] != -1]
            has = after[near] < n
            rank[near[~has]] = none
            near = near[has]
            rank[near] = self.ranks(ids[near], ids[after[near]])
            wait(near)
        return ids[rank != -1]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words at once.

        Round by round: the rank of every neighbouring pair, the lowest rank of
        each word, and that pair merged wherever the word has it, from the left
        and without overlap.  Words with no pair left leave the ragged array.
        """
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        ids = self.first[flat]
        stop = np.cumsum(lens)
        ids[stop - 1] = self.last[flat[stop - 1]]
        word = np.repeat(np.arange(n), lens)
        done_ids, done_words = [], []
        while len(ids):
            inside = word[1:] == word[:-1]
            rank = np.where(inside, self.ranks(ids[:-1], ids[1:]), np.int64(1 << 40))
            begin = np.flatnonzero(np.concatenate(([True], ~inside)))
            size = np.diff(np.append(begin, len(ids)))
            low = np.minimum.reduceat(np.append(rank, 1 << 40), begin)
            live = low < 1 << 40
            each = np.repeat(low, size)
            hit = (rank == each[:-1]) & (rank < 1 << 40)
            at = np.flatnonzero(hit)
            if len(at):                                   # x x x: first and second merge, the third waits
                run = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            stay = np.ones(len(ids), bool)
            ids = ids.copy()
            ids[at] = self.new[rank[at]]
            stay[at + 1] = False
            alive = np.repeat(live, size)
            over = stay & ~alive
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
            stay &= alive
            ids, word = ids[stay], word[stay]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=n)

    def rare(self, text: str) -> bool:
        """Has letters that Unicode versions may class differently: code points
        that Unicode 3.2 did not assign yet.  The library itself splits those."""
        if text.isascii():
            return False
        try:
            text.encode("latin-1")
            return False
        except UnicodeEncodeError:
            return _newer()(text) is not None

    def _library_words(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    @property
    def library(self) -> Tokenizer:
        if self._library is None:
            self._library = Tokenizer.from_file(self.path)
        return self._library

    def _parts(self, text: str) -> list[str]:
        """``pieces`` of one text without shortcuts."""
        out = []
        for i, part in enumerate(self.cut(text) if self.cut and "<|" in text else [text]):
            if i % 2:
                out.append(part)
            else:
                if self.lower:
                    part = self.library.normalizer.normalize_str(part) if self.rare(part) else self.normal(part)
                out += self.words(part)
        return out

    def pieces(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and each text as a row of them: ``(strings,
        codes, counts)``, ``codes`` for all texts in a row and ``counts`` of
        each text.  A special token's string is a pre-token by itself.

        Arrow's kernels mark the ends of the pre-tokens and number the distinct
        ones.  Texts on which its classes could differ from the library's, or
        whose white space needs a look ahead, are cut one by one.
        """
        odd = pc.match_substring(texts, "<|")
        if self.lower:
            odd = pc.or_(odd, pc.match_substring_regex(texts, r"[Σİ\x02\x0b\x{85}" + _OTHER_BLANKS + "]"))
            odd = pc.or_(odd, pc.match_substring_regex(texts, _newer_class()))
            normal = [t.isascii() or unicodedata.is_normalized("NFC", t) for t in texts.to_pylist()]
            odd = pc.or_(odd, pc.invert(pa.array(normal, pa.bool_())))
        else:
            odd = pc.or_(odd, pc.match_substring_regex(
                texts, r"[ \n][ \n]| \z|[\t\r\x02\x0b\x0c\x1c-\x1f\x{85}" + _OTHER_BLANKS + "]"))
            odd = pc.or_(odd, pc.match_substring_regex(texts, _newer_class()))
        odd = odd.to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(~odd)
        plain = texts.take(pa.array(rows))
        if self.lower:
            plain = pc.utf8_lower(plain)
        marked = pc.replace_substring_regex(plain, self.marks, "\\0\x02")
        parts = pc.split_pattern(marked, "\x02")
        coded = parts.flatten().dictionary_encode()
        strings = coded.dictionary
        strings = (pc.utf8_trim(strings, characters=_WHITE) if self.lower else strings).to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.zeros(len(texts), np.int64)
        counts[rows] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        if len(rows) < len(texts):
            number = {}
            first = [number.setdefault(p, len(number)) for p in strings]
            codes = np.array(first, np.int64)[codes] if first else codes
            begin = np.cumsum(counts) - counts
            out: list[np.ndarray] = []
            for i, text in enumerate(texts.to_pylist()):
                if odd[i]:
                    row = [number.setdefault(p, len(number)) for p in self._parts(text)]
                    counts[i] = len(row)
                    out.append(np.array(row, np.int64))
                else:
                    out.append(codes[begin[i]:begin[i] + counts[i]])
            strings, codes = list(number), np.concatenate(out)
        return strings, codes, counts

    def words(self, piece: str) -> list[str]:
        """The pre-tokens of a text without special tokens' strings."""
        return self._library_words(piece) if self.rare(piece) else self.split(piece)

    def decode(self, ids: list[int]) -> str:
        """As the library decodes with special tokens kept: a file with word
        ends has no decoder, its tokens are joined by blanks; a byte-level file
        joins the bytes and replaces what is not UTF-8."""
        if self.end:
            return " ".join(map(self.token_of.__getitem__, ids))
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


# White space that Unicode knows beside blank, line break and ASCII's, for RE2; all white space.
_OTHER_BLANKS = r"\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHITE = " \t\n\x0b\x0c\r\x85" + "".join(
    chr(c) for c in [0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


@functools.cache
def _newer_spans() -> list[tuple[int, int]]:
    old = unicodedata.ucd_3_2_0.category
    spans, start = [], None
    for cp in range(0x110001):
        new = cp < 0x110000 and old(chr(cp)) == "Cn"
        if new and start is None:
            start = cp
        elif not new and start is not None:
            spans.append((start, cp - 1))
            start = None
    return spans


@functools.cache
def _newer_class() -> str:
    """RE2's class of the code points that Unicode 3.2 did not assign."""
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _newer_spans()) + "]"


@functools.cache
def _newer() -> Callable[[str], object]:
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _newer_spans()) + "]").search


def gather(values: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ragged rows ``codes`` of (``values``, ``counts``) one after another."""
    size = counts[codes]
    begin = (np.cumsum(counts) - counts)[codes]
    stop = np.cumsum(size)
    return values[np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - stop + size, size)]


@functools.cache
def load(path: str) -> Bpe:
    """One ``Bpe`` for each file and Python worker."""
    return Bpe(path)
