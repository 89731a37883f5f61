"""Token ids of whole texts with a public vocabulary, by pieces that recur.

Before merging, the tokenizer splits a text with a pattern in which a space goes with what follows it. So a
text may be cut before any space that follows a character which is not white space, without changing
its ids. A batch of texts is cut by Arrow, its distinct pieces are merged together, as rows of arrays, and every piece's ids
are gathered from there.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
#: Pieces in each of the two generations of the table, and the longest piece that is kept.
KEPT, LONGEST = 400_000, 40


_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def pieces(text: str) -> list[str]:
    """The text cut at spaces that follow something visible; each piece but the first has lost its leading space."""
    return _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")


MARKS = (",", ".")


class Table:
    """Ids of pieces as bytes, in two generations: what is not asked for during a whole one is forgotten."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]) -> None:
        self.encode, self.young, self.old = encode, {}, {}

    def ids(self, texts: list[str]) -> list[bytes]:
        cut = [pieces(t) for t in texts]
        heads = self.encode([c[0] for c in cut])
        young, old = self.young, self.old
        missing = []
        for p in set().union(*(c[1:] for c in cut)).difference(young):
            if (known := old.get(p)) is None:
                missing.append(p)
            else:
                young[p] = known
        # A word with a comma or full stop is the word and the mark; most such words are known without it.
        bare = [p for p in missing if p[-1:] not in MARKS or p[:-1] not in young or not p[:-1].isalpha()]
        young.update(zip(bare, self.encode([" " + p for p in bare]), strict=True))
        if len(bare) < len(missing):
            ends = dict(zip(MARKS, self.encode(list(MARKS)), strict=True))
            for p in missing:
                if p not in young:
                    young[p] = young[p[:-1]] + ends[p[-1]]
        find = young.__getitem__
        out = [b"".join([head, *map(find, c[1:])]) for head, c in zip(heads, cut, strict=True)]
        for p in missing:
            if len(p) > LONGEST:
                del young[p]
        if len(young) > KEPT:
            self.old, self.young = young, {}
        return out


# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary's file: itself where it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class Splitter:
    """Words of the pattern; strings of the special tokens are cut out first, as the library does."""

    def __init__(self, special: dict[str, int]) -> None:
        self.special = special
        marks = "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if special else None
        self.words = regex.compile(PATTERN).findall

    def __call__(self, text: str) -> list[str]:
        bare = text[1:] if text[:1] == " " else text
        if bare.isalpha():  # letters are one word of the pattern
            return [text]
        if bare[-1:] in MARKS and bare[:-1].isalpha():
            return [text[:-1], text[-1]]
        if self.marks is None or not self.marks.search(text):
            return self.words(text)
        out: list[str] = []
        for part in self.marks.split(text):
            out += [part] if part in self.special else self.words(part)
        return out


def library_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """The library's model, word by word: its call for whole texts takes three times as long for rare words."""
    library = Tokenizer.from_file(path)
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    split, merge = Splitter(special), library.model.tokenize
    letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})

    def ids(word: str) -> list[int]:
        if word in special:
            return [special[word]]
        return [t.id for t in merge(word.encode("utf-8").decode("latin-1").translate(letters))]

    def encode(parts: list[str]) -> list[bytes]:
        known: dict[str, list[int]] = {}
        out = []
        for p in parts:
            if p[1:].isalpha() and p.isascii() and p[0] == " ":  # the usual case, without detours
                out.append(array("I", [t.id for t in merge(blank + p[1:])]).tobytes())
                continue
            found: list[int] = []
            for w in split(p):
                if w not in known:
                    known[w] = ids(w)
                found += known[w]
            out.append(array("I", found).tobytes())
        return out

    blank = byte_letters()[32]
    return encode


#: Longer words (in bytes) go to the library, one by one.
LONG_WORD = 48
#: Cells of an array of words.
CELLS = 1 << 21
NONE = np.int32(1 << 30)


class Merger:
    """The vocabulary's merges, applied to many words at once: in each step every word makes its first merge of lowest rank."""

    def __init__(self, path: str) -> None:
        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]
        vocab = spec["vocab"]
        self.split = Splitter({t.content: i for i, t in library.get_added_tokens_decoder().items()})
        self.one = library_encoder(path)
        self.byte_ids = np.zeros(256, np.int32)
        for b, c in byte_letters().items():
            self.byte_ids[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["merges"]]
        self.whole = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.wide = 1 + max(vocab.values())
        keys = np.array([vocab[a] * self.wide + vocab[b] for a, b in pairs], np.int64)
        # Ranks by pair: an open table, at most one twentieth full, that lookups of many pairs step through together.
        self.shift = 64 - max(10, (20 * len(keys)).bit_length())
        self.keys = np.full(1 << (64 - self.shift), -1, np.int64)
        self.ranks = np.full(len(self.keys), NONE, np.int32)
        todo = np.arange(len(keys))
        at = self._slot(keys)
        while len(todo):  # of those that want one free slot the first takes it, the others go on
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.ranks[at[placed]] = keys[todo[placed]], todo[placed]
            stay = np.ones(len(todo), bool)
            stay[placed] = False
            todo, at = todo[stay], (at[stay] + 1) % len(self.keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs of ids; ``NONE`` where there is none. -1 stands for no token."""
        keys = left.astype(np.int64) * self.wide + right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != -1) & (keys >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) % len(self.keys)
            seen = self.keys[at]
            hit = seen == keys[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            more = ~hit & (seen != -1)
            open_, at = open_[more], at[more]
        return out

    def merge(self, ids: np.ndarray) -> np.ndarray:
        """Rows of byte ids to rows of token ids, filled up with -1."""
        n, width = ids.shape
        out = np.full((n, width), -1, np.int32)
        where, columns = np.arange(n), np.arange(width)
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1) if width > 1 else np.full((n, 1), NONE)
        fill, last = np.full((n, 1), -1, np.int32), np.full((n, 1), NONE, np.int32)
        while True:
            best = ranks.argmin(axis=1)  # the first of equal ranks
            rank = ranks[np.arange(len(where)), best]
            live = rank < NONE
            if not live.all():
                out[where[~live]] = ids[~live]
                if not live.any():
                    return out
                where, ids, ranks, best, rank = where[live], ids[live], ranks[live], best[live], rank[live]
            rows = np.arange(len(where))
            before = columns < best[:, None]
            ids = np.where(before, ids, np.concatenate([ids[:, 1:], fill[: len(rows)]], axis=1))
            ids[rows, best] = self.whole[rank]
            ranks = np.where(before[:, :-1], ranks, np.concatenate([ranks[:, 1:], last[: len(rows)]], axis=1))
            ranks[rows, best] = self.rank(ids[rows, best], ids[rows, best + 1])
            inner = np.flatnonzero(best)
            ranks[inner, best[inner] - 1] = self.rank(ids[inner, best[inner] - 1], ids[inner, best[inner]])

    def words(self, words: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids, and where those of each word start and how many they are; ``spaced`` words have a space before them."""
        starts, sizes, data = _buffer(words)
        found, begin, count, at = [], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0

        def add(rows: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
            nonlocal at
            found.append(ids)
            count[rows], begin[rows] = lengths, at + np.cumsum(lengths) - lengths
            at += len(ids)

        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size == 0 and not spaced:
                continue
            if size > LONG_WORD:
                blobs = self.one([(" " if spaced else "") + words[i].as_py() for i in rows.tolist()])
                add(rows, np.frombuffer(b"".join(blobs), "<u4").astype(np.int32), np.array([len(b) // 4 for b in blobs], np.int64))
                continue
            step = CELLS // (size + 1)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                ids = self.byte_ids[data[starts[part][:, None] + np.arange(size)]] if size else np.zeros((len(part), 0), np.int32)
                if spaced:
                    ids = np.concatenate([np.full((len(part), 1), self.byte_ids[32]), ids], axis=1)
                merged = self.merge(ids)
                kept = merged >= 0
                add(part, merged[kept], kept.sum(axis=1))
        return (np.concatenate(found) if found else np.zeros(0, np.int32)), begin, count


def _buffer(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes in bytes, and the bytes, of an array without nulls."""
    strings = strings.cast(pa.large_string())
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    return ends[:-1], np.diff(ends), np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)


def _gather(ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ids of one run after another."""
    ends = np.cumsum(count)
    return ids[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - begin, count)]


class Units:
    """Ids of pieces of text, each given once: word ids and, of each piece, where its ids are."""

    def __init__(self, merger: Merger) -> None:
        self.merger, self.ids, self.begin, self.count, self.n = merger, [], [], [], 0

    def add(self, where: np.ndarray, ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> None:
        self.ids.append(ids)
        self.begin.append((where, begin + self.n, count))
        self.n += len(ids)

    def mixed(self, where: np.ndarray, texts: list[str]) -> None:
        """Pieces of several words each, by the pattern."""
        split = [self.merger.split(t) for t in texts]
        ids, begin, count = [], np.zeros(len(split), np.int64), np.zeros(len(split), np.int64)
        words = [w for s in split for w in s]
        special = self.merger.split.special
        plain = pa.array([w if w not in special else "" for w in words], pa.large_string())
        ids, begin, count = self.merger.words(plain, spaced=False)
        named = [i for i, w in enumerate(words) if w in special]
        begin[named], count[named] = len(ids) + np.arange(len(named)), 1
        ids = np.concatenate([ids, np.array([special[words[i]] for i in named], np.int32)])
        sizes = np.array([len(s) for s in split], np.int64)
        upto = np.concatenate([[0], np.cumsum(count)])
        ends = np.cumsum(sizes)
        totals = upto[ends] - upto[ends - sizes]
        self.add(where, _gather(ids, begin, count), np.cumsum(totals) - totals, totals)

    def pieces(self, distinct: pa.Array) -> None:
        """Pieces with a space before each."""
        n = len(distinct)
        letters = pc.utf8_is_alpha(distinct).to_numpy(zero_copy_only=False)
        last = pc.utf8_slice_codeunits(distinct, -1)
        bare = pc.utf8_slice_codeunits(distinct, 0, -1)
        whole = np.flatnonzero(letters)
        self.add(whole, *self.merger.words(distinct.take(pa.array(whole)), spaced=True))
        seen = letters
        for mark in MARKS:  # a word and a mark; the mark is a word of the pattern
            hit = (~seen) & pc.equal(last, mark).to_numpy(zero_copy_only=False) & pc.utf8_is_alpha(bare).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(hit)
            ids, begin, count = self.merger.words(bare.take(pa.array(rows)), spaced=True)
            moved = np.full(len(ids) + len(rows), self.merger.byte_ids[ord(mark)], np.int32)
            total = np.cumsum(count + 1)
            moved[np.delete(np.arange(len(moved)), total - 1)] = _gather(ids, begin, count)
            self.add(rows, moved, total - count - 1, count + 1)
            seen = seen | hit
        rest = np.flatnonzero(~seen)
        self.mixed(rest, [" " + t for t in distinct.take(pa.array(rest)).to_pylist()])
        assert n == sum(len(w) for w, _, _ in self.begin)


def batch_ids(texts: pa.Array, vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and how many each text has; null is the empty text."""
    if vocabulary not in _MERGERS:
        _MERGERS[vocabulary] = Merger(public_tokenizers.path(vocabulary))
    merger = _MERGERS[vocabulary]
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    strings = texts.to_pylist()
    unsafe = np.array([_UNSAFE.search(t) is not None for t in strings])
    # Texts in which every space is a cut are cut by Arrow, the others by the pattern; then they are put in order again.
    order = np.concatenate([np.flatnonzero(~unsafe), np.flatnonzero(unsafe)])
    by_arrow = pc.split_pattern(texts.filter(pa.array(~unsafe)), " ")
    by_pattern = pa.array([_CUT.split(strings[i]) for i in np.flatnonzero(unsafe).tolist()], by_arrow.type)
    flat = pa.concat_arrays([by_arrow.flatten(), by_pattern.flatten()])
    sizes = np.concatenate([x.value_lengths().to_numpy() for x in (by_arrow, by_pattern)]).astype(np.int64)
    heads = np.cumsum(sizes) - sizes
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    n = len(coded.dictionary)
    code[heads] = n + np.arange(len(heads))  # a text's first piece has no space before it
    units = Units(merger)
    units.pieces(coded.dictionary)
    units.mixed(n + np.arange(len(heads)), flat.take(pa.array(heads)).to_pylist())
    ids = np.concatenate(units.ids)
    begin, count = np.zeros(n + len(heads), np.int64), np.zeros(n + len(heads), np.int64)
    for where, b, c in units.begin:
        begin[where], count[where] = b, c
    lengths = np.concatenate([[0], np.cumsum(count[code])])
    ends = np.cumsum(sizes)
    found = _gather(ids, begin[code], count[code])
    totals = lengths[ends] - lengths[ends - sizes]
    if unsafe.any():  # back to the order of the texts
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        starts = np.cumsum(totals) - totals
        found, totals = _gather(found, starts[back], totals[back]), totals[back]
    return found, totals


_MERGERS: dict[str, Merger] = {}


def encode_texts(texts: pa.Array | list[str | None], vocabulary: str = VOCABULARY) -> list[bytes]:
    """Ids of each whole text as little-endian unsigned 32-bit integers; null is the empty text.

    Inside a task only. The merges live as long as the Python worker; nothing else is kept between calls.
    """
    ids, count = batch_ids(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), vocabulary)
    data, ends = ids.astype("<u4").tobytes(), np.cumsum(count) * 4
    return [data[b - 4 * n : b] for b, n in zip(ends.tolist(), count.tolist(), strict=True)]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about ``most`` bytes of text: the memory of a call follows the text, not the rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
