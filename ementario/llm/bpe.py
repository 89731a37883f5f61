"""Byte-pair encoding by dynamic programming over prefixes.

Every prefix of a word has exactly one encoding, so it has one last token. Among the vocabulary's tokens that end a
prefix, it is the one that may follow the last token of what stands before it: the pair that, encoded
together, stays as it is. An automaton over the vocabulary gives the tokens that end at each place, and
following the last tokens back gives the ids. Work is linear in the text, also for one word of any length.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from ementario.llm.tokens import VOCABULARY, Splitter, Table, byte_letters

#: Words and pairs kept per worker.
KEPT_WORDS, KEPT_PAIRS = 200_000, 500_000


class PrefixEncoder:
    """A vocabulary with its merges, read from a tokenizers file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in byte_letters().items()}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_ids = {vocab[c]: b for c, b in letters.items()}
        #: Rank of a merge by its pair, and what each merge is made of. Single bytes rank below all merges.
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank_of: dict[int, int] = dict.fromkeys(self.byte_ids, -1)
        for r, m in enumerate(merges):
            left, right = m.split(" ") if isinstance(m, str) else m
            pair = vocab[left], vocab[right]
            if (whole := vocab.get(left + right)) is None or whole in self.rank_of:
                continue
            self.rank[pair], self.halves[whole], self.rank_of[whole] = r, pair, r
        self.automaton = ahocorasick.Automaton()
        for i in [*self.byte_ids, *self.halves]:
            if self.stands(i):
                text = self.bytes[i].decode("latin-1")
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.split = Splitter(self.special)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}

    def stands(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token."""
        return token not in self.halves or self.compatible(*self.halves[token], self.rank_of[token])

    def compatible(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether the encodings ``left`` and ``right`` stay apart when their texts are joined.

        The merges are undone from the last one backwards along the border. At each step the two tokens that then met
        at the border must not have had a merge that came before the one undone last.
        """
        halves, rank_of = self.halves, self.rank_of
        while True:
            if self.rank.get((left, right), limit) < limit:
                return False
            if rank_of[left] > rank_of[right]:
                limit, left = rank_of[left], halves[left][1]
            elif right in halves:  # of equal merges the left one comes first
                limit, right = rank_of[right] + 0.5, halves[right][0]
            else:
                return True

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word of the pattern."""
        last: list[tuple[int, int] | None] = [None] * (len(raw) + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            if last[end + 1] is not None:
                continue
            before = end + 1 - size
            if before:
                key = (last[before][0], token)
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = compatible(*key)
                if not fits:
                    continue
            last[end + 1] = (token, before)
        ids = []
        at = len(raw)
        while at:
            token, at = last[at]
            ids.append(token)
        return ids[::-1]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        words = self.words
        for w in self.split(text):
            found = words.get(w)
            if found is None:
                found = [self.special[w]] if w in self.special else self.word(w.encode("utf-8"))
                if len(w) <= 40:
                    if len(words) >= KEPT_WORDS:
                        words.clear()
                    words[w] = found
            ids += found
        return ids

    def encode_pieces(self, parts: list[str]) -> list[bytes]:
        return [array("I", self.encode(p)).tobytes() for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_ENCODERS: dict[str, tuple[PrefixEncoder, Table]] = {}


def encoder(vocabulary: str = VOCABULARY) -> tuple[PrefixEncoder, Table]:
    """This worker's encoder, built at first use."""
    if vocabulary not in _ENCODERS:
        made = PrefixEncoder(public_tokenizers.path(vocabulary))
        _ENCODERS[vocabulary] = made, Table(made.encode_pieces)
    return _ENCODERS[vocabulary]


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, slice_rows: int = 500) -> DataFrame:
    """doc_id, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` of every whole text.

    Null text is empty and has no ids. Repeated rows are encoded each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                rows = batch.slice(at, slice_rows)
                ids = table.ids([t or "" for t in rows.column("text").to_pylist()])
                texts = [coder.decode(np.frombuffer(b, "<u4")) for b in ids]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
