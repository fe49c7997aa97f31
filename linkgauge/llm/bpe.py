"""Byte-level BPE by backtracking: exact merges in time linear in the text.

An Aho-Corasick automaton finds, for every place of a pre-token, the longest vocabulary entry that begins there.
Entries are laid one after the other; a neighbour is accepted only if the pair-compatibility table says that the
merge rules would leave that boundary alone. When nothing fits, the last entry is shortened or taken back, and the
place is remembered as a dead end, so no place is tried twice. Decoding gathers bytes through an offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_batches, texts

NEVER = 1 << 60
#: Fixed value: the pre-token pattern of the byte-level vocabulary, with the commonest branch first.
PATTERN = r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts below U+0250, where these are all letters, numerals and spaces; the standard module is faster.
L, N, S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
NARROW, WIDE = re.compile(rf" ?[{L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"), re.compile("[^\x00-\u024f]")
#: Pre-tokens longer than this many characters are encoded anew each time; CACHE of the others and PAIRS of the pair table are
#: remembered at most, those that were met OFTEN times before there were
#: so many. Times are counted by hashes, in SEEN bytes.
CACHE_CHARS, CACHE, PAIRS, OFTEN, SEEN = 40, 80_000, 80_000, 3, 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """What the driver reads from a tokenizer file; plain values, so that it can be sent to tasks."""

    tokens: list[bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for text, i in ids.items():
            tokens[i] = bytes(of_letter[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        return cls(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.tokens = vocabulary.tokens
        self.special = vocabulary.special
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(vocabulary.merges)}
        self.made = {c: (r, a, b) for r, (a, b, c) in reversed([*enumerate(vocabulary.merges)])}
        self.edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.apart = _Frequent(lambda pair: self._fits(*divmod(pair, len(self.tokens))), lambda: PAIRS)
        self.byte_id = {t[0]: i for i, t in enumerate(self.tokens) if len(t) == 1 and i not in self.made}
        usable = [i for i, t in enumerate(self.tokens) if t and i not in self.special.values() and self._reachable(i)]
        self.id_of = {self.tokens[i]: i for i in usable}
        self.automaton = ahocorasick.Automaton()
        for i in usable:
            self.automaton.add_word(self.tokens[i].decode("latin-1")[::-1], i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.pieces = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache = _Frequent(lambda piece: np.array(self.encode_piece(piece.encode()), "<u4").tobytes(), lambda: CACHE, lambda piece: len(piece) <= CACHE_CHARS)
        self.sizes = [len(t) for t in self.tokens]
        lengths = np.array(self.sizes, np.int64)
        self.lengths, self.offsets = lengths, np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _reachable(self, i: int) -> bool:
        """False for entries that the merge rules never yield for their own bytes: a part or their join would differ."""
        if i not in self.made:
            return True
        rank, a, b = self.made[i]
        return self._reachable(a) and self._reachable(b) and self.rank[a, b] == rank and self.compatible(a, b, rank)

    def _edge(self, i: int, right: bool) -> list[tuple[int, int]]:
        """The entries that stand at one edge while i is put together, smallest first, each with the rank that ends it."""
        if (found := self.edges.get((i, right))) is None:
            found = []
            if i in self.made:
                rank, a, b = self.made[i]
                below = self._edge(b if right else a, right)
                found = [*below[:-1], (below[-1][0], rank)]
            found = self.edges[i, right] = [*found, (i, NEVER)]
        return found

    def compatible(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether a and b, side by side, both form and stay unjoined by every merge ranked before until.

        While both form, the entries at the boundary change at known ranks. If a merge of the two that face each other
        comes before the next change, the boundary goes. Of equal merges the one further left comes first."""
        return self.apart[a * len(self.tokens) + b] if until == NEVER else self._fits(a, b, until)

    def _fits(self, a: int, b: int, until: int = NEVER) -> bool:
        left, right, i, j = self._edge(a, True), self._edge(b, False), 0, 0
        while True:
            (x, ends_x), (y, ends_y) = left[i], right[j]
            joins = self.rank.get((x, y), NEVER)
            if joins < until and joins < ends_x and joins <= ends_y:
                return False
            if ends_x == ends_y == NEVER:
                return True
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def _shorten(self, i: int) -> int | None:
        """The longest entry that is a proper prefix of entry i."""
        if i not in self.shorter:
            text = self.tokens[i]
            self.shorter[i] = next((self.id_of[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.id_of), None)
        return self.shorter[i]

    def longest(self, data: bytes) -> dict[int, int]:
        """The longest entry that begins at each place of data, by the number of bytes after that place.

        One scan of the reversed bytes; at each end the automaton tells the longest match first, which is kept here."""
        return dict(reversed([*self.automaton.iter(data.decode("latin-1")[::-1])]))

    def encode_piece(self, data: bytes) -> list[int]:
        if (whole := self.id_of.get(data)) is not None:
            return [whole]
        last, longest, sizes, apart, many = len(data) - 1, self.longest(data), self.sizes, self.apart, len(self.tokens)
        dead, out, at = bytearray(len(data) + 1), [], 0
        token: int | None = longest[last]
        while True:
            while token is not None and (dead[at + sizes[token]] or out and not apart[out[-1] * many + token]):
                token = self._shorten(token)
            if token is not None:
                out.append(token)
                at += sizes[token]
                if at > last:
                    return out
                token = longest[last - at]
            else:
                dead[at] = 1
                before = out.pop()
                at -= sizes[before]
                token = self._shorten(before)

    def _ordinary(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, (self.pieces if WIDE.search(text) else NARROW).findall(text)))

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers. Special entries in the text count as such."""
        if self.split is not None and any(s in text for s in self.special):
            return b"".join(self.special[x].to_bytes(4, "little") if x in self.special else self._ordinary(x) for x in self.split.split(text))
        return self._ordinary(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: bytes) -> bytes:
        n = np.frombuffer(ids, "<u4")
        size = self.lengths[n]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.offsets[n] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, "<u4").tobytes()).decode("utf-8", "replace")


class _Frequent(dict):
    """Results of a function by what they are of: those are remembered that were asked for several times, while there is room. So
    rare keys, of which there are ever more, leave the room to frequent ones."""

    def __init__(self, made: Callable, room: Callable[[], int], kept: Callable = lambda key: True) -> None:
        super().__init__()
        self.made, self.room, self.kept, self.seen = made, room, kept, bytearray(SEEN)

    def __missing__(self, key):
        found = self.made(key)
        if len(self) < self.room() and self.kept(key):
            at = hash(key) % len(self.seen)
            if self.seen[at] < OFTEN:
                self.seen[at] += 1
            else:
                self[key] = found
        return found


_encoders: OrderedDict[str, Encoder] = OrderedDict()


def encoder_for(vocabulary: Callable[[], Vocabulary], key: str) -> Encoder:
    """One encoder for each worker process and vocabulary; two are kept at most."""
    if key not in _encoders:
        while len(_encoders) > 1:
            _encoders.popitem(last=False)
        _encoders[key] = Encoder(vocabulary())
    return _encoders[key]


def tokenize(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, token_ids, decoded) of every row of docs, in one pass without a shuffle.

    token_ids holds the ids as little-endian unsigned 32-bit integers, decoded is the text that they stand for.
    Null and empty texts: no ids, empty text. Repeated rows: one result each. Other columns are left out.
    The vocabulary is sent to the tasks: its size is that of the tokenizer file, whatever the data."""
    read = Vocabulary.from_file(path)
    key, sent = hashlib.sha256(repr(read).encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(read)

    def run(batches):
        encoder = encoder_for(lambda: sent.value, key)
        for batch in batches:
            ids = [encoder.encode_bytes(t or "") for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([encoder.decode_bytes(x).decode("utf-8", "replace") for x in ids], pa.string())], ["doc_id", "token_ids", "decoded"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return map_batches(rows, run, f"doc_id {kind}, token_ids binary, decoded string")
