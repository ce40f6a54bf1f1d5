"""Byte-level BPE encoding and decoding with a contiguous array of ranks for each short word.

1. A text is cut at the strings of added tokens, then into words (see ``byte_bpe.cut``); a word is cut
   into pieces by the split pattern.  A worker encodes each word once and remembers a bounded number.
2. A short piece is a row of a matrix: its parts, one for each byte at first, and beside them the ranks
   of the merges of adjacent parts.  All pieces of one block take a step at once: the least rank of each
   row is found by a scan, the boundary there is deleted (what is behind it moves up by one) and the two
   ranks next to the new part are looked up again, until no pair of a row has a rank.
3. A piece of more than ``SHORT`` bytes is merged by a heap over linked parts, so its cost does not
   grow with the square of its length.
4. Ids are decoded by joining the bytes of their tokens; bytes that are no UTF-8 become U+FFFD.

Rows do not depend on each other, so nothing is shuffled and a lost task is simply run again.  Null text
counts as empty; an empty text has no ids.  Repeated rows and ids, null ids included, give a row each; an
empty table gives an empty one.  A very long text costs its own size; words are worked on in blocks of
``CELLS`` matrix cells.  Other columns pass unread, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_bpe import cut, decode_ids, word_text
from corpusloom.llm.common import spans_of

SHORT = 96  # bytes of a piece that is merged in a matrix
CELLS = 1 << 19
MEMO_WORDS = 150_000
NONE = np.iinfo(np.int32).max  # rank of a pair that is no merge


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a vocabulary file: itself where it is printable, the
    letters from U+0100 on for the others, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Vocabulary:
    """Merges, added tokens and token bytes of a byte-level vocabulary file (JSON)."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, layer = file["model"], file["pre_tokenizer"]
        plain = model["type"] == "BPE" and layer["type"] == "ByteLevel" and not layer["add_prefix_space"] and file["normalizer"] is None and not model.get("ignore_merges")
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        ids, letters = model["vocab"], byte_letters()
        self.first = np.array([ids[letters[b]] for b in range(256)], np.int32)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
        keys = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), np.array([n for _, _, n in pairs], np.int32)
        self.rank_of = {(a, b): (rank, n) for rank, (a, b, n) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        longest = sorted(self.added, key=lambda x: (-len(x), x))
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.pieces = regex.compile(pattern).findall
        codes = {c: b for b, c in letters.items()}
        by_id = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for token, i in ids.items():
            by_id[i] = bytes(codes[c] for c in token)
        for token, i in self.added.items():
            by_id[i] = token.encode()
        starts = np.zeros(len(by_id) + 1, np.int64)
        np.cumsum([len(t) for t in by_id], out=starts[1:])
        self.table = starts, np.frombuffer(b"".join(by_id), np.uint8)
        self.known: dict[str, bytes] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merges of parts ``a`` with parts ``b``."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE) if len(self.keys) else np.full(key.shape, NONE, np.int32)

    def merge_block(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of short pieces, by one matrix of parts and one of ranks."""
        size = np.array([len(p) for p in pieces])
        wide = int(size.max())
        column = np.arange(wide)
        inside = column < size[:, None]
        parts = np.full((len(pieces), wide), -1, np.int32)
        parts[inside] = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), wide), NONE, np.int32)  # of each part with the next one
        both = inside[:, 1:]
        ranks[:, :-1][both] = self.pair_ranks(parts[:, :-1][both], parts[:, 1:][both])
        out = parts.copy()
        own = np.arange(len(pieces))
        while True:
            least = ranks.argmin(axis=1)
            row = np.arange(len(own))
            rank = ranks[row, least]
            live = rank < NONE
            if not live.all():
                out[own[~live]] = -1
                out[own[~live], : parts.shape[1]] = parts[~live]
                own, parts, ranks, least, rank = own[live], parts[live], ranks[live], least[live], rank[live]
                row = row[: len(own)]
            if not len(own):
                break
            wide = parts.shape[1]
            behind = column[: wide - 1] > least[:, None]  # the boundary behind ``least`` goes
            parts, ranks = np.where(behind, parts[:, 1:], parts[:, :-1]), np.where(behind | (column[: wide - 1] == least[:, None]), ranks[:, 1:], ranks[:, :-1])
            parts[row, least] = self.made[rank]
            for at in (least - 1, least):  # the pairs before and behind the new part
                some = (at >= 0) & (at + 1 < wide - 1)
                k, c = row[some], at[some]
                a, b = parts[k, c], parts[k, c + 1]
                ranks[k, c] = np.where(b < 0, NONE, self.pair_ranks(a, b))
            ranks[:, -1] = NONE
        return [r[r >= 0].tobytes() for r in out]

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of a long piece: a heap of ranked pairs over linked parts."""
        part = self.first[np.frombuffer(piece, np.uint8)].tolist()
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.rank_of
        heap = [(rank_of[p][0], i, *p) for i, p in enumerate(zip(part, part[1:])) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if part[i] == a else n
            if j >= n or part[j] != b:
                continue
            part[i], part[j] = rank_of[a, b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n:
                    pair = part[left], part[right]
                    if pair in rank_of:
                        heapq.heappush(heap, (rank_of[pair][0], left, *pair))
        return np.array([p for p in part if p >= 0], np.int32).tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, in its place."""
        out: list[bytes] = [b""] * len(pieces)
        short = sorted((k for k, p in enumerate(pieces) if 0 < len(p) <= SHORT), key=lambda k: len(pieces[k]))
        at = 0
        while at < len(short):
            end = at + 1
            while end < len(short) and len(pieces[short[end]]) * (end + 1 - at) <= CELLS and len(pieces[short[end]]) <= 2 * len(pieces[short[at]]):
                end += 1
            block = short[at:end]
            for k, ids in zip(block, self.merge_block([pieces[k] for k in block]), strict=True):
                out[k] = ids
            at = end
        for k, p in enumerate(pieces):
            if len(p) > SHORT:
                out[k] = self.merge_long(p)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet."""
        if len(self.known) > MEMO_WORDS:
            self.known.clear()
        fresh = [w for w in words if w not in self.known]
        cuts = [self.pieces(word_text(w)) for w in fresh]
        place: dict[str, int] = {}
        for pieces in cuts:
            for p in pieces:
                place.setdefault(p, len(place))
        ids = self.merge([p.encode("utf-8", "surrogatepass") for p in place])
        for w, pieces in zip(fresh, cuts, strict=True):
            self.known[w] = b"".join([ids[place[p]] for p in pieces])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = self.at_added.split if self.at_added else lambda t: [t]
        cuts = [[part if part in self.added else cut(part) for part in split(t)] for t in texts]
        self.learn({w for parts in cuts for words in parts if not isinstance(words, str) for w in words})
        known, added = self.known, {t: np.int32(i).tobytes() for t, i in self.added.items()}
        return [np.frombuffer(b"".join([added[w] if isinstance(w, str) else b"".join(map(known.__getitem__, w)) for w in parts]), np.uint32) for parts in cuts]


_vocabularies: dict = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for a worker process."""
    if (path, pattern) not in _vocabularies:
        _vocabularies[path, pattern] = Vocabulary(path, pattern)
    return _vocabularies[path, pattern]


_OUT = "doc_id long, n_tokens long, ids binary, decoded string"
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _coded(path: str, pattern: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in spans_of(texts):
                coded = voc.encode([t or "" for t in texts[low:high]])
                back = [decode_ids(ids, voc.table).decode("utf-8", "replace") for ids in coded]
                raw = [ids.astype("<u4").tobytes() for ids in coded]
                if digest:
                    raw, back = [hashlib.sha256(r).hexdigest() for r in raw], [hashlib.sha256(b.encode()).hexdigest() for b in back]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array([len(i) for i in coded], pa.int64()), pa.array(raw, pa.string() if digest else pa.binary()), pa.array(back, pa.string())],
                    names=[c.split()[0] for c in (_DIGEST if digest else _OUT).split(", ")],
                )

    return run


def rank_bpe(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens`` and either ``ids`` (little-endian, unsigned,
    32 bits) and ``decoded``, or with ``digest`` the SHA-256 of both in hex.

    ``path`` names a vocabulary file that every node can read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_coded(path, pattern, digest), _DIGEST if digest else _OUT)
