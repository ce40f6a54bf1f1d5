"""Exact substring deduplication by suffix arrays.

Every byte that lies in a ``length``-byte string which also starts earlier in the corpus is removed.

Where two equal strings can be, they must share an anchor: of all short windows of a string, the one
with the least hash, leftmost on ties.  Neighbouring starts with the same anchor form a context, and

1. blocks of documents send the distinct anchors of their contexts (8 bytes each) to anchor buckets,
   which tell which anchors occur once only: those contexts are done;
2. blocks send each distinct remaining context once, with its first place, to context buckets.  An
   anchor with more than ``HOT`` unequal contexts has them sent as single strings under their own
   hash, so a phrase in a third of the corpus is dealt over all buckets;
3. a bucket sorts the suffixes of its contexts in two stages: suffixes smaller than their successors
   are sorted directly, all others are induced by scanning the buckets of first bytes in order.  The
   common prefixes of neighbours give the classes of equal strings, and each class its first place;
4. blocks mark what is not first and cut it from their documents.

Documents are shuffled by block once.  Null text counts as empty.  A null doc_id comes first; rows
with the same doc_id follow each other by text, and equal rows are copies of each other.  An empty table
gives an empty one.  A text is never cut, so the block of a very long one is as large as it; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_order, parts_for, text_bytes

GRAM = 24  # bytes of an anchor window
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20  # corpus bytes behind one bucket
SORT_BYTES = 1 << 20  # contexts that are suffix-sorted together
HOT = 2000
STEP = 1 << 17

_MULT = 6364136223846793005
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_MULT, k, 1 << 64))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every start, by doubling."""
    h1 = raw.astype(np.uint64) * _MIX + np.uint64(0x632BE59BD9B4E019)
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h = h16[:-8] * _power(8) + h8[16:]
    h ^= h >> np.uint64(31)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :]) if width > size else v


def contexts(raw: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, anchor hash and border hash of every context; documents end at
    ``ends``.  The border hash only serves to count unequal contexts of an anchor."""
    lows, sizes, keys, borders = [], [], [], []
    n = len(raw)
    for at in range(0, n - length + 1, STEP):
        part = raw[at : at + STEP + length - 1]
        h = gram_hashes(part)
        low = np.uint64((1 << 18) - 1)
        least = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1) & low
        starts = np.arange(at, at + len(least))
        doc_end = ends[np.searchsorted(ends, at, "right") :]
        cut = np.searchsorted(doc_end, starts[-1], "right") + 1
        inside = doc_end[:cut]
        bounds = np.concatenate([[at], inside])
        valid = np.zeros(len(least), bool)
        for a, b in zip(np.maximum(bounds[:-1], at) - at, bounds[1:] - at - length + 1, strict=True):
            if b > a:
                valid[a:b] = True
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        first = np.flatnonzero(change & valid)
        stop = np.flatnonzero(np.concatenate([(change[1:] & valid[:-1]) | (valid[:-1] & ~valid[1:]), valid[-1:]])) + 1
        lows.append(first + at)
        sizes.append(stop - first)
        keys.append(h[least[first].astype(np.int64)])
        borders.append(h[first] * _MIX ^ h[stop - 1 + length - GRAM])
    if not lows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(lows), np.concatenate(sizes), np.concatenate(keys), np.concatenate(borders)


def two_stage_suffix_array(raw: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``raw`` whose order is exact for the first ``depth`` bytes.

    Stage one sorts the suffixes that are smaller than their successors.  Stage two scans the
    buckets of first bytes upwards: the predecessor of each suffix met, if it is larger than that
    suffix, is the next of its own bucket.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.concatenate([raw[1:] != raw[:-1], [True]]))
    run_small = np.concatenate([raw[ends[:-1] + 1] > raw[ends[:-1]], [False]])
    small = np.repeat(run_small, np.diff(np.concatenate([[-1], ends])))
    direct = np.flatnonzero(small)
    padded = np.concatenate([raw, np.zeros(depth, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").ravel(), kind="stable")]
    del rows
    byte = raw[direct]
    split = np.searchsorted(byte, np.arange(257))
    incoming: list[list[np.ndarray]] = [[] for _ in range(256)]
    incoming[raw[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        own = np.concatenate(incoming[c]) if incoming[c] else np.zeros(0, np.int64)
        larger = [own]
        while len(own):
            before = own[own > 0] - 1
            own = before[raw[before] == c]
            larger.append(own)
        bucket = np.concatenate([*larger, direct[split[c] : split[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[raw[before] > c]
        to = raw[before]
        order = np.argsort(to, kind="stable")
        before, to = before[order], to[order]
        at = np.searchsorted(to, np.arange(c + 1, 257))
        for k in range(len(at) - 1):
            if at[k] < at[k + 1]:
                incoming[c + 1 + k].append(before[at[k] : at[k + 1]])
        incoming[c] = []
    return np.concatenate(out)


def common_prefixes(raw: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, at most ``most``."""
    lcp = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return lcp
    padded = np.concatenate([raw, np.zeros(most + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alive = np.arange(1, len(order))
    for at in range(0, most, 8):
        a = np.ascontiguousarray(words[order[alive] + at]).view("<u8").ravel()
        b = np.ascontiguousarray(words[order[alive - 1] + at]).view("<u8").ravel()
        differ = a ^ b
        part = alive[differ != 0]
        low = differ[differ != 0]
        low &= np.uint64(0) - low
        lcp[part] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        alive = alive[differ == 0]
        if not len(alive):
            break
    lcp[alive] = most
    return np.minimum(lcp, most)


def _expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. size[0] values, and so on."""
    total = int(size.sum())
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(total)


def square(raw: np.ndarray, low: np.ndarray, span: np.ndarray, width: int) -> np.ndarray:
    """Strings of ``span`` bytes at ``low``, padded to one width and ended by their length."""
    out = np.zeros((len(low), width + 1), np.uint8)
    padded = np.concatenate([raw, np.zeros(width, np.uint8)])
    for k in range(0, len(low), 20_000):
        part = out[k : k + 20_000]
        part[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[low[k : k + 20_000]]
        part[:, :width][np.arange(width) >= span[k : k + 20_000, None]] = 0
    out[:, width] = span
    return out.view(np.dtype((np.void, width + 1))).ravel()


class Block:
    """Documents of one block in corpus order and their contexts."""

    def __init__(self, rows: pa.Table, length: int, buckets: int):
        docs = sorted(zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True), key=lambda d: (d[0] is not None, d[0] or 0, d[1] or b""))
        self.length = length
        self.ids = [d[0] for d in docs]
        self.texts = [d[1] or b"" for d in docs]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(self.size)
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        seq, last, k = [], object(), 0
        for i in self.ids:
            k = k + 1 if i == last else 0
            last = i
            seq.append(k)
        self.seq = np.array(seq, np.int64)
        self.low, self.count, self.key, border = contexts(self.raw, self.ends, length)
        where = (self.key & np.uint64(0xFFFFFF)).astype(np.int64) % buckets
        order = np.lexsort((border, self.key, where))
        k, w, e = self.key[order], where[order], border[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        other = new.copy()
        other[1:] |= e[1:] != e[:-1]
        edge = np.flatnonzero(new)
        self.distinct, self.distinct_bucket = k[new], w[new]
        self.uses = np.diff(np.append(edge, len(k)))
        self.unequal = np.add.reduceat(other, edge, dtype=np.int64) if len(edge) else self.uses
        self.which = np.empty(len(k), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def repeated(self, flags: np.ndarray, buckets: int) -> None:
        """Choose the contexts to compare; each distinct one once, in the order of their buckets.

        ``unit_*`` are what is sent: whole contexts, or the single strings of hot ones.
        """
        flag = flags[self.which] if len(flags) else np.zeros(0, np.uint8)
        some = flag > 0
        self.run_low, self.run_count = self.low[some], self.count[some]
        first, self.run_context = self._unequal(self.run_low, self.run_count)
        self.context_run = first
        low, count, key, hot = self.run_low[first], self.run_count[first], self.key[some][first], flag[some][first] == 2
        self.context_count = count
        whole = np.flatnonzero(~hot)
        at = np.cumsum(count) - count
        single, single_at = _expand(low[hot], count[hot]), _expand(at[hot], count[hot])
        unit_low, unit_count, unit_key = low[whole], count[whole], key[whole]
        # where the answers of a unit go among the strings of all contexts
        unit_to = at[whole]
        if len(single):
            own = self._string_hashes(single)
            order = np.lexsort((single, own))
            new = np.ones(len(order), bool)
            new[1:] = own[order][1:] != own[order][:-1]
            lead = order[new][np.cumsum(new) - 1]
            view = np.lib.stride_tricks.sliding_window_view(self.raw, self.length)
            for k in range(0, len(order), 20_000):
                new[k : k + 20_000] |= (view[single[order[k : k + 20_000]]] != view[single[lead[k : k + 20_000]]]).any(axis=1)
            one = order[new]
            unit_low, unit_count, unit_key = np.concatenate([unit_low, single[one]]), np.concatenate([unit_count, np.ones(len(one), np.int64)]), np.concatenate([unit_key, own[one]])
            unit_to = np.concatenate([unit_to, single_at[one]])
        bucket = (unit_key & np.uint64(0xFFFFFF)).astype(np.int64) % buckets
        order = np.lexsort((unit_low, unit_key, bucket))
        self.unit_low, self.unit_count, self.unit_key, self.unit_bucket, self.unit_to = unit_low[order], unit_count[order], unit_key[order], bucket[order], unit_to[order]

    def _unequal(self, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First of each kind of equal contexts, and the kind of every context."""
        if not len(low):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, first, kind = np.unique(square(self.raw, low, count + self.length - 1, 2 * self.length - GRAM), return_index=True, return_inverse=True)
        return first, kind.ravel()

    def _string_hashes(self, start: np.ndarray) -> np.ndarray:
        powers = np.array([pow(_MULT, k, 1 << 64) for k in range(self.length)], np.uint64)
        view = np.lib.stride_tricks.sliding_window_view(self.raw, self.length)
        own = np.concatenate([view[start[k : k + 20_000]].astype(np.uint64) @ powers for k in range(0, len(start), 20_000)]) * _MIX
        return own ^ (own >> np.uint64(29))

    def place(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document row and offset in it of block offsets."""
        doc = np.searchsorted(self.ends, start, "right")
        return doc, start - (self.ends - self.size)[doc]


_SENT = "bucket int, block int, kind int, n long, a binary, b binary, c binary, d binary"
_SENT_NAMES = [c.split()[0] for c in _SENT.split(", ")]


def _sent(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=_SENT_NAMES)


def _by_bucket(bucket: np.ndarray):
    """(bucket, first, stop) of a sorted array of buckets."""
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for k, at in enumerate(edge):
        yield int(bucket[at]), int(at), int(edge[k + 1]) if k + 1 < len(edge) else len(bucket)


def _send_anchors(length: int, buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        block, own = rows.column("block")[0].as_py(), Block(rows, length, buckets)
        return _sent([(b, block, 0, t - s, own.distinct[s:t].tobytes(), np.minimum(own.uses[s:t], 2).astype(np.uint8).tobytes(), own.unequal[s:t].astype(np.uint32).tobytes(), None) for b, s, t in _by_bucket(own.distinct_bucket)])

    return run


def _judge_anchors(hot: int):
    """0: an anchor occurs once; 1: more often; 2: in too many unequal contexts for one task."""

    def run(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(a, np.uint64) for a in rows.column("a").to_pylist()])
        uses = np.concatenate([np.frombuffer(b, np.uint8) for b in rows.column("b").to_pylist()])
        unequal = np.concatenate([np.frombuffer(c, np.uint32) for c in rows.column("c").to_pylist()])
        _, inverse = np.unique(keys, return_inverse=True)
        many = np.bincount(inverse, uses) > 1
        flag = (many.astype(np.uint8) + (many & (np.bincount(inverse, unequal) > hot)))[inverse].astype(np.uint8)
        out, at = [], 0
        for bucket, block, n in zip(*(rows.column(c).to_pylist() for c in ("bucket", "block", "n")), strict=True):
            out.append((bucket, block, 0, n, flag[at : at + n].tobytes(), None, None, None))
            at += n
        return _sent(out)

    return run


def _flags(answers: pa.Table) -> np.ndarray:
    got = sorted((b, a) for b, kind, a in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "a")), strict=True) if kind == 0)
    return np.frombuffer(b"".join(a for _, a in got), np.uint8)


def _send_contexts(length: int, buckets: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block, own = rows.column("block")[0].as_py(), Block(rows, length, buckets)
        own.repeated(_flags(answers), buckets)
        low = own.unit_low
        doc, offset = own.place(low)
        ids = np.array([-(2**63) if i is None else i for i in own.ids], np.int64)
        out = []
        for b, s, t in _by_bucket(own.unit_bucket):
            span = own.unit_count[s:t] + length - 1
            places = np.stack([ids[doc[s:t]], own.seq[doc[s:t]], offset[s:t]]).astype(np.int64)
            out.append((b, block, 1, t - s, own.unit_key[s:t].astype(np.uint64).tobytes(), own.unit_count[s:t].astype(np.uint8).tobytes(), own.raw[_expand(low[s:t], span)].tobytes(), places.tobytes()))
        return _sent(out)

    return run


def first_places(raw: np.ndarray, low: np.ndarray, count: np.ndarray, base: np.ndarray, length: int) -> np.ndarray:
    """For each string of each context (at ``low`` in ``raw``, ``count`` strings, the first one at
    place ``base``): the least place of an equal string."""
    windows = _expand(low, count)
    place = np.full(len(raw), -1, np.int64)
    place[windows] = _expand(base, count)
    order = two_stage_suffix_array(raw, length)
    order = order[place[order] >= 0]
    new = common_prefixes(raw, order, length) < length
    new[:1] = True
    edge = np.flatnonzero(new)
    least = np.minimum.reduceat(place[order], edge)
    place[order] = np.repeat(least, np.diff(np.append(edge, len(order))))
    return place[windows]


def _compare(length: int):
    """Context bucket: tell each block which strings of its contexts are the first of the corpus."""

    def run(rows: pa.Table) -> pa.Table:
        sent = list(zip(*(rows.column(c).to_pylist() for c in _SENT_NAMES), strict=True))
        n = np.array([r[3] for r in sent])
        key = np.concatenate([np.frombuffer(r[4], np.uint64) for r in sent])
        count = np.concatenate([np.frombuffer(r[5], np.uint8) for r in sent]).astype(np.int64)
        raw = np.frombuffer(b"".join(r[6] for r in sent), np.uint8)
        doc, seq, offset = np.concatenate([np.frombuffer(r[7], np.int64).reshape(3, -1) for r in sent], axis=1)
        by_doc = np.lexsort((seq, doc))
        new = np.ones(len(by_doc), bool)
        new[1:] = (doc[by_doc][1:] != doc[by_doc][:-1]) | (seq[by_doc][1:] != seq[by_doc][:-1])
        base = np.empty(len(by_doc), np.int64)
        base[by_doc] = (np.cumsum(new) - 1) << 40
        base += offset
        span = count + length - 1
        low = np.cumsum(span) - span
        order = np.argsort(key, kind="stable")
        answer = np.zeros(int(count.sum()), bool)
        answer_at = np.cumsum(count) - count
        k, sorted_key, filled = 0, key[order], np.cumsum(span[order])
        while k < len(order):
            stop = max(k + 1, int(np.searchsorted(filled, (filled[k - 1] if k else 0) + SORT_BYTES, "right")))
            stop = int(np.searchsorted(sorted_key, sorted_key[stop - 1], "right"))
            part = order[k:stop]
            text = raw[_expand(low[part], span[part])]
            own_low = np.cumsum(span[part]) - span[part]
            _, one, inverse = np.unique(square(text, own_low, span[part], int(span[part].max())), return_index=True, return_inverse=True)
            inverse = inverse.ravel()
            earliest = np.full(len(one), np.iinfo(np.int64).max)
            np.minimum.at(earliest, inverse, base[part])
            distinct = text[_expand(own_low[one], span[part][one])]
            distinct_span, distinct_count = span[part][one], count[part][one]
            least = first_places(distinct, np.cumsum(distinct_span) - distinct_span, distinct_count, earliest, length)
            at = np.cumsum(distinct_count) - distinct_count
            answer[_expand(answer_at[part], count[part])] = least[_expand(at[inverse], count[part])] == _expand(base[part], count[part])
            k = stop
        out, at, context = [], 0, 0
        for bucket, block, _, rows_n, *_ in sent:
            size = int(count[context : context + rows_n].sum())
            out.append((bucket, block, 1, size, np.packbits(answer[at : at + size]).tobytes(), None, None, None))
            at += size
            context += rows_n
        assert context == int(n.sum())
        return _sent(out)

    return run


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
_FULL = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def _cut(length: int, buckets: int, digest: bool):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block(rows, length, buckets)
        own.repeated(_flags(answers), buckets)
        got = sorted((b, n, a) for b, kind, n, a in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "n", "a")), strict=True) if kind == 1)
        answer = np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=n) for _, n, a in got]) if got else np.zeros(0, np.uint8)
        first = np.zeros(int(own.context_count.sum()), bool)
        first[_expand(own.unit_to, own.unit_count)] = answer
        change = np.zeros(len(own.raw) + 1, np.int32)
        if len(own.run_low):
            at = np.cumsum(own.context_count) - own.context_count
            is_first = np.zeros(len(own.run_low), bool)
            is_first[own.context_run] = True
            keeps = first[_expand(at[own.run_context], own.run_count)] & np.repeat(is_first, own.run_count)
            starts = _expand(own.run_low, own.run_count)[~keeps]
            change[starts] += 1
            change[starts + length] -= 1  # starts differ, and so do their ends
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        schema = _DIGEST if digest else _FULL
        out = {name: [] for name in schema.names}
        for doc_id, size, end in zip(own.ids, own.size.tolist(), own.ends.tolist(), strict=True):
            mark = gone[end - size : end]
            kept = own.raw[end - size : end][~mark].tobytes()
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
            out["doc_id"].append(doc_id)
            out["n_bytes"].append(size)
            out["n_removed"].append(size - len(kept))
            if digest:
                out["n_spans"].append(len(edges) // 2)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            else:
                out["spans"].append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                out["kept"].append(kept)
        return pa.table(out, schema=schema)

    return run


def suffix_dedup(docs: DataFrame, length: int = 100, digest: bool = False, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut repeated strings of ``length`` bytes (GRAM to 150) out of all documents.

    Returns ``doc_id, n_bytes, n_removed`` and ``spans`` (maximal removed runs of bytes) with
    ``kept`` (remaining bytes), or with ``digest`` their number and SHA-256.
    """
    if not GRAM <= length <= 150:
        raise ValueError(f"length must be from {GRAM} to 150")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    total = text_bytes(docs, text_col)
    blocks, buckets = parts_for(total, BLOCK_BYTES), parts_for(total, BUCKET_BYTES)
    dealt = narrow.select(F.pmod(F.xxhash64(id_order()), F.lit(blocks)).cast("int").alias("block"), "doc_id", "text")
    by_block = dealt.groupBy("block")
    anchors = by_block.applyInArrow(_send_anchors(length, buckets), _SENT)
    flags = anchors.groupBy("bucket").applyInArrow(_judge_anchors(hot), _SENT)
    sent = by_block.cogroup(flags.groupBy("block")).applyInArrow(_send_contexts(length, buckets), _SENT)
    answers = sent.groupBy("bucket").applyInArrow(_compare(length), _SENT)
    out = "doc_id long, n_bytes long, n_removed long, " + ("n_spans long, kept_sha256 string" if digest else "spans array<struct<start:long,end:long>>, kept binary")
    return by_block.cogroup(flags.unionByName(answers).groupBy("block")).applyInArrow(_cut(length, buckets, digest), out)
