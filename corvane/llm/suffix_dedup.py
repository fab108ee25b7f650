"""Removal of byte strings that an earlier document holds too.

A byte is removed if a string of ``length`` bytes that covers it also starts in
a document with a smaller id. Which strings are equal is read off Burrows-
Wheeler transforms built column-wise (``collection_bwt``): equal ones are
neighbours whose common prefix is long enough.

One transform of a whole corpus would need as many passes over all of it as its
longest document has bytes, so the corpus is cut into collections that can be
built apart. The smallest hash of the 20-byte strings inside a 50-byte string
depends on that string alone; consecutive strings with one such key make a
piece of at most 98 bytes, and pieces with one key go to one collection. Equal
strings thus always meet, and a collection takes at most 98 rounds. Keys that
occur in one document alone cannot repeat and are left out first. Equal pieces
are merged, keeping their smallest id, in each group of documents and again in
each collection, so copies cost one string. Every key is solved by a transform;
collections take whole keys up to ``COLLECTION_BYTES`` of distinct pieces, and a
key with more than ``DIVIDE_BYTES`` is divided by further, independent hashes.

Keys that occur in over ``hot_groups`` groups are divided by a second hash
before they travel, and their pieces are merged on the way: first among about
the root of the number of groups, then all. So one passage that every document
holds reaches a task from that many senders, not from every group.

A collection's columns are held in memory, as their size is bounded: a
machine-local file is lost with its executor, and a shared one would be
rewritten every round (figures in the README).

The texts are shuffled once, into groups of about ``GROUP_BYTES``; groups send
keys, get back those that repeat, send their pieces, and get back for each
string the smallest id that holds it.

Defined results: null and empty texts stay empty; rows that share an id don't
remove from one another; a null id counts as larger than all others and removes
nothing; texts of any length are treated whole; an empty table gives an empty
result. Columns named in ``keep`` are carried, others are not.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .collection_bwt import classes
from .common import materialise, small_batches, then_rest

LENGTH = 50
KEY_BYTES = 20
GROUP_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
COLLECTION_BYTES = 1 << 18
#: Distinct pieces of one key that are solved together.
DIVIDE_BYTES = 1 << 20
#: Groups in which a key occurs before it is divided.
HOT_GROUPS = 200
#: Groups from which on the pieces of divided keys are merged on the way.
MERGE_GROUPS = 100_000
_BLOCK = 1 << 14
NO_ID = np.iinfo(np.int64).max
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _hashes(data: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes (8 at least) at each position."""
    n = len(data) - size + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).copy()  # the bytes from each position on
    h, part = np.full(n, _MIX[seed], np.uint64), np.empty(n, np.uint64)
    for i, at in enumerate(sorted({*range(0, size - 7, 8), size - 8})):
        h ^= np.multiply(eight[at : at + n], _MIX[(i + seed) % 4], out=part)
        np.right_shift(h, np.uint64(33), out=part)
        h <<= np.uint64(31)
        h |= part
    for shift, mix in ((29, _MIX[1]), (32, _MIX[0])):
        h *= mix
        h ^= np.right_shift(h, np.uint64(shift), out=part)
    return h


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n, step, m = len(h) - width + 1, 1, h
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    return m[:n] if step == width else np.minimum(m[:n], m[width - step : width - step + n])


class Group:
    """The texts of one group, one after the other, in the order of their ids."""

    def __init__(self, table: pa.Table, length: int, id_name: str = "__id", text_name: str = "__text"):
        rows = list(zip(table.column(id_name).to_pylist(), (t or b"" for t in table.column(text_name).to_pylist()), range(table.num_rows), strict=True))
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.length = length
        self.rows = [r[2] for r in rows]
        self.ids = np.array([NO_ID if r[0] is None else r[0] for r in rows], np.int64)
        self.sizes = np.array([len(r[1]) for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
        self.doc = np.repeat(np.arange(len(rows), dtype=np.int32), np.maximum(self.sizes - length + 1, 0))  # of each string
        ends = np.cumsum(np.maximum(self.sizes - length + 1, 0))
        first = ends - np.maximum(self.sizes - length + 1, 0)
        self.at = np.arange(len(self.doc)) + (self.starts - first)[self.doc]

    def _keys(self, seed: int) -> np.ndarray:
        n = max(0, len(self.data) - self.length + 1)
        out = np.empty(n, np.uint64)
        for i in range(0, n, _BLOCK):  # small enough to stay in the processor's cache
            m = min(_BLOCK, n - i)
            out[i : i + m] = _smallest(_hashes(self.data[i : i + m + self.length - 1], KEY_BYTES, seed), self.length - KEY_BYTES + 1)
        return out[self.at]

    def keys(self) -> np.ndarray:
        """Key of each string, even."""
        return self._keys(0) & ~np.uint64(1)

    def divided(self, keys: np.ndarray) -> np.ndarray:
        """The keys of all strings by a second hash."""
        return (keys * _MIX[2] ^ self._keys(1)) & ~np.uint64(1)

    def runs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first string, number of strings) of each piece."""
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(keys)))
        most = self.length - 1
        parts = -(-count // most)
        if (parts > 1).any():
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first, count = np.repeat(first, parts) + nth * most, np.minimum(np.repeat(count, parts) - nth * most, most)
        return first, count

    def pieces(self, repeated: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the pieces with a repeated key: (first string, count, key, whether it is hot, number of its distinct piece), and the distinct pieces."""
        keys = self.keys()
        first, count = self.runs(keys)
        on = member(keys[first], repeated)
        very = on & member(keys[first], hot)
        if very.any():
            string = np.repeat(very, count)
            keys = np.where(string, self.divided(keys), keys)
            may = np.repeat(on, count)
            first, count = self.runs(keys)
            on, very = may[first], string[first]
        first, count, very = first[on], count[on], very[on]
        flat, sizes = gather(self.data, self.at[first], count + self.length - 1)
        coded = binary(flat, sizes).dictionary_encode()
        return first, count, keys[first], very, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``data`` put together."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return data[at], sizes


def binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def spans_of(a: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, sizes) of a binary array."""
    a = a.cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and len(a) else np.empty(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


def merged(pieces: pa.Array, keys: np.ndarray, ids: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pieces with their keys and smallest ids, and the number of each piece's distinct one."""
    coded = pieces.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    least, key = np.full(len(coded.dictionary), NO_ID), np.zeros(len(coded.dictionary), np.uint64)
    np.minimum.at(least, which, ids)
    key[which] = keys
    return coded.dictionary, key, least, which


def smallest_ids(pieces: pa.Array, keys: np.ndarray, ids: np.ndarray, length: int, seed: int = 2) -> list[np.ndarray]:
    """For each distinct piece, with its key and smallest id: of each of its strings the smallest id that holds it."""
    flat, counts = _smallest_ids(pieces, keys, ids, length, seed)
    return np.split(flat, np.cumsum(counts)[:-1])


def _smallest_ids(pieces: pa.Array, keys: np.ndarray, ids: np.ndarray, length: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """``smallest_ids`` one after the other, and the number of strings of each piece.

    They are read off the transforms of whole keys, of about ``COLLECTION_BYTES``
    together; a key of over ``DIVIDE_BYTES`` is divided by another hash.
    """
    data, starts, sizes = spans_of(pieces)
    counts = sizes - length + 1
    flat, at = np.repeat(ids, counts), np.cumsum(counts) - counts
    order = np.argsort(keys, kind="stable")
    last = np.append(keys[order][1:] != keys[order][:-1], True) if len(keys) else np.empty(0, bool)
    total = np.cumsum(sizes[order])
    i = 0
    while i < len(order):
        before = total[i - 1] if i else 0
        end = i + int(np.argmax(last[i:]))  # of the first key
        if total[end] - before > DIVIDE_BYTES and seed < len(_MIX):
            part = order[i : end + 1]
            places, _ = gather(np.arange(len(flat)), at[part], counts[part])
            flat[places] = _divide(data, starts[part], sizes[part], ids[part], length, seed)
            i = end + 1
            continue
        j = int(np.searchsorted(total, before + COLLECTION_BYTES, side="right"))
        j = max(i, min(j, len(order) - 1))
        j += int(np.argmax(last[j:])) + 1
        part = order[i:j]
        found = classes(data, starts[part], sizes[part], length)
        best = np.full(1 + max((int(g.max(initial=0)) for _, _, g in found), default=0), NO_ID)
        for _, strings, group in found:
            np.minimum.at(best, group, ids[part[strings]])
        for size, strings, group in found:
            p = part[strings]
            flat[at[p] + sizes[p] - size] = best[group]
        i = j
    return flat, counts


def _divide(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, length: int, seed: int) -> np.ndarray:
    """``smallest_ids``, one after the other, of the pieces of one key, cut where the smallest hash by ``seed`` changes."""
    flat, _ = gather(data, starts, sizes)
    counts = sizes - length + 1
    own = np.repeat(np.arange(len(sizes)), counts)  # piece of each string
    at = np.arange(len(own)) + (own * (length - 1))  # its place in ``flat``
    key = _smallest(_hashes(flat, KEY_BYTES, seed), length - KEY_BYTES + 1)[at]
    new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(own)))
    parts, part_sizes = gather(flat, at[first], runs + length - 1)
    distinct, keys, least, which = merged(binary(parts, part_sizes), key[first], ids[own[first]])
    found, strings = _smallest_ids(distinct, keys, least, length, seed + 1)
    return gather(found, (np.cumsum(strings) - strings)[which], strings[which])[0]


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), hot_groups: int = HOT_GROUPS, as_text: bool = False, merge_groups: int = MERGE_GROUPS) -> DataFrame:
    """id, the columns of ``keep``, n_bytes, n_removed, n_spans and ``kept`` of each row: the bytes that stay, or with ``as_text`` their whole characters."""
    if length < KEY_BYTES or 2 * length - 2 > 254:
        raise ValueError("length must be from 20 to 128")
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string").cast("binary")
    src = docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("__text"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
    total = src.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n_groups, n_buckets = max(1, -(-total // GROUP_BYTES)), max(1, -(-total // BUCKET_BYTES))
    dealt = src.withColumn("g", F.pmod(F.xxhash64("__id", "__text"), F.lit(n_groups))).repartition(F.col("g"))
    texts = dealt.select("g", "__id", "__text")

    names = ("bucket", "pieces", "sizes", "piece_keys", "ids")

    def send_keys(t: pa.Table) -> pa.Table:
        group = Group(t, length)
        keys, rows = group.keys(), []
        first, _ = group.runs(keys)
        k, d = keys[first], group.ids[group.doc[first]]
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        head = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.int64)
        tail = np.append(head[1:], len(k))[: len(head)] - 1
        k = k[head] | (d[head] != d[tail]).astype(np.uint64)  # odd: in several documents of this group
        where = _bucket(k, n_buckets)
        order = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[order], np.arange(n_buckets + 1))
        for b in np.unique(where).tolist():
            rows.append((b, k[order[cuts[b] : cuts[b + 1]]].tobytes()))
        return _rows(rows, g=t.column("g")[0].as_py(), names=("bucket", "keys"))

    def repeated_keys(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("keys")]
        every = np.sort(np.concatenate(parts))
        plain = every & ~np.uint64(1)
        head = np.flatnonzero(np.append(True, plain[1:] != plain[:-1]))
        n = np.diff(np.append(head, len(plain)))
        odd = np.maximum.reduceat(every & np.uint64(1), head)
        again = (n > 1) | (odd == 1)
        known = plain[head[again]] | (n[again] > hot_groups).astype(np.uint64)  # odd: hot
        rows = []
        for g, part in zip(t.column("g").to_pylist(), parts, strict=True):
            part = part & ~np.uint64(1)
            at = np.searchsorted(known & ~np.uint64(1), part)
            at[at == len(known)] = 0
            mine = known[at[(known[at] & ~np.uint64(1)) == part]] if len(known) else known
            if len(mine):
                rows.append((g, mine.tobytes()))
        return pa.table({"g": pa.array([r[0] for r in rows], pa.int64()), "keys": pa.array([r[1] for r in rows], pa.binary())})

    def answers(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        k = np.sort(np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(x.as_py(), np.uint64) for x in t.column("keys")]]))
        return k & ~np.uint64(1), k[(k & np.uint64(1)) == 1] & ~np.uint64(1)

    def distinct_pieces(group: Group, lists: pa.Table):
        """Pieces of a group by bucket, hot ones after all others: what is sent and what ``finish`` gets answers for, in one order."""
        first, count, keys, very, which, distinct = group.pieces(*answers(lists))
        n = len(distinct)
        ids, key, hot = np.full(n, NO_ID), np.zeros(n, np.uint64), np.zeros(n, bool)
        np.minimum.at(ids, which, group.ids[group.doc[first]])
        key[which], hot[which] = keys, very & (n_groups > merge_groups)
        where = _bucket(key, n_buckets) + n_buckets * hot
        order = np.argsort(where, kind="stable")
        return first, count, which, distinct, ids, key, order, where[order]

    def send_pieces(hot: bool):
        def send(t: pa.Table, lists: pa.Table) -> pa.Table:
            if not t.num_rows:
                return _rows([], 0, names)
            group, rows = Group(t, length), []
            _, _, _, distinct, ids, key, order, where = distinct_pieces(group, lists)
            data, starts, sizes = spans_of(distinct)
            for b in np.unique(where).tolist():
                if (b >= n_buckets) == hot:
                    some = order[slice(*np.searchsorted(where, [b, b + 1]))]
                    flat, _ = gather(data, starts[some], sizes[some])
                    rows.append((b, _pack(flat), _pack(sizes[some].astype(np.uint8)), key[some].tobytes(), _pack(ids[some])))
            return _rows(rows, t.column("g")[0].as_py(), names)

        return send

    def received(t: pa.Table) -> tuple:
        """Distinct pieces of many senders with keys and smallest ids, the number of each sent piece's, and how many each sent."""
        sizes = [_open(x, np.uint8).astype(np.int64) for x in t.column("sizes")]
        flat = np.concatenate([_open(x, np.uint8) for x in t.column("pieces")])
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in t.column("piece_keys")])
        return *merged(binary(flat, np.concatenate(sizes)), keys, np.concatenate([_open(x, np.int64) for x in t.column("ids")])), [len(s) for s in sizes]

    def merge(t: pa.Table) -> pa.Table:
        """Of the hot pieces of some groups each once, sent on under a number below zero."""
        distinct, keys, ids, _, _ = received(t.sort_by("g"))  # in one order here and in ``spread``
        data, _, sizes = spans_of(distinct)
        return _rows([(t.column("bucket")[0].as_py(), _pack(data[: sizes.sum()]), _pack(sizes.astype(np.uint8)), keys.tobytes(), _pack(ids))], -1 - t.column("part")[0].as_py(), names)

    def answer(t: pa.Table, which: np.ndarray, sent: list[int], runs: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> pa.Table:
        """What each sender of ``t`` learns of its pieces. ``runs``: of each distinct piece, runs of strings with one smallest id; ``lens`` and ``ids`` of these runs."""
        at, rows, i = np.cumsum(runs) - runs, [], 0
        for g, n in zip(t.column("g").to_pylist(), sent, strict=True):
            w = which[i : i + n]
            i += n
            some, _ = gather(ids, at[w], runs[w])
            sizes, _ = gather(lens, at[w], runs[w])
            rows.append((t.column("bucket")[0].as_py(), _pack(runs[w].astype(np.uint8)), _pack(sizes), _pack(some), g))
        return pa.table({"g": pa.array([r[4] for r in rows], pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()), **{n: pa.array([r[k] for r in rows], pa.binary()) for k, n in enumerate(("runs", "lens", "ids"), 1)}})

    def solve(t: pa.Table) -> pa.Table:
        distinct, keys, ids, which, sent = received(t)
        every, counts = _smallest_ids(distinct, keys, ids, length)
        at = np.cumsum(counts) - counts
        new = np.append(True, every[1:] != every[:-1])
        new[at] = True
        heads = np.flatnonzero(new)
        return answer(t, which, sent, np.add.reduceat(new, at), np.diff(np.append(heads, len(every))).astype(np.uint8), every[heads])

    def spread(t: pa.Table, solved: pa.Table) -> pa.Table:
        """Answers to merged pieces, handed on to the groups that sent them."""
        t = t.sort_by("g")
        _, _, _, which, sent = received(t)
        runs, lens, ids = (np.concatenate([_open(x, k) for x in solved.column(c)]) for c, k in (("runs", np.uint8), ("lens", np.uint8), ("ids", np.int64)))
        return answer(t, which, sent, runs.astype(np.int64), lens, ids)

    def finish(t: pa.Table, both: pa.Table) -> pa.Table:
        if not t.num_rows:
            return out_schema.empty_table()
        group = Group(t, length)
        lists, solved = both.filter(pa.compute.is_valid(both.column("keys"))), both.filter(pa.compute.is_valid(both.column("runs"))).sort_by("bucket")
        first, count, which, distinct, _, _, order, _ = distinct_pieces(group, lists)
        runs, lens, ids = (np.concatenate([np.empty(0, k), *[_open(x, k) for x in solved.column(c)]]) for c, k in (("runs", np.uint8), ("lens", np.uint8), ("ids", np.int64)))
        if len(runs) != len(distinct):
            raise RuntimeError("answers don't match the pieces that were sent")
        values = np.repeat(ids, lens)  # of each string of each distinct piece, in the order sent
        ends = np.cumsum(np.add.reduceat(lens.astype(np.int64), np.cumsum(runs.astype(np.int64)) - runs)) if len(runs) else np.empty(0, np.int64)
        sizes = np.diff(np.append(0, ends))
        begin = np.empty(len(distinct), np.int64)
        begin[order] = ends - sizes
        least, _ = gather(values, begin[which], count)
        string = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        gone = group.at[string[least < group.ids[group.doc[string]]]]
        n = len(group.data)
        covered = np.cumsum(np.bincount(gone, minlength=n)[:n] - np.bincount(gone + length, minlength=n)[:n]) > 0
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        inner = group.starts[group.starts < len(covered)]
        begins[inner] = covered[inner]
        upto = lambda x: np.concatenate(([0], np.cumsum(x)))
        a, b = group.starts, group.starts + group.sizes
        removed, spans = (upto(x)[b] - upto(x)[a] for x in (covered, begins))
        kept = [group.data[i:j][~covered[i:j]].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        kept = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        cols = [t.column(c).take(pa.array(group.rows)).combine_chunks() for c in t.column_names if c not in ("g", "__text")]
        return pa.Table.from_arrays([*cols, pa.array(group.sizes), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)), kept], names=[*(c for c in t.column_names if c not in ("g", "__text")), "n_bytes", "n_removed", "n_spans", "kept"])

    keys = texts.groupBy("g").applyInArrow(then_rest(send_keys), "g long, bucket long, keys binary")
    lists = keys.groupBy("bucket").applyInArrow(then_rest(repeated_keys), "g long, keys binary")
    sent, told = "g long, bucket long, pieces binary, sizes binary, piece_keys binary, ids binary", "g long, bucket long, runs binary, lens binary, ids binary"
    answered = texts.groupBy("g").cogroup(lists.groupBy("g"))
    pieces = answered.applyInArrow(then_rest(send_pieces(hot=False)), sent)
    if n_groups <= merge_groups:
        solved = pieces.groupBy("bucket").applyInArrow(then_rest(solve), told)
    else:
        few = max(2, math.isqrt(n_groups))
        hot = answered.applyInArrow(then_rest(send_pieces(hot=True)), sent).withColumn("part", F.floor(F.col("g") / few))
        every = pieces.unionByName(hot.groupBy("part", "bucket").applyInArrow(then_rest(merge), sent))
        solved = materialise(every.groupBy("bucket").applyInArrow(then_rest(solve), told))
        back = solved.filter("g < 0").withColumn("part", -1 - F.col("g"))
        solved = solved.filter("g >= 0").unionByName(hot.groupBy("part", "bucket").cogroup(back.groupBy("part", "bucket")).applyInArrow(then_rest(spread), told))
    both = lists.unionByName(solved, allowMissingColumns=True)
    carried = [(n, k) for n, k in dealt.dtypes if n not in ("g", "__text")]
    schema = ", ".join(f"`{n}` {k}" for n, k in carried) + ", n_bytes long, n_removed long, n_spans long, kept " + ("string" if as_text else "binary")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out_schema = to_arrow_schema(_parse_datatype_string(schema))
    out = dealt.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(then_rest(finish), schema)
    return out.select(F.col("__id").alias(id_col), *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_removed", "n_spans", "kept")


def _press(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).view(np.uint8), "zstd", asbytes=True) if len(a) else b""


def _open(x: pa.Scalar, kind) -> np.ndarray:
    """An array that ``_pack`` made."""
    data = x.as_py()
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], n, "zstd"), kind) if n else np.empty(0, kind)


def _pack(a: np.ndarray) -> bytes:
    return a.nbytes.to_bytes(8, "little") + _press(a)


def _rows(rows: list[tuple], g: int, names: tuple[str, ...]) -> pa.Table:
    """Rows of one group: its number, a bucket and binary columns."""
    kinds = [pa.int64(), *[pa.binary()] * (len(names) - 1)]
    return pa.table({"g": pa.array([g] * len(rows), pa.int64()), **{n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))}})


def query(spark, sf_dir):
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
