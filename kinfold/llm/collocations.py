"""Phrase collocations by Rabin-Karp fingerprints.

A scan turns texts into bytes, finds words and hashes every run of n words with prefix polynomials: the hash of
any stretch is a difference of two prefixes. Equal stretches of a chunk of text are folded into one partial: a
fingerprint, a count, and a pointer to one occurrence. Partials meet by fingerprint; where their counts reach the
minimum, all their pointers go back to the documents, which return the words themselves. Counting those settles
collisions exactly, and only phrases that may be frequent are ever written out as text.

Lengths are counted one after the other. A run of n words is frequent only if both runs of n - 1 words in it are,
so each scan looks its runs up in a filter of the frequent fingerprints of the length before. The filter may let
others pass and never holds one back; its size is bounded, so very large tables prune less, not wrongly.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint, scratch_path
from .common import bounded_batches, text_of

CHUNK_BYTES = 8 << 20  # text that is folded into partials at once
PART_BYTES = 4 << 20  # text per bucket of fingerprints, and per slot of documents
LEAST_PARTS = 1024
FILTER_BYTES = 32 << 20  # of the filter that travels to all tasks
FILTER_SHARE = 16  # bits per frequent fingerprint, until that bound
POINTERS = 1 << 20  # pointers that a task gathers before it passes them on
PHRASES = 1 << 19  # phrases that a task gathers before it folds or passes them on
SLICE = 1 << 20  # bytes that share one prefix polynomial
BASE = 0x9E3779B97F4A7C15
UNDEFINED = "und"

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0x09] = 0x20


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


_UP, _DOWN = _powers(BASE, SLICE), _powers(pow(BASE, -1, 1 << 64), SLICE)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits; the low bits of a polynomial modulo 2^64 depend on low bits only."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of some documents: ``text`` has them with one blank between neighbours of a piece."""

    text: np.ndarray  # bytes, lower case
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    joined: np.ndarray  # whether the next word is in the same piece
    seeds: np.ndarray  # per document

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> Words:
        """Words of the documents whose bytes lie between ``offsets``."""
        n = len(data)
        low, kind = _LOWER[data], _CLASS[data]
        fresh = np.zeros(n + 1, bool)
        fresh[offsets] = True
        word = kind == 0
        cut = fresh[1:n] | ~word[:-1]
        first, last = word.copy(), word.copy()
        first[1:] &= cut
        last[:-1] &= fresh[1:n] | ~word[1:]
        keep = word.copy()
        keep[1:] |= (kind[1:] == 1) & word[:-1] & ~fresh[1:n]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        at = np.cumsum(keep, dtype=np.int32)[s] - np.int32(1)
        breaks = np.cumsum((kind == 2) | fresh[:n], dtype=np.int32)[s]
        doc = (np.searchsorted(offsets, s, side="right") - 1).astype(np.int32)
        joined = np.zeros(len(s), bool)
        joined[:-1] = breaks[1:] == breaks[:-1]
        return cls(low[keep], at, at + (e - s).astype(np.int32), doc, joined, seeds)

    @classmethod
    def together(cls, parts: list[Words]) -> Words:
        if len(parts) == 1:
            return parts[0]
        bytes_before = np.cumsum([0] + [len(p.text) for p in parts], dtype=np.int32)
        docs_before = np.cumsum([0] + [len(p.seeds) for p in parts], dtype=np.int32)
        return cls(
            np.concatenate([p.text for p in parts]),
            np.concatenate([p.start + b for p, b in zip(parts, bytes_before)]),
            np.concatenate([p.end + b for p, b in zip(parts, bytes_before)]),
            np.concatenate([p.doc + d for p, d in zip(parts, docs_before)]),
            np.concatenate([p.joined for p in parts]), np.concatenate([p.seeds for p in parts]),
        )

    def runs(self, n: int) -> np.ndarray:
        """Words at which a run of ``n`` words of one piece starts."""
        ok = np.ones(max(len(self.start) - n + 1, 0), bool)
        for i in range(n - 1):
            ok &= self.joined[i : i + len(ok)]
        return np.flatnonzero(ok)

    def fingerprints(self, at: np.ndarray, n: int, bits: int = 64) -> np.ndarray:
        """Hashes of the runs of ``n`` words that start at the words ``at``, which ascend."""
        out = np.empty(len(at), np.uint64)
        s, e = self.start[at], self.end[at + n - 1]
        done = 0
        while done < len(at):
            base = int(s[done])
            stop = max(done + 1, int(np.searchsorted(s, base + SLICE - (1 << 12))))
            m = int(e[done:stop].max() - base)
            up, down = (_UP, _DOWN) if m <= SLICE else (_powers(BASE, m), _powers(pow(BASE, -1, 1 << 64), m))
            prefix = np.zeros(m + 1, np.uint64)
            np.cumsum((self.text[base : base + m].astype(np.uint64) + np.uint64(1)) * up[:m], out=prefix[1:])
            a, b = s[done:stop] - base, e[done:stop] - base
            out[done:stop] = (prefix[b] - prefix[a]) * down[a]
            done = stop
        seeded = _mixed(out + self.seeds[self.doc[at]] + np.uint64(n))
        return seeded if bits >= 64 else seeded >> np.uint64(64 - bits) << np.uint64(64 - bits)

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the runs of ``n`` words at ``a`` and at ``b`` have the same text and seed."""
        size = self.end[a + n - 1] - self.start[a]
        equal = (size == self.end[b + n - 1] - self.start[b]) & (self.seeds[self.doc[a]] == self.seeds[self.doc[b]])
        long = np.flatnonzero(equal & (size > 256))
        for i in long:  # few
            x, y = self.start[a[i]], self.start[b[i]]
            equal[i] = np.array_equal(self.text[x : x + size[i]], self.text[y : y + size[i]])
        padded = np.append(self.text, np.zeros(8, np.uint8))
        left = np.flatnonzero(equal & (size <= 256))
        done = 0
        while len(left):
            rest = size[left] - done
            x = _eight(padded, self.start[a[left]] + done) ^ _eight(padded, self.start[b[left]] + done)
            mask = np.where(rest >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * np.minimum(rest, 7)).astype(np.uint64)) - np.uint64(1))
            differ = (x & mask) != 0
            equal[left[differ]] = False
            left = left[~differ & (rest > 8)]
            done += 8
        return equal

    def phrases(self, at: np.ndarray, n: np.ndarray) -> pa.Array:
        """The texts of runs, as an Arrow string array."""
        s = self.start[at].astype(np.int64)
        size = self.end[at + n - 1] - s
        ends = np.cumsum(size)
        from_ = np.arange(ends[-1] if len(ends) else 0) + np.repeat(s - ends + size, size)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(self.text[from_])])


def _eight(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as one number; the array ends with eight more."""
    view = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    return view[at]


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and the offsets between its values."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _words_of(batch: pa.RecordBatch) -> Words:
    seeds = {lang: _seed(lang) for lang in batch.column("lang").unique().to_pylist()}
    data, offsets = _bytes_of(batch.column("text"))
    return Words.of(data, offsets, np.array([seeds[x] for x in batch.column("lang").to_pylist()], np.uint64))


# --- partials and pointers travel as packed columns ---

def _pack(*columns: np.ndarray) -> tuple[int, bytes]:
    """Byte planes of all columns, compressed; high bytes are mostly alike."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return len(planes), pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(body: bytes, size: int, kinds: list[str]) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, out, at = size // sum(widths), [], 0
    for k, w in zip(kinds, widths):
        out.append(np.ascontiguousarray(planes[at : at + n * w].reshape(w, n).T).view(k).reshape(-1))
        at += n * w
    return out


_PARTIAL = ["<u8", "<u8", "<u4", "<u4"]  # fingerprint (as differences), document, word, count
_POINTER = ["<u8", "<u4", "<u4", "<u2", "<u1"]  # document, word, count, check bits of the fingerprint, words
_PACKED = "part int, kind string, size int, body binary"
_PACKED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.string()), ("size", pa.int32()), ("body", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _PACKED_ARROW.types)], schema=_PACKED_ARROW)


def _split(parts: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Stretches of equal values of a sorted array."""
    edges = np.searchsorted(parts, np.arange(count + 1))
    for p in np.flatnonzero(np.diff(edges)):
        yield int(p), slice(int(edges[p]), int(edges[p + 1]))


@dataclass
class Filter:
    """Bits of the frequent fingerprints, a stretch per bucket; two bits each."""

    bits: np.ndarray
    base: np.ndarray
    mask: np.ndarray
    shift: int

    @staticmethod
    def places(fp: np.ndarray, mask) -> tuple[np.ndarray, np.ndarray]:
        return fp & mask, (fp >> np.uint64(20)) * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(30) & mask

    @staticmethod
    def stretch(fp: np.ndarray, most_bits: int) -> bytes:
        size = min(1 << max(3, int(len(fp) * FILTER_SHARE - 1).bit_length()), most_bits)
        bits = np.zeros(size, bool)
        for at in Filter.places(fp, np.uint64(size - 1)):
            bits[at] = True
        return np.packbits(bits, bitorder="little").tobytes()

    @classmethod
    def of(cls, stretches: dict[int, bytes], buckets: int) -> Filter:
        base, mask, at = np.zeros(buckets, np.uint64), np.zeros(buckets, np.uint64), 1
        for b, body in stretches.items():
            base[b], mask[b], at = at * 8, len(body) * 8 - 1, at + len(body)
        bits = np.frombuffer(b"\0" + b"".join(stretches.values()), np.uint8)
        return cls(bits, base, mask, 64 - (buckets.bit_length() - 1))

    def passes(self, fp: np.ndarray) -> np.ndarray:
        b = (fp >> np.uint64(self.shift)).astype(np.int64)
        ok = np.ones(len(fp), bool)
        for at in self.places(fp, self.mask[b]):
            at = at + self.base[b]
            ok &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return ok


def _partials(words: Words, keys: np.ndarray, n: int, known: Filter | None, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Fold the runs of ``n`` words of a chunk, bucket by bucket of their fingerprints."""
    at = words.runs(n)
    if known is not None and len(at):
        passed = np.zeros(len(words.start), bool)
        before = words.runs(n - 1)
        passed[before] = known.passes(words.fingerprints(before, n - 1, bits))
        at = at[passed[at] & passed[at + 1]]
    if not len(at):
        return
    fp = words.fingerprints(at, n, bits)
    order = np.argsort(fp, kind="stable")
    fp, at = fp[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
    head = np.repeat(first, np.diff(np.append(first, len(fp))))
    rest = np.flatnonzero(head != np.arange(len(fp)))
    odd = rest[~words.same(at[rest], at[head[rest]], n)]
    if len(odd):  # collisions inside the chunk: each text gets a partial of its own
        heads: dict[tuple, int] = {}
        for i in odd:
            w = at[i]
            text = words.text[words.start[w] : words.end[w + n - 1]].tobytes()
            head[i] = heads.setdefault((int(fp[i]), int(words.seeds[words.doc[w]]), text), int(i))
    count = np.bincount(head, minlength=len(fp))
    kept = np.flatnonzero(count)
    fp, at, count = fp[kept], at[kept], count[kept]
    doc = words.doc[at]
    starts = np.searchsorted(words.doc, np.arange(len(keys)))
    key, word = keys[doc], at - starts[doc]
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    rows = []
    for b, part in _split((fp >> shift).astype(np.int64), buckets):
        f = fp[part]
        rows.append((b, "f", *_pack(np.diff(f, prepend=np.uint64(0)), key[part], word[part].astype("<u4"), count[part].astype("<u4"))))
    yield _batch(rows)


def _scan(batches: Iterator[pa.RecordBatch], n: int, known, buckets: int, bits: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    known = known.value if known is not None else None
    held, keys, size = [], [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(_words_of(batch))
        keys.append(batch.column("key").to_numpy().view(np.uint64))
        size += len(held[-1].text)
        if size >= chunk_bytes:
            yield from _partials(Words.together(held), np.concatenate(keys), n, known, buckets, bits)
            held, keys, size = [], [], 0
    if held:
        yield from _partials(Words.together(held), np.concatenate(keys), n, known, buckets, bits)


def _meet(batches: Iterator[pa.RecordBatch], n: int, min_count: int, buckets: int, slots: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket. Of fingerprints that reach the minimum all partials pass on, as pointers."""
    most_bits = 1 << ((FILTER_BYTES * 8 // buckets).bit_length() - 1)
    pending: list[list[np.ndarray]] = []
    waiting = 0

    def settle(bodies: list[tuple[bytes, int]]) -> tuple[list[np.ndarray], np.ndarray] | None:
        columns = [_unpack(body, size, _PARTIAL) for body, size in bodies]
        fp = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns])
        key, word, count = (np.concatenate([c[i] for c in columns]) for i in (1, 2, 3))
        order = np.argsort(fp, kind="stable")
        fp, key, word, count = fp[order], key[order], word[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
        total = np.add.reduceat(count.astype(np.int64), first)
        kept = np.repeat(total >= min_count, np.diff(np.append(first, len(fp))))
        if not kept.any():
            return None
        found = [key[kept], word[kept], count[kept], (fp[kept] >> np.uint64(40)).astype("<u2"), np.full(kept.sum(), n, "<u1")]
        return found, fp[first][total >= min_count]

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate([p[i] for p in pending]) for i in range(len(_POINTER))]
        slot = (columns[0] % np.uint64(slots)).astype(np.int64)
        order = np.lexsort((columns[0], slot))
        columns, slot = [c[order] for c in columns], slot[order]
        return _batch([(s, "p", *_pack(*(c[part] for c in columns))) for s, part in _split(slot, slots)])

    bucket, bodies = None, []

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal pending, waiting
        settled = settle(bodies) if bodies else None
        if settled:
            pending.append(settled[0])
            waiting += len(settled[0][0])
            body = Filter.stretch(settled[1], most_bits)
            yield _batch([(bucket, "b", len(body), body)])
        if waiting >= POINTERS:
            yield flush()
            pending, waiting = [], 0

    for batch in batches:
        for p, size, body in zip(batch.column("part").to_pylist(), batch.column("size").to_pylist(), batch.column("body").to_pylist()):
            if p != bucket:
                yield from close()
                bucket, bodies = p, []
            bodies.append((body, size))
    yield from close()
    if pending:
        yield flush()


_FOUND = "lang string, n int, phrase string, f long"
_FOUND_ARROW = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.large_string()), ("f", pa.int64())])
_KEYS = ["part", "lang", "n", "phrase"]


def _folded(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """One row per phrase, its counts added up."""
    return pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("f", "sum")]).rename_columns([*keys, "f"])


def _pack_phrases(t: pa.Table) -> Iterator[tuple[int, str, int, bytes]]:
    """A row per bucket: numbers of rows and bytes of languages, then languages, counts, lengths and texts."""
    t = t.take(pa.compute.sort_indices(t, [("part", "ascending"), ("phrase", "ascending")])).combine_chunks()
    lang = t.column("lang").combine_chunks().dictionary_encode() if t.num_rows else None
    names = json.dumps(lang.dictionary.to_pylist() if lang is not None else []).encode()
    parts = t.column("part").to_numpy()
    text, offsets = _bytes_of(t.column("phrase").combine_chunks())
    code, n, f = lang.indices.to_numpy().astype("<u4"), t.column("n").to_numpy().astype("<u1"), t.column("f").to_numpy().astype("<u8")
    lengths = np.diff(offsets).astype("<u4")
    for p in np.unique(parts):
        i, j = np.searchsorted(parts, [p, p + 1])
        planes = b"".join(c[i:j].view(np.uint8).reshape(j - i, -1).T.tobytes() for c in (code, n, f, lengths))
        body = np.array([j - i, len(names)], "<u4").tobytes() + names + planes + text[offsets[i] : offsets[j]].tobytes()
        yield int(p), "f", len(body), pa.compress(body, codec="zstd", asbytes=True)


def _unpack_phrases(body: bytes, size: int) -> pa.Table:
    raw = pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
    rows, named = np.frombuffer(raw[:8], "<u4").tolist()
    names, at, columns = json.loads(raw[8 : 8 + named]), 8 + named, []
    for kind in ("<u4", "<u1", "<u8", "<u4"):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, rows * width, at).reshape(width, rows)
        columns.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += rows * width
    code, n, f, lengths = columns
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    phrase = pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(raw[at:])])
    lang = pa.array(names, pa.string()).take(pa.array(code.astype(np.int64)))
    return pa.table({"lang": lang, "n": pa.array(n.astype(np.int32)), "phrase": phrase, "f": pa.array(f.astype(np.int64))})


def _count(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket: phrases that reach the minimum, and the words of each language."""
    part, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if held:
            t = _folded(held, ["lang", "n", "phrase"])
            t = t.filter(pa.compute.or_(pa.compute.greater_equal(t["f"], min_count), pa.compute.equal(t["n"], 0)))
            yield from t.select(_FOUND_ARROW.names).cast(_FOUND_ARROW).to_batches()

    for batch in batches:
        for p, size, body in zip(batch.column("part").to_pylist(), batch.column("size").to_pylist(), batch.column("body").to_pylist()):
            if p != part:
                yield from close()
                part, held = p, []
            held.append(_unpack_phrases(body, size))
    yield from close()


class _Slot:
    """Pointers of one slot, resolved while its documents pass by."""

    def __init__(self, bodies: list[tuple[bytes, int]]):
        columns = [_unpack(body, size, _POINTER) for body, size in bodies]
        self.key, self.word, self.count, self.check, self.n = (
            np.concatenate([c[i] for c in columns]) if columns else np.empty(0, _POINTER[i]) for i in range(len(_POINTER))
        )
        order = np.argsort(self.key, kind="stable")
        self.key, self.word, self.count, self.check, self.n = (
            c[order] for c in (self.key, self.word, self.count, self.check, self.n)
        )
        self.open = np.ones(len(order), bool)

    def resolve(self, words: Words, keys: np.ndarray, langs: list[str], buckets: int, bits: int) -> pa.Table | None:
        a, b = np.searchsorted(self.key, keys, side="left"), np.searchsorted(self.key, keys, side="right")
        doc = np.repeat(np.arange(len(keys)), b - a)
        at = np.arange(len(doc)) + np.repeat(a - np.cumsum(b - a) + (b - a), b - a)
        fit = self.open[at]
        doc, at = doc[fit], at[fit]
        starts = np.searchsorted(words.doc, np.arange(len(keys) + 1))
        word, n = starts[doc] + self.word[at], self.n[at].astype(np.int64)
        fit = word + n <= starts[doc + 1]
        doc, at, word, n = doc[fit], at[fit], word[fit], n[fit]
        fp = np.zeros(len(at), np.uint64)
        for length in np.unique(n):
            mine = np.flatnonzero(n == length)
            mine = mine[np.argsort(word[mine], kind="stable")]
            fp[mine] = words.fingerprints(word[mine], int(length), bits)
        fit = (fp >> np.uint64(40)).astype("<u2") == self.check[at]
        doc, at, word, n, fp = doc[fit], at[fit], word[fit], n[fit], fp[fit]
        _, once = np.unique(at, return_index=True)  # rows that repeat a document resolve its pointers once
        doc, at, word, n, fp = doc[once], at[once], word[once], n[once], fp[once]
        self.open[at] = False
        if not len(at):
            return None
        part = (fp >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int32)
        return pa.table({
            "part": pa.array(part), "lang": pa.array(langs, pa.string()).take(pa.array(doc)), "n": pa.array(n.astype(np.int32)),
            "phrase": words.phrases(word, n), "f": pa.array(self.count[at].astype(np.int64)),
        })

    def close(self) -> None:
        if self.open.any():
            raise RuntimeError(f"{int(self.open.sum())} occurrences have lost their documents; did the table change?")


def _materialise(batches: Iterator[pa.RecordBatch], buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by slot, pointers before documents. Returns phrases, and words per language as length 0."""
    current, bodies, slot = None, [], None
    held: list[pa.Table] = []
    total: dict[str, int] = {}
    for batch in batches:
        parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_pylist()
        cuts = [0, *(np.flatnonzero((parts[1:] != parts[:-1]) | (np.array(kinds[1:]) != np.array(kinds[:-1]))) + 1), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if parts[a] != current:
                if bodies or slot is not None:
                    (slot or _Slot(bodies)).close()
                current, bodies, slot = parts[a], [], None
            rows = batch.slice(a, b - a)
            if kinds[a] == "p":
                bodies += zip(rows.column("body").to_pylist(), rows.column("size").to_pylist())
                continue
            slot = slot or _Slot(bodies)
            words, langs = _words_of(rows), rows.column("lang").to_pylist()
            found = slot.resolve(words, rows.column("key").to_numpy().view(np.uint64), langs, buckets, bits)
            if found is not None:
                held.append(found)
            for lang, count in zip(langs, np.bincount(words.doc, minlength=len(langs))):
                total[lang] = total.get(lang, 0) + int(count)
        if sum(t.num_rows for t in held) >= 2 * PHRASES:
            held = [_folded(held, _KEYS)]
            if held[0].num_rows >= PHRASES:
                yield _batch(list(_pack_phrases(held[0])))
                held = []
    if bodies or slot is not None:
        (slot or _Slot(bodies)).close()
    if total:
        held.append(pa.table({
            "part": pa.array([0] * len(total), pa.int32()), "lang": pa.array(list(total), pa.string()), "n": pa.array([0] * len(total), pa.int32()),
            "phrase": pa.array([""] * len(total), pa.large_string()), "f": pa.array(list(total.values()), pa.int64()),
        }))
        yield _batch(list(_pack_phrases(_folded(held, _KEYS))))


def phrase_counts(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES, bits: int = 64,
) -> DataFrame:
    """``(lang, n, phrase, f)``: every phrase of 1 to ``max_words`` words with at least ``min_count`` occurrences.

    Rows with ``n = 0`` and no phrase have the words of each language. ``bits`` keeps that many bits of a fingerprint; the
    counts are the same for any number, fewer bits only send more pointers. The result is stored in the shared folder.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.xxhash64(F.col(id_col), F.col(lang_col), F.col(text_col)).alias("key"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDEFINED)).alias("lang"), text_of(text_col).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 << max(LEAST_PARTS.bit_length() - 1, (size // PART_BYTES).bit_length())
    known, stored = None, []
    for n in range(1, max_words + 1):
        path = scratch_path(spark, f"phrases-{n}")
        found = (
            rows.mapInArrow(lambda it, n=n, known=known: _scan(it, n, known, parts, bits, chunk_bytes), _PACKED)
            .repartition("part").sortWithinPartitions("part")
            .mapInArrow(lambda it, n=n: _meet(it, n, min_count, parts, parts), _PACKED)
        )
        found.write.parquet(path)
        stored.append(spark.read.parquet(path))
        if n < max_words:
            # a bounded number of bytes: FILTER_BYTES at most
            bits_of = stored[-1].where("kind = 'b'").select("part", "body").collect()
            known = spark.sparkContext.broadcast(Filter.of({r["part"]: bytes(r["body"]) for r in sorted(bits_of)}, parts))
    pointers = stored[0]
    for more in stored[1:]:
        pointers = pointers.unionByName(more)
    nothing = F.lit(None)
    texts = rows.select(
        F.pmod("key", F.lit(parts)).cast("int").alias("part"),
        F.lit("t").alias("kind"), nothing.cast("int").alias("size"), nothing.cast("binary").alias("body"), "key", "lang", "text",
    )
    pointers = pointers.where("kind = 'p'").select(
        "part", "kind", "size", "body", nothing.cast("long").alias("key"), nothing.cast("string").alias("lang"), nothing.cast("string").alias("text")
    )
    counts = (
        pointers.unionByName(texts).repartition("part").sortWithinPartitions("part", "kind")
        .mapInArrow(lambda it: _materialise(it, parts, bits), _PACKED)
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(lambda it: _count(it, min_count), _FOUND)
    )
    path = scratch_path(spark, "phrase-counts")
    counts.write.parquet(path)
    return spark.read.parquet(path)


def _exact(c: Column | str) -> Column:
    return F.col(c).cast("decimal(15,0)") if isinstance(c, str) else c.cast("decimal(15,0)")


def mine(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside_percent: int = 50,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES, bits: int = 64,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language by their score.

    Texts are lower-cased (A-Z only), split at sentence marks and line ends into pieces, and those at blanks and tabs into
    words; runs of other characters are words whatever they are. A candidate is a phrase of 2 to ``max_words`` words with
    ``a >= min_count`` occurrences, overlapping ones included. Cut in two, its score is 1,000,000 a^2 / (l r), floored, with
    the counts of its two parts; the lowest-scoring cut counts, of ties the earliest. Candidates inside a longer candidate
    that has at least ``inside_percent`` of their occurrences are dropped. ``n`` is the language's number of words.

    Every row and whole text counts, rows that repeat an id too. Null texts count as empty, null languages as ``und``, null
    ids are no different from others. An empty table gives no rows. Other columns are not read.
    """
    counts = phrase_counts(docs, max_words, min_count, id_col, text_col, lang_col, chunk_bytes, bits)
    known = counts.where("n > 0").select("lang", "phrase", "f")
    phrases = counts.where("n > 1").select("lang", "phrase", F.col("n").alias("len"), F.col("f").alias("a")).withColumn("w", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("len") - F.col("k")), " ").alias("right"),
    )
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumns({"_up": F.lit(1_000_000).cast("decimal(7,0)") * _exact("a") * _exact("a"), "_down": _exact("l") * _exact("r")})
    cuts = cuts.withColumn("score", F.expr("_up div _down"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # of the candidates that hold a phrase, the most frequent decides
    inner = phrases.where("len > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("len") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("size") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    left = checkpoint(left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    # the best of many small groups, then of eight of those together, and so on: no group is larger than eight lists
    order, ranked = [F.desc("score"), F.desc("a"), F.asc("phrase")], left
    groups = 1
    found = left.count()
    while groups * 8 * top < found:
        groups *= 8
    while groups >= 1:
        salted = ranked.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
        w = Window.partitionBy("lang", "_salt").orderBy(*order)
        ranked = salted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
        groups //= 8
    words = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
