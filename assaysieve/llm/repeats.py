"""Substring dedup by fixed-block anchors.

1. Every document is cut into consecutive blocks of half a window (rounded up), its anchors. A window that repeats elsewhere holds at least one whole
   anchor there, wherever it begins. All rolling windows of block size probe the anchors of documents with a smaller id.
2. Around the hits, and around the anchors that were hit, lie all windows that can repeat. Their hashes, 64 bits over whole windows, are compared:
   a window is a repeat if a document with a smaller id has it too. Consecutive repeated windows make up the maximal exact repeats.
3. Repeated words are cut from each document.

Hashes travel packed, a row for each piece of documents and bucket. A bucket is read as a stream, anchors before probes, so that a
hash that a third of all documents have needs no more memory than any other. Exact copies of a whole text are settled beforehand by a digest.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.llm.text import space_words

WINDOW = 50
PIECE_WORDS = 200_000  # words whose hashes are packed together
CACHED_WORDS = 300_000
MIN_BUCKETS = 64  # hashes are dealt to as many buckets as there are shuffle partitions, but no fewer than these
BASE = 0x9E3779B97F4A7C15 | 1
ROW = "bucket int, phase int, data binary"
FOUND = "doc_id bigint, data binary"


def block_of(window: int) -> int:
    """The longest block of which a window holds a whole one wherever it begins."""
    return (window + 1) // 2


@cache
def _inverse() -> int:
    return pow(BASE, -1, 1 << 64)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = xxhash.xxh3_64_intdigest(word)
        return self[word]


class Hasher:
    """Hashes of all windows of some length over a run of words, from sums of powers modulo 2**64."""

    def __init__(self) -> None:
        self.words = _WordHash()
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, words: list[bytes]) -> np.ndarray:
        if len(words) >= self.up.size:
            size = max(len(words) + 1, 2 * self.up.size)
            self.up, self.down = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64)))) for b in (BASE, _inverse()))
        values = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.up[:values.size])))

    def windows(self, sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        mixed = (sums[at + size] - sums[at]) * self.down[at]
        for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xCA5A826395121157), (32, 1)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return mixed


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _pack(docs: np.ndarray, counts: np.ndarray, hashes: np.ndarray, places: np.ndarray | None) -> bytes:
    """Numbers of documents and entries, width of places, then document ids, entries per document, hashes and places."""
    width = 0 if places is None else 2 if not places.size or places.max() < 1 << 16 else 4
    head = np.array([docs.size, hashes.size, width, hashes.dtype.itemsize], "<u4").tobytes()
    tail = b"" if places is None else places.astype(f"<u{width}").tobytes()
    return b"".join((head, docs.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), hashes.tobytes(), tail))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    n_docs, n, width, wide = np.frombuffer(data, "<u4", 4)
    at = 16
    docs = np.frombuffer(data, "<i8", n_docs, at)
    at += 8 * n_docs
    counts = np.frombuffer(data, "<u4", n_docs, at)
    at += 4 * n_docs
    hashes = np.frombuffer(data, f"<u{wide}", n, at)
    at += wide * n
    return docs, counts, hashes, np.frombuffer(data, f"<u{width}", n, at).astype(np.int64) if width else None


class _Packer:
    """Collects entries of documents, and packs them by bucket."""

    def __init__(self, buckets: int, kind: str) -> None:
        self.buckets, self.kind = buckets, kind
        self.parts: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}

    def add(self, phase: int, doc: int, hashes: np.ndarray, places: np.ndarray) -> None:
        if hashes.size:
            self.parts.setdefault(phase, []).append((doc, hashes, places))

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        for phase, parts in self.parts.items():
            docs = np.array([d for d, _, _ in parts], np.int64)
            of = np.repeat(np.arange(docs.size), [h.size for _, h, _ in parts])
            hashes, places = np.concatenate([h for _, h, _ in parts]), np.concatenate([p for _, _, p in parts])
            bucket = _bucket(hashes, self.buckets)
            order = np.argsort(bucket.astype(np.uint16 if self.buckets < 1 << 16 else np.int64), kind="stable")
            bucket, of, hashes, places = bucket[order], of[order], hashes[order].astype(self.kind), places[order]
            for own in np.split(np.arange(bucket.size), np.flatnonzero(np.diff(bucket)) + 1):
                low, high = own[0], own[-1] + 1
                counts = np.bincount(of[low:high], minlength=docs.size)
                used = counts > 0
                yield int(bucket[low]), phase, _pack(docs[used], counts[used], hashes[low:high], None if phase == 0 else places[low:high])
        self.parts.clear()


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types], names=names)


def _packed(packer: _Packer) -> pa.RecordBatch:
    return _batch(list(packer.rows()), ["bucket", "phase", "data"], [pa.int32(), pa.int32(), pa.binary()])


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _anchors_and_probes(window: int, buckets: int):
    """Anchors come twice: in phase 0 to be probed, in phase 2 to be told whether a later document hit them. Probes are phase 1."""
    block = block_of(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, packer, held = Hasher(), _Packer(buckets, "<u4"), 0
        for doc, text, copy in _rows(batches, "doc_id", "_text", "_copy"):
            words = [] if copy else space_words(text)
            if doc is None or len(words) < window:
                continue
            hashes = hasher.windows(hasher.sums(words), np.arange(len(words) - block + 1), block)
            anchors = np.arange(0, len(words) - block + 1, block)
            packer.add(0, doc, hashes[anchors], anchors)
            packer.add(1, doc, hashes, np.arange(hashes.size))
            packer.add(2, doc, hashes[anchors], anchors)
            held += len(words)
            if held >= PIECE_WORDS:
                yield _packed(packer)
                held = 0
        yield _packed(packer)

    return run


def _windows(window: int, buckets: int):
    """Windows around hits and hit anchors: phase 0 to be probed, phase 1 to probe."""
    block = block_of(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, packer, held = Hasher(), _Packer(buckets, "<u8"), 0
        for doc, text, copy, hits in _rows(batches, "doc_id", "_text", "_copy", "_hits"):
            words = space_words(text) if hits and not copy else []
            if doc is None or len(words) < window:
                continue
            near = np.zeros(len(words) + 1, np.int64)
            at = np.concatenate([np.frombuffer(h, "<u4") for h in hits]).astype(np.int64)
            at = at[at <= len(words) - block]  # others are of another text with this id
            np.add.at(near, np.maximum(at - (window - block), 0), 1)
            np.add.at(near, at + 1, -1)
            places = np.flatnonzero(np.cumsum(near)[:len(words) - window + 1])
            hashes = hasher.windows(hasher.sums(words), places, window)
            packer.add(0, doc, hashes, places)
            packer.add(1, doc, hashes, places)
            held += places.size
            if held >= PIECE_WORDS:
                yield _packed(packer)
                held = 0
        yield _packed(packer)

    return run


class _Least:
    """Least document id per hash, and the largest id that probed it."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.hashes, self.least = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.most: np.ndarray | None = None

    def add(self, hashes: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((hashes, docs))
        self.held += hashes.size
        if self.held > max(self.hashes.size, 1 << 18):
            self.settle()

    def settle(self) -> None:
        if self.parts:
            hashes = np.concatenate([self.hashes.astype(self.parts[0][0].dtype), *(h for h, _ in self.parts)])
            docs = np.concatenate([self.least, *(d for _, d in self.parts)])
            order = np.lexsort((docs, hashes))
            hashes, docs = hashes[order], docs[order]
            first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            self.hashes, self.least = hashes[first], docs[first]
            self.parts, self.held = [], 0

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes stand, and whether they are there."""
        if self.most is None:
            self.settle()
            self.most = np.full(self.hashes.size, np.iinfo(np.int64).min)
        if not self.hashes.size:
            return np.zeros(hashes.size, np.int64), np.zeros(hashes.size, bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.hashes.size - 1)
        return at, self.hashes[at] == hashes


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the places of its entries that a smaller document has too (phase 1) or that a larger one hit (phase 2).

    Entries found in phase 1 with 64-bit hashes carry the hash's lower half, to tell texts of one id apart.
    """
    now, least, out = None, _Least(), []
    for bucket, phase, data in _rows(batches, "bucket", "phase", "data"):
        if bucket != now:
            now, least = bucket, _Least()
        docs, counts, hashes, places = _unpack(data)
        of = np.repeat(docs, counts)
        if phase == 0:
            least.add(hashes, of)
            continue
        at, there = least.places(hashes)
        if not there.any():
            continue
        if phase == 1:
            found = there & (least.least[at] < of)
            np.maximum.at(least.most, at[found], of[found])
        else:
            found = there & (least.most[at] > of)
        if found.any():
            wide = hashes.dtype.itemsize == 8
            entry = np.stack((places[found], (hashes[found] & np.uint64(0xFFFFFFFF)).astype(np.int64)), 1) if wide else places[found]
            which = of[found]
            cuts = np.flatnonzero(np.diff(which)) + 1
            out += [(int(w), e.astype("<u4").tobytes()) for w, e in zip(which[np.concatenate(([0], cuts))], np.split(entry, cuts), strict=True)]
            if len(out) > 20_000:
                yield _batch(out, ["doc_id", "data"], [pa.int64(), pa.binary()])
                out = []
    yield _batch(out, ["doc_id", "data"], [pa.int64(), pa.binary()])


def _met(packed: DataFrame, buckets: int) -> DataFrame:
    """Deal packed rows by bucket and probe each bucket in the order of the phases; results are gathered by document."""
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "phase")
    return dealt.mapInArrow(_probe, FOUND).groupBy("doc_id").agg(F.collect_list("data").alias("data"))


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))]
        for batch in batches:
            rows = []
            for doc, text, copy, entries in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_text", "_copy", "_entries")), strict=True):
                words = space_words(text)
                cover = np.zeros(len(words) + 1, np.int64)
                if copy and len(words) >= window:
                    cover[0], cover[-1] = 1, -1
                elif entries and len(words) >= window:
                    found = np.concatenate([np.frombuffer(e, "<u4") for e in entries]).astype(np.int64).reshape(-1, 2)
                    found = found[found[:, 0] <= len(words) - window]
                    own = hasher.windows(hasher.sums(words), found[:, 0], window) & np.uint64(0xFFFFFFFF)
                    at = found[own == found[:, 1].astype(np.uint64), 0]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
                gone = np.cumsum(cover)[:len(words)] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])))).reshape(-1, 2)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if edges.size else b" ".join(words)
                rows.append((doc, len(words), int(gone.sum()), kept.decode(), [{"first": int(a), "last": int(b)} for a, b in edges]))
            for begin in range(0, len(rows), 500):
                yield _batch(rows[begin:begin + 500], ["doc_id", "n_words", "n_removed", "kept", "removed"], types)

    return run


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<first:bigint,last:bigint>>"


def deduplicate(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, the kept words joined by blanks, and the removed spans of words.

    A word goes if it lies in a window of `window` words that also starts in a document with a smaller doc_id; windows are those of the input.
    Null and empty texts have no words. A null id has no order: its document loses nothing and takes nothing from others.
    Rows with the same id take nothing from each other; each gives a row.
    """
    spark = documents.sparkSession
    buckets = max(MIN_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    digests = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.sha2(F.col(text), 256).alias("_digest")).where("doc_id is not null and _digest is not null")
    first = digests.groupBy("_digest").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = digests.join(first, "_digest").where("doc_id > _first").groupBy("doc_id").agg(F.collect_set("_digest").alias("_copies"))

    def with_info(frame: DataFrame | None, name: str) -> DataFrame:
        """The rows with the flag of a copy and what was found; every use shuffles the texts in the same way, so Spark does it once."""
        out = rows.join(copies, "doc_id", "left")
        if frame is not None:
            out = out.join(frame.withColumnRenamed("data", name), "doc_id", "left")
        return out.withColumn("_copy", F.coalesce(F.array_contains("_copies", F.sha2("_text", 256)), F.lit(False))).drop("_copies")

    hits = _met(with_info(None, "").mapInArrow(_anchors_and_probes(window, buckets), ROW), buckets)
    entries = _met(with_info(hits, "_hits").mapInArrow(_windows(window, buckets), ROW), buckets)
    return with_info(entries, "_entries").mapInArrow(_kept(window), KEPT)


def digest(documents: DataFrame) -> DataFrame:
    return deduplicate(documents).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
