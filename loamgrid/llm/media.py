"""Media columns by content-defined payload chunking.

A rolling gear hash cuts payloads where their content says so; chunks are stored once per digest, the digests being
deduplicated by joins; an ordered list of chunks rebuilds each medium, which is verified against its own digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise, slices, stable_rows

#: The payload's unit: it is padded with bytes 0 to a positive multiple.
UNIT = 64
MAGIC = b"CDC1"
#: Digests that a task remembers in order not to send a payload twice; after so many it starts anew.
MAX_SEEN = 500_000


@dataclass(frozen=True)
class Cuts:
    """A cut may follow a byte from ``least`` on where the low ``bits`` of the hash are 0, and must at ``most``."""

    least: int = 4096
    bits: int = 13
    most: int = 65536


def gear_table() -> np.ndarray:
    """256 pseudo-random 32-bit numbers, by rule."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4).digest(), "big") for i in range(256)], np.uint32)


def chunk_ends(payload: bytes, cuts: Cuts, gear: np.ndarray) -> list[int]:
    """Where the chunks end. The low bits of the gear hash depend on the last ``bits`` bytes only: it is summed by doubling."""
    n, ends, start = len(payload), [], 0
    if n > cuts.least:
        window, span = gear[np.frombuffer(payload, np.uint8)], 1
        while span < cuts.bits:
            window[span:] += window[:-span] << np.uint32(span)
            span *= 2
        for at in np.flatnonzero((window & np.uint32((1 << cuts.bits) - 1)) == 0).tolist():
            while at + 1 - start > cuts.most:
                start += cuts.most
                ends.append(start)
            if at + 1 - start >= cuts.least:
                start = at + 1
                ends.append(start)
    while n - start > cuts.most:
        start += cuts.most
        ends.append(start)
    return [*ends, n] if start < n else ends


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(padded payload, length before padding)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % UNIT if raw else UNIT), len(raw)


class Features:
    """What is computed over the samples read back, chunk by chunk."""

    def __init__(self) -> None:
        self.sha, self.stored = hashlib.sha256(), hashlib.sha256(MAGIC)
        self.size, self.stored_size, self.chunks, self.tail = 0, len(MAGIC), 0, b""
        self.counts = np.zeros(256, np.int64)

    def add(self, frame: bytes, chunk: bytes) -> None:
        self.sha.update(chunk)
        for part in (struct.pack("<I", len(frame)), frame):
            self.stored.update(part)
            self.stored_size += len(part)
        self.size += len(chunk)
        self.chunks += 1
        self.tail = (self.tail + chunk)[-UNIT:]
        self.counts += np.bincount(np.frombuffer(chunk, np.uint8), minlength=256)

    def row(self) -> list:
        p = self.counts[self.counts > 0] / self.size
        level = np.arange(256)
        mean = int((self.counts * level).sum() * 1000 // self.size)
        feature = (
            f"samples={self.size};chunks={self.chunks};mean_milli={mean};peak={int(level[self.counts > 0].max())};"
            f"distinct={len(p)};entropy={-(p * np.log2(p)).sum() + 0.0:.4f}"
        )
        digest = self.sha.digest()
        return [digest, self.size, zlib.crc32(self.tail), self.stored_size, self.stored.hexdigest(), feature]


FEATURE_SCHEMA = "media binary, payload_bytes bigint, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
_FEATURE_KINDS = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def _batch(rows: list[list], kinds: list, schema: str) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])


def chunk_documents(docs: DataFrame, cuts: Cuts, with_frames: bool) -> DataFrame:
    """A row for each chunk of each row of docs, or with frames one for each chunk that a task offers to the store.

    place: the task and the number of the chunk within it, the same in both forms; offer: the first of its digest in
    the task. media, digest: SHA-256 of payload and chunk.
    """
    schema = "doc_id bigint, n_bytes bigint, media binary, seq int, n_chunks int, digest binary, place bigint, offer boolean"
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.bool_()]
    if with_frames:
        schema, kinds = "place bigint, digest binary, part boolean, frame binary", [pa.int64(), pa.binary(), pa.bool_(), pa.binary()]

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        gear, pack = gear_table(), zstandard.ZstdCompressor(level=6, write_content_size=True)
        place, seen = TaskContext.get().partitionId() << 40, set()
        for batch in slices(batches, 64):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                payload, n = payload_of(text)
                ends = chunk_ends(payload, cuts, gear)
                media = hashlib.sha256(payload).digest()
                for seq, (start, end) in enumerate(zip([0, *ends], ends)):
                    chunk = payload[start:end]
                    digest = hashlib.sha256(chunk).digest() if len(ends) > 1 else media
                    offer = digest not in seen
                    if offer:
                        if len(seen) >= MAX_SEEN:
                            seen.clear()
                        seen.add(digest)
                    if not with_frames:
                        rows.append([key, n, media, seq, len(ends), digest, place, offer])
                    elif offer:
                        rows.append([place, digest, len(ends) > 1, pack.compress(chunk)])
                    place += 1
            yield _batch(rows, kinds, schema)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def open_frame(frame: bytes, digest: bytes) -> bytes:
    """The chunk in a stored frame; what does not match its digest is an error."""
    import zstandard

    chunk = zstandard.ZstdDecompressor().decompress(frame)
    if hashlib.sha256(chunk).digest() != digest:
        raise ValueError(f"chunk {digest.hex()} is damaged")
    return chunk


def _whole_media(batches):
    """Features of media that are one chunk: its digest is the medium's own."""
    for batch in slices(batches):
        rows = []
        for digest, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one = Features()
            one.add(frame, open_frame(frame, digest))
            rows.append(one.row())
        yield _batch(rows, _FEATURE_KINDS, FEATURE_SCHEMA)


def _listed_media(batches):
    """Features of media that come as chunks sorted by (media, seq); one chunk is held at a time."""
    media, one = None, None

    def finished():
        row = one.row()
        if row[0] != media:
            raise ValueError(f"medium {media.hex()} is not what was stored")
        return row

    for batch in slices(batches):
        rows = []
        for key, digest, frame in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != media:
                if one is not None:
                    rows.append(finished())
                media, one = key, Features()
            if frame is None:
                raise ValueError(f"chunk {digest.hex()} is not in the store")
            one.add(frame, open_frame(frame, digest))
        yield _batch(rows, _FEATURE_KINDS, FEATURE_SCHEMA)
    if one is not None:
        yield _batch([finished()], _FEATURE_KINDS, FEATURE_SCHEMA)


@dataclass(frozen=True)
class MediaStore:
    """chunks: (digest, frame, whole, listed), one row per digest; lists: (media, seq, digest) of media of several
    chunks; documents: (doc_id, n_bytes, media)."""

    chunks: DataFrame
    lists: DataFrame
    documents: DataFrame


def store_media(docs: DataFrame, cuts: Cuts = Cuts()) -> MediaStore:
    """Write the payloads of ``docs`` (doc_id, text; null: empty) as deduplicated chunks into the shared scratch folder.

    Rows are read twice and must come in the same partitions both times, as those of files do; anything else is
    written first (``stable_rows``).

    Scale: texts are read twice, first for digests, then for the frames (zstandard) that tasks offer. Each digest's
    least place owns it; the other offers, a small share, and owners used both ways are noted by place and met by
    a join, so that payloads need not move where the notes are small by measured size, and move once otherwise. Hot
    chunks are cheap: a task offers a digest once.
    """
    docs = stable_rows(docs.select("doc_id", "text"), "media-docs")
    refs = materialise(chunk_documents(docs, cuts, with_frames=False), "media-refs")
    several = F.col("n_chunks") > 1
    used = refs.groupBy("digest").agg(F.max(several).alias("listed"), F.max(~several).alias("whole"))
    both = materialise(used.filter("listed and whole").select("digest"), "media-both")
    offered = refs.filter("offer").groupBy("digest").agg(F.min("place").alias("owner"), F.count(F.lit(1)).alias("n"))
    repeated = materialise(offered.filter("n > 1"), "media-repeated")
    offers = refs.filter("offer").select("digest", "place", several.alias("part"))
    losers = offers.join(repeated, "digest").filter("place <> owner").select("place", F.lit(True).alias("drop"))
    mixed = offers.join(both, "digest").select("place", F.lit(False).alias("drop"))
    notes = losers.unionByName(mixed).groupBy("place").agg(F.max("drop").alias("drop"), F.lit(True).alias("noted"))
    notes = materialise(notes, "media-notes")
    frames = chunk_documents(docs, cuts, with_frames=True).join(notes, "place", "left").filter("drop is null or not drop")
    noted = F.coalesce("noted", F.lit(False))
    chunks = frames.select("digest", "frame", (~F.col("part") | noted).alias("whole"), (F.col("part") | noted).alias("listed"))
    first = lambda c: F.first(c).alias(c)
    lists = refs.filter(several).groupBy("media", "seq").agg(first("digest"))
    documents = refs.filter("seq = 0").select("doc_id", "n_bytes", "media")
    store = MediaStore(materialise(chunks, "media-chunks"), materialise(lists, "media-lists"), documents)
    discard(both, repeated, notes)
    return store


def media_features(store: MediaStore) -> DataFrame:
    """FEATURE_SCHEMA for each medium, computed over the samples read back from the store and verified."""
    whole = store.chunks.filter("whole").select("digest", "frame").mapInArrow(_whole_media, FEATURE_SCHEMA)
    parts = store.chunks.filter("listed").select("digest", "frame")
    joined = store.lists.join(parts, "digest", "left").select("media", "digest", "frame", "seq")
    count = int(store.chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = joined.repartition(count, "media").sortWithinPartitions("media", "seq").select("media", "digest", "frame")
    return whole.unionByName(ordered.mapInArrow(_listed_media, FEATURE_SCHEMA))


def media_columns(docs: DataFrame, cuts: Cuts = Cuts()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature.

    The payload is the text's UTF-8 (none for null), padded with bytes 0 to a positive multiple of 64; a sample is a
    byte. The stored form of a medium is a mark and its chunks' frames, each after its length. All but n_bytes is
    computed from what the store gives back, once per distinct payload; damaged or missing chunks raise. Repeated
    rows and null doc_ids keep their rows; further columns are ignored; an empty table gives an empty result.
    """
    store = store_media(docs, cuts)
    features = materialise(media_features(store), "media-features")
    out = store.documents.join(features, "media")
    hexed = F.lower(F.hex("media")).alias("payload_sha256")
    return out.select("doc_id", "n_bytes", "payload_bytes", hexed, "tail_crc32", "media_bytes", "media_sha256", "feature")
