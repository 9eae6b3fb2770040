"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are made per document; equal ones are one row from there on.  The
64 bits are cut into six blocks; two fingerprints that differ in at most three
bits agree on three whole blocks, so each fingerprint is filed under its 20
triples of blocks (about 32 bits each).  Inside a bucket all pairs are compared
vertically: bit planes hold one bit of many fingerprints, a shifted plane lines
up every fingerprint with its d-th successor, and carry-save counters add the
differing bits of 64 pairs per word; words whose pairs all exceed the radius
are abandoned.  Only a spanning forest of the links leaves a task.

A bucket of more than ``BLOCK_ROWS`` fingerprints is cut into blocks, and every
two blocks are compared by a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, field, stash, with_row_id
from ledgerline.llm.components import components

RADIUS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
BLOCK_ROWS = 1024
#: Rows that one comparison holds at a time, besides the rest of the last bucket.
CHUNK_ROWS = 1 << 16


def _fingerprint(text: bytes, n: int) -> bytes:
    """Eight big-endian bytes; text: UTF-8."""
    from xxhash import xxh64_digest

    words = text.lower().split()  # bytes: A-Z and the six white spaces only
    if not words:
        return bytes(8)
    joined, total, ones = b" ".join(words), 0, np.zeros(64, np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(n, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    for at in range(0, len(starts), CHUNK_ROWS):
        part = [xxh64_digest(joined[a:b], HASH_SEED)
                for a, b in zip(starts[at:at + CHUNK_ROWS], ends[at:at + CHUNK_ROWS])]
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return np.packbits(2 * ones > total).tobytes()


def fingerprints(docs: DataFrame, text_col: str = "text", n: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` (the text excepted) with ``__fp``, a long that holds the 64 bits.

    A null text is an empty one: its fingerprint is zero.
    """
    keep = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            fp = np.frombuffer(b"".join(_fingerprint(t or b"", n) for t in texts), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp, pa.int64())],
                                             names=[*batch.schema.names[:-1], "__fp"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return docs.select(*[F.col(f"`{f.name}`") for f in keep], F.col(text_col).alias("__text")).mapInArrow(
        run, f"{fields}, __fp long" if fields else "__fp long")


def _blocks(bits: int = 64, n: int = 6) -> list[int]:
    """Masks of n blocks of nearly equal width."""
    cuts = [bits * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _masks(radius: int) -> list[int]:
    """Masks of the block triples; with 2 * radius blocks, radius of them stay equal."""
    return [sum(c) for c in combinations(_blocks(64, 2 * radius), radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _planes(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """One row per bit, 64 fingerprints per word."""
    lanes = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, bits].T
    packed = np.packbits(lanes, axis=1, bitorder="little")
    wide = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, :packed.shape[1]] = packed
    return wide.view(np.uint64)


def _shifted(planes: np.ndarray, d: int) -> np.ndarray:
    """Each lane gets what is d lanes further."""
    q, s = divmod(d, 64)
    out = np.zeros_like(planes)
    w = planes.shape[1]
    if q < w:
        out[:, : w - q] = planes[:, q:] >> np.uint64(s)
    if s and q + 1 < w:
        out[:, : w - q - 1] |= planes[:, q + 1:] << np.uint64(64 - s)
    return out


def _within(planes: np.ndarray, valid: np.ndarray, d: int, radius: int) -> np.ndarray:
    """Lanes i, of those set in valid, whose distance to lane i + d is at most the radius."""
    diff, live = planes ^ _shifted(planes, d), np.flatnonzero(valid)
    diff = diff[:, live]
    over = np.zeros(len(live), np.uint64)
    counters = [np.zeros(len(live), np.uint64) for _ in range((radius + 1).bit_length())]
    for at in range(0, len(diff), 8):
        for carry in diff[at:at + 8]:
            for k, c in enumerate(counters):  # a carry-save increment of all counters
                counters[k], carry = c ^ carry, c & carry
            over = over | carry | _above(counters, radius)
        open_words = (valid[live] & ~over) != 0
        if not open_words.any():
            return np.zeros(0, np.int64)
        if open_words.mean() < 0.5:
            live, over, diff = live[open_words], over[open_words], diff[:, open_words]
            counters = [c[open_words] for c in counters]
    found = np.zeros(planes.shape[1], np.uint64)
    found[live] = valid[live] & ~over
    return np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over the radius, from the top bit down."""
    over, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            over, equal = over | (equal & counters[k]), equal & ~counters[k]
    return over


def _links(group: np.ndarray, fps: np.ndarray, bits: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside the groups; group is sorted."""
    n, parent = len(fps), list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows, d, rebuild = np.arange(n), 1, 1
    out: list[tuple[int, int]] = []
    planes, g = None, group
    while True:
        if planes is None or d >= rebuild:  # keep the groups that still have partners at d
            _, back, size = np.unique(g, return_inverse=True, return_counts=True)
            stay = size[back] > d
            rows, g = rows[stay], g[stay]
            if not len(rows):
                return out
            planes, rebuild = _planes(fps[rows], bits), 2 * d
        same = np.zeros(planes.shape[1] * 64, bool)
        if d < len(g):
            same[: len(g) - d] = g[d:] == g[:-d]
        if same.any():
            valid = np.packbits(same, bitorder="little").view(np.uint64)
            for i in _within(planes, valid, d, radius).tolist():
                a, b = root(int(rows[i])), root(int(rows[i + d]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    x, y = int(fps[rows[i]].view(np.int64)), int(fps[rows[i + d]].view(np.int64))
                    out.append((max(x, y), min(x, y)))
        elif d >= len(g):
            return out
        d += 1


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(hi, lo): links between the distinct fingerprints ``prints(fp)`` that connect all within the radius."""
    masks = _masks(radius)
    filed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, m in enumerate(masks)])).alias("b")).select("b.t", "b.key", "fp")
    # stored: a join side straight from an aggregation keeps AQE from splitting a large bucket
    sizes = stash(filed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # blocks of a large bucket: every two meet in one task; a small bucket is one block
    shared = filed.join(sizes, ["t", "key"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS))
    shared = shared.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    other = F.expr("CASE WHEN blocks = 1 THEN array(own) ELSE filter(sequence(0L, blocks - 1), x -> x != own) END")
    shared = shared.withColumn("other", F.explode(other))
    shared = shared.select("t", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            t, group, fps = cols
            for k in np.unique(t).tolist():
                bits = [i for i in range(64) if not masks[k] >> i & 1]
                mine = t == k
                if pairs := _links(group[mine], fps[mine], bits, radius):
                    hi, lo = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=["hi", "lo"])

        held: list[list[np.ndarray]] = []
        last, number = None, 0
        for batch in batches:
            t, key, a, b, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            ids = np.stack([t.astype(np.int64), key, a, b])
            new = np.ones(len(t), bool)
            new[1:] = (ids[:, 1:] != ids[:, :-1]).any(axis=0)
            if last is not None and len(t):
                new[0] = (ids[:, 0] != last).any()
            group = number + np.cumsum(new)
            if len(t):
                last, number = ids[:, -1], int(group[-1])
            held.append([t, group, fp.astype(np.int64).view(np.uint64)])
            if sum(len(x[0]) for x in held) >= CHUNK_ROWS:  # all whole buckets go, the last one waits
                cols = [np.concatenate(c) for c in zip(*held)]
                cut = int(np.searchsorted(cols[1], cols[1][-1]))
                yield from found([c[:cut] for c in cols])
                held = [[c[cut:] for c in cols]]
        if held:
            yield from found([np.concatenate(c) for c in zip(*held)])

    order = ["t", "key", "a", "b"]
    return (shared.repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(run, "hi long, lo long").distinct())


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every distinct ``__fp`` of ``prints``; linked ones have one root."""
    distinct = prints.select(F.col("__fp").alias("fp")).distinct()
    labels = components(links(distinct, radius))
    return (distinct.join(labels, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id of all documents that links reach, the
    document itself included.  Null and empty texts have fingerprint zero and
    are linked like any other.  Null ids get a component but don't name it (a
    component of null ids only has a null id).  Repeated rows each have a row.
    An empty table gives no rows.  Other columns are ignored.
    """
    prints = stash(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", n))
    # one row per fingerprint from here on: copies don't make a hot key
    least = prints.groupBy("__fp").agg(F.min("doc_id").alias("least"))
    rooted = stash(groups(prints, radius).join(least, F.col("fp") == F.col("__fp")).select("fp", "root", "least"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.join(named, "root").select("fp", "component_id")
    return (prints.join(ids, F.col("__fp") == F.col("fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  n: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest id stays.

    Null ids come after all others; among rows of one id the first read stays.
    """
    stored = with_row_id(docs)
    prints = stash(fingerprints(stored.select(field(id_col).alias("id"), ROW_ID, field(text_col).alias("text")), "text", n))
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col(ROW_ID).alias("row"))
    least = prints.groupBy("__fp").agg(F.min(rank).alias("least"))
    rooted = groups(prints, radius).join(least, F.col("fp") == F.col("__fp"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias(ROW_ID))
    return stored.join(kept, ROW_ID, "left_semi").select("doc.*")
