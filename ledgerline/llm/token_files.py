"""Token ids in binary files, compressed by Re-Pair grammars.

Documents are range-partitioned by id; the ids of a partition are cut into shards
of whole documents and a file holds the shards of one partition, one after another.
In each shard frequent pairs of neighbouring symbols are replaced by nonterminals,
round after round, all pairs down to a sixteenth of the last round's counts at a time, until
no pair occurs ``MIN_COUNT`` times; a pair never spans two documents.  The file
keeps the rules, the length that each nonterminal expands to and where each document's
symbols begin, so one document or a range of its ids is read without the rest.

A shard, all numbers little-endian:

    magic "LLRP", version, symbol width w in bytes (2 or 4)      3 x 4 bytes
    n_docs, n_ids, n_terminals, n_rules, n_symbols, names_bytes  6 x 8 bytes
    terminals     n_terminals x 4   the id that symbol t stands for
    rules         n_rules x 2 x w   the two symbols that symbol n_terminals + r stands for
    expansions    n_rules x 8       ids that symbol n_terminals + r expands to
    symbols       n_symbols x w
    symbol starts (n_docs + 1) x 8  where each document's symbols begin
    id counts     n_docs x 8
    name sizes    n_docs x 4        bytes of each document's id as text, -1 for null
    names         names_bytes
    one line feed
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded, shuffle_partitions, stash
from ledgerline.llm.token_chunks import WordEnds, give_back, kept
from ledgerline.session import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: A shard is closed by the document that brings it to so many ids.
SHARD_IDS = 1 << 20
#: A pair gets a rule if it occurs so often.
MIN_COUNT = 8
MAGIC, VERSION, HEAD = b"LLRP", 1, "<4sII6Q"
#: Bits of the table that counts pairs by hash, which leaves few pairs to count exactly.
HASH_BITS = 18
#: A round replaces all pairs down to this part of the last round's least frequent ones.
STEP = 16


def _runs_alternate(at: np.ndarray) -> np.ndarray:
    """Which of sorted positions: every other one of each run of neighbours, from the run's first; no two overlap."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = np.diff(at) != 1
    first = np.flatnonzero(fresh)
    inside = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return np.flatnonzero(inside % 2 == 0)


def _hash_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """HASH_BITS bits of hash of pairs."""
    out = left.astype(np.uint32)
    out *= np.uint32(0x9E3779B1)
    out ^= right.astype(np.uint32) * np.uint32(0x85EBCA6B)
    out *= np.uint32(0xC2B2AE35)
    out >>= np.uint32(32 - HASH_BITS)
    return out


def _frequent_pairs(seq: np.ndarray, ends: np.ndarray, at: np.ndarray | None, limit: int | None, min_count: int):
    """(pairs that occur ``limit`` times or more at the given positions, where, which, limit), pairs in order.

    Without a limit it is a ``STEP``-th of the most frequent one's count.  Counting
    by hash first leaves few pairs to count exactly.
    """
    hashed = _hash_of(seq[:-1], seq[1:]) if at is None else _hash_of(seq[at], seq[at + 1])
    if at is None:
        hashed[np.flatnonzero(ends[:-1])] = 1 << HASH_BITS  # no pair: two documents
    counts = np.bincount(hashed, minlength=(1 << HASH_BITS) + 1)  # at least the count of any pair with that hash
    counts[1 << HASH_BITS] = 0
    if limit is None:
        limit = max(min_count, int(counts.max()) // STEP)
    kept = np.flatnonzero((counts >= limit)[hashed])
    at = kept if at is None else at[kept]
    keys = seq[at].astype(np.uint64)
    keys <<= np.uint64(32)
    keys |= seq[at + 1]
    order = np.sort(keys)
    first = np.flatnonzero(np.append(True, order[1:] != order[:-1])) if len(order) else np.zeros(0, np.int64)
    pairs = order[first[np.diff(np.append(first, len(order))) >= limit]]
    if not len(pairs):
        return pairs, at[:0], at[:0], limit
    # by hash where it belongs to one frequent pair only, else by search
    numbers = np.zeros((1 << HASH_BITS) + 1, np.int64)
    spots = _hash_of(pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF))
    numbers[spots] = np.arange(len(pairs))
    shared = np.bincount(spots, minlength=len(numbers)) > 1
    hashed = hashed[kept]
    which = numbers[hashed]
    several = np.flatnonzero(shared[hashed])
    which[several] = np.minimum(np.searchsorted(pairs, keys[several]), len(pairs) - 1)
    hit = pairs[which] == keys
    return pairs, at[hit], which[hit], limit


def re_pair(symbols: np.ndarray, ends: np.ndarray, n_terminals: int, min_count: int = MIN_COUNT):
    """(rules, symbols, ends): pairs that occur ``min_count`` times or more replaced, more frequent ones first.

    ``ends`` marks the last symbol of each document.  Symbol ``n_terminals + r``
    stands for the two symbols ``rules[r]``, which are smaller.
    """
    seq, ends, rules = symbols.astype(np.uint32), ends.copy(), [np.zeros((0, 2), np.uint32)]
    n, limit, where = n_terminals, None, None
    while len(seq) > 1:
        pairs, at, which, limit = _frequent_pairs(seq, ends, where, limit, min_count)
        if len(pairs):
            chosen = _runs_alternate(at)
            alone, which = at[chosen], which[chosen]
            used = np.zeros(len(pairs), np.int64)
            used[which] = 1  # a pair whose every copy overlaps another gets no rule
            number = np.cumsum(used) - used
            pairs = pairs[used == 1]
            rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
            seq[alone] = n + number[which]
            ends[alone] = ends[alone + 1]
            stay = np.ones(len(seq), bool)
            stay[alone + 1] = False
            # what may be frequent after the last limit: pairs with a new symbol, and those that overlapped
            fresh = seq >= n
            fresh[at] = True
            fresh[:-1] |= fresh[1:]
            n += len(pairs)
            seq, ends, fresh = seq[stay], ends[stay], fresh[stay]
        if limit == min_count:
            if not len(pairs):
                break
            where = np.flatnonzero(fresh[:-1] & ~ends[:-1])
        else:
            limit = max(min_count, limit // STEP)
    return np.concatenate(rules), seq, ends


def expansion_lengths(rules: np.ndarray, n_terminals: int) -> np.ndarray:
    """How many ids each nonterminal expands to."""
    lengths = [1] * n_terminals
    for a, b in rules.tolist():
        lengths.append(lengths[a] + lengths[b])
    return np.array(lengths[n_terminals:], "<u8")


def shard_bytes(names: list[str | None], documents: list[bytes], min_count: int = MIN_COUNT) -> bytes:
    """A shard of documents, each the little-endian 32-bit ids of one, none of them empty."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    counts = np.array([len(d) // 4 for d in documents], "<u8")
    most = int(ids.max())
    if most >> 24:
        terminals = np.unique(ids)
    else:
        there = np.zeros(most + 1, bool)
        there[ids] = True
        terminals = np.flatnonzero(there).astype("<u4")
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts).astype(np.int64) - 1] = True
    if most >> 24:
        dense = np.searchsorted(terminals, ids)
    else:
        dense = np.zeros(most + 1, np.uint32)
        dense[terminals] = np.arange(len(terminals))
        dense = dense[ids]
    rules, seq, ends = re_pair(dense, ends, len(terminals), min_count)
    width = 2 if len(terminals) + len(rules) <= 1 << 16 else 4
    kind = f"<u{width}"
    starts = np.append(0, np.flatnonzero(ends) + 1).astype("<u8")
    texts = [None if x is None else x.encode() for x in names]
    sizes = np.array([-1 if x is None else len(x) for x in texts], "<i4")
    blob = b"".join(x for x in texts if x)
    head = struct.pack(HEAD, MAGIC, VERSION, width, len(documents), len(ids), len(terminals), len(rules), len(seq), len(blob))
    return b"".join([head, terminals.astype("<u4").tobytes(), rules.astype(kind).tobytes(),
                     expansion_lengths(rules, len(terminals)).tobytes(), seq.astype(kind).tobytes(), starts.tobytes(),
                     counts.tobytes(), sizes.tobytes(), blob])


class Shard:
    """A shard that begins at ``at`` of a file's bytes; ``end`` is where the next one begins."""

    def __init__(self, data: bytes, at: int = 0):
        magic, version, width, docs, ids, terminals, rules, symbols, blob = struct.unpack_from(HEAD, data, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no shard of token ids at byte {at}")
        at += struct.calcsize(HEAD)
        kind = f"<u{width}"

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, n, at)
            at += out.nbytes
            return out

        self.n_ids = ids
        self.terminals, self.rules = take("<u4", terminals), take(kind, 2 * rules).reshape(-1, 2)
        self.lengths, self.symbols = take("<u8", rules), take(kind, symbols)
        self.starts, self.counts, sizes = take("<u8", docs + 1), take("<u8", docs), take("<i4", docs)
        self.names: list[str | None] = []
        for n in sizes.tolist():
            self.names.append(None if n < 0 else data[at:at + n].decode())
            at += max(n, 0)
        self.end = at + 1
        self._expanded: list[bytes] | None = None

    def __len__(self) -> int:
        return len(self.names)

    def document(self, i: int) -> bytes:
        """All ids of document ``i``; the first call expands every rule once."""
        if self._expanded is None:
            self._expanded = [t.tobytes() for t in self.terminals.astype("<u4").reshape(-1, 1)]
            for a, b in self.rules.tolist():
                self._expanded.append(self._expanded[a] + self._expanded[b])
        return b"".join(map(self._expanded.__getitem__, self.symbols[int(self.starts[i]):int(self.starts[i + 1])].tolist()))

    def all(self) -> list[bytes]:
        """All ids of every document."""
        expanded = [t.tobytes() for t in self.terminals.astype("<u4").reshape(-1, 1)]
        for a, b in self.rules.tolist():
            expanded.append(expanded[a] + expanded[b])
        sizes = np.append(np.ones(len(self.terminals), np.int64), self.lengths.astype(np.int64))
        first, n = np.cumsum(sizes) - sizes, sizes[self.symbols]
        at = np.arange(self.n_ids)
        at += np.repeat(first[self.symbols] - (np.cumsum(n) - n), n)
        data = np.frombuffer(b"".join(expanded), "<u4")[at].tobytes()
        ends = (4 * np.cumsum(self.counts.astype(np.int64))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def ids(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``i``; expands the symbols that hold them and nothing else."""
        n, seq = len(self.terminals), self.symbols[int(self.starts[i]):int(self.starts[i + 1])]
        stop = min(stop, int(self.counts[i]))
        sizes = np.ones(len(seq), np.int64)
        ruled = seq >= n
        sizes[ruled] = self.lengths[seq[ruled] - n]
        after = np.cumsum(sizes)
        first = int(np.searchsorted(after, start, side="right"))
        at, out = int(after[first] - sizes[first]) if first < len(seq) else stop, []
        stack = seq[first:int(np.searchsorted(after, stop)) + 1][::-1].tolist()
        while stack and at < stop:
            s = stack.pop()
            if s < n:
                if at >= start:
                    out.append(self.terminals[s])
                at += 1
                continue
            size = int(self.lengths[s - n])
            if at + size <= start:
                at += size  # wholly before the range: skipped by its length
            else:
                stack += self.rules[s - n][::-1].tolist()
        return np.array(out, "<u4")


def shards(data: bytes) -> Iterator[Shard]:
    """The shards of a file."""
    at = 0
    while at < len(data):
        shard = Shard(data, at)
        yield shard
        at = shard.end


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          tokenizer: str | None = None, shard_ids: int = SHARD_IDS, min_count: int = MIN_COUNT) -> None:
    """Write the ids of every whole text, ``end_id`` behind each document's, in ascending order of ids.

    Null texts count as empty, so they are the end id alone.  Null ids come first,
    repeated ids in the order in which they are read.  Strings of special tokens inside
    a text are ordinary text.  Files are written by Spark's committer, so a
    retried task leaves no half file; an empty table leaves no shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept(WordEnds, tokenizer, VOCABULARY), np.array([end_id], "<u4").tobytes()
        names: list[str | None] = []
        made: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal names, made, size
            out = pa.RecordBatch.from_arrays([pa.array([shard_bytes(names, made, min_count)], pa.binary())], names=["value"])
            names, made, size = [], [], 0
            return out

        for batch in bounded(batches, 1, 6 << 20):
            for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                names.append(name)
                made.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= shard_ids:
                    yield close()
        if made:
            yield close()
        give_back()

    spark = docs.sparkSession
    # rows of one id are dealt out by their place, so that they needn't meet in one task
    placed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    dealt = placed.repartitionByRange(shuffle_partitions(spark), "id", "place").sortWithinPartitions("id", "place")
    files = dealt.select(F.col("id").cast("string"), "text").mapInArrow(run, "value binary")
    files.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for each document of the files, decoded from them.

    ``start`` counts the ids of all documents before it: files are numbered in the
    order of their partitions, and a file's documents start behind the totals of
    the files before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                at = 0
                for shard in shards(data.as_buffer().to_pybytes()):
                    counts = shard.counts.astype(np.int64)
                    starts = at + np.cumsum(counts) - counts
                    at += shard.n_ids
                    crc = np.array([zlib.crc32(d) for d in shard.all()], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file.as_py()] * len(shard), pa.int32()), pa.array(shard.names, pa.string()), pa.array(starts),
                         pa.array(counts), pa.array(crc)], names=["file", "doc_id", "inside", "n_tokens", "ids_crc32"])
        give_back()

    number = F.regexp_extract(F.col("path"), r"part-(\d+)", 1).cast("int").alias("file")
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(number, "content")
    found = stash(content.mapInArrow(run, "file int, doc_id string, inside long, n_tokens long, ids_crc32 long"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each file: as many as the partitions they were written from
    first = (found.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
             .select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first")))
    return found.join(first, "file").select(
        F.col("doc_id").cast(id_type).alias("doc_id"), (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the documents' ids to a new folder beside the stored tables, and read that."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, path, id_col, **options)
    return read(spark, path, docs.schema[id_col].dataType.simpleString())
