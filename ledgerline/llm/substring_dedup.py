"""Substring deduplication by recompression.

Rounds of recompression rename a document's word sequence: a run of one symbol
becomes one symbol, then every pair (a, b) with a in the left and b in the
right half of the alphabet becomes one symbol.  Names and halves are hashes, so
all tasks agree on them without a dictionary, and a symbol's parse depends on
its neighbours only: equal passages get equal interior symbols.  Each symbol
carries its support, the words that its parse depends on.

*Units* are ``UNIT_SYMBOLS`` consecutive high-level symbols of which the first
or last has the smallest hash (a rule that needs nothing outside the unit and
that picks one in any ``2 * UNIT_SYMBOLS - 2`` symbols).  Spark counts units
over the corpus; one that occurs in a single text only rules out every window
that holds its support.  Windows without any unit (inside long runs) stay.

The windows that are left are verified exactly: the smallest doc_id of each
window's words is aggregated and handed back, and words of windows that start
in a smaller document are removed.  Equal texts are judged once.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ledgerline.llm.common import ROW_ID, bounded, running_before, stash

WINDOW = 50
ROUNDS = 2
UNIT_SYMBOLS = 10
#: Distinct words whose hashes a Python worker remembers: about 50 MB.
REMEMBERED = 300_000
#: Base of the rolling hash, odd, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
NEVER = np.int64(1) << 40


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h


def _word_hashes() -> _WordHashes:
    """Kept between the tasks of a Python worker."""
    kept = sys.modules.setdefault("_ledgerline_word_hashes", types.ModuleType("_ledgerline_word_hashes"))
    if "made" not in kept.__dict__:
        kept.made = _WordHashes()
    return kept.made


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.cumprod(np.full(n - 1, base, np.uint64))
    return out


def _range_hash(ids: np.ndarray):
    """hash(start, end) of word ranges, by prefix sums of ids * BASE^i (all modulo 2^64)."""
    n = len(ids)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(ids * _powers(BASE, n), out=sums[1:])
    back = _powers(INVERSE, n + 1)
    return lambda a, b: _mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))


def _round(name, first, end, low, high, doc):
    """One round: runs, then pairs.  Returns the same six arrays, shorter."""
    n = len(name)
    if not n:
        return name, first, end, low, high, doc
    new_doc = np.ones(n, bool)
    new_doc[1:] = doc[1:] != doc[:-1]
    head = new_doc.copy()
    head[1:] |= name[1:] != name[:-1]
    at = np.flatnonzero(head)  # first element of each run
    size = np.diff(np.append(at, n))
    base = name[at]
    run = np.where(size > 1, _mix(base ^ _mix(size.astype(np.uint64))), base)
    right = (_mix(base ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(1)).astype(bool)
    same_doc = ~new_doc[at[1:]]
    joins = ~right[:-1] & right[1:] & same_doc  # run j takes run j + 1
    second = np.zeros(len(at), bool)
    second[1:] = joins
    take = np.zeros(len(at), bool)
    take[:-1] = joins
    lead = np.flatnonzero(~second)
    out = run[lead].copy()
    pair = take[lead]
    out[pair] = _mix(run[lead[pair]] * np.uint64(3) + _mix(run[lead[pair] + 1]))
    a = at[lead]  # first and last element of each new symbol
    b = np.append(a[1:], n) - 1
    starts_doc = new_doc[a]
    ends_doc = np.append(new_doc[1:], True)[b]
    # the parse depends on the element before and the one after
    new_low = np.where(starts_doc, -NEVER, low[np.maximum(a - 1, 0)])
    new_high = np.where(ends_doc, NEVER, high[np.minimum(b + 1, n - 1)])
    return out, first[a], end[b], new_low, new_high, doc[a]


def _units(ids: np.ndarray, sizes: np.ndarray, rounds: int, m: int):
    """Units of documents laid end to end: key, support (low, high), document."""
    n = len(ids)
    words = np.arange(n, dtype=np.int64)
    level = (ids, words, words + 1, words, words + 1, np.repeat(np.arange(len(sizes)), sizes))
    for _ in range(rounds):
        level = _round(*level)
    name, first, end, low, high, doc = level
    if len(name) < m:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    v = _mix(name)
    least = np.lib.stride_tricks.sliding_window_view(v, m).min(axis=1)
    k = np.flatnonzero(((v[: len(least)] == least) | (v[m - 1:] == least)) & (doc[: len(least)] == doc[m - 1:]))
    return _range_hash(ids)(first[k], end[k + m - 1]), low[k], high[k + m - 1], doc[k]


def _ids(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents laid end to end, and each document's number of words."""
    hashes = _word_hashes()
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), np.uint64, int(sizes.sum()))
    return flat, sizes


def _windows(sizes: np.ndarray, window: int) -> np.ndarray:
    """Which words start a window, over documents laid end to end."""
    n = int(sizes.sum())
    ends = np.repeat(np.cumsum(sizes), sizes)
    return np.arange(n) + window <= ends


def _ruled_out(n: int, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Window starts i with [low, high) inside [i, i + window) for one of the supports."""
    a, b = np.maximum(high - window, 0), low + 1
    ok = (low >= 0) & (high <= n) & (a < b)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, a[ok], 1)
    np.add.at(delta, np.minimum(b[ok], n), -1)
    return np.cumsum(delta[:-1]) > 0


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _surveyed(docs: DataFrame, window: int, rounds: int, m: int) -> DataFrame:
    """Per row: row id, id, the text's two hashes, n_words, digest of all words, unit keys, and whether a window has no unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2):
            words = [(t or b"").split() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            ids, sizes = _ids(words)
            keys, low, high, doc = _units(ids, sizes, rounds, m)
            bare = _windows(sizes, window) & ~_ruled_out(len(ids), low, high, window)
            starts = np.cumsum(sizes) - sizes
            has_bare = np.add.reduceat(np.append(bare, False), starts) > 0 if len(sizes) else np.zeros(0, bool)
            has_bare &= sizes > 0
            offsets = np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32)
            sha = [_digest(w) for w in words]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(sizes), pa.array(sha),
                pa.array(has_bare), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64)))],
                names=[ROW_ID, "id", "h1", "h2", "n_words", "sha", "bare", "keys"])

    return docs.mapInArrow(run, f"{ROW_ID} long, id long, h1 long, h2 long, n_words long, sha string, bare boolean, "
                                "keys array<long>")


def _candidates(docs: DataFrame, window: int, rounds: int, m: int) -> DataFrame:
    """Per row with shared units: row id, id, text, and the windows to verify: hash, 32 bits of a second one, start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2):
            words = [(t or b"").split() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            ids, sizes = _ids(words)
            keys, low, high, doc = _units(ids, sizes, rounds, m)
            alone = np.ones(len(keys), bool)
            shared = batch.column(3)
            bounds = np.searchsorted(doc, np.arange(len(sizes) + 1))
            for i in range(len(sizes)):
                if shared[i].is_valid and (mine := shared[i].values) is not None:
                    a, b = bounds[i], bounds[i + 1]
                    alone[a:b] = ~np.isin(keys[a:b], mine.to_numpy(zero_copy_only=False).view(np.uint64))
            ruled = _ruled_out(len(ids), low[alone], high[alone], window)
            at = np.flatnonzero(_windows(sizes, window) & ~ruled)
            hashes = _range_hash(ids)(at, at + window) if len(at) else np.zeros(0, np.uint64)
            # the same of other word hashes, so that it is independent of the first
            checks = _range_hash(_mix(ids ^ np.uint64(BASE)))(at, at + window) if len(at) else np.zeros(0, np.uint64)
            starts = np.cumsum(sizes) - sizes
            owner = np.searchsorted(starts, at, side="right") - 1
            # of empty documents that share a start, the last one has the words
            offsets = pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2),
                pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array((checks >> np.uint64(32)).astype(np.uint32).view(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array((at - starts[owner]).astype(np.int32)))],
                names=[ROW_ID, "id", "text", "hashes", "checks", "starts"])

    return docs.mapInArrow(run, f"{ROW_ID} long, id long, text string, hashes array<long>, checks array<int>, "
                                "starts array<int>")


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """row id, n_removed and kept_sha256 of rows with windows to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, sha = [], []
            for text, starts in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                words = (text or b"").split()
                delta = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy(zero_copy_only=False)
                np.add.at(delta, at, 1)
                np.add.at(delta, np.minimum(at + window, len(words)), -1)
                gone = np.cumsum(delta[:-1]) > 0
                rest = [w for w, g in zip(words, gone.tolist()) if not g]
                removed.append(int(gone.sum()))
                sha.append(_digest(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["cut_row", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, "cut_row long, n_removed long, kept_sha256 string")


def _by_rank(docs: DataFrame, id_col: str, text_col: str, window: int, rounds: int, unit_symbols: int) -> DataFrame:
    """``deduplicated`` for ids that aren't integers: the distinct ids' places in their order stand for them."""
    ids = docs.select(F.col(id_col).alias("named")).filter("named IS NOT NULL").distinct()
    places = stash(running_before(ids, [F.col("named")], {"place": F.lit(1).cast("long")}).select("named", "place"))
    rows = docs.select(F.col(id_col).alias("named"), F.col(text_col).alias("text")).join(places, "named", "left")
    out = deduplicated(stash(rows.select("place", "text")), "place", "text", window, rounds, unit_symbols)
    return (out.withColumnRenamed("doc_id", "place").join(places, "place", "left")
            .select(F.col("named").alias("doc_id"), "n_words", "n_removed", "kept_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 rounds: int = ROUNDS, unit_symbols: int = UNIT_SYMBOLS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    Null and empty texts have no words (digest of the empty string).  Ids may be
    of any type that has an order; a null id counts as larger than any other.  Rows of one id don't remove each other's
    words, as none has the smaller id.  An empty table gives no rows.  Other
    columns are ignored.
    """
    if not isinstance(docs.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return _by_rank(docs, id_col, text_col, window, rounds, unit_symbols)
    last = (1 << 63) - 1
    # texts are read twice rather than stored: the second reading may be split otherwise (executors come and go),
    # so it finds its rows by id and two hashes of the text, not by row id
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit(1), F.col(text_col)).alias("h2"))
    numbered = rows.select(F.monotonically_increasing_id().alias(ROW_ID), "id", "text", "h1", "h2")
    seen = stash(_surveyed(numbered, window, rounds, unit_symbols))
    # equal texts are one: the row of the smallest id stands for them
    first = stash(seen.groupBy("sha").agg(F.min(F.struct("id", F.col(ROW_ID).alias("row"))).alias("first")))
    judged = stash(seen.select(ROW_ID, "id", "h1", "h2", "n_words", "sha", "bare").join(first, "sha")
                   .select(ROW_ID, "id", "h1", "h2", "n_words", "sha", "bare", F.col("first.id").alias("first_id"),
                           F.col("first.row").alias("first_row")))
    # units of two texts or more
    units = seen.select(ROW_ID, F.xxhash64("sha").alias("text_hash"), F.explode("keys").alias("key"))
    # stored: a join side straight from an aggregation keeps AQE from splitting a key that very many texts share
    several = stash(units.groupBy("key").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b"))
                    .filter("a != b").select("key"))
    own = judged.filter(f"{ROW_ID} = first_row AND n_words >= {window}").select(ROW_ID, "id", "h1", "h2", "bare")
    shared = units.select("key", ROW_ID).join(several, "key").groupBy(ROW_ID).agg(F.collect_set("key").alias("shared"))
    open_rows = stash(own.join(shared, ROW_ID, "left").filter("bare OR shared IS NOT NULL")
                      .select(ROW_ID, "id", "h1", "h2", "shared"))
    windows = stash(_candidates(rows.join(open_rows, ["id", "h1", "h2"]).select(ROW_ID, "id", "text", "shared"),
                                window, rounds, unit_symbols))
    each = windows.select(ROW_ID, "id", F.explode(F.arrays_zip("hashes", "checks", "starts")).alias("w")).select(
        ROW_ID, "id", F.col("w.hashes").alias("hash"), F.col("w.checks").alias("check"), F.col("w.starts").alias("start"))
    earliest = stash(each.groupBy("hash", "check").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                     .filter("least < most").select("hash", "check", "least"))
    # a row that is repeated, id and text, came through the join as often
    doomed = (each.join(earliest, ["hash", "check"]).filter("id > least")
              .groupBy(ROW_ID).agg(F.collect_set("start").alias("gone")))
    cut = stash(_cut(windows.select(ROW_ID, "text").join(stash(doomed), ROW_ID), window).dropDuplicates(["cut_row"]))
    empty = F.sha2(F.lit(""), 256)
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= window)
    return (judged.join(cut, F.col("first_row") == F.col("cut_row"), "left")
            .select(F.when(F.col("id") != last, F.col("id")).alias("doc_id"), "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))
