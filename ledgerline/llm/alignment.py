"""Alignment of two tokenizations of the same texts, and the id pairs that end together.

Tokenizer A and tokenizer B spell the same bytes.  Byte offsets where a token of
each ends cut both sequences into groups.  Any byte range of a document yields
a fragment: the tokens up to its first common end (which may belong to a group that
began before the range), closed groups, and the tokens behind its last common end
(which may go on).  Fragments compose associatively with the empty one as identity,
so documents over ``PART_CHARS`` are cut into parts that Spark shuffles to any
tasks, and their fragments are reduced as a tree, ``FAN`` neighbours at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded, stash
from ledgerline.llm.token_chunks import ByteLevel, Pieces, give_back, kept

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Longer texts are cut into parts of about so many characters, at the next place where both tokenizers always split.
PART_CHARS = 1 << 16
#: Neighbouring fragments that one step of the tree composes.
FAN = 8
#: Most frequent id pairs whose counts every task gets; the others are joined. 16 bytes each.
TOP_PAIRS = 1 << 20
#: A single space between two characters that aren't white space.
CUT = re.compile(r"\S (?=\S)")

LINKS = "keys array<long>, times array<int>"
ALIGNED = f"doc_id {{kind}}, n_a long, n_b long, n_groups long, groups_sha256 string, {LINKS}"


@dataclass(frozen=True)
class Fragment:
    """Tokens of a byte range: ids of both sides, and how many of each lie in each closed segment.

    The first segment ends at the first common end of the range; what the counts
    leave over is the open suffix.  Without counts all tokens are open.
    """

    a: np.ndarray
    b: np.ndarray
    in_a: np.ndarray
    in_b: np.ndarray

    def then(self, other: Fragment) -> Fragment:
        """The fragment of this range and the next one."""
        in_a, in_b = other.in_a.copy(), other.in_b.copy()
        if len(in_a):  # this one's open tokens belong to the other's first segment
            in_a[0] += len(self.a) - int(self.in_a.sum())
            in_b[0] += len(self.b) - int(self.in_b.sum())
        return Fragment(*(np.concatenate(x) for x in (
            (self.a, other.a), (self.b, other.b), (self.in_a, in_a), (self.in_b, in_b))))


NOTHING = Fragment(*(np.zeros(0, "<u4") for _ in range(4)))


def fragment(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of the tokens whose end bytes lie in one byte range."""
    common = np.intersect1d(a_ends, b_ends)
    in_a = np.diff(np.searchsorted(a_ends, common, side="right"), prepend=0)
    in_b = np.diff(np.searchsorted(b_ends, common, side="right"), prepend=0)
    return Fragment(a.astype("<u4"), b.astype("<u4"), in_a.astype("<u4"), in_b.astype("<u4"))


class _Aligner:
    """Both encoders of a worker, and the lengths of their tokens."""

    def __init__(self, a_path: str | None, b_path: str | None):
        self.a = kept(ByteLevel, a_path, A_FILE, lead=True, exact=True)
        self.b = kept(Pieces, b_path, B_FILE)
        self.a_size, self.b_size = (np.array([len(x) for x in e.bytes], np.int32) for e in (self.a, self.b))

    def tokens(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of both sides; None where they don't spell the text."""
        return [(a, b) if t and a is not None and b is not None else None
                for t, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts))]

    def joined(self, found: list[tuple[bytes, bytes] | None]):
        """All texts in a row: ids, the positions of the tokens that end together, tokens per text."""
        a, b = (np.frombuffer(b"".join(x[k] for x in found if x), "<u4") for k in (0, 1))
        # a batch's bytes fit 32 bits
        a_ends, b_ends = np.cumsum(self.a_size[a], dtype=np.int32), np.cumsum(self.b_size[b], dtype=np.int32)
        marks = np.zeros((int(a_ends[-1]) if len(a) else 0) + 1, np.int8)
        marks[a_ends] = 1
        marks[b_ends] += 1
        n_a, n_b = (np.array([len(x[k]) // 4 if x else 0 for x in found], np.int64) for k in (0, 1))
        return a, b, np.flatnonzero(marks[a_ends] == 2), np.flatnonzero(marks[b_ends] == 2), n_a, n_b


class _Digits(list):
    """At 3 * id + k: the id with a comma, a bar or a semicolon behind it."""

    def __init__(self, path: str):
        super().__init__()

    def upto(self, most: int) -> _Digits:
        for i in range(len(self) // 3, most + 1):
            self += [f"{i},", f"{i}|", f"{i};"]
        return self


def _records(ids: pa.Array, a, b, close_a, close_b, n_a, n_b) -> pa.RecordBatch:
    """A row for each text of those that ``joined`` laid in a row."""
    # texts that have tokens end with a common end, so no group spans two of them
    ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
    groups = np.diff(np.searchsorted(close_a, ends_a), prepend=0)
    line = np.empty(len(a) + len(b), np.uint32)  # the ids group by group, A's in front of B's
    for ids_, close, sign, others in ((a, close_a, 1, np.append(0, close_b + 1)), (b, close_b, 2, np.append(close_a + 1, 0))):
        closing = np.zeros(len(ids_), np.int32)
        closing[close] = 1
        before = np.cumsum(closing, dtype=np.int32)
        before -= closing
        line[np.arange(len(ids_), dtype=np.int32) + others.astype(np.int32)[before]] = 3 * ids_ + np.uint32(sign) * closing.astype(np.uint32)
    word = kept(_Digits, "", "").upto(int(max(a.max(), b.max())) if len(a) else 0).__getitem__
    digests, at = [], 0
    for size in (n_a + n_b).tolist():
        text = "".join(map(word, line[at:at + size].tolist()))
        digests.append(hashlib.sha256(text[:-1].encode()).hexdigest() if size else "")
        at += size
    # links: the tokens that end together, alike ones of a text counted
    text_of = np.repeat(np.arange(len(n_a), dtype=np.int64), groups)
    keys = a[close_a].astype(np.int64) << 32 | b[close_b]
    at = 0
    for n in groups.tolist():  # each text's own, in order
        keys[at:at + n].sort()
        at += n
    fresh = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    fresh[np.cumsum(groups)[:-1][groups[1:] > 0]] = True  # a text's first
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(keys))).astype(np.int32)
    offsets = pa.array(np.searchsorted(text_of[first], np.arange(len(n_a) + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_a), pa.array(n_b), pa.array(groups.astype(np.int64)), pa.array(digests, pa.string()),
         pa.ListArray.from_arrays(offsets, pa.array(keys[first])), pa.ListArray.from_arrays(offsets, pa.array(times))],
        names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "keys", "times"])


def _short(rows: DataFrame, a_path: str | None, b_path: str | None, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(a_path, b_path)
        for batch in bounded(batches, 1, 3 << 20):
            found = aligner.tokens([t or "" for t in batch.column(1).to_pylist()])
            yield _records(batch.column(0), *aligner.joined(found))
        give_back()

    return rows.select("doc_id", "text").mapInArrow(run, ALIGNED.format(kind=kind))


def parts_of(text: str, most: int = PART_CHARS) -> list[str]:
    """The text cut at single spaces, which the parts lose, at or behind every ``most`` characters."""
    out, at = [], 0
    while len(text) - at > most and (m := CUT.search(text, at + most - 1)):
        out.append(text[at:m.end() - 1])
        at = m.end()
    return [*out, text[at:]]


def _long(rows: DataFrame, a_path: str | None, b_path: str | None, kind: str, part_chars: int) -> DataFrame:
    """As ``_short``, with each text's parts aligned in tasks of their own and their fragments composed."""
    piece = f"row long, doc_id {kind}, part int, "
    whole = "spelt boolean, a binary, b binary, in_a binary, in_b binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2, 1 << 20):
            made = [parts_of(t, part_chars) for t in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(made)), [len(m) for m in made]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([k for m in made for k in range(len(m))], pa.int32()),
                 pa.array([p for m in made for p in m], pa.string())], names=["row", "doc_id", "part", "text"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(a_path, b_path)
        for batch in bounded(batches, 3, 1 << 20):
            found, made = aligner.tokens(batch.column(3).to_pylist()), []
            for x in found:
                ids = [np.frombuffer(i, "<u4") for i in x or (b"", b"")]
                made.append(fragment(*ids, np.cumsum(aligner.a_size[ids[0]]), np.cumsum(aligner.b_size[ids[1]])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([x is not None for x in found]),
                 *(pa.array([getattr(f, n).tobytes() for f in made], pa.binary()) for n in ("a", "b", "in_a", "in_b"))],
                names=["row", "doc_id", "part", "spelt", "a", "b", "in_a", "in_b"])

    def compose(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        columns = [table.column(n).to_pylist() for n in ("a", "b", "in_a", "in_b")]
        all_of = NOTHING
        for x in zip(*columns):
            all_of = all_of.then(Fragment(*(np.frombuffer(v, "<u4") for v in x)))
        out = table.slice(0, 1).select(["row", "doc_id"])
        out = out.append_column("part", pa.array([table.column("part")[0].as_py() // FAN], pa.int32()))
        out = out.append_column("spelt", pa.array([all(table.column("spelt").to_pylist())]))
        for n in ("a", "b", "in_a", "in_b"):
            out = out.append_column(n, pa.array([getattr(all_of, n).astype("<u4").tobytes()], pa.binary()))
        return out

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                spelt = row.column(3)[0].as_py()
                a, b, in_a, in_b = (np.frombuffer(row.column(k)[0].as_py() if spelt else b"", "<u4") for k in range(4, 8))
                yield _records(row.column(1), a, b, np.cumsum(in_a, dtype=np.int64) - 1, np.cumsum(in_b, dtype=np.int64) - 1,
                               np.array([len(a)]), np.array([len(b)]))

    cuts = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(cut, piece + "text string")
    made = stash(cuts.repartition("row", "part").mapInArrow(align, piece + whole))
    most = made.agg(F.max("part")).first()[0] or 0
    while most > 0:
        # stored, so that a task runs one Python function and needs one worker
        made = stash(made.withColumn("__up", F.expr(f"part div {FAN}")).groupBy("row", "__up")
                     .applyInArrow(lambda t: compose(t.drop_columns(["__up"])), piece + whole))
        most //= FAN
    return made.mapInArrow(finish, ALIGNED.format(kind=kind))


def _frequent(pairs: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(least count, keys, counts, best): all pairs of at least that count, ``most`` of them or fewer."""
    sizes = (pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count()
             .orderBy(F.desc("power")).collect())  # at most 64 rows
    least, so_far = 1 << 62, 0
    for r in sizes:
        so_far += r["count"]
        if so_far > most:
            break
        least = 1 << r.power
    top = pairs.filter(F.col("n") >= least).toArrow().sort_by("key")
    return least, *(top.column(c).to_numpy() for c in ("key", "n", "best"))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
            b_path: str | None = None, part_chars: int = PART_CHARS, top_pairs: int = TOP_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is an A token and a B token that end at the same byte; an id pair's
    count is how many links of all documents hold it.  ``n_best``: a document's
    links whose count is the highest of any pair with their B id, ties included;
    ``count_sum``: their counts added up.  Null and empty texts, and texts that one
    of the tokenizers doesn't spell out byte by byte, have no tokens: zeros and ''.
    Rows repeated or with null ids are rows like any other; other columns are
    ignored; an empty table gives no rows.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # parts have at least so many characters, and so bytes
    long = F.coalesce(F.octet_length("text") > part_chars, F.lit(False))
    # in tasks of their own, with row numbers from 0 up and from -1 down
    short = stash(_short(rows.filter(~long), a_path, b_path, kind).withColumn("row", F.monotonically_increasing_id()))
    found = short.unionByName(stash(_long(rows.filter(long), a_path, b_path, kind, part_chars)
                                    .withColumn("row", -1 - F.monotonically_increasing_id())))
    return _with_counts(spark, found, stash(pair_counts(found)), top_pairs)


def pair_counts(found: DataFrame) -> DataFrame:
    """(key, n, best): how many links hold each id pair, and whether no pair with the same B id has more."""
    counts = stash(found.select(F.inline(F.arrays_zip("keys", "times"))).groupBy(F.col("keys").alias("key"))
                   .agg(F.sum("times").alias("n")).withColumn("b", F.col("key").bitwiseAND(0xFFFFFFFF)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(stash(most), "b").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_counts(spark: SparkSession, found: DataFrame, pairs: DataFrame, top_pairs: int) -> DataFrame:
    """The documents' sums over their links: frequent pairs are looked up in the task, the others joined."""
    least, *top = _frequent(pairs, top_pairs)
    shared = spark.sparkContext.broadcast(tuple(top))  # at most top_pairs rows
    digest = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lists = batch.column(len(digest))
            keys, times = (x.flatten().to_numpy(zero_copy_only=False) for x in (lists, batch.column(len(digest) + 1)))
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.searchsorted(known, keys)
            hit = np.zeros(len(keys), bool)
            inside = at < len(known)
            hit[inside] = known[at[inside]] == keys[inside]
            row, at = np.repeat(np.arange(batch.num_rows), sizes), at[hit]
            total, first = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(total, row[hit], n[at] * times[hit])
            np.add.at(first, row[hit], best[at] * times[hit])
            links = np.zeros(batch.num_rows, np.int64)
            np.add.at(links, row, times)
            offsets = pa.array(np.searchsorted(row[~hit], np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(digest)], pa.array(links), pa.array(first), pa.array(total),
                 pa.ListArray.from_arrays(offsets, pa.array(keys[~hit])), pa.ListArray.from_arrays(offsets, pa.array(times[~hit]))],
                names=[*digest, "n_links", "n_best", "count_sum", "keys", "times"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in digest) + f", n_links long, n_best long, count_sum long, {LINKS}"
    summed = stash(found.select(*digest, "keys", "times").mapInArrow(run, schema))
    rare = stash(summed.select("row", F.inline(F.arrays_zip("keys", "times"))))
    late = (rare.join(pairs.filter(F.col("n") < least), rare["keys"] == pairs.key).groupBy(F.col("row").alias("late"))
            .agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best")))
    with_all = summed.join(late, summed.row == F.col("late"), "left")
    return with_all.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
