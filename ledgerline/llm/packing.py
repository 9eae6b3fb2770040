"""Packing of tokenized documents into sequences of bounded length.

Documents become pieces of at most ``capacity`` tokens.  The pieces are dealt
at random into groups of bounded size; in each group best-fit decreasing fills
bins, then a local search moves pieces between underfull bins, exchanges one
for one or two for one, always so that the sum of squared fills rises, in at most
six passes, or until a pass finds nothing.  The search is bounded, which may cost
fill but no piece: of the bins with a wanted length 17 are looked at, and more only
until one gives; of a bin's own pairs 64; and two for one are the 256 shortest pairs
of each of the four bins that were emptiest at the start of the pass.  A table of up to
``GROUP_PIECES`` pieces is one group, so one task packs it.  The pieces of the bins
that stay far from full in any group are dealt again and packed once more.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, bounded, stash
from ledgerline.llm.token_chunks import ByteLevel, give_back, kept, pack

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Pieces that one task packs together.
GROUP_PIECES = 100_000
#: Bins below this share of the capacity are opened again for the second round.
REOPEN = 0.98


class Encoder(ByteLevel):
    """Ids of whole texts, as bytes."""

    def __init__(self, path: str | None = None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        super().__init__(path)

    def encode(self, text: str) -> bytes:
        return self.all([text])[0]

    def all(self, texts: list[str] | pa.Array) -> list[bytes]:
        return super().encode(texts)


_bytes = pack


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece: __row_id, doc_id, piece, start, length, ids_crc32.

    A document's ids are those of its whole text and ``end_id``.  Only documents
    over ``capacity`` ids are cut, from the end, so that the first piece may be
    the shorter one.  Null and empty texts are the end id alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept(Encoder, path, VOCABULARY), _bytes([end_id])
        for batch in bounded(batches, 2, 6 << 20):
            row, piece, start, length, crc = [], array("i"), array("q"), array("q"), array("q")
            for i, found in enumerate(encoder.all(batch.column(2))):
                ids = found + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a:4 * b]))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.frombuffer(piece, np.int32)),
                 *(pa.array(np.frombuffer(x, np.int64)) for x in (start, length, crc))],
                names=[ROW_ID, "doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    rows = docs.select(F.monotonically_increasing_id().alias(ROW_ID), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"{ROW_ID} long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of positions in ``lengths``."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = defaultdict(list)  # free tokens -> bins
    free = 0  # bit r: some bin has r tokens free
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        fits = free >> n
        if fits:
            r = (fits & -fits).bit_length() - 1 + n
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room[r - n].append(b)
        free |= 1 << (r - n)
    return bins


def _improve(bins: list[list[int]], lengths: list[int], capacity: int, passes: int = 6) -> list[list[int]]:
    """Local search among the underfull bins; every step raises the sum of squared fills.

    With fills f >= e of two bins, handing d more tokens to the fuller one
    raises the sum, so a bin looks for the largest exchange that still fits.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    by_length: dict[int, set[int]] = defaultdict(set)  # length -> underfull bins that have such a piece
    mask = 0  # bit n: some underfull bin has a piece of n tokens

    def enter(b: int) -> None:
        nonlocal mask
        if fill[b] < capacity:
            for i in bins[b]:
                by_length[lengths[i]].add(b)
                mask |= 1 << lengths[i]

    def leave(b: int) -> None:
        nonlocal mask
        for i in bins[b]:
            n = lengths[i]
            if b in by_length[n]:
                by_length[n].remove(b)
                if not by_length[n]:
                    mask &= ~(1 << n)

    def giver(n: int, a: int, least: int) -> int | None:
        """A bin other than a with a piece of n tokens and so low a fill that a gain of ``least`` counts."""
        seen = None
        for k, b in enumerate(by_length[n]):
            if b != a and fill[b] - fill[a] < least and (seen is None or fill[b] < fill[seen]):
                seen = b
            if k >= 16 and seen is not None:
                break
        return seen

    def swap(a: int, give: list[int], b: int, take: list[int]) -> None:
        leave(a), leave(b)
        for i in give:
            bins[a].remove(i)
        for i in take:
            bins[b].remove(i)
        bins[a] += take
        bins[b] += give
        for x in (a, b):
            fill[x] = sum(lengths[i] for i in bins[x])
            enter(x)

    def step(a: int) -> bool:
        gap, best = capacity - fill[a], (0, None)
        give = [([], 0)] + [([i], lengths[i]) for i in bins[a]]
        give += [([i, j], lengths[i] + lengths[j]) for k, i in enumerate(bins[a]) for j in bins[a][k + 1:]][:64]
        for out, n in give:  # a move, one for one, one for two of a's
            want = (mask & ((1 << (min(n + gap, capacity) + 1)) - 1)).bit_length() - 1
            while want > n and want - n > best[0]:
                b = giver(want, a, want - n)
                if b is not None:
                    best = (want - n, (out, b, [want]))
                    break
                want = (mask & ((1 << want) - 1)).bit_length() - 1
            if best[0] == gap:
                break
        if best[0] < gap and donors:  # two of an emptier bin for one of a's, or for none
            for b in donors[-4:]:
                if b == a or not bins[b]:
                    continue
                pairs = sorted((lengths[i] + lengths[j], lengths[i], lengths[j])
                               for k, i in enumerate(bins[b]) for j in bins[b][k + 1:])[:256]
                for out, n in give[: 1 + len(bins[a])]:
                    k = bisect_right(pairs, (n + gap, capacity, capacity)) - 1
                    if k >= 0 and (d := pairs[k][0] - n) > best[0] and fill[b] - fill[a] < d:
                        best = (d, (out, b, list(pairs[k][1:])))
        if best[1] is None:
            return False
        out, b, take = best[1]
        taken: list[int] = []
        for n in take:
            taken.append(next(i for i in bins[b] if lengths[i] == n and i not in taken))
        swap(a, list(out), b, taken)
        return True

    for b in range(len(bins)):
        enter(b)
    for _ in range(passes):
        order = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=fill.__getitem__, reverse=True)
        donors, changed = order, False
        for a in order:
            while bins[a] and fill[a] < capacity and step(a):
                changed = True
        if not changed:
            break
    return [b for b in bins if b]


def _packed(pieces_df: DataFrame, capacity: int, first_id: int) -> DataFrame:
    """Adds sequence_id, offset and fill; pieces are dealt into groups of bounded size."""
    n_groups = -(-max(1, pieces_df.count()) // GROUP_PIECES)
    names = ["doc_id", ROW_ID, "piece", "start", "length", "ids_crc32"]
    kinds = {f.name: f.dataType.simpleString() for f in pieces_df.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(ROW_ID, "ascending"), ("piece", "ascending")])  # a retried task packs alike
        lengths = table.column("length").to_pylist()
        bins = _improve(_best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        base = first_id + (table.column("__group")[0].as_py() << 24)
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                sequence[i], offset[i] = base + k, at
                at += lengths[i]
            fill[b] = at
        out = table.select(names)
        for name, col in (("sequence_id", sequence), ("offset", offset), ("fill", fill)):
            out = out.append_column(name, pa.array(col))
        return out

    group = F.pmod(F.xxhash64(ROW_ID, "piece"), F.lit(n_groups))
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", sequence_id long, offset long, fill long"
    return pieces_df.select(*names, group.alias("__group")).groupBy("__group").applyInArrow(run, schema)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of one sequence lie gapless from 0 and sum to at most ``capacity``.
    Null and empty texts are one piece of one id.  Repeated rows and rows with
    null ids are packed like any other.  An empty table gives no rows.  Other
    columns are ignored.
    """
    cut = stash(pieces(docs, id_col, text_col, capacity, end_id, path))
    once = stash(_packed(cut, capacity, 0))
    full = F.col("fill") >= F.lit(int(REOPEN * capacity))
    again = _packed(once.filter(~full).drop("sequence_id", "offset", "fill"), capacity, 1 << 60)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return once.filter(full).select(*cols).unionByName(again.select(*cols))
