"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: lower-cased words, with numbers, units after a
number and capitalised names inside a sentence replaced by typed placeholders
whose values are the slots.  Windows of template tokens are hash-joined with
those of the benchmark; matching windows of one document, item and offset form
a piece.  Pieces at neighbouring offsets, no further apart than the item is long,
form an alignment: a word put in or left out starts a new piece.  It counts if it
covers at least ``coverage`` of the item's tokens and its slots are consistent:
each value of the item stands for one value of the document throughout.  So a
copy whose numbers and names were replaced is caught, and a text that happens to
share the template isn't.  A run of ``VERBATIM`` tokens that are the item's, values
too, counts however long the item is.

A window with more placeholders than words says little as a template: any sum is
like any other.  Such windows are joined by a hash that includes their slots'
values, so items of numbers or names are found where they were copied verbatim.

A bitmap of fixed size (``BITS``) over the benchmark's window hashes lets the
documents' other windows go before the join, whatever the benchmark's size: a
fuller bitmap only lets more through to the join, which is exact.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, bounded, field, stash, with_row_id

WINDOW = 8
COVERAGE = 0.5
#: Tokens of an item in a row that count whatever share of it they are.
VERBATIM = 30
#: Bits of the bitmap: 2 MB, however many windows the benchmark has.
BITS = 1 << 24
#: Distinct tokens whose codes a Python worker remembers: about 50 MB.
REMEMBERED = 200_000
# Words that are units where a number stands before them.
UNITS = frozenset("""
    % cm m km mm mi ft in inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
    g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres
    gallon gallons s sec min h hr ms second seconds minute minutes hour hours day days week weeks month months year
    years usd eur gbp dollar dollars euro euros cent cents percent mph kmh w kw v hz khz mhz ghz kb mb gb tb""".split())

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?:\n%]")
_NUMBER, _UNIT, _NAME, _END = 1 << 60, 2 << 60, 3 << 60, 4 << 60
_KIND, _HASH = np.uint64(7 << 60), np.uint64((1 << 60) - 1)


class _Codes(dict):
    """token -> 60 bits of hash of its lower case; above them, what it may be."""

    def __missing__(self, token: str) -> int:
        from xxhash import xxh64_intdigest

        low = token.lower()
        h = xxh64_intdigest(low) & int(_HASH)
        if token[0].isdigit():
            code = _NUMBER | h
        elif token in ".!?:\n":
            code = _END
        elif low in UNITS:
            code = _UNIT | h
        elif token[0].isupper() and token[1:].islower():
            code = _NAME | h
        else:
            code = h
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = code
        return code


def _codes() -> _Codes:
    """Kept between the tasks of a Python worker."""
    kept = sys.modules.setdefault("_ledgerline_codes", types.ModuleType("_ledgerline_codes"))
    if "made" not in kept.__dict__:
        kept.made = _Codes()
    return kept.made


def _template(text: str) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Template tokens (hashes), which of them are placeholders, all tokens, and each template token's first token."""
    tokens = _TOKEN.findall(text)
    code = np.fromiter(map(_codes().__getitem__, tokens), np.uint64, len(tokens))
    kind = code & _KIND
    before = np.concatenate(([np.uint64(_END)], kind[:-1])) if len(kind) else kind
    name = (kind == _NAME) & (before != _END)
    unit = (kind == _UNIT) & (before == _NUMBER)
    number = kind == _NUMBER
    out = code & _HASH
    out[number], out[unit], out[name] = np.uint64(1), np.uint64(2), np.uint64(3)
    # sentence ends go, and a name of several words is one placeholder
    stay = kind != _END
    stay[1:] &= ~(name[1:] & name[:-1])
    at = np.flatnonzero(stay)
    return out[at], (number | unit | name)[at], tokens, at


def _valued(out: np.ndarray, slot: np.ndarray, tokens: list[str], at: np.ndarray) -> np.ndarray:
    """Template tokens with hashes of their values in place of placeholders; of a name, all its words."""
    code = np.fromiter(map(_codes().__getitem__, tokens), np.uint64, len(tokens))[at[0]:]
    starts = at - at[0]
    place = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
    mixed = ((code & _HASH) + place.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    mixed[code & _KIND == _END] = 0
    return np.where(slot, np.add.reduceat(mixed * (place.astype(np.uint64) + np.uint64(1)), starts), out)


def _hashes(out: np.ndarray, w: int, seed: int) -> np.ndarray:
    n = len(out) - w + 1
    h = np.full(n, seed, np.uint64)
    for k in range(w):
        h = (h ^ out[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _windows(text: str, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hashes) of all windows of each size; with their slots' values where these are more than the words."""
    out, slot, tokens, at = _template(text)
    valued = None
    for w in sizes:
        if len(out) >= w:
            h = _hashes(out, w, w)
            slots = np.concatenate(([0], np.cumsum(slot)))
            heavy = 2 * (slots[w:] - slots[:-w]) > w
            if heavy.any():
                valued = _valued(out, slot, tokens, at) if valued is None else valued
                h = np.where(heavy, _hashes(valued, w, w + (1 << 32)), h)
            yield w, h


def _slots(tokens: list[str], at: np.ndarray, slot: np.ndarray, a: int, w: int) -> list[str]:
    """Values of the placeholders in a window; of a name, all its words."""
    ends = np.append(at[1:], len(tokens))
    return [" ".join(t for t in tokens[at[k]:ends[k]] if t not in ".!?:\n").lower() for k in range(a, a + w) if slot[k]]


def windows(rows: DataFrame, sizes: list[int], bitmap=None) -> DataFrame:
    """(id, n, size, pos, hash, slots) of the windows of ``rows(id, text)``; n: template tokens of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else bitmap.value
        for batch in bounded(batches, 1):
            ids, n, size, pos, hashes, values = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                parts = None
                for w, h in _windows(text or "", sizes):
                    seen = np.ones(len(h), bool)
                    if bits is not None:
                        b = h & np.uint64(BITS - 1)
                        seen = (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)) > 0
                    for a in np.flatnonzero(seen).tolist():
                        parts = parts or _template(text)
                        ids.append(i)
                        n.append(len(parts[0]))
                        size.append(w)
                        pos.append(a)
                        hashes.append(int(h[a].astype(np.int64)))
                        values.append(_slots(parts[2], parts[3], parts[1], a, w))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(n, pa.int32()), pa.array(size, pa.int32()),
                 pa.array(pos, pa.int32()), pa.array(hashes, pa.int64()), pa.array(values, pa.list_(pa.string()))],
                names=["id", "n", "size", "pos", "hash", "slots"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(
        run, f"id {kind}, n int, size int, pos int, hash long, slots array<string>")


def _bitmap(items: DataFrame):
    """The broadcast bitmap of the items' window hashes: at most BITS / 64 words come to the driver."""
    place = F.col("hash").bitwiseAND(F.lit(BITS - 1))
    rows = (items.select(place.alias("p")).distinct()
            .groupBy(F.expr("p div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("bits")).collect())
    bits = np.zeros(BITS // 64, np.uint64)
    for r in rows:
        bits[r.word] = np.int64(r.bits).view(np.uint64)
    return items.sparkSession.sparkContext.broadcast(bits)


def _covered(starts: list[int], size: int) -> set[int]:
    return {k for p in starts for k in range(p, p + size)}


def _longest(places: set[int]) -> int:
    """Length of the longest run of consecutive places."""
    best = n = 0
    last = None
    for k in sorted(places):
        n = n + 1 if last is not None and k == last + 1 else 1
        best, last = max(best, n), k
    return best


def _best(tokens: int, size: int, pieces: list[dict], coverage: float) -> tuple[int, bool] | None:
    """(covered tokens, whether verbatim) of a document's best alignment with an item, if one counts.

    pieces: offset, at (item places of the windows), same (of those with the
    item's values), pairs (item's and document's values).  Going along the
    offsets, a piece joins the alignments it is consistent with; one without
    slots joins all.
    """
    most: tuple[int, bool] | None = None

    def count(n: int, exact: bool) -> None:
        nonlocal most
        most = max(most or (0, False), (n, exact))

    need = max(size, coverage * tokens)
    plain: dict | None = None  # the alignment of pieces without slots
    open_: list[dict] = []  # those with slots
    for piece in sorted(pieces, key=lambda x: x["offset"]):
        at = piece["offset"]
        if len(piece["same"]) * size >= VERBATIM and (n := _longest(_covered(piece["same"], size))) >= VERBATIM:
            count(n, True)
        values: dict[str, str] = {}
        if any(values.setdefault(x["a"], x["b"]) != x["b"] for x in piece["pairs"]):
            continue
        here = _covered(piece["at"], size)
        open_ = [x for x in open_ if at - x["last"] <= tokens]
        if plain and at - plain["last"] > tokens:
            plain = None
        if not values:
            plain = plain or {"values": {}, "covered": set(), "last": at}
            join = [plain, *open_]
        else:
            join = [x for x in open_ if all(x["values"].get(a, b) == b for a, b in values.items())]
            if not join:
                join = [{"values": {}, "covered": set(plain["covered"]) if plain else set(), "last": at}]
                open_ += join
        for x in join:
            x["values"].update(values)
            x["covered"] |= here
            x["last"] = at
            if len(x["covered"]) >= need:
                count(len(x["covered"]), all(a == b for a, b in x["values"].items()))
    return most


def _counted(found: DataFrame, coverage: float) -> DataFrame:
    """(row, item_row, kind, covered, tokens) of the documents and items (row, item_row, tokens, size, pieces) with an alignment that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, covered = [], [], []
            for i, (tokens, size, pieces) in enumerate(zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)])):
                if best := _best(tokens, size, pieces, coverage):
                    at.append(i)
                    covered.append(best[0])
                    kinds.append("exact" if best[1] else "reparameterised")
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(kinds, pa.string()),
                 pa.array(covered, pa.int64()), batch.column(2).take(rows).cast(pa.int64())],
                names=["row", "item_row", "kind", "covered", "tokens"])

    kind = found.schema["row"].dataType.simpleString()
    return found.select("row", "item_row", "tokens", "size", "pieces").mapInArrow(
        run, f"row {kind}, item_row long, kind string, covered long, tokens long")


def matches(rows: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text",
            window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(row, item, kind, covered, tokens): contaminated ones of ``rows(id, text)`` and the items they hold.

    kind: ``exact`` if all slots have the item's values, else ``reparameterised``.
    """
    items = benchmark.select(F.monotonically_increasing_id().alias("id"), F.col(item_text).alias("text"),
                             F.col(item_col).alias("item"))
    items = stash(items)
    # items shorter than a window are one window of their own length
    own = stash(windows(items, list(range(1, window + 1))).filter(f"size = least(n, {window})"))
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())  # at most ``window`` numbers
    found = windows(rows, sizes, _bitmap(own))
    own = own.select(F.col("id").alias("item_row"), F.col("n").alias("tokens"), "size", F.col("pos").alias("item_pos"),
                     "hash", F.col("slots").alias("item_slots"))
    met = found.select(F.col("id").alias("row"), "size", "pos", "hash", "slots").join(own, ["hash", "size"])
    met = met.filter("size(slots) = size(item_slots)")
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    pieces = met.groupBy("row", "item_row", (F.col("pos") - F.col("item_pos")).alias("offset")).agg(
        F.first("tokens").alias("tokens"), F.first("size").alias("size"),
        F.collect_set("item_pos").alias("at"),  # at most the item's tokens
        F.collect_set(F.when(F.col("slots") == F.col("item_slots"), F.col("item_pos"))).alias("same"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    found = pieces.groupBy("row", "item_row").agg(
        F.first("tokens").alias("tokens"), F.first("size").alias("size"),
        F.collect_list(F.struct("offset", "at", "same", "pairs")).alias("pieces"))  # one document's and one item's
    return _counted(found, coverage).join(items.select(F.col("id").alias("item_row"), "item"), "item_row").select(
        "row", "item", "kind", "covered", "tokens")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", **parameters) -> DataFrame:
    """One row per contaminated row and item: doc_id, item_id, kind, covered, tokens.

    Null and empty texts match nothing, on either side.  Repeated rows and rows with
    null ids are reported like any other.  An empty table gives no rows.  Other
    columns are ignored.
    """
    # the id travels with the row number, so the documents are read once
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id")).alias("id"),
                       F.col(text_col).alias("text"))
    found = matches(rows, benchmark, item_col, item_text, **parameters)
    return found.select("row.doc_id", F.col("item").alias("item_id"), "kind", "covered", "tokens")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    stored = with_row_id(docs)
    found = matches(stored.select(F.col(ROW_ID).alias("id"), field(text_col).alias("text")), benchmark, **parameters)
    return stored.join(found.select(F.col("row").alias(ROW_ID)).distinct(), ROW_ID, "left_anti").select("doc.*")
