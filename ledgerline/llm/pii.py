"""Personal data: base patterns and bootstrapped contextual extraction.

Four base patterns find e-mail addresses, IP addresses, card and phone numbers
in whole texts; they are seed entities, and so are long hexadecimal strings, of a
kind of their own (secret) that the base patterns don't know.  *Candidates* are
looser forms of the kinds (numbers without a plus sign, spelled-out addresses,
digits that fail a check) and, of no kind yet, all other identifiers: tokens of six
characters or more with a digit.  The one or two words before an entity or
candidate are a lexical pattern.

Patterns and instances form a graph that Spark scores in rounds, until nothing
changes: a pattern's confidence in a kind is the weight of the distinct-instance
evidence behind it over all the times its words occur in the corpus, whatever
follows; a candidate's weight is that of its best pattern.  Patterns that start with
too few seeds, or words that any text has, never gain confidence.  Secrets and
candidates at patterns of high confidence become spans, identifiers of any shape
with the pattern's kind; those of the base patterns always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, bounded, stash

#: Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone")
#: Those with the kinds that only contexts make spans.
ALL_KINDS = (*KINDS, "secret")
SECRET = len(KINDS)
#: A round in which no candidate's weight grows by more is the last one.
SETTLED = 0.001
MIN_SEEDS = 3
CONFIDENCE = 0.6
#: Bits of the bitmap of pattern words: 2 MB, however many patterns there are.
BITS = 1 << 24
#: Characters before an entity in which its pattern's words are looked for first.
REACH = 200
#: Signs that may stand between a pattern's words and the entity.
OPENING = "\"'`([{<"

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behind and the possessive repeats change no match: they spare retries inside a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Looser forms of each kind, by which candidates are found.
_LOOSE = {
    "email": re.compile(r"(?<![\w.])[\w.+-]{1,64}[ ]?(?:\(at\)|\[at\]|\{at\})[ ]?[\w-]{1,64}"
                        r"(?:[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\})[ ]?[\w-]{1,64}){1,4}", re.I),
    "ip": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<![\w+])[0-9](?:[ -]?[0-9]){12,18}(?![\w])"),
    "phone": re.compile(r"(?<![\w+])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![\w])"),
}


_HEX = re.compile(r"(?<![0-9A-Za-z_])[0-9a-f]{32,}(?![0-9A-Za-z_])")
_IDENTIFIER = re.compile(r"(?<![\w.+/=:@-])(?=[\w.+/=:@-]*[0-9])[A-Za-z0-9][\w.+/=:@-]{5,}")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ so that long runs aren't tried from every place."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = last + len(text[last:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1  # a local part can't reach over this @
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _listed(spans) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _hash(words: str) -> int:
    from xxhash import xxh64_intdigest

    h = xxh64_intdigest(words)
    return h - (1 << 64) if h >> 63 else h


def _patterns(text: str, start: int) -> list[int]:
    """Hashes of the last one and two words before a place; quotes and brackets in between don't count."""
    reach = REACH
    while True:
        words = text[max(0, start - reach):start].lower().rstrip(OPENING).split()
        if len(words) > 2 or reach >= start:  # the first one found may be cut
            break
        reach *= 4
    return [_hash(" ".join(words[-n:])) for n in (1, 2) if len(words) >= n]


def _instance(kind: int, value: str) -> str:
    """What counts as the same entity."""
    return _digits(value) if kind in (2, 3) else re.sub(r"[\W_]+", ".", value.lower())


class _Taken:
    """Spans that nothing else may overlap, asked for in ascending order of places."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans, self.i = sorted(spans), 0

    def free(self, start: int, end: int) -> bool:
        while self.i < len(self.spans) and self.spans[self.i][1] <= start:
            self.i += 1
        return self.i == len(self.spans) or self.spans[self.i][0] >= end


def _occurrences(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """Base spans, and all entities and candidates (kind -1: any) with their patterns."""
    base, found = base_spans(text), []

    def add(kind: int, start: int, end: int, seed: bool) -> None:
        found.append({"kind": kind, "start": start, "end": end, "instance": _hash(_instance(kind, text[start:end])),
                      "seed": seed, "patterns": _patterns(text, start)})

    for a, k, b in base:
        add(k, a, b, True)
    taken = [(a, b) for a, _, b in base]
    free = _Taken(taken)
    for m in _HEX.finditer(text):
        if free.free(m.start(), m.end()) and re.search("[0-9]", m[0]) and re.search("[a-f]", m[0]):
            add(SECRET, m.start(), m.end(), True)
            taken.append((m.start(), m.end()))
    loose = []
    for k, name in enumerate(KINDS):
        free = _Taken(taken)
        for m in _LOOSE[name].finditer(text):
            if free.free(m.start(), m.end()):
                add(k, m.start(), m.end(), False)
                loose.append((m.start(), m.end()))
    ends = 0
    merged = []  # the loose forms may overlap each other
    for a, b in sorted(taken + loose):
        if a >= ends:
            merged.append((a, b))
        ends = max(ends, b)
    free = _Taken(merged)
    for m in _IDENTIFIER.finditer(text):
        end = m.start() + len(m[0].rstrip(".:=/-"))
        if end - m.start() >= 6 and any("0" <= c <= "9" for c in m[0]) and free.free(m.start(), end):
            add(-1, m.start(), end, False)
    return base, found


_FOUND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()),
                             ("seed", pa.bool_()), ("patterns", pa.list_(pa.int64()))]))
_FOUND_DDL = "array<struct<kind:int,start:int,end:int,instance:long,seed:boolean,patterns:array<long>>>"


def _searched(rows: DataFrame, kind: str) -> DataFrame:
    """Per row: row id, doc_id, the counts, base_sha256, the base spans and all occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2):
            made = [_occurrences(t or "") for t in batch.column(2).to_pylist()]
            listed = [_listed(base) for base, _ in made]
            counts = [pa.array([sum(k == x for _, k, _ in base) for base, _ in made], pa.int64()) for x in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *counts,
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
                 pa.array(listed, pa.string()), pa.array([f for _, f in made], _FOUND)],
                names=[ROW_ID, "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "found"])

    return rows.mapInArrow(run, f"{ROW_ID} long, doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                f"base_sha256 string, base string, found {_FOUND_DDL}")


def _word_counts(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often the words of patterns occur in the corpus; a few hash neighbours come along."""
    place = F.col("pattern").bitwiseAND(F.lit(BITS - 1))
    rows = (patterns.select(place.alias("p")).distinct().groupBy(F.expr("p div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("bits")).collect())  # BITS / 64 at most
    bits = np.zeros(BITS // 64, np.uint64)
    for r in rows:
        bits[r.word] = np.int64(r.bits).view(np.uint64)
    known = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in bounded(batches, 0):
            hashes: list[int] = []
            for text in batch.column(0).to_pylist():
                words = (text or "").lower().split()
                hashes.extend(map(xxh64_intdigest, words))
                hashes.extend(xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:]))
            h = np.array(hashes, np.uint64)
            b = h & np.uint64(BITS - 1)
            h = h[(known.value[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)) > 0]
            keys, n = np.unique(h.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["pattern", "n"])

    counted = texts.mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counted.join(patterns.select("pattern").distinct(), "pattern", "left_semi")


def _scored_patterns(edges: DataFrame, totals: DataFrame, min_seeds: int, settled: float = SETTLED) -> DataFrame:
    """(kind, pattern, confidence) once the graph of edges(kind, pattern, instance, seed, n) has settled."""
    weights = stash(edges.groupBy("kind", "instance").agg(F.max(F.col("seed").cast("double")).alias("weight")))
    while True:
        patterns = (edges.join(weights, ["kind", "instance"]).groupBy("kind", "pattern")
                    .agg(F.sum(F.col("weight") * F.col("n")).alias("mass"), F.sum("weight").alias("distinct"),
                         F.sum("n").alias("seen"))
                    .join(totals, "pattern", "left")
                    .filter(F.col("distinct") >= min_seeds)
                    .select("kind", "pattern", (F.col("mass") / (
                        F.greatest("seen", F.coalesce("total", F.lit(0))) + 1)).alias("confidence")))
        patterns = stash(patterns)
        best = (edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "instance")
                .agg(F.max("confidence").alias("reached")))
        # a seed keeps its weight; a candidate has that of its best pattern, damped so that doubt adds up;
        # weights only grow and stay below one, so the rounds end
        weights = stash(weights.withColumnRenamed("weight", "was").join(best, ["kind", "instance"], "left")
                        .select("kind", "instance", "was", F.greatest("was", F.coalesce(F.col("reached") * 0.9, F.lit(0.0)))
                                .alias("weight")))
        if weights.filter(F.col("weight") > F.col("was") + settled).isEmpty():
            return patterns
        weights = weights.drop("was")


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts are those of the base patterns; ``spans`` lists all spans as
    kind:start:end (code points, end exclusive);
    added ones may be of the kind secret.  Null texts are empty ones.
    Repeated rows and null ids each have a row.  An empty table gives no rows.
    Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias(ROW_ID), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    seen = stash(_searched(rows, kind))
    each = seen.filter("size(found) > 0").select(ROW_ID, F.explode("found").alias("f"))
    edges = stash(each.filter("f.kind >= 0").select("f.kind", "f.instance", "f.seed", F.explode("f.patterns").alias("pattern"))
                  .groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))
    # patterns with a chance: as many distinct instances of a kind as seeds are asked for
    likely = stash(edges.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("instances"))
                   .filter(F.col("instances") >= min_seeds).select("kind", "pattern"))
    edges = stash(edges.join(likely, ["kind", "pattern"], "left_semi"))
    totals = stash(_word_counts(docs.select(F.col(text_col).alias("text")), likely))
    sure = stash(_scored_patterns(edges, totals, min_seeds).filter(F.col("confidence") >= confidence))
    # secrets and candidates of a kind need a sure pattern of that kind, other identifiers take the surest one's
    open_ = each.filter(f"NOT f.seed OR f.kind = {SECRET}").select(
        ROW_ID, F.col("f.kind").alias("own"), "f.start", "f.end", F.explode("f.patterns").alias("pattern"))
    wanted = (open_.join(sure, "pattern").filter("own = kind OR own = -1")
              .groupBy(ROW_ID, "start", "end").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "kind")).alias("best"))
              .select(ROW_ID, F.struct("start", F.col("best.kind").alias("kind"), "end").alias("s")).groupBy(ROW_ID)
              .agg(F.collect_set("s").alias("added")))  # at most a text's spans
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    own = F.transform(F.filter("found", lambda f: f["seed"] & (f["kind"] < SECRET)), lambda f: F.struct(f["start"], f["kind"], f["end"]))
    every = F.sort_array(F.concat(own, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    listed = F.array_join(F.transform(every, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return seen.join(wanted, ROW_ID, "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", listed.alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))
