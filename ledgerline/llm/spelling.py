"""Spelling variants: frequent words and the rarer words one letter away from them.

Words are letter multisets, that is binary vectors over (letter, how-manieth):
one replaced letter moves two bits, one letter more or less moves one.  PartEnum
signatures make that an equi-join.  The dimensions are dealt into parts; vectors at
Hamming distance k agree on all but k parts, so they share the projection on
some choice of (parts - k) parts, and every such projection is one signature.  Words
of equal length take distance two over four parts, words whose lengths differ by one
take distance one over three parts.  One edit also leaves one half of the word as it
was, so the unchanged half stands in the signature too, which keeps anagrams of
common letters out of each other's buckets.  Pairs that share a signature are
verified by their edit distance.  No pair is lost: both properties are necessary
for a distance of one edit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import let, stash

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (Hamming distance, parts) for words of equal length and for lengths that differ by one.
REPLACED, INSERTED = (2, 4), (1, 3)


def _lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; ``lower`` does it where all is ASCII, and faster."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                min_count: int = 5, slip: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``min_length`` letters and ``min_count`` occurrences.

    With ``slip``, a run whose crc32 of ``<id>:<run>`` it divides loses one letter,
    that at the crc32 modulo the length: known misspellings to find.  Null texts
    have no words, a null id counts as the empty string, repeated rows count as
    often as they stand there, other columns are ignored.
    """
    run = F.explode(F.regexp_extract_all(_lower(F.col(text_col)), F.lit(f"([{LETTERS}]{{{min_length},}})"))).alias("run")
    # a letter less makes no run longer, so the short ones needn't be looked at
    runs = docs.select(F.col(id_col).cast("string").alias("id"), run)
    word = F.col("run")
    if slip:
        size, h = F.char_length("run"), F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
        word = let(h, lambda h: F.when(h % slip != 0, F.col("run")).otherwise(let(
            (h % size).cast("int"),
            lambda at: F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size)))))
    return (runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") >= min_count) & (F.char_length("word") >= min_length)))


def _projections(word: str, distance: int, parts: int) -> list[str]:
    """The projections of a word's letter multiset on all choices of parts - distance parts."""
    seen: dict[str, int] = {}
    dealt: list[list[str]] = [[] for _ in range(parts)]
    for letter in sorted(word):
        k = seen[letter] = seen.get(letter, -1) + 1
        dealt[zlib.crc32(b"%d:%d" % (ord(letter), k)) % parts].append(f"{letter}{k}")
    return [f"{i}/" + "/".join("".join(dealt[p]) for p in chosen)
            for i, chosen in enumerate(combinations(range(parts), parts - distance))]


def word_signatures(word: str) -> tuple[list[int], list[int]]:
    """64-bit signatures of a word as the one with fewer letters or as many, and as the one with more or as many."""
    n = len(word)

    def made(kind: str, length: int, projections: list[str]) -> list[int]:
        half = length // 2  # letters that stay in front, or else length - half at the end
        halves = (f"<{word[:half]}", f">{word[n - (length - half):]}")
        return [xxhash.xxh3_64_intdigest(f"{kind}{length}{h}|{p}") - (1 << 63) for h in halves for p in projections]

    equal, other = made("=", n, _projections(word, *REPLACED)), _projections(word, *INSERTED)
    return equal + made("+", n, other), equal + made("+", n - 1, other)


def signatures(words: DataFrame) -> DataFrame:
    """(sig, longer, word, n): one row for each signature of each word of ``words(word, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, longer, row = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                for side, found in enumerate(word_signatures(word)):
                    sigs += found
                    longer += [bool(side)] * len(found)
                    row += [i] * len(found)
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.int64()), pa.array(longer, pa.bool_()), batch.column(0).take(at),
                 batch.column(1).take(at)], names=["sig", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig long, longer boolean, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of distinct words of ``words(word, n)`` that are one edit apart, each once.

    Both sides of the join are stored, so AQE can split the bucket of a signature
    that very many words share.
    """
    sigs = stash(signatures(words))
    left = sigs.filter("NOT longer").select("sig", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = sigs.filter("longer").select("sig", F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.char_length("a") != F.char_length("b")) | (F.col("a") < F.col("b"))
    near = once & (F.levenshtein("a", "b", 1) == 1)
    return left.join(right, (left.sig == right.sig) & near).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): from word along ``forms(word, form)`` to the last, by pointer doubling.

    A form has several times its word's count, so there are no cycles and chains
    are short; a round doubles the steps taken.
    """
    at = stash(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("mid"), F.col("root").alias("end"))
        at = stash(at.drop("moved").join(further, at.root == further.mid, "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")))
        if at.filter("moved").isEmpty():
            return at.select("word", "root")


def grouped(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words(word, n)``, words being distinct.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if
    that n is at least ``ratio`` times the word's, else null with ``form_n``; ``root``
    is where the forms lead, the word itself if it has none.  Null words take no
    part; an empty table gives no rows.
    """
    words = stash(words.filter(F.col("word").isNotNull()).select("word", "n"))
    pairs = stash(near_pairs(words))
    ends = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")).alias("best"))
    ends = ends.unionByName(pairs.select(
        F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("form")).alias("best")))
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    takes = -F.col("best.less") >= ratio * F.col("n")
    found = stash(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.form")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")))
    return (found.join(_roots(found.filter("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
