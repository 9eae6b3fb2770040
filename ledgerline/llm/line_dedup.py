"""Line deduplication by a suffix array over line ids.

Lines that hold a word are numbered by their rank among all distinct lines;
prefix doubling then ranks the suffixes of every document's line sequence by
their first 2, 4, ... lines: the pair (rank of the suffix, rank of the suffix
h lines on) is counted, and a pair's new rank is the number of suffixes before
it, a distributed prefix sum.  Suffixes that are alone with their rank leave;
nothing that starts there repeats.  At ``min_lines`` lines the suffixes of one
rank are an interval of the suffix array whose common prefix is that long or
longer.  Its member that comes first in the corpus (smallest doc_id, row, line)
stays, the lines of all others go.  A longer repeat is the union of the
intervals' runs along it, so every maximal repeated run of at least
``min_lines`` lines loses its later copies whole, and doubling needn't go on.
A line of ``min_words`` words or more is a run by itself: the intervals of the first
order give its copies.

Native: DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, WORD, field, let, running_before, stash, with_row_id

MIN_LINES = 2
#: A single line of so many words is repeated text, not a phrase that many documents have.
MIN_WORDS = 50


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key tuples that occur twice or more, with ``rank`` and the first occurrence."""
    classes = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1")
    return running_before(classes, [F.col(k) for k in keys], {"rank": F.col("n")}).select(*keys, "first", "rank")


def repeated_lines(stored: DataFrame, id_col: str, text_col: str, min_lines: int = MIN_LINES,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(row id, gone): which of a document's lines with words, from 0, later copies of repeated runs cover."""
    # so many words take as many characters, and a space between each two
    long = (F.length("l") >= 2 * min_words - 1) & (F.regexp_count("l", F.lit(WORD)) >= min_words)
    lines = F.filter(F.split(field(text_col), "\n"), lambda x: x.rlike(WORD))
    at = F.struct(field(id_col).isNull().alias("no_id"), field(id_col).alias("id"), F.col(ROW_ID).alias("row"),
                  F.col("seq"))
    # two independent 64-bit hashes stand for a line
    suffixes = (stored.select("doc", ROW_ID, F.posexplode(lines).alias("seq", "l"))
                .select(F.col(ROW_ID).alias("row"), "seq", at.alias("at"),
                        F.xxhash64("l").alias("k1"), F.xxhash64(F.lit(1), F.col("l")).alias("k2"), long.alias("long")))
    suffixes, keys, h, alone = stash(suffixes), ["k1", "k2"], 1, None
    while True:
        ranked = _ranked(suffixes, keys)
        suffixes = suffixes.join(ranked, keys).select("row", "seq", "at", "first", "rank", *(["long"] if h == 1 else []))
        if h >= min_lines:
            break
        suffixes = stash(suffixes)
        if h == 1:
            alone = suffixes.filter("long AND at != first").select("row", "seq")
        step = min(h, min_lines - h)
        on = suffixes.select(F.col("row"), (F.col("seq") - step).alias("seq"), F.col("rank").alias("k2"))
        suffixes = suffixes.withColumnRenamed("rank", "k1").join(on, ["row", "seq"]).select("row", "seq", "at", "k1", "k2")
        keys, h = ["k1", "k2"], h + step
    doomed = (suffixes.filter("at != first")
              .select("row", F.explode(F.expr(f"sequence(seq, seq + {min_lines - 1})")).alias("seq")))
    if alone is not None:  # with runs of one line, long lines are runs anyway
        doomed = doomed.unionByName(alone)
    gone = doomed.groupBy("row").agg(F.collect_set("seq").alias("gone"))  # at most a document's lines
    return gone.select(F.col("row").alias(ROW_ID), "gone")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, rest, n_lines, n_removed): each row of ``docs``, the text that stays, its lines and how many went.

    Lines without a word are never part of a run, don't count and stay.  A null
    text stays null.  Null ids come last in the order of copies; of repeated
    rows the first read keeps its lines.  An empty table gives no rows.
    """
    stored = with_row_id(docs)
    gone = repeated_lines(stored, id_col, text_col, min_lines, min_words).withColumnRenamed(ROW_ID, "gone_row")

    def rest(a: Column) -> Column:
        """The lines that stay: ``gone`` counts lines with a word, ``a`` holds them all."""
        spoken = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: a[i].rlike(WORD))
        out = let(spoken, lambda s: F.array_except(F.sequence(F.lit(0), F.size(a) - 1),
                                                   F.transform(F.col("gone"), lambda g: s[g])))
        return F.array_join(F.transform(out, lambda i: a[i]), "\n")

    text = field(text_col)
    lines = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    return (stored.join(gone, F.col(ROW_ID) == F.col("gone_row"), "left").select(
        "doc", F.when(F.col("gone").isNull(), text).otherwise(let(F.split(text, "\n"), rest)).alias("rest"),
        F.when(text.isNull(), 0).otherwise(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the texts that stay; documents that lost every line go."""
    out = deduplicated(docs, id_col, text_col, min_lines, min_words).filter("NOT (n_removed > 0 AND n_removed = n_lines)")
    return out.select(*[(F.col("rest") if c == text_col else field(c)).alias(c) for c in docs.columns])
