"""Quality rules with host-level verdicts.

Every document gets counts and rule failures; failures are aggregated by host
(the document's source), each host's failure rate per rule is shrunk towards
the corpus by a beta prior that is fitted to all hosts (empirical Bayes,
moments), and the host's verdicts are joined back to its documents:

* a document that fails the base rules goes, whatever its host;
* a document that fails a soft rule goes if its host fails that rule
  systematically (shrunk rate at least ``rule_rate``); on other hosts a single
  failure is forgiven;
* if nearly everything of a host fails (shrunk rate of any failure at least
  ``host_rate``), all its documents go.

Native: DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, WORD, let, stash, whole, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
RULE_RATE = 0.02
HOST_RATE = 0.9
#: Soft rules: SQL conditions over the counts.
SOFT_RULES = {
    "symbols": "100 * q.n_symbols > 10 * q.word_chars",
    "dup_lines": "q.n_dup_lines >= 2 and 100 * q.n_dup_lines > 30 * q.n_lines",
    "word_length": "q.word_chars > 20 * q.n_words",
}


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more."""
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2]))

    def covered(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, a)["g"] == F.get(s, b)["g"], F.lit(False))
        hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j - 1, j) | same(j, j + 1))
        at = F.transform(hit, lambda j: s[j]["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2)))))

    def repeated(g: Column) -> Column:
        sorted_grams = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(sorted_grams, covered))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(grams, repeated))


def counts(text: Column) -> Column:
    """A struct of the base counts of one text, all long (null: all zero)."""
    text = F.coalesce(text, F.lit(""))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    n_repeat = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                                   _repeat_words(w).cast("long").alias("r")))
    n_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    made = F.struct(n_repeat.alias("w"), n_lines.alias("l"), without(SPACES).cast("long").alias("word_chars"),
                    (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"))
    return let(made, lambda m: F.struct(
        m["w"]["n"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["d"].alias("n_dup_lines"), m["w"]["r"].alias("n_repeat_words"), m["l"]["n"].alias("n_lines")))


def _prior(hosts: DataFrame, failures: str) -> tuple[float, float]:
    """Beta prior of the hosts' failure rates: mean over documents, strength from their spread."""
    rate = F.col(failures) / F.col("n_docs")
    row = hosts.agg(F.sum(failures).alias("f"), F.sum("n_docs").alias("n"), F.var_pop(rate).alias("v")).first()
    mean = ((row.f or 0) + 0.5) / ((row.n or 0) + 1.0)
    # spread of the rates: beta variance = mean (1 - mean) / (strength + 1)
    strength = mean * (1 - mean) / row.v - 1 if row.v else 1e4
    strength = min(max(strength, 1.0), 1e4)
    return mean * strength, (1 - mean) * strength


def judged(docs: DataFrame, text_col: str = "text", host_col: str = "source", rule_rate: float = RULE_RATE,
           host_rate: float = HOST_RATE, keep: list[str] | None = None) -> DataFrame:
    """(doc, q, verdict): each row of ``docs`` (or its columns ``keep``), its counts, and what became of it.

    verdict: base_failed, kept, the host's shrunk rate of any failure, and the
    soft rules that the document fails.  One row per input row.  A null or
    empty text has zero words and fails the base rules.  Documents without a
    host (null) form one host.  Repeated rows count as often as they occur.  An
    empty table gives no rows.
    """
    names = list(SOFT_RULES)
    base = (F.col("q.n_words") < MIN_WORDS) | (100 * F.col("q.n_repeat_words") > 50 * F.col("q.n_words"))
    kept_columns = docs if keep is None else docs.select(*keep)
    rated = docs.select(whole(kept_columns).alias("doc"), F.col(host_col).alias("host"), counts(F.col(text_col)).alias("q"))
    rated = stash(rated.withColumn("r", F.struct(base.alias("base"), *[F.expr(c).alias(n) for n, c in SOFT_RULES.items()])))

    any_fails = F.col("r.base")
    for n in names:
        any_fails = any_fails | F.col(f"r.{n}")
    # partial sums before the shuffle: a hot host is one row per task
    hosts = stash(rated.groupBy(F.col("host").alias("judged_host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(any_fails.cast("long")).alias("f_any"),
        *[F.sum(F.col(f"r.{n}").cast("long")).alias(f"f_{n}") for n in names]))

    def shrunk(col: str) -> Column:
        a, b = _prior(hosts, col)
        return (F.col(col) + a) / (F.col("n_docs") + a + b)

    verdicts = hosts.select("judged_host", shrunk("f_any").alias("host_any"),
                            *[(shrunk(f"f_{n}") >= rule_rate).alias(f"bad_{n}") for n in names])
    out = rated.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
    rejected = F.col("r.base") | (F.col("host_any") >= host_rate)
    for n in names:
        rejected = rejected | (F.col(f"r.{n}") & F.col(f"bad_{n}"))
    verdict = F.struct(F.col("r.base").alias("base_failed"), (~rejected).alias("kept"), F.col("host_any").alias("host_rate"),
                       *[F.col(f"r.{n}") for n in names])
    return out.select("doc", "q", verdict.alias("verdict"))


def kept_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return judged(docs, **parameters).filter("verdict.kept").select("doc.*")
