"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for all operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import (
    alignment,
    decontaminate,
    html_extract,
    line_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_files,
)

LONG = " ".join(f"word{i % 977} is {i}" for i in range(40_000)) + "\nlast line"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "The first text. It has some words in it, and a few more.\nSecond line here.", "en", "a", 70),
    (1, "The first text. It has some words in it, and a few more.\nSecond line here.", "en", "a", 70),  # a repeated row
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "  \n\t\n ", "en", "b", 6),
    (None, "A text without an id, mail me at x.y@example.com or +1 (578) 555-6437.", "en", "b", 60),
    (None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG)),
    (6, "word " * 300, "en", "b", 1500),
    (7, "é中文 — ñ x\x0b\x0cy\x1c<|endoftext|>\r\n", "fr", "c", 25),
]
BENCH = [(1, "How many apples does Mary have if she buys 12 apples and eats 5 apples each day?"), (2, None), (3, ""),
         (None, "tiny"), (1, "How many apples does Mary have if she buys 12 apples and eats 5 apples each day?")]


def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (6, 0), (5, None), (None, 1)], "doc_id long, quality int")


#: name -> (function of (spark, docs), rows come out one for one)
OPERATORS = {
    "quality_rules": (lambda s, d: quality_rules.judged(d).select("doc.doc_id", "q.*", "verdict.*"), True),
    "sharding": (lambda s, d: sharding.byte_shards(d, 3), True),
    "simhash": (lambda s, d: simhash.near_duplicates(d), True),
    "pii": (lambda s, d: pii.found(d), True),
    "decontaminate": (lambda s, d: decontaminate.contaminated(d, bench(s)), False),
    "quality_classifier": (lambda s, d: quality_classifier.scored(d, labels(s)), True),
    "substring_dedup": (lambda s, d: substring_dedup.deduplicated(d, window=5), True),
    "line_dedup": (lambda s, d: line_dedup.deduplicated(d).select("doc.doc_id", "rest", "n_lines", "n_removed"), True),
    "html_extract": (lambda s, d: html_extract.extracted(
        d.withColumnsRenamed({"doc_id": "page_id", "text": "html", "source": "url"})), True),
    "packing": (lambda s, d: packing.packed(d), False),
    "spelling": (lambda s, d: spelling.grouped(spelling.word_counts(d, min_length=4, min_count=1, slip=7)), False),
    "token_files": (lambda s, d: token_files.round_trip(d), True),
    "alignment": (lambda s, d: alignment.aligned(d), True),
}
#: Names that the operators use themselves.
CLASHES = ["doc", "q", "verdict", "host", "n_docs", "rest", "gone", "row", "rank", "shard", "slot", "size", "__row_id",
           "__fp", "fp", "root", "component_id", "features", "score", "item_id", "kind", "at", "first", "place", "id",
           "h", "word", "n", "run", "row", "part", "keys", "times", "file", "content"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(2)


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, docs, name):
    run, one_for_one = OPERATORS[name]
    out = run(spark, docs).collect()
    if one_for_one:
        assert len(out) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    run, _ = OPERATORS[name]
    assert run(spark, spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(spark, docs, name):
    run, _ = OPERATORS[name]
    key = lambda rows: sorted(str([v for k, v in sorted(r.asDict().items()) if k not in (
        "sequence_id", "offset", "slot", "start_byte", "shard")]) for r in rows)
    small = docs.filter("doc_id IS NULL OR doc_id != 5")
    assert key(run(spark, clashing(small)).collect()) == key(run(spark, small).collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, docs, name, stage):
    d = "/root/testdata/sf0.001"
    for frame in (docs, clashing(docs), spark.createDataFrame([], SCHEMA)):
        out = stage(spark, frame, d)
        if name != "packing":
            assert out.columns == frame.columns
            assert out.dtypes == frame.dtypes
        out.collect()


def test_defined_results(spark, docs):
    zero = {r.fingerprint for r in simhash.near_duplicates(docs.filter("doc_id IN (2, 3, 4)")).collect()}
    assert zero == {"0" * 16}
    assert {r.component_id for r in simhash.near_duplicates(docs.filter("doc_id IN (2, 3, 4)")).collect()} == {2}
    sizes = {r.doc_id: (r["size"], r.text_crc32) for r in sharding.byte_shards(docs.filter("doc_id IN (2, 3)"), 4).collect()}
    assert sizes == {2: (16, 0), 3: (16, 0)}
    lengths = [r.length for r in packing.packed(docs.filter("doc_id IN (2, 3)")).collect()]
    assert lengths == [1, 1]
    gone = {r.doc_id: r.n_removed for r in substring_dedup.deduplicated(docs.filter("doc_id <= 4"), window=5).collect()}
    assert set(gone.values()) == {0}  # rows of one id don't remove each other's words
    assert simhash.one_per_group(docs.filter("doc_id = 1")).count() == 1
    assert line_dedup.without_repeats(docs.filter("doc_id = 1")).count() == 1
    # the end-of-text string is ordinary text
    assert all(r.length < 1024 for r in packing.pieces(docs.filter("doc_id = 7")).collect())
