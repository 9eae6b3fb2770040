"""Spelling variants, token files and token alignment, against plain Python and exact round trips."""

import hashlib
import random
import re
import tracemalloc
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerline.llm import alignment, queries, spelling, token_chunks, token_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


# ---- spelling

def variants_by_hand(counts, ratio=5):
    letters = sorted({c for w in counts for c in w})
    out = {}
    for w in counts:
        near = {w[:i] + w[i + 1:] for i in range(len(w))}
        near |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near = (near & counts.keys()) - {w}
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= ratio * counts[w] else None
        out[w] = (form, len(near), counts[form] if form else None)
    rows = set()
    for w, (form, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, counts[w], n_near, form_n))
    return rows


def test_spelling_variants(spark, texts):
    counts = Counter()
    for i, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    got = queries.op11_spelling_variants(spark, SF).collect()
    assert {tuple(r) for r in got} == variants_by_hand(counts) and len(got) == len(counts)
    assert sum(r.n_near > 0 for r in got) > 10


def test_spelling_of_crowded_letters(spark):
    """Few letters, so that signatures are shared by very many words, and chains of forms."""
    rng = random.Random(3)
    counts = {"".join(rng.choice("abÀ") for _ in range(rng.randint(3, 9))): int(5 ** rng.uniform(0, 6)) for _ in range(600)}
    words = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n long")
    got = {tuple(r) for r in spelling.grouped(words).collect()}
    assert got == variants_by_hand(counts)
    assert any(r[1] != r[2] for r in got if r[1])  # a root behind the form


# ---- token ids

AWKWARD = ["", " ", "a", "a  b", " a ", "tab\tand\x0b\x0c\r\n", "<|endoftext|> x<|endoftext|>", "é中文 — ñ　x\x1c", "▁ a▁b", "\x01 b \x01",
           "ſ İ Σ́", "x" * 1000, "line\n\n two\n", "a  b ", "Don't we'll I'M", " ".join(f"w{i}" for i in range(1200))]


@pytest.mark.parametrize("make", [
    lambda p: token_chunks.ByteLevel(p("byte_bpe_50k.json")),
    lambda p: token_chunks.ByteLevel(p("byte_bpe_50k.json"), lead=True, exact=True),
    lambda p: token_chunks.WordEnds(p("word_bpe_49k.json")),
    lambda p: token_chunks.Pieces(p("piece_bpe_32k.model")),
])
def test_chunks_give_the_ids_of_whole_texts(make, texts):
    encoder = make(public_tokenizers.path)
    rng = random.Random(4)
    fuzz = ["".join(rng.choice("ab c\n\t'sé中▁ 　\x01́K1,.|>\r") for _ in range(rng.randrange(30))) for _ in range(2000)]
    some = AWKWARD + fuzz + [t or "" for t in texts.values()]
    some += ["z" * 900 + " " + "y" * 201 + "\nexactly15bytes! exactly16bytes!! a\x00 a\x00\x00 a"] * 2
    for most in (1 << 20, 20):  # with 20 the chunks are forgotten all the time
        encoder.table.most = most
        for i in range(0, len(some), 100):
            for text, ids in zip(some[i:i + 100], encoder.encode(some[i:i + 100])):
                want = encoder.whole(text) if text else b""
                spelt = not encoder.exact or not text or encoder.text(want) == (" " * encoder.lead + text).encode()
                assert ids == (want if spelt else None), text


def test_a_full_chunk_table_is_small():
    table, ids, at = token_chunks.ChunkTable(token_chunks.TABLE_CHUNKS), np.arange(3, dtype="<u4").tobytes(), 0
    tracemalloc.start()
    try:
        while table.n <= table.most:
            low = np.arange(at, at := at + 2000, dtype=np.uint64) * np.uint64(977)
            table.add(low, low >> np.uint64(3), [ids] * len(low))
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 70e6 and most < 100e6  # 124 and 169 MB with the keys in the slots
    low = np.arange(0, at + 5000, dtype=np.uint64) * np.uint64(977)
    found = table.find(low, low >> np.uint64(3))
    assert (found[:at] == np.arange(at)).all() and (found[at:] == -1).all()
    assert (table.find(low[:at], (low[:at] >> np.uint64(3)) + np.uint64(1)) == -1).all()  # by all their bytes


@pytest.mark.parametrize("kind, file", [(token_chunks.WordEnds, "word_bpe_49k.json"), (token_chunks.ByteLevel, "byte_bpe_50k.json")])
def test_many_texts_take_little_memory_at_once(kind, file):
    encoder = kind(public_tokenizers.path(file))
    texts = pa.array([f"{'some words of a text ' * 100}{i}" for i in range(3000)], pa.string())  # 6 MB
    sizes = list(map(len, encoder.encode(texts)))
    tracemalloc.start()
    try:
        made = encoder.encode(texts)
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most - held < 25e6  # over 100 MB with the chunks of all texts at once
    assert list(map(len, made)) == sizes and made[7] == encoder.whole(texts[7].as_py())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=60), min_size=1, max_size=8), st.integers(2, 5), st.booleans())
def test_grammar_round_trip(docs, min_count, large):
    docs = [np.array(d, "<u4") + large * 4_000_000_000 % (1 << 32) for d in docs] * 2
    docs = [d.astype("<u4") for d in docs]
    names = [None if i == 1 else f"é{i}" for i in range(len(docs))]
    data = token_files.shard_bytes(names, [d.tobytes() for d in docs], min_count) + b"\n"
    (shard,) = token_files.shards(data)
    assert shard.names == names and shard.end == len(data) and shard.n_ids == sum(map(len, docs))
    assert shard.all() == [d.tobytes() for d in docs]
    for i, d in enumerate(docs):
        assert shard.document(i) == d.tobytes()
        for a, z in ((0, 1), (1, 4), (len(d) - 1, len(d) + 5), (3, 3), (len(d), len(d) + 1)):
            assert shard.ids(i, a, z).tolist() == d[a:z].tolist()


def test_grammar_replaces_what_repeats():
    once = np.arange(50, dtype="<u4")
    data = token_files.shard_bytes([str(i) for i in range(64)], [once.tobytes()] * 64)
    shard = token_files.Shard(data)
    assert len(shard.symbols) == 64 and max(shard.lengths) == 50  # each copy is one symbol
    assert all(a < 50 + r and b < 50 + r for r, (a, b) in enumerate(shard.rules.tolist()))


def test_token_files(spark, texts):
    encode, at, want = tokenizer("word_bpe_49k.json"), 0, []
    for i in sorted(texts):
        ids = np.array([*encode(texts[i] or ""), 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, SF).collect()) == want


def test_token_files_of_awkward_rows(spark, scratch):
    rows = [(None, "no id"), (3, None), (3, "a b c"), (3, "a b c"), (-2, ""), (7, "x " * 5000), *[(9, "all alike")] * 300]
    rows += [(20 + i, t) for i, t in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = f"{scratch}/{uuid.uuid4().hex}"
    token_files.write(docs, path, shard_ids=500)
    got = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in token_files.read(spark, path).collect())
    encode, at = tokenizer("word_bpe_49k.json"), 0
    for start, n, _, _ in got:
        assert start == at
        at += n
    assert [x[2] for x in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    crc = lambda t: zlib.crc32(np.array([*encode(t or ""), 2], "<u4").tobytes())
    assert Counter((x[2], x[3]) for x in got) == Counter((i, crc(t)) for i, t in rows)
    with open(next(iter(__import__("glob").glob(f"{path}/part-*"))), "rb") as f:
        assert f.read(4) == token_files.MAGIC
    names = spark.createDataFrame([("é", "b"), (None, "a"), ("", "c")], "doc_id string, text string")
    assert {r.doc_id for r in token_files.round_trip(names).collect()} == {"é", None, ""}
    assert token_files.round_trip(docs.limit(0)).count() == 0


# ---- alignment

BYTE = {c: bytes([b]) for c, b in token_chunks._BYTE.items()}


def both_sides(text):
    """[(id, bytes)] of each side by the libraries alone, or none."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    m = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for t in [text or ""]:
        left = [(i, b"".join(BYTE[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
        right = [(i, bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode())
                 for i in m.encode(t) for p in [m.id_to_piece(i)]]
        spelt = t and all(b"".join(x[1] for x in side) == (" " + t).encode() for side in (left, right))
        return (left, right) if spelt else ([], [])


def by_hand(rows):
    sides, links, count, groups = [both_sides(t) for _, t in rows], [], Counter(), []
    for left, right in sides:
        ends = []
        for side in (left, right):
            at, e = 0, {}
            for i, b in side:
                at += len(b)
                e[at] = i
            ends.append(e)
        common = sorted(ends[0].keys() & ends[1].keys())
        links.append([(ends[0][e], ends[1][e]) for e in common])
        count.update(links[-1])
        texts, at = [], 0
        for e in common:
            inside = [",".join(str(ends[k][x]) for x in sorted(ends[k]) if at < x <= e) for k in (0, 1)]
            texts.append("|".join(inside))
            at = e
        groups.append(";".join(texts))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter(
        (i, len(left), len(right), len(ls), len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls),
         hashlib.sha256(g.encode()).hexdigest() if left else "")
        for (i, _), (left, right), ls, g in zip(rows, sides, links, groups))


def test_alignment(spark, texts):
    few = {i: t for i, t in texts.items() if not t or len(t) < 1500 or i % 10 == 0}
    rows = [*few.items(), *[(1000 + i, t) for i, t in enumerate(AWKWARD)], (None, "no id"), (None, None), *[(5, "twice here")] * 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = by_hand(rows)
    # parts of 40 characters: most documents go through the tree; pairs looked up, joined, and both
    for part, top in ((1 << 16, 1 << 20), (40, 100), (300, 0)):
        got = alignment.aligned(docs, part_chars=part, top_pairs=top).collect()
        assert Counter(tuple(r) for r in got) == want


def test_query_is_the_operator(spark, texts):
    got = queries.op13_token_alignment(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all((r.n_links > 0) == bool(r.groups_sha256) and r.n_best <= r.n_links <= r.count_sum for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(0, 70), max_size=5))
def test_fragments_compose_at_any_cuts(a_sizes, b_sizes, cuts):
    a_ends, b_ends = np.cumsum(np.array(a_sizes, int)), np.cumsum(np.array(b_sizes, int))
    a, b = np.arange(len(a_ends)), 100 + np.arange(len(b_ends))
    same = lambda x, y: all((getattr(x, n) == getattr(y, n)).all() and len(getattr(x, n)) == len(getattr(y, n))
                            for n in ("a", "b", "in_a", "in_b"))
    whole, parts, at = alignment.fragment(a, b, a_ends, b_ends), [], -1
    for cut in [*sorted(cuts), 10_000]:
        in_a, in_b = (a_ends > at) & (a_ends <= cut), (b_ends > at) & (b_ends <= cut)
        parts.append(alignment.fragment(a[in_a], b[in_b], a_ends[in_a], b_ends[in_b]))
        at = max(at, cut)
    left = alignment.NOTHING
    for p in parts:
        left = left.then(p)
    right = alignment.NOTHING
    for p in reversed(parts):
        right = p.then(right)
    assert same(left, whole) and same(right, whole)


def test_parts_lose_single_spaces_only():
    text = "ab  cd ef\tgh ij " * 50
    for most in (1, 7, 100):
        assert " ".join(alignment.parts_of(text, most)) == text
    assert alignment.parts_of("x" * 500, 10) == ["x" * 500]  # nowhere to cut
