"""Token counts, vector codes and spelling variants against plain code, on given and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import merges, queries
from tidemark.llm.merges import count_tokens
from tidemark.llm.spellings import group_spellings, neighbours
from tidemark.llm.vector_codes import FARTHEST, Slices, encode_vectors

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def alike(found, wanted):
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


# Token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def counted(library, rows, limit=1024):
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    return [(i, len((t or "").encode()), n, n > limit) for (i, t), n in zip(rows, sizes)]


def test_token_counts_of_given(cluster, data, given, library):
    alike(queries.op11_token_counts(cluster, data).collect(), counted(library, given))


def test_token_counts_of_odd(odd, odd_rows, nothing, library):
    alike(count_tokens(odd, VOCABULARY, limit=40).collect(), counted(library, [r[:2] for r in odd_rows], 40))
    empty = count_tokens(nothing, VOCABULARY)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


LIBRARY = Tokenizer.from_file(VOCABULARY)
PARTS = ["a", "the", " the", "  ", "\n", "\t", "'s", "'LL", "12", "½", "é", "漢字", "\U0001f600", "<|endoftext|>", "<|", "̀", " ", "\x85", "ꟍ", "!!", "x" * 90]


@settings(max_examples=300, deadline=None)
@drawn(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(exclude_categories=["Cs"])), max_size=30).map("".join))
def test_token_counts_of_any_text(text):
    assert merges.counter(VOCABULARY)(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_long_pieces_and_long_texts(library, monkeypatch):
    for text in ("ab" * 20_000, " " * 9_999 + "x", "\n" * 500, "é" * 3_000):
        assert merges.counter(VOCABULARY)(text) == len(library.encode(text, add_special_tokens=False).ids)
    monkeypatch.setattr(merges, "STRETCH", 7)
    text = " ".join(random.Random(1).choices([p for p in PARTS if p.strip()], k=2_000))
    assert merges.counter(VOCABULARY)(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_a_worker_forgets_counts_beyond_its_bound(monkeypatch, library):
    monkeypatch.setattr(merges, "PIECES", 10)
    own = merges.Counter(VOCABULARY)
    texts = [f"word{i} and more{i}" for i in range(50)]
    assert [own(t) for t in texts] == [len(library.encode(t).ids) for t in texts]
    assert len(own.counts) < 20


# Vector codes


def plain_codes(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error) by comparing each part with each entry. Rows: (id, vector, label)."""
    kept = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and np.isfinite(x) for x in r[1])]
    if not kept:
        return []
    dims = len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))[1])
    kept = [r for r in kept if len(r[1]) == dims]
    width = dims // parts
    steps = [[max(-FARTHEST, min(FARTHEST, int(np.floor(x * 256)))) for x in v] for _, v, _ in kept]
    least = {}
    for (i, _, _), v in zip(kept, steps):
        if i is not None:
            least[i] = min(v, least.get(i, v))
    first = [least[i] for i in sorted(least)[:entries]]
    if not first:
        return []
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for v in first] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (distance(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            found = defaultdict(list)
            for v in steps:
                found[nearest(cut(v, p), books[p])].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*found[e])] if e in found else old for e, old in enumerate(books[p])]
    out, sums = [], Counter()
    for (i, _, label), v in zip(kept, steps):
        code = [nearest(cut(v, p), books[p]) for p in range(parts)]
        error = sum(distance(cut(v, p), books[p][e]) for p, e in enumerate(code))
        sums[label] += error
        out.append((i, "".join(f"{e:02x}" for e in code), error, label))
    return [(i, code, error, sums[label]) for i, code, error, label in out]


def vectors(seed, n, dims, span=1.0):
    draw = random.Random(seed)
    rows = [(draw.randrange(n), [round(draw.gauss(0, span), 2) for _ in range(dims)], draw.choice([None, 1, 1, 2])) for _ in range(n)]
    return rows + rows[: n // 4]  # repeated rows, and ids with several vectors


ODD_VECTORS = [
    (None, [0.5] * 8, 1), (3, None, 1), (4, [0.1] * 7 + [None], 2), (5, [float("nan")] * 8, 2), (6, [float("inf")] + [0.0] * 7, None),
    (7, [], 1), (8, [0.25] * 6, 1), (9, [1e30] * 8, 7), (10, [-1e30] + [0.0] * 7, 7), (-5, [0.0] * 8, None), (11, [0.0] * 16, 3),
]
KIND = "vec_id long, embedding array<double>, label int, code string, error int, vector string, l int, hot int, n int"


@pytest.mark.parametrize("parts, entries, rounds", [(4, 5, 2), (2, 64, 3), (8, 1, 1), (1, 9, 0)])
def test_codes_equal_plain_ones(cluster, parts, entries, rounds):
    rows = vectors(parts, 120, 8) + ODD_VECTORS
    df = cluster.createDataFrame([(*r, "x", 1, "y", 2, 3, 4) for r in rows], KIND).repartition(3)
    found = encode_vectors(df, parts, entries, rounds)
    alike(found.select("vec_id", "code", "error", "label_error").collect(), plain_codes(rows, parts, entries, rounds))
    assert found.select("codebooks_sha256").distinct().count() == 1


def test_codes_of_nothing(cluster):
    names = ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    for rows in ([], [(1, None, 1)], [(None, [1.0] * 16, 1)]):
        found = encode_vectors(cluster.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
        assert found.columns == names and found.collect() == []
    with pytest.raises(ValueError):
        encode_vectors(cluster.createDataFrame([(1, [1.0] * 16, 1)], "vec_id long, embedding array<float>, label int"), entries=65)


@settings(max_examples=200, deadline=None)
@drawn(
    st.integers(1, 4).flatmap(
        lambda d: st.tuples(
            st.lists(st.lists(st.integers(-9, 9), min_size=d, max_size=d), min_size=1, max_size=64),
            st.lists(st.lists(st.integers(-12, 12), min_size=d, max_size=d), min_size=1, max_size=20),
        )
    )
)
def test_masks_hold_exactly_the_box_and_the_nearest_is_the_first(both):
    entries, parts = (np.array(x, np.int64) for x in both)
    slices = Slices(entries)
    radius = slices.radius(parts)
    inside = (np.abs(parts[:, None, :] - entries[None]) <= radius[:, None, None]).all(axis=2)
    masks = [sum(1 << e for e in np.flatnonzero(row)) for row in inside]
    assert slices.candidates(parts, radius).tolist() == masks
    distance = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    index, least = slices.nearest(parts)
    assert index.tolist() == distance.argmin(axis=1).tolist() and least.tolist() == distance.min(axis=1).tolist()


def test_a_rare_radius_leaves_few_candidates():
    draw = np.random.default_rng(3)
    entries, parts = draw.integers(-500, 500, (64, 4)), draw.integers(-500, 500, (400, 4))
    slices = Slices(entries)
    masks = slices.candidates(parts, slices.radius(parts))
    assert np.mean([int(m).bit_count() for m in masks]) < 32


# Spelling variants


def plain_spellings(rows, shortest=5, least=3, ratio=2):
    n = Counter()
    for i, text in rows:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[0])
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= shortest:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= least}
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def plain_near(words):
    near = defaultdict(set)
    for w in words:
        for v in words:
            if w < v and abs(len(w) - len(v)) <= 1:
                start = next((k for k, (a, b) in enumerate(zip(w, v)) if a != b), min(len(w), len(v)))
                if w[start + (len(w) >= len(v)) :] == v[start + (len(v) >= len(w)) :]:
                    near[w].add(v)
                    near[v].add(w)
    return near


def test_spellings_of_given(cluster, data, given):
    alike(queries.op13_spellings(cluster, data).collect(), plain_spellings(given))


@pytest.mark.parametrize("shortest, least, ratio", [(5, 3, 2), (1, 1, 2), (2, 1, 3)])
def test_spellings_of_odd(odd, odd_rows, nothing, shortest, least, ratio):
    rows = [r[:2] for r in odd_rows if r[0] != 14]
    found = group_spellings(odd.where("doc_id IS NULL OR doc_id <> 14"), shortest, least, ratio)
    alike(found.collect(), plain_spellings(rows, shortest, least, ratio))
    with pytest.raises(ValueError):
        group_spellings(odd, ratio=1)
    empty = group_spellings(nothing)
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_neighbours_of_close_words(cluster):
    draw = random.Random(5)
    words = {"".join(draw.choices("abÀ", k=draw.randint(1, 7))) for _ in range(400)} | {"aaaaaaa", "aaaaaa", "long" * 60, "long" * 60 + "x"}
    found = neighbours(cluster.createDataFrame([(w, len(w)) for w in words], "word string, n long")).collect()
    near = plain_near(words)
    alike(found, [(w, len(w), v, len(v)) for w in words for v in near[w]])


def test_chains_of_forms_end_at_their_roots(cluster):
    chain = ["abcdef", "abcdeg", "abcdhg", "abcyhg", "xbcyhg", "xbcyhgs", "xzcyhgs"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k))
    found = group_spellings(cluster.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    alike(found, plain_spellings([(1, text)]))
    assert any(row.form and row.root != row.form for row in found)
