"""Operators that look for copies: near duplicates, bytes, lines, benchmark passages."""

import random

import numpy as np
import pytest

import __spark_entry__ as contract
from orefold.llm.decontaminate import allowed_edits, benchmark_leaks, seeds_of
from orefold.llm.graph import components
from orefold.llm.line_runs import repeated_line_runs
from orefold.llm.near_dup import near_duplicates, superminhash
from orefold.llm.repeats import repeated_bytes, sliding_minimum
from orefold.llm.words import PrefixHashes

from . import brute
from .conftest import SMALL, by_id


def in_order(rows):
    """Distinct documents as they come: by id, null last."""
    return sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))


# --- near duplicates --------------------------------------------------------


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(documents, given, odd_rows, size):
    rows = given + odd_rows
    expected = brute.near_components(rows, size)
    got = by_id(near_duplicates(documents(rows), shingle=size), "n_shingles", "component_id", "kept")
    assert got == sorted([(i, *expected[i], i == expected[i][1]) for i, _ in rows], key=repr)


def chains(n, seed):
    """Texts that drift: neighbours are linked, distant ones are not."""
    rng = random.Random(seed)
    words = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    out = []
    for i in range(n):
        for _ in range(rng.choice((1, 2, 3))):
            words[rng.randrange(60)] = f"v{rng.randrange(10**6)}"
        out.append((i, " ".join(words)))
    rng.shuffle(out)
    return [(i, t) for i, (_, t) in enumerate(out)]


def test_no_link_of_a_large_group_is_lost(documents, monkeypatch):
    monkeypatch.setattr("orefold.llm.near_dup._BLOCK", 16)
    rows = chains(250, 1) + [(1000 + i, t) for i, t in chains(60, 2)]
    expected = brute.near_components(rows, 2)
    got = by_id(near_duplicates(documents(rows), shingle=2), "n_shingles", "component_id")
    assert got == sorted([(i, *expected[i]) for i, _ in rows], key=repr)


def test_all_texts_of_an_id_are_linked(documents):
    one, other = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(1, one), (1, other), (2, one + " tail"), (3, other + " tail"), (4, "far " + " ".join(f"c{i}" for i in range(80)))]
    got = by_id(near_duplicates(documents(rows), shingle=2), "component_id", "kept")
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]
    rows = [(2, one), (3, other), (5, one + " x"), (5, other + " y")]
    got = by_id(near_duplicates(documents(rows), shingle=2), "component_id")
    assert got == [(2, 2), (3, 2), (5, 2), (5, 2)]


def test_null_ids_and_empty_tables(documents):
    rows = [(None, "a b c"), (3, "a b c"), (4, None), (5, None)]
    got = by_id(near_duplicates(documents(rows), shingle=2), "n_shingles", "component_id", "kept")
    assert got == sorted([(None, 2, None, True), (3, 2, 3, True), (4, 0, 4, True), (5, 0, 5, True)], key=repr)
    assert near_duplicates(documents([])).count() == 0


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 150, dtype=np.uint64)
        a, b = np.sort(pool[:110]), np.sort(pool[40:])
        truth = 70 / 150
        sets = np.concatenate([a, b])
        signature = superminhash(sets, np.array([0, len(a), len(sets)]), 96)
        errors.append((signature[0] == signature[1]).mean() - truth)
    assert abs(np.mean(errors)) < 0.02
    # Independent hashes would vary by 0.0509.
    assert np.std(errors) < 0.0509


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2000, 2001)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "u long, v long").repartition(6)
    got = dict(components(df).collect())
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1300)} == {1000}
    assert got[2001] == 2000 and len(got) == 201 + 300 + 2
    assert components(df.limit(0)).count() == 0


# --- repeated bytes ---------------------------------------------------------


def expected_bytes(rows, length):
    ordered = in_order([(i, t or "") for i, t in rows])
    flags = brute.repeated_units(lambda r: r[1].encode(), length, ordered)
    out = {}
    for (i, t), gone in zip(ordered, flags):
        kept = bytes(c for c, g in zip(t.encode(), gone) if not g)
        out[i, t] = (len(gone), sum(gone), len(brute.runs(gone)), brute.sha(kept))
    return sorted([(i, *out[i, t or ""]) for i, t in rows], key=repr)


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_bytes(documents, given, odd_rows, hot):
    shared = given[3][1][:160]
    rows = given[:120] + [r for r in odd_rows if r[0] not in (1010, 1011)]
    rows += [(2000 + i, f"{i} {shared[i:]} {i}") for i in range(30)] + [(3000, "ab" * 400), (3001, "ba" * 300), (3002, shared[:99])]
    got = by_id(repeated_bytes(documents(rows), hot=hot), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == expected_bytes(rows, 100)


def test_no_bytes(documents):
    assert repeated_bytes(documents([])).count() == 0
    got = by_id(repeated_bytes(documents([(None, "x" * 150), (4, "x" * 150)])), "n_removed")
    assert got == [(4, 149), (None, 150)]


def test_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 50, 103).astype(np.uint64)
    for width in (1, 2, 7, 103, 150):
        assert sliding_minimum(values, width).tolist() == [values[i : i + width].min() for i in range(103)]


# --- repeated line runs -----------------------------------------------------


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_line_runs(documents, given, odd_rows, length):
    paragraph = " ".join(f"p{i}" for i in range(12))
    rows = given + odd_rows + [(3000 + i, f"own {i}\n{paragraph}\nlast {i}\n{paragraph[:-4]}") for i in range(3)]
    ordered = in_order([(i, t or "") for i, t in rows])
    expected = line_flags(ordered, length, 12)
    assert length == 1 or [f for (i, _), f in zip(ordered, expected) if i == 3001] == [[False, True, False, False]]
    out = {}
    for (i, t), gone in zip(ordered, expected):
        kept = "\n".join(x for x, g in zip(t.split("\n"), gone) if not g)
        found = brute.runs(gone)
        out[i, t] = (len(gone), sum(gone), len(found), max(found, default=0), brute.sha(kept.encode()))
    df = repeated_line_runs(documents(rows), min_lines=length, min_words=12)
    got = by_id(df, "n_lines", "n_removed", "n_runs", "longest_run", "kept_sha256")
    assert got == sorted([(i, *out[i, t or ""]) for i, t in rows], key=repr)


def line_flags(ordered, min_lines, min_words):
    """Per document which lines go: in later copies of runs, and long ones in later copies of themselves."""

    def parts(row):
        return row[1].split("\n")

    runs, lines = (brute.repeated_units(parts, n, ordered) for n in (min_lines, 1))
    return [
        [a or (b and len(brute.WORD.findall(line)) >= min_words) for a, b, line in zip(of_runs, of_lines, parts(row))]
        for of_runs, of_lines, row in zip(runs, lines, ordered)
    ]


@pytest.mark.parametrize("min_lines", [1, 2, 3])
def test_copied_runs_occur_earlier_as_a_whole(documents, min_lines):
    rng = random.Random(min_lines)
    pool = [[rng.choice("abc") for _ in range(rng.randrange(1, 40))] for _ in range(8)]
    runs = [rng.choice(pool) for _ in range(30)]
    rows = [(n, "\n".join(a + [f"own {n}"] * (n % 3 == 0) + b)) for n, (a, b) in enumerate(zip(runs[::2], runs[1::2]))]
    rows += [(50, "\n".join("uvwx")), (51, "\n".join("efgh")), (52, "\n".join("uvwxefgh")), (53, "\n".join(["a"] * 70))]
    lines = [t.split("\n") for _, t in rows]
    places = [(d, i) for d, of in enumerate(lines) for i in range(len(of))]

    def common(p, q):
        n = 0
        for x, y in zip(lines[p[0]][p[1] :], lines[q[0]][q[1] :]):
            if x != y:
                break
            n += 1
        return n

    expected = {i: [] for i, _ in rows}
    ends = {}
    for at, p in enumerate(places):
        n = max((common(p, q) for q in places[:at]), default=0)
        if n >= min_lines and p[1] + n > ends.get(p[0], 0):
            ends[p[0]] = p[1] + n
            expected[rows[p[0]][0]].append((p[1], n))
    got = repeated_line_runs(documents(rows), min_lines=min_lines).select("doc_id", "copied", "n_runs").collect()
    assert {r[0]: [tuple(c) for c in r[1]] for r in got} == expected
    if min_lines > 1:
        assert expected[52] == [(0, 4), (4, 4)] and {r[0]: r[2] for r in got}[52] == 1


def test_no_lines(documents):
    assert repeated_line_runs(documents([])).count() == 0


# --- benchmark passages -----------------------------------------------------


def test_leaks_equal_brute_force(spark, documents, given, odd_rows):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, None), (901, ""), (902, "only four words here"), (903, items[0][1])]
    rng = random.Random(8)
    rows = given + [r for r in odd_rows if r[0] not in (1010, 1011)]
    planted = set()
    for n in range(150):
        item, passage = items[n % 30]
        words = brute.plain(passage)
        for _ in range(allowed_edits(len(words), 80) - n % 2):
            at = rng.randrange(len(words))
            kind = rng.choice("sid")
            words[at : at + (kind != "i")] = [] if kind == "d" else [f"zz{rng.randrange(10**6)}"]
        rows.append((5000 + n, f"{given[n][1]} {' '.join(words)}. {given[n + 1][1][:200]}"))
        planted.add((5000 + n, item))
    df = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    got = {(r[0], r[1]): r[2] for r in benchmark_leaks(documents(rows), df).select("doc_id", "item_id", "distance").collect()}
    expected = {(i, k): d for i, found in brute.leaks(rows, items).items() for k, d in found.items()}
    assert set(got) <= set(expected) and all(got[k] == expected[k] for k in got)
    assert len(planted & set(got)) >= 0.97 * len(planted)
    exact = {k for k, d in expected.items() if d == 0}
    assert exact <= set(got)


@pytest.mark.parametrize("place", ["first", "last", "cut off", "whole"])
def test_leaks_at_the_edges_of_a_document(spark, documents, place):
    rng = random.Random(place)
    items, rows = [], []
    for n in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range((20, 40, 60)[n % 3])]
        items.append((n, " ".join(words)))
        edits = allowed_edits(len(words), 80)
        if place == "cut off":
            words = words[:-edits]
        for _ in range(0 if place == "cut off" else edits):
            at = rng.randrange(len(words))
            kind = "d" if place == "whole" else rng.choice("sid")
            words[at : at + (kind != "i")] = [] if kind == "d" else [f"zz{rng.randrange(10**6)}"]
        other = [f"o{rng.randrange(10**6)}" for _ in range(50)]
        before, after = other * (place in ("last", "cut off")), other * (place == "first")
        rows.append((n, " ".join(before + words + after)))
    df = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in benchmark_leaks(documents(rows), df).select("doc_id", "item_id").collect()}
    assert len(got & {(n, n) for n in range(120)}) >= 0.97 * 120


def test_seeds_leave_no_gap():
    for n in range(5, 200):
        size, places = seeds_of(n, 80)
        assert len(places) == allowed_edits(n, 80) + 1 and size >= 1
        assert all(b - a >= size for a, b in zip(places, [*places[1:], n]))


def test_nothing_leaks_from_or_into_nothing(spark, documents, given):
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_leaks(documents(given[:5]), none).count() == 0
    items = spark.createDataFrame([(1, given[0][1])], "item_id long, text string")
    assert benchmark_leaks(documents([]), items).count() == 0
    assert benchmark_leaks(documents([(None, given[0][1])]), items).count() == 0


@pytest.mark.parametrize("name", ["op2_superminhash", "op5_line_runs", "op8_repeated_bytes", "op9_benchmark_leaks"])
def test_queries_cover_the_table(spark, given, name):
    df = contract.queries()[name](spark, SMALL)
    if name == "op2_superminhash":
        expected = brute.near_components(given, 2)
        assert by_id(df, "component_id") == sorted([(i, expected[i][1]) for i, _ in given], key=repr)
    elif name == "op8_repeated_bytes":
        assert by_id(df, "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected_bytes(given, 100)
    elif name == "op5_line_runs":
        flags = line_flags(in_order([(i, t or "") for i, t in given]), 2, 50)
        assert by_id(df, "n_removed") == sorted([(i, sum(f)) for (i, _), f in zip(in_order(given), flags)], key=repr)
    else:
        items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
        expected = brute.leaks(given, items)
        assert by_id(df, "item_id") == sorted([(i, k) for i, f in expected.items() for k in f], key=repr)


# --- hashes -----------------------------------------------------------------


def thue_morse(a, b, n=2048):
    """A text and its complement that collide in any polynomial modulo 2^64."""
    first = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in first), "".join((b, a)[x] for x in first)


def test_built_collisions_are_told_apart(documents):
    x, y = thue_morse("a", "b")
    filler = " ".join(f"f{i}" for i in range(20))
    rows = [(1, f"{x} {x}"), (2, f"{y} {y}")]
    got = by_id(near_duplicates(documents(rows), shingle=2), "component_id", "kept")
    assert got == [(1, 1, True), (2, 2, True)]
    rows = [(1, f"{x}\n{filler}"), (2, f"{y}\n{filler}")]
    out = {r["doc_id"]: r["n_removed"] for r in repeated_line_runs(documents(rows)).collect()}
    assert out == {1: 0, 2: 0}
    out = {r["doc_id"]: r["n_removed"] for r in repeated_bytes(documents([(1, x[:1024]), (2, y[:1024])]), length=1000).collect()}
    assert out == {1: 0, 2: 0}


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    data[3000:3400] = data[100:500]
    hashes = PrefixHashes(data)
    at = np.arange(300)
    assert (hashes(at + 100, at + 200) == hashes(at + 3000, at + 3100)).all()
    assert (hashes.windows(40)[100:400] == hashes.windows(40)[3000:3300]).all()
    every = hashes(np.arange(2500), np.arange(2500) + 7)
    assert len(np.unique(every)) == 2500
    assert len(hashes.windows(6000)) == 0
