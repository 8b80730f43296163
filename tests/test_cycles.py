import os
import random
from collections import defaultdict
from itertools import permutations

import pytest
from brute import closed_trails, simple_cycles

from ledgerloop.operators import cycles


def pairs_frame(spark, pairs):
    return spark.createDataFrame(sorted(set(pairs)), "src string, dst string")


def found(df):
    rows = [tuple(r["path"]) for r in df.select("path").collect()]
    assert len(rows) == len(set(rows)), "a cycle was reported twice"
    return set(rows)


def complete(n):
    return list(permutations([f"n{i}" for i in range(n)], 2))


def random_pairs(seed, nodes, edges):
    rng = random.Random(seed)
    return [
        (a, b)
        for a, b in (
            (f"a{rng.randrange(nodes)}", f"a{rng.randrange(nodes)}") for _ in range(edges)
        )
        if a != b
    ]


@pytest.mark.parametrize(
    "n, expected", [(4, {2: 6, 3: 8, 4: 6}), (5, {2: 10, 3: 20, 4: 30, 5: 24})]
)
def test_complete_graphs(spark, ws, n, expected):
    counts = {}
    for path in found(cycles.bounded_cycles(pairs_frame(spark, complete(n)), ws)):
        counts[len(path)] = counts.get(len(path), 0) + 1
    assert counts == expected


@pytest.mark.parametrize(
    "pairs",
    [
        [("a", "b"), ("b", "c"), ("a", "c")],
        [("a", "b")],
        [],
    ],
)
def test_graphs_without_cycles(spark, ws, pairs):
    df = spark.createDataFrame(pairs, "src string, dst string")
    assert found(cycles.bounded_cycles(df, ws)) == set()


def test_cycles_that_share_an_account(spark, ws):
    pairs = [("m", "a"), ("a", "m"), ("m", "b"), ("b", "c"), ("c", "m")]
    assert found(cycles.bounded_cycles(pairs_frame(spark, pairs), ws)) == {
        ("a", "m"),
        ("b", "c", "m"),
    }


def test_both_directions_of_a_triangle_are_different(spark, ws):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("b", "a"), ("c", "b"), ("a", "c")]
    triangles = found(cycles.bounded_cycles(pairs_frame(spark, pairs), ws, 3, 3))
    assert triangles == {("a", "b", "c"), ("a", "c", "b")}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs_against_depth_first_search(spark, ws, seed):
    pairs = random_pairs(seed, 14, 45)
    expected = simple_cycles(pairs, 2, 6)
    df = pairs_frame(spark, pairs)
    assert found(cycles.bounded_cycles(df, ws)) == expected
    assert found(cycles.bounded_cycles(df, ws, trim=False)) == expected


@pytest.mark.parametrize("low, high", [(2, 2), (3, 3), (6, 6), (3, 7), (4, 5)])
def test_length_bounds(spark, ws, low, high):
    pairs = random_pairs(7, 12, 40)
    df = pairs_frame(spark, pairs)
    assert found(cycles.bounded_cycles(df, ws, low, high)) == simple_cycles(pairs, low, high)


def test_hub_with_a_third_of_all_edges(spark, ws):
    pairs = random_pairs(3, 60, 120)
    pairs += [("hub", f"a{i}") for i in range(0, 60, 2)] + [(f"a{i}", "hub") for i in range(1, 60, 2)]
    df = pairs_frame(spark, pairs)
    assert found(cycles.bounded_cycles(df, ws, 2, 5)) == simple_cycles(pairs, 2, 5)


def test_renaming_accounts_keeps_the_counts(spark, ws):
    pairs = random_pairs(5, 12, 40)
    renamed = [(b[::-1] + "z", a[::-1] + "z") for a, b in pairs]  # renamed and reversed
    one = found(cycles.bounded_cycles(pairs_frame(spark, pairs), ws))
    two = found(cycles.bounded_cycles(pairs_frame(spark, renamed), ws))
    assert sorted(map(len, one)) == sorted(map(len, two))


def test_parallel_transfers_do_not_multiply_cycles(spark, ws, make_transfers):
    rows = [("a", "b", 10, 5), ("a", "b", 20, 1), ("b", "a", 30, 9), ("a", "a", 1, 0)]
    edges = make_transfers(rows).where("source_account <> target_account")
    (row,) = cycles.detect_cycles(edges, ws).collect()
    assert row["path"] == ["a", "b"]
    assert (float(row["total"]), float(row["low"]), float(row["high"])) == (50.0, 20.0, 30.0)


def test_invalid_lengths(spark, ws):
    with pytest.raises(ValueError, match="cycle lengths"):
        cycles.bounded_cycles(pairs_frame(spark, complete(3)), ws, 1, 3)


def test_frontier_guard_fails_instead_of_truncating(spark, ws):
    with pytest.raises(RuntimeError, match="half paths"):
        cycles.bounded_cycles(pairs_frame(spark, complete(6)), ws, max_frontier_rows=3)


@pytest.mark.parametrize("seed, high", [(1, 4), (2, 5), (3, 6)])
def test_closed_trails_against_brute_force(spark, ws, make_transfers, seed, high):
    rng = random.Random(seed)
    rows = [(f"a{rng.randrange(5)}", f"a{rng.randrange(5)}") for _ in range(16)]
    rows = [r for r in rows if r[0] != r[1]]
    edges = [(f"t{i:04d}", s, d) for i, (s, d) in enumerate(rows)]
    df = cycles.closed_trails(make_transfers(rows), ws, 2, high)
    got = [(tuple(r["transaction_ids"]), tuple(r["path"])) for r in df.collect()]
    assert len(got) == len(set(got))
    assert set(got) == closed_trails(edges, 2, high)


def test_trails_of_several_loops_at_a_hub(spark, ws, make_transfers):
    """Three partners in both directions, twice each: up to three loops at the hub, in any order."""
    rows = [("hub", f"p{i % 3}") for i in range(4)] + [(f"p{i % 3}", "hub") for i in range(4)]
    rows.append(("p0", "p1"))
    edges = [(f"t{i:04d}", s, d) for i, (s, d) in enumerate(rows)]
    df = cycles.closed_trails(make_transfers(rows), ws, 3, 6)
    got = [(tuple(r["transaction_ids"]), tuple(r["path"])) for r in df.collect()]
    assert len(got) == len(set(got))
    assert set(got) == closed_trails(edges, 3, 6)


def test_half_trails_are_bounded_at_a_hub_of_two_way_partners(spark, ws, make_transfers):
    """Partners in both directions give loops of two hops; half paths never pass the hub."""
    partners = 300
    rows = [("hub", f"p{i}") for i in range(partners)] + [(f"p{i}", "hub") for i in range(partners)]
    plain = make_transfers(rows).selectExpr("transaction_id id", "source_account src", "target_account dst")
    loops = cycles._loops(cycles.ranked_core(plain, ws), ws, 6)
    assert loops.count() == partners
    written = spark.read.parquet(f"{ws.folder}/*trail-out-2")
    assert written.count() == 0


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("low, high", [(2, 6), (5, 5), (6, 6), (2, 4), (7, 8)])
def test_counted_cycles_are_those_listed(spark, ws, seed, low, high):
    pairs = random_pairs(seed, 11, 45) + [("hub", f"a{i}") for i in range(11)] + [(f"a{i}", "hub") for i in range(9)]
    listed = simple_cycles(pairs, low, high)
    counted = cycles.count_cycles(pairs_frame(spark, pairs), ws, low, high).collect()
    assert {r["n_accounts"]: int(r["cycles"]) for r in counted} == {
        k: sum(len(c) == k for c in listed) for k in range(low, high + 1)
    }


def test_counts_of_complete_and_empty_graphs(spark, ws):
    counted = cycles.count_cycles(pairs_frame(spark, complete(6)), ws, 2, 6).collect()
    assert [int(r["cycles"]) for r in counted] == [15, 40, 90, 144, 120]
    nothing = cycles.count_cycles(spark.createDataFrame([], "src string, dst string"), ws, 2, 3)
    assert [int(r["cycles"]) for r in nothing.collect()] == [0, 0]


def test_counting_lists_no_cycle(spark, ws):
    """No join of half paths: the last joins are between counts."""
    plan = cycles.count_cycles(pairs_frame(spark, complete(5)), ws, 6, 6)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "nodes" not in text and text.count("Join") == 1


@pytest.mark.parametrize("hash_bits", [40, 2])
def test_narrowed_edges_are_those_on_closed_walks(spark, ws, monkeypatch, hash_bits):
    """A large part without a closed walk stays out of the search; accounts that share a hash
    change no result."""
    monkeypatch.setattr(cycles, "NARROW_ROWS", 1)
    monkeypatch.setattr(cycles, "HASH_BITS", hash_bits)
    ring = [(f"r{i}", f"r{(i + 1) % 6}") for i in range(6)]
    long_ring = [(f"q{i}", f"q{(i + 1) % 40}") for i in range(40)]
    bushes = [(f"r{i}", f"q{7 * i}") for i in range(5)] + [("m", "r0"), ("r0", "m"), ("r3", "r0")]
    pairs = ring + long_ring + bushes
    kept = cycles._narrowed(pairs_frame(spark, pairs), "src", "dst", ws, 6, repeated=False)
    on_walks = set(ring) | {("m", "r0"), ("r0", "m"), ("r3", "r0")}
    rows = {(r["src"], r["dst"]) for r in kept.collect()}
    assert rows == on_walks if hash_bits == 40 else rows >= on_walks
    assert found(cycles.bounded_cycles(pairs_frame(spark, pairs), ws)) == simple_cycles(pairs, 2, 6)


def test_narrowed_searches_against_brute_force(spark, ws, make_transfers, monkeypatch):
    monkeypatch.setattr(cycles, "NARROW_ROWS", 1)
    for seed, hash_bits in ((1, 40), (2, 3)):
        monkeypatch.setattr(cycles, "HASH_BITS", hash_bits)
        pairs = random_pairs(seed, 14, 34)
        for high in (5, 6, 7):
            listed = cycles.bounded_cycles(pairs_frame(spark, pairs), ws, 2, high)
            assert found(listed) == simple_cycles(pairs, 2, high)
        rows = random_pairs(seed, 6, 14)
        edges = [(f"t{i:04d}", s, d) for i, (s, d) in enumerate(rows)]
        trails = cycles.closed_trails(make_transfers(rows), ws, 2, 6).collect()
        got = [(tuple(r["transaction_ids"]), tuple(r["path"])) for r in trails]
        assert len(got) == len(set(got)) and set(got) == closed_trails(edges, 2, 6)


def test_counts_hold_sets_as_numbers(spark, ws):
    """No array is grouped by: sets of accounts in between are columns of numbers."""
    cycles.count_cycles(pairs_frame(spark, complete(5)), ws, 5, 6)
    kinds = dict(spark.read.parquet(f"{ws.folder}/*forward-counts-3").dtypes)
    assert set(kinds.values()) <= {"bigint", "int"} and "shared_1" in kinds


@pytest.fixture
def written(monkeypatch):
    """By name what all workspaces wrote: columns and rows."""
    tables = defaultdict(list)
    plain = cycles.Workspace.materialize

    def materialize(own, df, name):
        table = plain(own, df, name)
        tables[name].append((table.dtypes, [tuple(r) for r in table.collect()]))
        return table

    monkeypatch.setattr(cycles.Workspace, "materialize", materialize)
    return tables


def test_short_searches_leave_out_one_way_accounts(ws, make_transfers, written):
    """The first transfers are found, and written, for those accounts alone that may lie on a cycle."""
    ring = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "a")]
    rows = ring + [(f"x{k}", "a") for k in range(30)] + [("c", f"y{k}") for k in range(5)]
    assert found(cycles.detect_cycles(make_transfers(rows), ws, 2, 4)) == simple_cycles(rows, 2, 4)
    ((_, pairs),) = written["pairs"]
    assert {pair[:2] for pair in pairs} == set(ring)


def test_short_searches_keep_all_where_few_are_one_way(ws, make_transfers, written):
    rows = [*complete(4), ("x", "n0"), ("n1", "y")]
    assert found(cycles.detect_cycles(make_transfers(rows), ws, 2, 4)) == simple_cycles(rows, 2, 4)
    ((_, pairs),) = written["pairs"]
    assert len(pairs) == len(rows)


def test_short_search_of_nothing(ws, make_transfers):
    assert found(cycles.detect_cycles(make_transfers([]), ws, 2, 4)) == set()


def test_transfers_are_narrowed_once(ws, make_transfers, monkeypatch, written):
    """A second time would read and aggregate all transfers again."""
    monkeypatch.setattr(cycles, "NARROW_ROWS", 1)
    rows = random_pairs(3, 12, 30)
    assert found(cycles.detect_cycles(make_transfers(rows), ws)) == simple_cycles(rows, 2, 6)
    # A pair is one number, and what is looked up in the transfers half of one.
    assert [kinds for kinds, _ in written["hashed-pairs"]] == [[("pair", "bigint")]]
    assert [kinds for kinds, _ in written["closing-pairs"]] == [[("closing", "int")]]
    # What only the narrowing reads is gone.
    left = [name for _, _, names in os.walk(ws.folder.removeprefix("file:")) for name in names]
    kept = sum(len(os.listdir(f"{ws.folder}/{d}")) for d in os.listdir(ws.folder) if "-" in d)
    assert left and len(left) == kept


def test_a_round_that_removes_little_is_not_begun(spark, ws, written):
    """One account loses its only edge in each round of a chain before a large ring."""
    ring = [(f"r{i:03d}", f"r{(i + 1) % 100:03d}") for i in range(100)]
    chain = [(f"c{i}", f"c{i + 1}") for i in range(4)] + [("c4", "r000")]
    bush = [("r001", f"b{i}") for i in range(40)]
    arcs = cycles.ranked_core(pairs_frame(spark, ring + chain + bush), ws)
    assert arcs.count() == len(ring) + len(chain) - 1
    assert len(written["arcs"]) == 1
