"""Closed cycles and closed trails of bounded length, as joins of half paths.

Accounts are ordered by degree (largest first, ties by id).  Every cycle is found once, from
its first account in that order, the root: a half path may only visit accounts that come
after its root.  A hub is therefore a root or absent, and the product of a hub's incoming and
outgoing edges is never formed.

A cycle of k accounts is one forward half path of ceil(k/2) hops and one backward half path of
floor(k/2) hops with the same root and the same end.  Cycles of six accounts thus need three
hops from each side instead of a six-hop frontier, and the closing join has a two-column key.

In a sparse graph nearly all halves of three hops close nothing.  Before such a search the roots
that some closed walk meets are found on account numbers alone (`_closing_pairs`), and only edges
around them enter the search, which then carries names, measures and transfers.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloop.functions import paths
from ledgerloop.operators.graph import first_transfers
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import TOTAL

MIN_LENGTH = 2
MAX_LENGTH = 6

TRIM_ROUNDS = 8
# Another round is not worth two shuffles when the last one removed less than this share.
TRIM_GAIN = 0.1

# Edges are narrowed before a search for cycles of this length, from this many different pairs on.
NARROW_LENGTH = 5
NARROW_ROWS = 200_000
# Before a shorter search edges of other accounts are left out where they are at least this share.
ONE_WAY_SHARE = 0.5
# Bits of an account's number that are a hash; those above hold its degree, up to a most.
HASH_BITS = 40
MOST_DEGREE = (1 << 23) - 1
# Bits of either account's hash in the number of a pair, no more than HASH_BITS.
PAIR_BITS = 32
# Bits of the root and of the end in the key that halves are compared by.
ROOT_BITS, END_BITS = 31, 32
# No account's number.
NO_NUMBER = -1


def _account_nodes(edges: DataFrame, src: Column, dst: Column) -> DataFrame:
    """How often each account is left and reached."""
    ends = F.array(
        F.struct(src.alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(dst.alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")),
    )
    return (
        edges.select(F.inline(ends))
        .groupBy("node")
        .agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    )


def _both_ways() -> Column:
    return (F.col("out") > 0) & (F.col("into") > 0)


def _one_way_edges() -> list[Column]:
    """How many edges start where none ends, and how many end where none starts."""
    return [
        F.sum(F.when(F.col("into") == 0, F.col("out"))).alias("start"),
        F.sum(F.when(F.col("out") == 0, F.col("into"))).alias("end"),
    ]


def _degrees(
    edges: DataFrame, src: Column, dst: Column, ws: Workspace, trim: bool
) -> tuple[DataFrame, int]:
    """The degrees of the accounts, with `trim` of those that are both reached and left, and at most
    how many edges touch another account.

    The account table is written before it is joined.  The join then has a plain exchange on
    either side, which is the shape in which adaptive execution splits the edges of a hub.
    """
    seen = Observation()
    nodes = _account_nodes(edges, src, dst).observe(seen, *_one_way_edges())
    if trim:
        nodes = nodes.where(_both_ways())
    degrees = ws.materialize(
        nodes.select("node", (F.col("out") + F.col("into")).alias("degree")), "degrees"
    )
    return degrees, sum(seen.get[name] or 0 for name in ("start", "end"))


def _with_degrees(edges: DataFrame, ws: Workspace, trim: bool) -> DataFrame:
    """Attach the degree of both ends; with `trim`, only edges between accounts that are both
    reached and left, as no other edge can lie on a cycle."""
    ends = F.col("src"), F.col("dst")
    return _joined_degrees(edges, *ends, _degrees(edges, *ends, ws, trim)[0])


def _joined_degrees(edges: DataFrame, src: Column, dst: Column, degrees: DataFrame) -> DataFrame:
    edges = edges.drop("src_degree", "dst_degree")
    for end, node in (("src", src), ("dst", dst)):
        own = degrees.select(F.col("node").alias("_node"), F.col("degree").alias(f"{end}_degree"))
        edges = edges.join(own, node == F.col("_node")).drop("_node")
    return edges


def ranked_core(
    edges: DataFrame, ws: Workspace, trim: bool = True, rounds: int = TRIM_ROUNDS
) -> DataFrame:
    """Edges that may lie on a cycle, with the degrees that order their accounts.

    Trimming is repeated while it pays.  Stopping early is still correct, the remaining edges
    just close no cycle, and any fixed degrees give a valid order.
    """
    current, rows = ws.materialize_counted(edges, "pairs")
    return _trimmed(current, rows, ws, trim, rounds)


def _trimmed(
    current: DataFrame,
    rows: int,
    ws: Workspace,
    trim: bool = True,
    rounds: int = TRIM_ROUNDS,
    ends: tuple[Column, Column] | None = None,
) -> DataFrame:
    """`ends` are the accounts of an edge, if they are not src and dst.  Another round is not begun
    when the accounts show that it would remove too little."""
    src, dst = ends or (F.col("src"), F.col("dst"))
    for turn in range(rounds if trim else 1):
        degrees, most = _degrees(current, src, dst, ws, trim)
        if turn and most <= rows * TRIM_GAIN:
            break
        current, remaining = ws.materialize_counted(
            _joined_degrees(current, src, dst, degrees), "arcs"
        )
        if remaining >= rows * (1 - TRIM_GAIN):
            break
        rows = remaining
    return current


def _after(degree: Column, node: Column, root_degree: Column, root: Column) -> Column:
    """`node` comes after `root` in the account order."""
    return (degree < root_degree) | ((degree == root_degree) & (node > root))


def _low(number: Column, bits: int) -> Column:
    return number.bitwiseAND(F.lit((1 << bits) - 1))


def _pair(source: Column, target: Column) -> Column:
    """Both hashed accounts of an edge in one number."""
    near, far = (
        _low(F.xxhash64(account), min(HASH_BITS, PAIR_BITS)) for account in (source, target)
    )
    return F.shiftleft(near, PAIR_BITS).bitwiseOR(far)


def _pair_ends() -> tuple[Column, Column]:
    pair = F.col("pair")
    return F.shiftrightunsigned(pair, PAIR_BITS), _low(pair, PAIR_BITS)


def _pair_mark(pair: Column) -> Column:
    """A hash of the pair that is half as wide: a table of it is small enough to be broadcast for
    longer.  Pairs that share one can only keep more edges."""
    return _low(F.xxhash64(pair), ROOT_BITS).cast("int")


def _number(degree: Column, node: Column) -> Column:
    """One number per hashed account; larger ones come first in the account order."""
    top = F.least(degree, F.lit(MOST_DEGREE)).cast("long")
    return F.shiftleft(top, HASH_BITS).bitwiseOR(node)


def _hash(number: Column) -> Column:
    return _low(number, HASH_BITS)


def _mark(root: Column) -> Column:
    return _low(root, ROOT_BITS).cast("int")


def _closing_pairs(pairs: DataFrame, rows: int, ws: Workspace, max_length: int) -> DataFrame:
    """Of pairs (see _pair), a part that holds every closed walk of up to max_length hops.

    A closed walk falls into loops at its first account in the order of `_number`, the root, each
    one a forward and a backward half over accounts after the root.  Halves are walks: nothing but
    root and end is kept of them, and both as one number when they are compared.  Accounts that
    share a hash act as one, which can only add walks; a pair inside such an account is a loop.
    From the few roots whose halves met, halves are grown again with their accounts, and the pairs on
    those that meet are kept.
    """
    src, dst = _pair_ends()
    arcs = _trimmed(pairs, rows, ws, ends=(src, dst)).select(
        _number(F.col("src_degree"), src).alias("s"), _number(F.col("dst_degree"), dst).alias("d")
    )
    directions = [("s", "d", (max_length + 1) // 2), ("d", "s", max_length // 2)]

    def start(near: str, far: str) -> DataFrame:
        return arcs.where(F.col(far) < F.col(near)).select(
            F.col(near).alias("root"), F.col(far).alias("meet")
        )

    def step(walks: DataFrame, near: str, far: str, *nodes: Column) -> DataFrame:
        p, a = walks.alias("p"), arcs.alias("a")
        return p.join(
            a,
            (F.col("p.meet") == F.col(f"a.{near}")) & (F.col(f"a.{far}") < F.col("p.root")),
        ).select(
            "p.root", F.col(f"a.{far}").alias("meet"), *[column.alias("nodes") for column in nodes]
        )

    def keys(near: str, far: str, hops: int) -> DataFrame:
        levels = [start(near, far)]
        for _ in range(1, hops):
            levels.append(step(levels[-1], near, far))
        mark = _mark(F.col("root")).cast("long")
        return _union(levels).select(
            F.shiftleft(mark, END_BITS).bitwiseOR(_low(F.col("meet"), END_BITS)).alias("key")
        )

    ahead, back = (keys(*direction) for direction in directions)
    met = ahead.join(back, "key", "left_semi").select(
        F.shiftright("key", END_BITS).cast("int").alias("mark")
    )
    marks = ws.materialize(met.distinct(), "roots")

    halves = []
    for near, far, hops in directions:
        first = start(near, far).join(marks, _mark(F.col("root")) == F.col("mark"), "left_semi")
        levels = [
            ws.materialize(first.withColumn("nodes", F.array("root", "meet")), "root-walks")
        ]
        for _ in range(1, hops):
            longer = step(levels[-1], near, far, F.array_append("p.nodes", F.col(f"a.{far}")))
            levels.append(ws.materialize(longer, "root-walks"))
        halves.append(_union(levels))

    used = [arcs.where("s = d")]
    for (near, far, _), own, other in zip(directions, halves, reversed(halves)):
        on_loops = own.join(other, ["root", "meet"], "left_semi")
        place = F.explode(F.sequence(F.lit(1), F.size("nodes") - 1)).alias("place")
        used.append(
            on_loops.select("nodes", place).select(
                F.expr("nodes[place - 1]").alias(near), F.expr("nodes[place]").alias(far)
            )
        )
    pair = F.shiftleft(_hash(F.col("s")), PAIR_BITS).bitwiseOR(_hash(F.col("d")))
    return _union(used).select(pair.alias("pair")).distinct()


def _between_two_way_accounts(
    edges: DataFrame, source: str, target: str, ws: Workspace
) -> DataFrame:
    """The edges between accounts that are both reached and left, or all where these are many."""
    hashed = [F.xxhash64(source), F.xxhash64(target)]
    seen = Observation()
    nodes = _account_nodes(edges, *hashed).observe(
        seen, F.sum("out").alias("rows"), *_one_way_edges()
    )
    both = ws.materialize(nodes.where(_both_ways()).select("node"), "two-way-accounts")
    rows, *lost = (seen.get[name] or 0 for name in ("rows", "start", "end"))
    if max(lost) < rows * ONE_WAY_SHARE:
        return edges
    for end in hashed:
        edges = edges.join(both, end == F.col("node"), "left_semi")
    return edges


def _narrowed(
    edges: DataFrame, source: str, target: str, ws: Workspace, max_length: int, repeated: bool
) -> DataFrame:
    """The edges without many that no closed walk of up to max_length hops can use.  Nothing is
    done where the search is small.  `repeated` tells that pairs may occur often.  Tables of pairs
    and walks are deleted as soon as the closing pairs are written."""
    if max_length < NARROW_LENGTH:
        return _between_two_way_accounts(edges, source, target, ws) if repeated else edges
    pair = _pair(F.col(source), F.col(target))
    pairs = edges.select(pair.alias("pair"))
    with Workspace(ws.spark, ws.folder) as own:
        pairs, rows = own.materialize_counted(
            pairs.distinct() if repeated else pairs, "hashed-pairs"
        )
        if rows < NARROW_ROWS:
            return edges
        closing = _closing_pairs(pairs, rows, own, max_length)
        marks = ws.materialize(
            closing.select(_pair_mark(F.col("pair")).alias("closing")).distinct(), "closing-pairs"
        )
    return edges.join(marks, _pair_mark(pair) == F.col("closing"), "left_semi")


class _Measures:
    """What is carried along a half path besides its accounts.

    With transfer attributes on the edges the totals needed for scoring are summed while
    paths grow, so that scored cycles need no further join with the transfers.
    """

    NAMES = ("total", "low", "high", "first_time", "last_time")

    def __init__(self, active: bool):
        self.active = active

    def start(self, arc: str = "") -> list[Column]:
        if not self.active:
            return []
        amount, time = F.col(f"{arc}amount"), F.col(f"{arc}timestamp")
        return [
            amount.cast(TOTAL).alias("total"),
            amount.alias("low"),
            amount.alias("high"),
            time.alias("first_time"),
            time.alias("last_time"),
        ]

    def grow(self, path: str, arc: str) -> list[Column]:
        if not self.active:
            return []
        amount, time = F.col(f"{arc}.amount"), F.col(f"{arc}.timestamp")
        return [
            (F.col(f"{path}.total") + amount).cast(TOTAL).alias("total"),
            F.least(f"{path}.low", amount).alias("low"),
            F.greatest(f"{path}.high", amount).alias("high"),
            F.least(f"{path}.first_time", time).alias("first_time"),
            F.greatest(f"{path}.last_time", time).alias("last_time"),
        ]

    def merge(self, one: str, two: str) -> list[Column]:
        if not self.active:
            return []
        return [
            (F.col(f"{one}.total") + F.col(f"{two}.total")).cast(TOTAL).alias("total"),
            F.least(f"{one}.low", f"{two}.low").alias("low"),
            F.greatest(f"{one}.high", f"{two}.high").alias("high"),
            F.least(f"{one}.first_time", f"{two}.first_time").alias("first_time"),
            F.greatest(f"{one}.last_time", f"{two}.last_time").alias("last_time"),
        ]


def _forward_start(arcs: DataFrame, measures: _Measures) -> DataFrame:
    return arcs.where(
        _after(F.col("dst_degree"), F.col("dst"), F.col("src_degree"), F.col("src"))
    ).select(
        F.col("src").alias("root"),
        F.col("src_degree").alias("root_degree"),
        F.col("dst").alias("meet"),
        F.array("src", "dst").alias("nodes"),
        F.lit(1).alias("hops"),
        *measures.start(),
    )


def _forward_step(paths_: DataFrame, arcs: DataFrame, measures: _Measures) -> DataFrame:
    """One more hop: root -> ... -> meet -> dst.  `nodes` runs from the root to the end."""
    p, a = paths_.alias("p"), arcs.alias("a")
    return p.join(
        a,
        (F.col("p.meet") == F.col("a.src"))
        & _after(F.col("a.dst_degree"), F.col("a.dst"), F.col("p.root_degree"), F.col("p.root"))
        & ~F.array_contains("p.nodes", F.col("a.dst")),
    ).select(
        "p.root",
        "p.root_degree",
        F.col("a.dst").alias("meet"),
        F.array_append("p.nodes", F.col("a.dst")).alias("nodes"),
        (F.col("p.hops") + 1).alias("hops"),
        *measures.grow("p", "a"),
    )


def _no_node(arcs: DataFrame) -> Column:
    """An empty array of accounts."""
    return F.array().cast(T.ArrayType(arcs.schema["src"].dataType))


def _backward_start(arcs: DataFrame, measures: _Measures) -> DataFrame:
    return arcs.where(
        _after(F.col("src_degree"), F.col("src"), F.col("dst_degree"), F.col("dst"))
    ).select(
        F.col("dst").alias("root"),
        F.col("dst_degree").alias("root_degree"),
        F.col("src").alias("meet"),
        _no_node(arcs).alias("nodes"),
        F.lit(1).alias("hops"),
        *measures.start(),
    )


def _backward_step(paths_: DataFrame, arcs: DataFrame, measures: _Measures) -> DataFrame:
    """One more hop in front: src -> meet -> ... -> root.  `nodes` lies strictly between the ends."""
    p, a = paths_.alias("p"), arcs.alias("a")
    return p.join(
        a,
        (F.col("p.meet") == F.col("a.dst"))
        & _after(F.col("a.src_degree"), F.col("a.src"), F.col("p.root_degree"), F.col("p.root"))
        & ~F.array_contains("p.nodes", F.col("a.src")),
    ).select(
        "p.root",
        "p.root_degree",
        F.col("a.src").alias("meet"),
        F.array_prepend("p.nodes", F.col("p.meet")).alias("nodes"),
        (F.col("p.hops") + 1).alias("hops"),
        *measures.grow("p", "a"),
    )


def _grow(start: DataFrame, step, hops: int, ws: Workspace, name: str, limit: int | None):
    """Half paths of 1..hops hops.  A level is written when the next one is built on it."""
    levels = [start]
    for level in range(2, hops + 1):
        longer = step(levels[-1])
        if level < hops or limit is not None:
            longer, rows = ws.materialize_counted(longer, f"{name}-{level}")
            if limit is not None and rows > limit:
                raise RuntimeError(
                    f"more than {limit} {name} half paths of {level} hops; "
                    "narrow the edges or lower the maximum length"
                )
        levels.append(longer)
    return levels


def _union(levels: list[DataFrame]) -> DataFrame:
    result = levels[0]
    for level in levels[1:]:
        result = result.unionByName(level)
    return result


def _halves(min_length: int, max_length: int) -> tuple[set[int], set[int]]:
    lengths = range(min_length, max_length + 1)
    return {(k + 1) // 2 for k in lengths}, {k // 2 for k in lengths}


def _wanted(min_length: int, max_length: int) -> Column:
    total = F.col("f.hops") + F.col("b.hops")
    return (
        total.between(min_length, max_length)
        & (F.col("f.hops") - F.col("b.hops")).between(0, 1)
    )


def bounded_cycles(
    pairs: DataFrame,
    ws: Workspace,
    min_length: int = MIN_LENGTH,
    max_length: int = MAX_LENGTH,
    trim: bool = True,
    max_frontier_rows: int | None = None,
) -> DataFrame:
    """All elementary directed cycles of min_length..max_length accounts.

    `pairs` holds distinct (src, dst), src <> dst, optionally with `amount` and `timestamp`
    of the pair's representative transfer.  Result: path (open, smallest account first),
    n_accounts and, with transfer attributes, total, low, high, first_time, last_time.
    `max_frontier_rows` makes the run fail, never truncate, when a level outgrows it.
    """
    if not 2 <= min_length <= max_length:
        raise ValueError("cycle lengths must satisfy 2 <= min_length <= max_length")
    if trim and max_frontier_rows is None:
        pairs = _narrowed(pairs, "src", "dst", ws, max_length, repeated=False)
    return _search(pairs, ws, min_length, max_length, trim, max_frontier_rows)


def _search(
    pairs: DataFrame,
    ws: Workspace,
    min_length: int,
    max_length: int,
    trim: bool = True,
    max_frontier_rows: int | None = None,
) -> DataFrame:
    measures = _Measures({"amount", "timestamp"} <= set(pairs.columns))
    arcs = ranked_core(pairs, ws, trim)

    forward_hops, backward_hops = _halves(min_length, max_length)
    forward = _grow(
        _forward_start(arcs, measures),
        lambda p: _forward_step(p, arcs, measures),
        max(forward_hops),
        ws,
        "forward",
        max_frontier_rows,
    )
    backward = _grow(
        _backward_start(arcs, measures),
        lambda p: _backward_step(p, arcs, measures),
        max(backward_hops),
        ws,
        "backward",
        max_frontier_rows,
    )
    f = _union([forward[h - 1] for h in sorted(forward_hops)]).alias("f")
    b = _union([backward[h - 1] for h in sorted(backward_hops)]).alias("b")
    joined = f.join(
        b,
        (F.col("f.root") == F.col("b.root"))
        & (F.col("f.meet") == F.col("b.meet"))
        & _wanted(min_length, max_length)
        & ~F.arrays_overlap("f.nodes", "b.nodes"),
    )
    # Joined to one array first: the rotation mentions it several times.
    return joined.select(
        F.concat("f.nodes", "b.nodes").alias("path"),
        (F.col("f.hops") + F.col("b.hops")).alias("n_accounts"),
        *measures.merge("f", "b"),
    ).withColumn("path", paths.canonical_rotation(F.col("path")))


def transfer_pairs(edges: DataFrame) -> DataFrame:
    """Input of bounded_cycles from transfers: distinct pairs with their earliest transfer."""
    return first_transfers(edges).select("src", "dst", "amount", "timestamp")


def account_pairs(edges: DataFrame) -> DataFrame:
    """Input of bounded_cycles without transfer attributes."""
    return edges.select(
        F.col("source_account").alias("src"), F.col("target_account").alias("dst")
    ).distinct()


def detect_cycles(
    edges: DataFrame,
    ws: Workspace,
    min_length: int = MIN_LENGTH,
    max_length: int = MAX_LENGTH,
    max_frontier_rows: int | None = None,
) -> DataFrame:
    """Cycles of a transfer table, with the measures that scoring needs."""
    if not 2 <= min_length <= max_length:
        raise ValueError("cycle lengths must satisfy 2 <= min_length <= max_length")
    if max_frontier_rows is None:
        # Narrowed before the first transfers are found; their pairs need it no more.
        edges = _narrowed(edges, "source_account", "target_account", ws, max_length, repeated=True)
    return _search(
        transfer_pairs(edges), ws, min_length, max_length, max_frontier_rows=max_frontier_rows
    )


def _numbered(pairs: DataFrame, ws: Workspace) -> DataFrame:
    """The pairs with a number for each account, where names are not asked for again."""
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    numbers = ws.materialize(
        ends.select("name", F.monotonically_increasing_id().alias("number")), "numbers"
    )
    src, dst = (
        numbers.select(F.col("name").alias(end), F.col("number").alias(f"{end}_number"))
        for end in ("src", "dst")
    )
    return (
        pairs.select("src", "dst")
        .join(src, "src")
        .join(dst, "dst")
        .select(F.col("src_number").alias("src"), F.col("dst_number").alias("dst"))
    )


def count_cycles(
    pairs: DataFrame, ws: Workspace, min_length: int = MIN_LENGTH, max_length: int = MAX_LENGTH
) -> DataFrame:
    """n_accounts and cycles: exactly how many cycles bounded_cycles would list, without listing one.

    Half paths are counted by root and meeting account.  Products of these counts also hold pairs of
    halves that share an account in between.  Half paths are therefore counted for every set of their
    accounts in between as well, and the products for a set of m accounts are added with sign
    (-1)^m, which leaves the pairs that share none.
    """
    if not 2 <= min_length <= max_length:
        raise ValueError("cycle lengths must satisfy 2 <= min_length <= max_length")
    none = _Measures(False)
    arcs = ranked_core(_numbered(pairs, ws), ws)
    forward_hops, backward_hops = _halves(min_length, max_length)

    # A set of accounts in between is this many numbers, in order and filled up with NO_NUMBER.
    width = max(forward_hops | backward_hops) - 1
    shared = [f"shared_{k}" for k in range(width)]

    def counted(levels: list[DataFrame], hops: int, name: str) -> DataFrame:
        # Forward paths hold both ends, backward ones only what lies between.
        between = F.slice("nodes", 2, hops - 1) if name == "forward" else F.col("nodes")
        own = [f"between_{k}" for k in range(hops - 1)]
        sets = [
            F.struct(
                *[
                    (F.col(chosen[k]) if k < len(chosen) else F.lit(NO_NUMBER)).alias(column)
                    for k, column in enumerate(shared)
                ],
                F.lit(len(chosen)).alias("accounts"),
            )
            for size in range(hops)
            for chosen in combinations(own, size)
        ]
        counts = (
            levels[hops - 1]
            .select("root", "meet", F.array_sort(between).alias("between"))
            .select("root", "meet", *[F.get("between", k).alias(c) for k, c in enumerate(own)])
            .select("root", "meet", F.inline(F.array(*sets)))
            .groupBy("root", "meet", *shared, "accounts")
            .agg(F.count(F.lit(1)).alias("paths"))
        )
        return ws.materialize(counts, f"{name}-counts-{hops}")

    forward = _grow(
        _forward_start(arcs, none),
        lambda p: _forward_step(p, arcs, none),
        max(forward_hops),
        ws,
        "forward",
        None,
    )
    backward = _grow(
        _backward_start(arcs, none),
        lambda p: _backward_step(p, arcs, none),
        max(backward_hops),
        ws,
        "backward",
        None,
    )
    ahead = {h: counted(forward, h, "forward") for h in sorted(forward_hops)}
    back = {h: counted(backward, h, "backward") for h in sorted(backward_hops)}

    def product(length: int) -> DataFrame:
        f, b = ahead[(length + 1) // 2].alias("f"), back[length // 2].alias("b")
        pairs_of_halves = F.col("f.paths").cast("decimal(19,0)") * F.col("b.paths")
        signed = F.when(F.col("f.accounts") % 2 == 1, -pairs_of_halves).otherwise(pairs_of_halves)
        same = [F.col(f"f.{c}") == F.col(f"b.{c}") for c in ("root", "meet", *shared)]
        return f.join(b, same).agg(
            F.lit(length).alias("n_accounts"),
            F.coalesce(F.sum(signed), F.lit(0)).cast("decimal(38,0)").alias("cycles"),
        )

    return _union([product(length) for length in range(min_length, max_length + 1)])


def _loops(arcs: DataFrame, ws: Workspace, max_hops: int) -> DataFrame:
    """Closed walks of 2..max_hops different transfers that meet their first account, the root, at
    both ends only; all others come after it in the account order and may repeat.

    No half path passes the root, so that a hub's partners in both directions are not multiplied.
    """

    def start(root: str, meet: str) -> DataFrame:
        return arcs.where(
            _after(F.col(f"{meet}_degree"), F.col(meet), F.col(f"{root}_degree"), F.col(root))
        ).select(
            F.col(root).alias("root"),
            F.col(f"{root}_degree").alias("root_degree"),
            F.col(meet).alias("meet"),
            F.array("id").alias("ids"),
            F.array("src").alias("sources"),
            F.lit(1).alias("hops"),
        )

    def step(p: DataFrame, forwards: bool) -> DataFrame:
        near, far = ("src", "dst") if forwards else ("dst", "src")
        put = F.array_append if forwards else F.array_prepend
        degree, node = F.col(f"a.{far}_degree"), F.col(f"a.{far}")
        return (
            p.alias("p")
            .join(
                arcs.alias("a"),
                (F.col("p.meet") == F.col(f"a.{near}"))
                & _after(degree, node, F.col("p.root_degree"), F.col("p.root"))
                & ~F.array_contains("p.ids", F.col("a.id")),
            )
            .select(
                "p.root",
                "p.root_degree",
                node.alias("meet"),
                put("p.ids", F.col("a.id")).alias("ids"),
                put("p.sources", F.col("a.src")).alias("sources"),
                (F.col("p.hops") + 1).alias("hops"),
            )
        )

    forward_hops, backward_hops = _halves(2, max_hops)
    forward = _grow(
        start("src", "dst"), lambda p: step(p, True), max(forward_hops), ws, "trail-out", None
    )
    backward = _grow(
        start("dst", "src"), lambda p: step(p, False), max(backward_hops), ws, "trail-in", None
    )
    f = _union([forward[h - 1] for h in sorted(forward_hops)]).alias("f")
    b = _union([backward[h - 1] for h in sorted(backward_hops)]).alias("b")
    return f.join(
        b,
        (F.col("f.root") == F.col("b.root"))
        & (F.col("f.meet") == F.col("b.meet"))
        & _wanted(2, max_hops)
        & ~F.arrays_overlap("f.ids", "b.ids"),
    ).select(
        F.col("f.root").alias("root"),
        F.concat("f.ids", "b.ids").alias("ids"),
        F.concat("f.sources", "b.sources").alias("sources"),
        (F.col("f.hops") + F.col("b.hops")).alias("hops"),
    )


def closed_trails(
    transfers: DataFrame, ws: Workspace, min_hops: int = 2, max_hops: int = 6
) -> DataFrame:
    """Closed walks of min_hops..max_hops different transfers; accounts may repeat.

    Every start transfer gives a row of its own.  A walk is rooted at its first account in the degree
    order and falls into loops there.  Loops are searched on their own; those of one root with
    different transfers are joined, the loop with the smallest first transfer first, so that each
    walk is found once, and rotated at the end.
    """
    if not 2 <= min_hops <= max_hops:
        raise ValueError("trail lengths must satisfy 2 <= min_hops <= max_hops")
    plain = transfers.select(
        F.col("transaction_id").alias("id"),
        F.col("source_account").alias("src"),
        F.col("target_account").alias("dst"),
    )
    plain = _narrowed(plain, "src", "dst", ws, max_hops, repeated=True)
    # Written, so that adaptive execution can split the loops of a hub.
    loops = ws.materialize(_loops(ranked_core(plain, ws), ws, max_hops), "loops")
    walks = [loops]
    while 2 * (len(walks) + 1) <= max_hops:
        w, n = walks[-1].alias("w"), loops.alias("n")
        more = w.join(
            n,
            (F.col("w.root") == F.col("n.root"))
            & (F.col("w.hops") + F.col("n.hops") <= max_hops)
            & (F.element_at("w.ids", 1) < F.element_at("n.ids", 1))
            & ~F.arrays_overlap("w.ids", "n.ids"),
        ).select(
            "w.root",
            F.concat("w.ids", "n.ids").alias("ids"),
            F.concat("w.sources", "n.sources").alias("sources"),
            (F.col("w.hops") + F.col("n.hops")).alias("hops"),
        )
        walks.append(ws.materialize(more, "walks"))
    return (
        _union(walks)
        .where(F.col("hops") >= min_hops)
        .select("*", F.explode(F.sequence(F.lit(0), F.size("ids") - 1)).alias("turn"))
        .select(
            F.size("ids").alias("n_hops"),
            paths.rotate(F.col("sources"), F.col("turn")).alias("path"),
            paths.rotate(F.col("ids"), F.col("turn")).alias("transaction_ids"),
        )
    )
