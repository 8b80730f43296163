"""Plain Python answers for small graphs."""

from itertools import product


def simple_cycles(pairs, low, high):
    out = {}
    for s, d in set(pairs):
        out.setdefault(s, set()).add(d)
    found = set()

    def walk(path):
        for nxt in out.get(path[-1], ()):
            if nxt == path[0] and low <= len(path) <= high:
                found.add(tuple(path))
            if nxt > path[0] and nxt not in path and len(path) < high:
                walk(path + [nxt])

    for start in out:
        walk([start])
    return found


def closed_trails(edges, low, high):
    """edges: (id, source, target); every rotation is a trail of its own."""
    found = set()

    def walk(used, nodes):
        if nodes[-1] == nodes[0] and low <= len(used) <= high:
            found.add((tuple(used), tuple(nodes[:-1])))
        if len(used) < high:
            for name, s, d in edges:
                if s == nodes[-1] and name not in used:
                    walk(used + [name], nodes + [d])

    for name, s, d in edges:
        if s != d:
            walk([name], [s, d])
    return found


def motif_rows(edges, length):
    """edges: (source, target, amount, time); one row per choice of transfers."""
    by_pair = {}
    for s, d, amount, time in set(edges):
        by_pair.setdefault((s, d), []).append((time, amount))
    rows = []
    for path in simple_cycles([(s, d) for s, d, *_ in edges if s != d], length, length):
        hops = [by_pair[(path[i], path[(i + 1) % length])] for i in range(length)]
        for choice in product(*hops):
            rows.append((" -> ".join(path + path[:1]), tuple(choice)))
    return sorted(rows)
