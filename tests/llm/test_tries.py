import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import spaced
from flowsift.llm import tries
from flowsift.llm.tries import Forest, common_turns, conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n bigint, path string, words int, key string, depth int, pos int"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    tie = lambda t: (t[0], t[1], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest())
    own = {c: [t[2:] for t in sorted(ts, key=tie)] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - int(np.fmod(c, 20)), [])[: h[c]] + ts[h[c] :] for c, ts in own.items()}


def brute(rows, rebuild=True):
    """Every prefix of every conversation, and sums over all prefixes that extend it."""
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(spaced(p[-1][1])) if p else 0
    out = Counter()
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out[(min(cs), len(p), parent, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "p", 2, "k", 3, 4) for r in rows], SCHEMA).repartition(5)
    return Counter(map(tuple, conversation_trie(docs).collect()))


def talks(rng, n, kinds, longest):
    """Conversations of few different turns, so that prefixes are shared at many depths."""
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None]) if kinds > 2 else "user", "ab cd " * rng.randrange(kinds)))
    return rows


@pytest.fixture(params=[150, 1 << 19], ids=["many tasks", "few tasks"])
def per_task(request, monkeypatch):
    monkeypatch.setattr(tries, "MOST_BYTES", request.param)


@pytest.mark.parametrize("n, kinds, longest", [(150, 2, 9), (200, 4, 6)])
def test_equals_brute_force(spark, per_task, n, kinds, longest):
    rows = talks(random.Random(n), n, kinds, longest)
    assert found(spark, rows) == brute(rows)


def test_copies_prefixes_and_long_conversations(spark, per_task):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 80) for t in range(c % 7)]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 260) for t in range(5)]
    rows += [(300, t, "user", f"turn {t}" if t < 250 else f"word {t}") for t in range(400)]
    rows += [(301, t, "user", f"turn {t}") for t in range(500)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 0, "user", "x y"), (0, None, "user", ""), (0, 0, "user", "x y"), (1, 5, "a", "bc"), (2, 5, "ab", "c"),
        (3, 1, "user", None), (23, 0, "user", "alone"), (-7, 0, "user", "below zero"), (None, 0, "user", "nobody"), (41, 0, "u", "w " * 50_000),
        (41, 1, "u", "z"), (42, 1, "u", "  é \n"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == Counter()
    assert found(spark, [(23, 0, "user", "dropped")]) == brute([(23, 0, "user", "dropped")])


def test_common_turns():
    a, b, c = (bytes([i]) * 16 for i in range(3))
    paths = [b"", a, a + b, a + b + c * 9, a + b + c * 12, a + c, b]
    assert common_turns(paths).tolist() == [0, 0, 1, 2, 11, 1, 0]


def test_merges_make_branching_nodes():
    forest = Forest(np.array([2, 3, 3, 2]), np.array([0, 1, 2, 0]))
    assert forest.depth[4:] == [2, 1, 0]
    assert forest.parent == [5, 4, 4, 6, 5, 6, -1]
    assert (forest.first[5], forest.last[5]) == (0, 2)


def test_query_equals_sql(spark, sf, oracle):
    from flowsift.llm.catalog import ORACLES, QUERIES

    name = "op12_prefix_trie"
    got = QUERIES[name](spark, sf).toArrow()
    want = oracle.execute(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert Counter(zip(*got.to_pydict().values())) == Counter(zip(*want.select(got.column_names).to_pydict().values()))
