"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib

from murmura.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, n int, key string, place string, node int, prior string"


def sorted_turns(rows):
    turns = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns.setdefault(conv, []).append((role or "", text or ""))
    return turns


def mod(a, b):
    return a - int(a / b) * b


def rebuild(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - mod(c, 5), [])[:h] + own[h:]
    return out


def brute(turns):
    nodes = {}
    for c, seq in turns.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    own = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in nodes.items()}
    rows = []
    for p, m in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(r[: len(q)] == q and len(r) == len(q) + 1 for r in under)]
        ends = sorted(c for c in m if len(turns[c]) == len(p))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[p[:-1]]) if p else None
        rows.append((min(m), len(p), parent, len(m), len(children), len(leaves), sum(own[q] for q in under), digest))
    return sorted(rows, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def drawn(n, longest, seed):
    r = random.Random(seed)
    rows = []
    for c in range(-n // 3, n):
        if r.random() < 0.8:
            for t in range(r.randint(1, longest)):
                text = r.choice(["a", "b"]) if t < 6 or r.random() < 0.03 else "é" * (t % 3)
                rows.append((c, t or None, r.choice(["u", "u", None]) if t < 2 else "u", text))
    return rows


def test_rebuilt_trie(spark):
    rows = drawn(60, 9, 1) + [(None, 1, "u", "lost")]
    assert got(prefixes.trie_of_rebuilt(frame(spark, rows))) == brute(rebuild(sorted_turns(rows)))


def test_blocks_and_unbranched_paths(spark):
    """Blocks of two and three columns; copies, single conversations, and branches far down."""
    rows = drawn(25, 14, 2)
    trunk = [("u", f"t{i}") for i in range(16)]
    for c in range(200, 212):  # a trunk that forks late, with copies
        seq = trunk[: 16 - c % 3] + [("a", str(c % 4))] * (c % 2 + 1)
        rows += [(c, i, *t) for i, t in enumerate(seq)]
    rows += [(300 + k, i, "u", f"alone{i}") for k in range(2) for i in range(40)]
    want = brute(sorted_turns(rows))
    assert got(prefixes.trie_of(frame(spark, rows), first=2, further=3)) == want
    assert got(prefixes.trie_of(frame(spark, rows))) == want


def test_awkward_rows(spark):
    repeated = [(7, 1, "u", "x")] * 30 + [(8, None, None, None), (8, None, None, None), (8, 0, "", "")]
    assert got(prefixes.trie_of(frame(spark, repeated), first=4, further=4)) == brute(sorted_turns(repeated))
    assert prefixes.trie_of(frame(spark, [])).count() == 0
    alone = [(3, 5, "u", "y" * 300_000)]  # loses its turn to an absent conversation 0, and is a member of the root
    assert got(prefixes.trie_of_rebuilt(frame(spark, alone))) == brute(rebuild(sorted_turns(alone)))


def test_many_ends_of_one_node(spark):
    """Ids that end at one node over many pieces are hashed in order."""
    rows = spark.range(-500, 20_000).selectExpr("unhex('00') as node", "id as conv_id").repartition(7)
    rows = rows.unionAll(spark.createDataFrame([(b"\x01", 5)], rows.schema))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {bytes(r.node): r.ends_sha256 for r in prefixes._ends(rows).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    many = ",".join(map(str, range(-500, 20_000)))
    assert got == {b"\x00": hashlib.sha256(many.encode()).hexdigest(), b"\x01": hashlib.sha256(b"5").hexdigest()}
