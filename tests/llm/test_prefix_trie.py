import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgermill.llm import prefix_trie as pt
from ledgermill.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, depth int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def words(node):
        return len(WORD.findall(node[-1][1])) if node else 0

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words(node) + sum(saved[k] for k in kids[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(node)))
        out.append(
            (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves[node],
             saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    nodes = pt.prefix_nodes(pt.with_shared_heads(pt.paths(df)), **options)
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(
        [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends or empty) for r in nodes.collect()],
        key=repr,
    )


def conversations(seed, n, longest, texts):
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            text = "a b" if rng.random() < 0.5 else rng.choice(texts)
            rows.append((conv, turn + 2 if turn or rng.random() < 0.8 else None, rng.choice(["user", "user", None]), text, "x", 1))
    return rows


@pytest.mark.parametrize("block", [5, 40, 50_000])
def test_nodes_match_brute_force(spark, block):
    texts = ["one", "one two", "", None, " \t", "three   words été"]
    rows = conversations(1, 120, 7, texts) + [(None, 0, "user", "of nobody", "x", 1)]
    rows += [(1000 + k, t, "user", "very common", "x", 1) for k in range(60) for t in range(3)]
    rows += [(2000, t, "user", f"turn {t // 2}", "x", 1) for t in range(90)]
    random.Random(2).shuffle(rows)
    assert found(spark, rows, block=block) == plain(rows)


def test_turnless_conversations_and_empty_tables(spark):
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(turnless, 0, "user", "short", "x", 1), (60, 5, None, None, "x", 1)]
    want = plain(rows)
    assert found(spark, rows) == want and want[-1][3] + want[0][3] > 1
    assert found(spark, [(turnless, 0, "user", "short", "x", 1)]) == [
        (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())
    ]
    assert found(spark, spark.createDataFrame([], SCHEMA)) == []


def test_extents_match_scans():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 4, 200)
    minima = pt.RangeMinima(values)
    at, least = rng.integers(0, 201, 500), rng.integers(0, 5, 500)
    for a, d, right, left in zip(at, least, minima.right(at, least), minima.left(at, least)):
        assert right == next((k for k in range(a, 200) if values[k] < d), 200)
        assert left == next((k + 1 for k in range(a - 1, -1, -1) if values[k] < d), 0)
    begin = rng.integers(0, 200, 500)
    end = begin + 1 + (rng.integers(0, 200, 500) % (200 - begin))
    assert all(m == values[a:b].min() for a, b, m in zip(begin, end, minima.least(begin, end)))


def test_query_reads_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_ranges(spark, folder)
    assert sorted([tuple(r) for r in got.select(*pt._NODE, "ends_sha256").collect()], key=repr) == plain(rows)
