import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgermill.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, h1 string, blank int"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def dealt(rows):
    """Rows after damage, with the first conversation ids of all."""
    out = []
    for conv, turn, role, text, *_ in rows:
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(named.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def plain(rows):
    """Figures of one conversation's rows by a table of least costs and edit strings over all suffixes."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    counts, seen, facts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), set(), []
    for k, (_, _, role, text) in enumerate(rows):
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        if k and rows[k - 1][2][:1] + role[:1] not in ("su", "ua", "au"):
            counts["illegal"] += 1
        facts.append((role[:1], fault in ("blank", "duplicate"), 5 if fault == "truncated" else 0))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lead = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {q: (0, "", ()) for q in ("", "a")}
    for k in range(len(facts), -1, -1):
        if k < len(facts):
            initial, forced, more = facts[k]
            _, _, role, text = rows[k]
            here = {}
            for q in lead:
                ways = [(2, "D", None, q)]
                if not forced:
                    to = "a" if q == "u" else "u"
                    ways.append((1 + more, "R", {"u": "user", "a": "assistant"}[to] + ":" + text, to))
                    if initial in lead[q]:
                        ways.append((more, "K", role + ":" + text, initial))
                ways = [(c + best[t][0], e + best[t][1], (() if w is None else (w,)) + best[t][2]) for c, e, w, t in ways if t in best]
                here[q] = min(ways) if ways else None
            best = {q: v for q, v in here.items() if v}
        for _ in range(3):
            for q in lead:
                to = "a" if q == "u" else "u"
                if to in best:
                    way = (5 + best[to][0], "I" + best[to][1], ({"u": "user:", "a": "assistant:"}[to], *best[to][2]))
                    best[q] = min(best.get(q, way), way)
    cost, audit, lines = best[""]
    return (gaps, *counts.values(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n, longest=12):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        role = rng.choice(["system", "user", "user"])
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["Well, yes.", "No!", "Why?", "never ends", " \t\r\n", "", "Tail. \n", "É.", "same text.", f"own {turn} {conv}."])
            if rng.random() < 0.2:
                role = rng.choice(["system", "user", "assistant", "tool", "", None, "User"])
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3]), role, text if rng.random() < 0.95 else None, "x", 1))
            role = {"user": "assistant"}.get(role, "user")
    rows += [(None, 0, "user", "Nobody's.", "x", 1), (None, None, "assistant", "Really.", "x", 1)]
    return rows


def figures(found):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in found.collect()}


def expected(rows, hurt=True):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]]
    for r in dealt(rows) if hurt else [(c, t, " " if x is None else x, " " if y is None else y) for c, t, x, y, *_ in rows]:
        groups[r[0]].append(r)
    return {c: plain(g) for c, g in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_match_brute_force(spark, seed):
    rows = conversations(seed, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    assert figures(repair.repair_figures(df)) == expected(rows, False)
    want = expected(rows)
    assert figures(repair.repair_figures(repair.damaged(df))) == want
    assert {k for w in want.values() for k in w[6]} == set("KRD")  # deleting a neighbour is always cheaper than inserting


def test_texts_wait_in_files_and_long_conversations_end(spark, monkeypatch):
    rows = [(1, t, ["user", "assistant"][t % 7 % 2], f"turn {t}{'.' if t % 5 else ''}", "x", 1) for t in range(3000)]
    rows += [(2, t, "system", "Once.", "x", 1) for t in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(repair, "SPOOL_BYTES", 1000)
    assert figures(repair.repair_figures(df)) == expected(rows, False)


def test_turns_are_lawful_and_give_the_digest(spark):
    df = spark.createDataFrame(conversations(5, 100), SCHEMA)
    found = figures(repair.repair_figures(df))
    turns = defaultdict(list)
    for r in sorted(repair.repaired_turns(df).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.at)):
        turns[r.conv_id].append(r)
        assert r.edit in "KRI" and (r.edit != "I" or r.text == "")
    for conv, wanted in found.items():
        roles = "".join(r.role[:1] for r in turns[conv])
        assert re.fullmatch("(s?(ua)+)?", roles)
        lines = "\n".join(f"{r.role}:{r.text}" for r in turns[conv])
        assert hashlib.sha256(lines.encode()).hexdigest() == wanted[-1]
        assert "".join(r.edit for r in turns[conv]) == wanted[-2].replace("D", "")


def test_prices_are_dual_and_exact():
    rng = random.Random(3)
    for _ in range(200):
        rows = repair.Rows()
        for _ in range(rng.randint(0, 70)):
            rows.add(rng.choice("suatx"), rng.random() < 0.2, rng.random() < 0.2)
        price = repair.auction_prices(rows)
        least = [0] * len(price)
        for node in range(len(price) - 2, -1, -1):
            assert all(price[node] <= cost + price[to] for cost, to, _ in rows.arcs(node))
        far = 10**9
        least = [far] * (len(price) - 1) + [0]
        for _ in range(3):
            for node in range(len(price) - 2, -1, -1):
                least[node] = min([least[node], *[cost + least[to] for cost, to, _ in rows.arcs(node)]])
        assert price[0] == least[0]


def test_empty_table_and_dropped_conversations(spark):
    assert repair.repair_figures(spark.createDataFrame([], SCHEMA)).collect() == []
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Gone.", "x", 1)], SCHEMA)
    assert figures(repair.repair_figures(repair.damaged(df))) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_reads_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert figures(queries.op11_auction_repair(spark, folder)) == expected(rows)
