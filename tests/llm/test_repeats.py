import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import repeats
from tests.llm.samples import awkward, edited, empty, frame, row, sentence


def brute(rows, length, keep_first):
    places = defaultdict(list)
    for n, r in sorted(enumerate(rows), key=lambda x: x[1][0]):
        body = (r[1] or "").encode()
        for s in range(len(body) - length + 1):
            places[body[s : s + length]].append((n, s))
    gone = [bytearray(len((r[1] or "").encode())) for r in rows]
    for found in places.values():
        for n, s in found[1:] if keep_first else found if len(found) > 1 else ():
            gone[n][s : s + length] = b"\1" * length
    out = Counter()
    for r, marks in zip(rows, gone):
        body = (r[1] or "").encode()
        rest = bytes(b for b, m in zip(body, marks) if not m)
        spans = sum(1 for k, m in enumerate(marks) if m and (k == 0 or not marks[k - 1]))
        out[r[0], len(body), sum(marks), spans, hashlib.sha256(rest).hexdigest()] += 1
    return out


def corpus():
    rows, passage = awkward(), sentence(9, 40)
    for k in range(30):
        rows.append(row(20 + k, sentence(500 + k, 30) + " " + passage + " " + sentence(900 + k, 20)))
    for k in range(4):
        rows.append(row(60 + k, sentence(77, 120)))
        rows.append(row(70 + k, edited(sentence(77, 120), k, 2)))
    rows.append(row(80, "abc" * 300))  # overlaps itself
    return rows


@pytest.mark.parametrize("length,many", [(100, 20_000), (100, 5), (400, 20_000)])
@pytest.mark.parametrize("keep_first", [False, True])
def test_digests_match_brute_force(spark, length, many, keep_first):
    rows = corpus()
    got = repeats.repeat_digests(frame(spark, rows), length=length, many=many, keep_first=keep_first).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, length, keep_first)


def test_long_texts_are_anchored_in_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH_BYTES", 700)
    data = np.frombuffer(sentence(5, 900).encode(), np.uint8)
    whole = repeats.stretches(data, np.zeros(1, np.int64), np.array([len(data)]), 100, 25)
    windows = {(int(s), int(h)) for _, a, b, _, h in zip(*whole) for s in range(a, b + 1)}
    parts = set()
    for at in range(0, len(data) - 99, 700):
        piece = data[at : at + 700 + 99]
        for _, a, b, _, h in zip(*repeats.stretches(piece, np.zeros(1, np.int64), np.array([len(piece)]), 100, 25)):
            parts |= {(at + int(s), int(h)) for s in range(a, b + 1)}
    assert parts == windows


def test_suffix_ranks_follow_suffix_order():
    data = np.frombuffer(b"banana bandana banana bandana band", np.uint8)
    rank = repeats.suffix_ranks(data, 12)
    cut = [bytes(data[k : k + 12]).ljust(12, b"\0") for k in range(len(data))]
    for a in range(len(data) - 12):
        for b in range(len(data) - 12):
            assert (rank[a] < rank[b]) == (cut[a] < cut[b]) and (rank[a] == rank[b]) == (cut[a] == cut[b])


def test_suffix_ranks_take_memory_in_proportion():
    data = np.random.default_rng(3).integers(97, 123, 400_000, dtype=np.uint8)
    data[300_000:] = data[:100_000]
    tracemalloc.start()
    rank = repeats.suffix_ranks(data, 240)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(data)
    assert (rank[300_000:399_000] == rank[:99_000]).all() and len(set(rank[:300_000].tolist())) == 300_000


@pytest.mark.parametrize("texts", [["x" * 3_000_000], ["y" * 1000] * 2000])
def test_texts_are_anchored_in_small_runs(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    sizes = [len(data) for data, *_ in repeats._parts(batch, 240)]
    assert max(sizes) < 300_000 and sum(sizes) >= sum(map(len, texts))


def test_removal_keeps_first_copies_and_columns(spark):
    passage = sentence(9, 100)
    rows = [row(1, "a " + passage), row(2, passage), row(3, "b é" + passage + "é c"), row(4, None), row(5, "short")]
    docs = frame(spark, rows)
    out = repeats.remove_repeats(docs, size="n_chars")
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[1] == (rows[0][1], len(rows[0][1]))
    assert 2 not in got and got[3][0].startswith("b é") and got[3][0].endswith("é c") and got[3][1] == len(got[3][0])
    assert got[4] == (None, None) and got[5] == ("short", 5)


def test_repeated_rows_and_empty_table(spark):
    text = sentence(4, 100)
    got = repeats.repeat_digests(frame(spark, [row(None, text), row(None, text)])).collect()
    assert [r.n_removed for r in got] == [len(text)] * 2
    assert repeats.repeat_digests(empty(spark)).collect() == []


def test_kept_text_is_one_more_column(spark):
    docs = frame(spark, [row(1, "short"), row(2, None)])
    plain, more = repeats.repeat_digests(docs), repeats.repeat_digests(docs, with_text=True)
    assert more.columns == [*plain.columns, "text"]
    assert {r.doc_id: r.text for r in more.collect()} == {1: "short", 2: ""}
