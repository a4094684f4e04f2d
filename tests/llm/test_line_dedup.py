from collections import defaultdict

import pytest

from ledgermill.llm import line_dedup
from tests.llm.samples import awkward, empty, frame, row, sentence

SPACE = "\t\n\x0b\f\r "


def norm(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least_chars=20, least_docs=3):
    docs = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            docs[norm(line)].add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")

        def gone(line):
            holders = docs[norm(line)]
            known = [d for d in holders if d is not None]
            return len(norm(line)) >= least_chars and len(holders) >= least_docs and (r[0] is None or r[0] < max(known))

        stay = [line for line in lines if not gone(line)]
        out.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def cases():
    shared = "A line that many documents share, été"
    rows = [*awkward(), row(3, "one two")]
    for k in range(30):
        own = sentence(k, 6)
        rows.append(row(20 + k, f"{own}\n  {shared.upper() if k % 2 else shared}\t\r\n\n{shared}\nshort line\n{own} {k}"))
    rows.append(row(None, f"{shared}\nonly here and not elsewhere"))
    rows.append(row(None, f"{shared}\nonly here and not elsewhere"))
    rows.append(row(25, shared))  # another text of a document
    rows.append(row(49, f"{shared}\n{shared}\nseen in two documents only"))  # the largest keeps all of its own
    rows.append(row(48, "seen in two documents only"))
    rows += [row(60, "twenty code points éé "), row(61, "twenty code points éé "), row(62, "twenty code points éé")]
    rows += [row(k, "\n".join([sentence(90, 9)] * 3)) for k in (70, 71, 72)]
    return rows


@pytest.mark.parametrize("hot", [line_dedup.HOT_SHARE, 1, 10**9])
def test_lines_match_plain_ones(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", hot)
    rows = cases()
    got = line_dedup.without_repeated_lines(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[49].n_dropped == 0 and by_id[62].n_dropped == 0 and by_id[70].text == "" and by_id[72].n_dropped == 0


def test_many_lines_of_one_text(spark):
    long = "\n".join(f"line number {k % 20000:06} of a long text" for k in range(40_000))
    rows = [row(k, long) for k in (1, 2, 3)]
    got = {r.doc_id: r for r in line_dedup.without_repeated_lines(frame(spark, rows)).collect()}
    assert got[1].n_dropped == got[2].n_dropped == 40_000 and got[1].text == "" and got[3].text == long


def test_names_that_clash_and_empty_tables(spark):
    rows = frame(spark, cases())
    named = rows.selectExpr("doc_id AS line", "text AS doc", "copy AS pos", "mark AS h1", "lang AS row1", "source AS n_lines")
    got = line_dedup.without_repeated_lines(named, key="line", text="doc").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(cases())
    assert line_dedup.without_repeated_lines(empty(spark)).collect() == []
