import re
from collections import Counter, defaultdict

from ledgermill.llm import line_quality
from tests.llm.samples import awkward, empty, frame, row, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, line_docs, share, left_share):
    def norm(line):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in line)
        return tuple(WORD.findall(folded))

    texts, docs = defaultdict(set), defaultdict(set)
    for r in rows:
        texts[r[3]].add(r[1] or "")
        for line in (r[1] or "").split("\n"):
            if WORD.search(line):
                docs[r[3], norm(line)].add(r[1])
    out = Counter()
    for r in rows:
        text = r[1] or ""
        words = WORD.findall(text)
        threes = Counter(zip(words, words[1:], words[2:]))
        again = set()
        for k in range(len(words) - 2):
            if threes[tuple(words[k : k + 3])] > 1:
                again |= {k, k + 1, k + 2}
        seen, dup, left = set(), 0, 0
        for line in text.split("\n"):
            if not WORD.search(line):
                continue
            dup += line in seen
            seen.add(line)
            n = len(docs[r[3], norm(line)])
            if not (n > line_docs and n > share * len(texts[r[3]])):
                left += sum(map(len, WORD.findall(line)))
        chars = sum(map(len, words))
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out[r[0], len(words), chars, symbols, dup, len(again), failed, left, not failed and left >= left_share * chars] += 1
    return out


def test_figures_and_verdicts_match_plain_ones(spark):
    rows = awkward() + [row(3, "one two"), row(10, "a b c a b c\n" * 30), row(11, "Top 12\nTop 12\n top\t12 \n")]
    for k in range(40):
        lines = ["Read More 1%d" % (k % 7), sentence(k, 30), sentence(k + 300, 30)]
        if k % 4 == 0:
            lines = [sentence(7, 80), sentence(8, 80), sentence(k, 4)]
        rows.append(row(20 + k, "\n".join(lines), source="a" if k % 3 else None))
    got = line_quality.line_quality(frame(spark, rows), line_docs=4, line_share=0.05, left_share=0.3)
    want = plain(rows, 4, 0.05, 0.3)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {k[-1] for k in want} == {True, False} and any(not k[6] and not k[-1] for k in want)


def test_copies_do_not_make_lines_common(spark):
    text = "\n".join(sentence(k, 30) for k in range(3))
    rows = [row(k, text) for k in range(200)]
    assert all(r.kept for r in line_quality.line_quality(frame(spark, rows)).collect())


def test_empty_table(spark):
    assert line_quality.line_quality(empty(spark)).collect() == []


def test_texts_lose_their_common_lines(spark):
    def norm(line):
        return tuple(WORD.findall("".join("0" if c in "0123456789" else c.lower() for c in line)))

    rows = awkward()
    for k in range(40):
        own = sentence(k, 8) + " été 😀"
        rows.append(row(20 + 3 * k, f"Read More 1{k % 7}\n\n{own}\nSubscribe now"))
        rows.append(row(21 + 3 * k, f"{own}\r\nread   more 22\nSUBSCRIBE NOW\n" if k % 2 else "Read more 12\nSubscribe now"))
        rows.append(row(22 + 3 * k, f"{own}\n\nSubscribe now\n\n", source="b" if k % 2 else None))
    rows.append(row(500, "Subscribe now"))
    docs = defaultdict(set)
    texts = defaultdict(set)
    for r in rows:
        texts[r[3]].add(r[1] or "")
        for line in (r[1] or "").split("\n"):
            docs[r[3], norm(line)].add(r[1])
    want = {}
    for r in rows:
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if not norm(x) or not (len(docs[r[3], norm(x)]) > 6 and len(docs[r[3], norm(x)]) > 0.05 * len(texts[r[3]]))]
        want[r[0]] = "\n".join(stay)
    got = line_quality.without_common_lines(frame(spark, rows), line_docs=6, line_share=0.05).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert want[20] == "\n" + sentence(0, 8) + " été 😀" and want[500] == ""
    assert all(r.left_chars == sum(map(len, WORD.findall(want[r.doc_id]))) for r in got)
