import re
from collections import Counter

from ledgermill.llm import licenses
from tests.llm.samples import awkward, empty, frame, row, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        wanted = phrase.split()
        for k in range(len(words) - len(wanted) + 1):
            if words[k : k + len(wanted)] == wanted:
                places.append(k)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)))


def test_base_places_match_brute_force(spark):
    rows = awkward() + [
        row(3, "one two"),
        row(20, "cc by cc-by, CC BY! ccby c c by cc  by"),
        row(21, "GNU General Public License\nAll rights\treserved. all rights reserve"),
        row(22, "Kelvin K CCİ BY all rİghts reserved ÉtÉ cc_by"),
        row(23, " ".join(["cc by"] * 500)),
        row(24, "cc"),
        row(25, "general public licensé general public license"),
    ]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    want = Counter((r[0], *base(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 for r in got)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_spans_survive_inserted_and_changed_words(spark):
    grant = dict((label, text) for text, label in licenses.TEMPLATES if len(text.split()) > 20)["mit"]
    words = grant.split()
    before, after = sentence(1, 30), sentence(2, 30)
    rows = [
        row(1, f"{before} {grant} {after}"),
        row(2, f"{before} {' '.join(words[:12] + ['really'] + words[12:20] + words[21:])} {after}"),
        row(3, f"{before} {' '.join(words[:6])} {after} {' '.join(words[6:12])}"),
        row(4, "Permission is hereby granted, free of charge, to any person " + before),
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0
    assert [(s["first"], s["last"], s.label) for s in got[1].spans] == [(30, 30 + len(words) - 1, "mit")]
    assert got[2].labels == "mit" and 0.7 <= got[2].score < 1.0
    assert got[3].labels == got[4].labels == "" and 0 < got[4].score < 0.7


def test_plan_runs_no_python(spark):
    plan = licenses.scan_licenses(frame(spark, awkward()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert licenses.scan_licenses(empty(spark)).collect() == []
