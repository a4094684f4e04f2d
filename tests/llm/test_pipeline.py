import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ledgermill.llm import mixing
from tests.llm.test_jaccard import brute as near_classes
from tests.llm.test_mixing import copies

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard_join", "suffix_dedup", "mixing", "bpe"]
    seen, at = {}, docs
    for name, function in corpus_pipeline.STAGES[:4]:
        at = spark.createDataFrame(function(spark, at, SF).collect(), docs.schema)
        assert at.columns == docs.columns
        seen[name] = at.collect()
    assert len(seen["language_id"]) >= 0.98 * docs.count()
    classes, _, _ = near_classes([tuple(r) for r in seen["language_id"]])
    assert sorted(r.doc_id for r in seen["jaccard_join"]) == sorted(i for i, (c, _) in classes.items() if c == i)
    first = {}
    for r in sorted(seen["jaccard_join"]):
        body, keep, gone = r.text.encode(), [], 0
        covered = bytearray(len(body))
        for s in range(len(body) - corpus_pipeline.REPEAT_BYTES + 1):
            if first.setdefault(body[s : s + corpus_pipeline.REPEAT_BYTES], (r.doc_id, s)) != (r.doc_id, s):
                covered[s : s + corpus_pipeline.REPEAT_BYTES] = b"\1" * corpus_pipeline.REPEAT_BYTES
        keep = bytes(b for b, c in zip(body, covered) if not c).decode("utf-8", "ignore")
        got = [x.text for x in seen["suffix_dedup"] if x.doc_id == r.doc_id]
        assert got == ([keep] if keep else [])
    rates = {
        r.source: r.rate
        for r in mixing.rates_by_power(spark.createDataFrame(seen["suffix_dedup"], docs.schema), 0.7).collect()
    }
    want = Counter({r.doc_id: n for r in seen["suffix_dedup"] if (n := copies(rates[r.source], r.doc_id))})
    assert Counter(r.doc_id for r in seen["mixing"]) == want


def test_run_ends_in_encoded_rows(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = 0
    for r in out:
        if r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest():
            whole += 1
            assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
    assert whole > 0.5 * len(out) > 0
