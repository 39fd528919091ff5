"""Each pipeline stage against a brute-force version, on the smallest tables and some odd rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_operators import brute_components, brute_mix

import corpus_pipeline
from millrace.llm import quality_classifier
from millrace.llm.common import named_words, table

SF = "/root/testdata/sf0.001"


def collect(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS)
    odd = [(5000, None, "en", "src0", None), (5001, "", None, None, 0), (5002, "some text " * 40, None, None, 400), (5002, "some text " * 40, None, None, 400)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()
    out = [collect(docs)]
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append(collect(after))
        docs = after
    return out


def test_quality(spark, stages):
    docs = spark.createDataFrame(stages[0], table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS).schema)
    ranker = quality_classifier.train(docs, table(spark, SF, "labels"))
    x = np.array([quality_classifier.features((r[1] or "").encode()) for r in stages[0]])
    assert Counter(r for r, s in zip(stages[0], ranker.score(x)) if s >= 0.3) == Counter(stages[1])
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {r[0] for r in stages[1]}
    good = [d for d, q in labels.items() if q == 1]
    assert np.mean([d in kept for d in good]) > 0.95


def test_copies(stages):
    groups = defaultdict(list)
    for r in stages[1]:
        groups[hashlib.sha256((r[1] or "").encode()).hexdigest()].append(r)
    best = [max(g, key=lambda r: r[0]) for g in groups.values()]
    assert Counter((r[0], r[1] or "") for r in stages[2]) == Counter((r[0], r[1] or "") for r in best)


def test_near_copies(stages):
    component = brute_components([(r[0], r[1]) for r in stages[2]])
    assert Counter(r[0] for r in stages[3]) == Counter(d for d, _, c in component if d == c)


def test_mix(stages):
    expected = {d: (n, taken) for d, n, _, _, taken in brute_mix([(r[0], r[1], r[3]) for r in stages[3]])}
    texts, got = {r[0]: r[1] for r in stages[3]}, defaultdict(list)
    for r in stages[4]:
        got[r[0]].append(r)
    for d, (n, taken) in expected.items():
        assert sum(len(named_words(r[1])) for r in got[d]) == taken
        whole = [r for r in got[d] if r[1] == texts[d]]
        assert len(whole) == (taken // n if n else 0)
        assert all(named_words(texts[d])[: len(named_words(r[1]))] == named_words(r[1]) for r in got[d])


def test_packing(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in stages[4]:
        ids = np.append(np.array(tok.encode(r[1], add_special_tokens=False).ids, "<u4"), np.uint32(2)).astype("<u4")
        want[(r[0], len(ids))] += len(ids)
    got = Counter()
    for doc, _, length, _, tokens, _, _ in stages[5]:
        got[(doc, tokens)] += length
    assert got == want


LONG = " ".join(f"w{i}" for i in range(60_000))
ODD = [
    (None, "one two three four five six seven eight nine ten eleven twelve", "en", "s", 60, "x", "x"),
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen", "en", "s", 69, "x", "x"),
    (7, "one two three four five six seven eight nine ten eleven twelve fourteen", "en", "s", 69, "x", "x"),
    (7, "quite another text under the same id", "en", None, 36, "x", "x"),
    (7, "quite another text under the same id", "en", None, 36, "x", "x"),
    (8, None, None, None, None, "x", "x"),
    (9, "", "de", "t", 0, "x", "x"),
    (10, LONG, "en", "t", len(LONG), "x", "x"),
    (11, LONG + " end", "en", "t", len(LONG) + 4, "x", "x"),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_on_odd_rows(spark, rows):
    """Rows without ids, ids of several texts, long texts, extra columns with names used inside, and no rows at all."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size string")
    stage = dict(corpus_pipeline.STAGES)
    text = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    kept = stage["quality classifier"](spark, docs, SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS) and set(text(kept)) <= {r[:2] for r in rows}
    unique = stage["exact dedup"](spark, docs, SF)
    # a null text equals the empty one, and of these the larger id stays
    assert text(unique) == Counter({r[:2]: 1 for r in rows if r[0] != 8})
    assert text(stage["n-gram Jaccard join"](spark, unique, SF)) == Counter({r[:2]: 1 for r in rows if r[0] in (7, 9, 10)})
    mixed = stage["mixing sources to target weights"](spark, docs, SF)
    assert mixed.columns == list(corpus_pipeline.COLUMNS) and all(r["text"] for r in mixed.collect())
    pieces = stage["packing"](spark, docs, SF).collect()
    assert len({(r["doc_id"], r["doc_tokens"]) for r in pieces}) == len({r[:2] for r in rows})
    assert sum(r["start"] == 0 for r in pieces) == len(rows)


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
